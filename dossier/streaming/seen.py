"""The delivered-item state as a stream: the same keys and window, kept by Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import lexicons as lx
from ..functions.urls import dedup_key

#: What a session needs for `delivered_stream`: its state store, and no batches without data, which under `availableNow` would never end.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def unseen_stream(events: DataFrame, url: str, at: str, days: int = lx.FINGERPRINT_DAYS) -> DataFrame:
    """Events whose key hasn't been seen within the window; state expires behind the watermark."""
    keyed = events.withColumn("u", dedup_key(url)).where("u <> ''")
    return keyed.withWatermark(at, f"{days} days").dropDuplicatesWithinWatermark(["u"])


def windowed_counts(events: DataFrame, at: str, by: str, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts by value and window; rows later than the watermark are left out."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), by).agg(F.count("*").alias("n"))


def start_memory(df: DataFrame, name: str, mode: str = "append"):
    """A query that keeps its rows in memory, for tests and small runs."""
    return df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()


class _Delivered(StatefulProcessor):
    """Keeps for each key when it was last delivered; the store forgets a key by itself once its time to live is over."""

    def __init__(self, days: float, ttl_ms: int):
        self.window, self.ttl_ms = int(days * 86_400_000_000), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "us long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        kept = self.last.get()
        last, before = (kept[0] if kept else None), (kept[0] if kept else None)
        for r in sorted(rows, key=lambda r: (r["_us"], r["_url"])):
            if last is None or r["_us"] - last >= self.window:
                last = r["_us"]
                yield Row(u=key[0], url=r["_url"], us=last)
        if last != before:
            self.last.update((last,))

    def close(self) -> None:
        pass


def delivered_stream(events: DataFrame, url: str, at: str, days: float = lx.FINGERPRINT_DAYS, ttl_ms: int | None = None) -> DataFrame:
    """(u, url, at) of items to deliver: those whose key wasn't delivered less than `days` before.

    Unlike `unseen_stream` the window starts anew with each delivery and late items are still judged. Keys expire in the state store `ttl_ms` after their
    last delivery (twice the window unless stated), so the state is bounded by what two windows deliver. Ties of time go to the smaller address;
    items without an address or a time are left out. The session needs `SETTINGS` when the stream starts.
    """
    keyed = events.select(dedup_key(url).alias("u"), F.col(url).alias("_url"), F.unix_micros(F.col(at).cast("timestamp")).alias("_us")).where("u <> '' AND _us IS NOT NULL")
    ttl = ttl_ms if ttl_ms is not None else int(2 * days * 86_400_000)
    told = keyed.groupBy("u").transformWithState(statefulProcessor=_Delivered(days, ttl), outputStructType="u string, url string, us long", outputMode="append", timeMode="ProcessingTime")
    return told.select("u", "url", F.timestamp_micros("us").alias("at"))
