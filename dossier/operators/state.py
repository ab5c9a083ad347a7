"""What has been delivered: a state of keys and days that expires, in batch and as Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import lexicons as lx
from ..functions.dates import state_day
from ..functions.text import hash31
from ..functions.urls import dedup_key


def load_seen(entries: DataFrame, url: Column, day: Column) -> DataFrame:
    """(u, t): each key with its latest day, an empty string where none is known. Nothing expires on reading."""
    return entries.select(dedup_key(url).alias("u"), state_day(day).alias("t")).where("u <> ''").groupBy("u").agg(F.max("t").alias("t"))


def merge_seen(seen: DataFrame, urls: DataFrame, today: Column, url: str = "url", days: int = lx.SEEN_DAYS) -> DataFrame:
    """The next state: entries older than the window go, undated ones get today, new keys are added."""
    cutoff = F.date_format(F.date_sub(today, days), "yyyy-MM-dd")
    now = F.date_format(today, "yyyy-MM-dd")
    old = seen.where((F.col("t") == "") | (F.col("t") >= cutoff)).select("u", F.when(F.col("t") == "", now).otherwise(F.col("t")).alias("t"))
    new = urls.select(dedup_key(url).alias("u")).where("u <> ''").distinct().join(old, "u", "left_anti").withColumn("t", now)
    return old.unionByName(new)


def fingerprints(items: DataFrame, url: str = "source_url") -> DataFrame:
    return items.select(dedup_key(url).alias("u")).where("u <> ''").distinct()


def seen_hashes(items: DataFrame, state: DataFrame, now: Column, url: str = "source_url", days: int = lx.FINGERPRINT_DAYS) -> DataFrame:
    """Fingerprints with `seen`: whether their hash is in the state (h, ts) and younger than the window."""
    live = state.where(now.cast("timestamp") - F.expr(f"INTERVAL '{days}' DAY") < F.col("ts")).select("h").distinct().withColumn("seen", F.lit(True))
    return fingerprints(items, url).withColumn("h", hash31("u")).join(live, "h", "left").withColumn("seen", F.coalesce("seen", F.lit(False)))


def all_seen(marked: DataFrame) -> DataFrame:
    """One row (is_duplicate, n_seen, n): true only if there are fingerprints and all were seen."""
    return marked.agg(F.coalesce(F.bool_and("seen"), F.lit(False)).alias("is_duplicate"), F.count(F.when(F.col("seen"), 1)).alias("n_seen"), F.count("*").alias("n"))


def mark(state: DataFrame, items: DataFrame, now: Column, url: str = "source_url", days: int = lx.FINGERPRINT_DAYS) -> DataFrame:
    """The state with today's hashes, pruned to the window."""
    new = fingerprints(items, url).select(hash31("u").alias("h"), now.cast("timestamp").alias("ts"))
    return state.select("h", "ts").unionByName(new).where(now.cast("timestamp") - F.expr(f"INTERVAL '{days}' DAY") < F.col("ts"))


def save(state: DataFrame, path: str, version: str) -> str:
    """Writes a new version beside the older ones; a reader takes the one it is told, so a failed write harms none."""
    out = f"{path.rstrip('/')}/version={version}"
    state.write.mode("overwrite").parquet(out)
    return out


def stage(df: DataFrame, path: str, date: str, batch: str) -> None:
    """One batch of a staged run, found again by its partition."""
    df.withColumn("date", F.lit(date)).withColumn("batch", F.lit(batch)).write.partitionBy("date", "batch").mode("append").parquet(path)
