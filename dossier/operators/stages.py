"""Runs in stages that survive their driver: each stage is a table that counts once it is committed, and what was delivered is kept in a ledger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lexicons as lx
from ..functions.urls import dedup_key
from . import dedupe


class Stages:
    """Named tables below a shared folder. A table counts once its commit lies beside it, so a killed attempt is never read.

    A commit is an empty file `commits/name=attempt`, made by one call that either makes it or doesn't; rows are in `tables/name/attempt`.
    One driver works on a folder at a time. Names are letters, digits, `-` and `_`. An empty table is a table like any other.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self._path(f"{self.folder}/{folder}")
        return sorted(f.getPath().getName() for f in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def commits(self) -> dict[str, str]:
        """Each committed name with its first committed attempt."""
        return {name: attempt for name, attempt in (c.rsplit("=", 1) for c in reversed(self._names("commits")))}

    def has(self, name: str) -> bool:
        return name in self.commits()

    def read(self, *names: str) -> DataFrame | None:
        """The committed ones among these tables (all, if none is named) in one scan; None where none is committed."""
        done = self.commits()
        paths = [f"{self.folder}/tables/{n}/{done[n]}" for n in (names or sorted(done)) if n in done]
        return self.spark.read.parquet(*paths) if paths else None

    def stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table of this name. It is made and committed only where it isn't committed yet."""
        if not name or not all(c.isalnum() or c in "-_" for c in name):
            raise ValueError(f"stage name {name!r}")
        if not self.has(name):
            attempt = f"{len(self._names(f'tables/{name}')) + 1:06d}"
            make().write.mode("errorifexists").parquet(f"{self.folder}/tables/{name}/{attempt}")
            self._fs.mkdirs(self._path(f"{self.folder}/commits"))
            self._fs.createNewFile(self._path(f"{self.folder}/commits/{name}={attempt}"))
        return self.read(name)

    def sweep(self) -> int:
        """Deletes what killed attempts left; how many there were."""
        done, gone = self.commits(), 0
        for name in self._names("tables"):
            for attempt in self._names(f"tables/{name}"):
                if done.get(name) != attempt:
                    gone += self._fs.delete(self._path(f"{self.folder}/tables/{name}/{attempt}"), True)
        return gone

    def drop(self) -> None:
        self._fs.delete(self._path(self.folder), True)


def live(ledger: Stages, now: Column, days: int = lx.FINGERPRINT_DAYS) -> DataFrame | None:
    """Keys (u, ts) that the ledger's committed batches delivered less than so many days before now; None where it has no batch."""
    told = ledger.read()
    return None if told is None else told.where(now.cast("timestamp") - F.expr(f"INTERVAL '{days}' DAY") < F.col("ts"))


def undelivered(items: DataFrame, ledger: Stages, now: Column, url: str = "url", ord_: str = "ord", days: int = lx.FINGERPRINT_DAYS) -> DataFrame:
    """The first row of each key that wasn't delivered within the window, with its key `u`. Rows without an address have no key and are left out."""
    first = dedupe.first_wins(items.withColumn("u", dedup_key(url)).where("u <> ''"), "u", ord_)
    told = live(ledger, now, days)
    return first if told is None else first.join(told.select("u").distinct(), "u", "left_anti")


def deliver(run: Stages, ledger: Stages, batch: str, items: Callable[[], DataFrame], now: Column, send: Callable[[DataFrame], bool], url: str = "url", ord_: str = "ord", days: int = lx.FINGERPRINT_DAYS) -> str:
    """Sends what is new among these items and enters it in the ledger: `done`, `skipped` (nothing is new) or `failed` (nothing is entered, and it is sent again next time).

    What is sent is fixed by a commit before it is sent, and each row has `delivery_id` (batch and key). A driver that is lost after sending sends
    the very same rows again, so that a receiver that knows their ids takes none twice. A batch in the ledger is never sent again.
    """
    if ledger.has(batch):
        return "done"
    outbox = run.stage("outbox", lambda: undelivered(items(), ledger, now, url, ord_, days).withColumn("delivery_id", F.concat(F.lit(f"{batch}/"), "u")))
    if outbox.isEmpty():
        return "skipped"
    if not send(outbox):
        return "failed"
    ledger.stage(batch, lambda: outbox.select("u", now.cast("timestamp").alias("ts")))
    return "done"


def last_run(patches: DataFrame, at: str = "at") -> DataFrame:
    """One row: each field's last value that isn't null, as a status that is patched field by field, and the last moment."""
    fields = [c for c in patches.columns if c != at]
    return patches.agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(at))).alias(c) for c in fields), F.max(at).alias(at))
