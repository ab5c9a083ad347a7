"""Queries over runs in stages: pages collected in batches, judged and delivered on four days, each run interrupted and started again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import gates, stages
from ..operators.graph import cut, shared_folder
from .pages import _ARTICLES, _KEYS

#: Days of the four runs; an item is delivered again after 30 days.
DAYS = ("2026-01-01", "2026-01-21", "2026-02-10", "2026-03-02")
#: Batch b of run r holds the pages whose number leaves (r + b) % 5; this run's second batch is never collected.
LOST_BATCH = (2, 1)


class Interrupted(Exception):
    """The driver is taken away after a stage."""


def _one_run(spark: SparkSession, sf_dir: str, base: str, r: int, stop: str | None) -> str:
    """Run r from its first uncommitted stage on, or until the stage `stop` is committed."""
    run, ledger, sent = stages.Stages(spark, f"{base}/run{r}"), stages.Stages(spark, f"{base}/ledger"), stages.Stages(spark, f"{base}/sent")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")

    def collected(b: int) -> DataFrame:
        return pages.where(F.col("page_id") % 5 == (r + b) % 5).select(F.col("page_id").alias("ord"), "url", tx.article("html").alias("a")).select("ord", "url", gates.article_failure(*(F.col("a")[c] for c in ("title", "text", "has_container", "paragraphs"))).alias("reason"))

    for b in range(3):
        if (r, b) != LOST_BATCH:
            run.stage(f"batch-{b + 1}", lambda b=b: collected(b))
        if stop == f"batch-{b + 1}":
            raise Interrupted
    batches = run.read("batch-1", "batch-2", "batch-3")
    judged = run.stage("judged", lambda: batches.where("reason IS NULL").select("ord", "url"))
    if stop == "judged":
        raise Interrupted

    def send(outbox: DataFrame) -> bool:
        sent.stage(f"run{r}", lambda: outbox.select(F.lit(r).cast("long").alias("run"), F.col("ord").alias("page_id"), F.col("u").alias("key")))
        if stop == "sent":
            raise Interrupted
        return True

    return stages.deliver(run, ledger, f"run{r}", lambda: judged, F.lit(DAYS[r]), send)


def page_delivery_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What four runs deliver of all pages: each stops after another stage (a batch, the judgement, the sending, none) and goes on from its commits."""
    base = f"{shared_folder(spark)}/runs/{uuid.uuid4().hex}"
    for r, stop in enumerate(("batch-2", "judged", "sent", None)):
        try:
            _one_run(spark, sf_dir, base, r, stop)
        except Interrupted:
            _one_run(spark, sf_dir, base, r, None)
    sent = stages.Stages(spark, f"{base}/sent")
    none = spark.createDataFrame([], "run long, page_id long, key string")
    told = sent.read()
    out = cut(none if told is None else told.select(none.columns))
    stages.Stages(spark, base).drop()
    return out


QUERIES = {f.__name__: f for f in (page_delivery_runs,)}


def _run(r: int) -> str:
    """SQL of run r: what is judged good in its batches, first of each key, without what runs within 30 days before delivered."""
    lost = f" AND page_id % 5 <> {(LOST_BATCH[0] + LOST_BATCH[1]) % 5}" if r == LOST_BATCH[0] else ""
    fresh = f" AND key NOT IN (SELECT key FROM r{r - 1})" if r else ""
    return f"r{r} AS (SELECT {r}::BIGINT AS run, min(page_id) AS page_id, key FROM good WHERE (page_id % 5 + 5 - {r}) % 5 < 3{lost}{fresh} GROUP BY key)"


ORACLES = {
    "page_delivery_runs": _ARTICLES
    + ", "
    + _KEYS.strip().removeprefix("WITH ")
    + ", good AS (SELECT page_id, dedup_key AS key FROM judged JOIN keys USING (page_id) WHERE reason IS NULL), "
    + ", ".join(map(_run, range(4)))
    + " "
    + " UNION ALL ".join(f"SELECT * FROM r{r}" for r in range(4)),
}
