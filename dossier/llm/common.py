"""What the operators of this subpackage share: reading tables, sizes, hash-based sampling and checkpoints."""

from __future__ import annotations

import gc
import math
import pickle
import uuid
import zlib
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which all executors share; one of our own only where none is set, as in tests."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        import tempfile

        folder = tempfile.mkdtemp(prefix="dossier-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


#: Folders of open `steps`, the innermost last.
_OPEN: list[str] = []


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder wherever it is stored."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def steps(spark: SparkSession):
    """Steps that operators write inside are deleted at its end, for callers that have written their results by then."""
    folder = f"{shared_folder(spark)}/steps/{uuid.uuid4().hex}"
    _OPEN.append(folder)
    try:
        yield
    finally:
        _OPEN.remove(folder)
        discard(spark, folder)


def checkpointed(df: DataFrame, file_rows: int = 0) -> DataFrame:
    """df as a table written below the shared folder and read again.

    What follows starts from files that outlive any executor, reads only the columns it needs and knows their true size.
    Unlike checkpoint() this also drops what the planner has inferred about df, which in loops grows with every turn.
    The table stays, as its reader may come at any time; inside `steps` it goes with them. file_rows is the most that a
    file holds, for rows so large that a few of them fill one; 0 is as Spark does.
    """
    path = f"{_OPEN[-1] if _OPEN else shared_folder(df.sparkSession) + '/steps'}/{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """What runs inside has this value of a session setting; afterwards it is as before."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def release(spark: SparkSession) -> None:
    """Lets Spark give up what finished steps left: shuffle and checkpoint files on disk, broadcasts and compiled plans in memory.

    It does so once the driver's garbage collector meets the dead references, by itself every 30 minutes or when the heap
    is full. Operators of many steps call this between them.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts; sizes of shelves and numbers of buckets follow it."""
    return int(docs.agg(F.coalesce(F.sum(F.octet_length(column).cast("long")), F.lit(0)).alias("n")).first()["n"])


def trained(sample: DataFrame, fit, order: list[str]):
    """fit(columns by name) on a bounded sample, run in one task: neither the sample nor what training needs is held by the driver, which gets the model only.

    Rows are put in the given order first, so the same sample gives the same model however it arrives.
    """

    def run(batches):
        parts = [pdf for pdf in batches if len(pdf)]
        pdf = pd.concat(parts).sort_values(order, kind="stable") if parts else pd.DataFrame({c: [] for c in columns})
        yield pd.DataFrame({"model": [pickle.dumps(fit({c: pdf[c].tolist() for c in columns}))]})

    columns = sample.columns
    got = sample.repartition(1).mapInPandas(run, "model binary").first()
    return pickle.loads(got["model"]) if got else fit({c: [] for c in columns})


#: Bytes of text that are Python strings at once inside a task.
STRETCH = 1 << 20


def slices(batch: pa.RecordBatch, column: str = "text", size: int = STRETCH):
    """Runs of rows of a batch whose texts have about `size` bytes together, so a task's memory follows that and not the batch."""
    if not batch.num_rows:
        return
    n = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // size
    cut = np.flatnonzero(np.diff(n, prepend=-1)).tolist()
    for a, b in zip(cut, [*cut[1:], batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def rows_where(docs: DataFrame, keep, column: str = "text") -> DataFrame:
    """The rows of docs, all columns whatever their names, for which keep(texts) gives true; texts come about a megabyte at a time."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index(column)]

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                yield part.filter(pa.array(keep(part.column(text).to_pylist()), pa.bool_()))

    plain = docs.toDF(*names)
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)


def bits_for(n: int) -> int:
    return max(0, math.ceil(math.log2(max(1, n))))


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out of training. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def fold_of(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5


def sample_share(share: Column, *keys: str) -> Column:
    """True for about that share of rows, chosen by a hash of the keys: the same rows in every run."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) < share * (1 << 30)
