"""Best-fit packing: best-fit decreasing over the lengths of all pieces, with a segment tree over remaining capacities.

Best-fit decreasing depends on the multiset of lengths only, and lengths are whole numbers up to the capacity. So Spark
encodes the documents and counts pieces by length; the plan is made from these at most `capacity` counts: open bins are
kept by remaining capacity, and a segment tree over the capacities gives the tightest open bin in logarithmic time. Bins
and pieces of equal length stay together in intervals, so the plan's size follows the capacity, not the corpus. Spark then
gives each piece its rank among those of its length and joins it with the plan.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .encoder import WORD_FILE, encoder, vocabulary_path

CAPACITY = 2048
#: Groups within a length that are ranked by themselves, so no length goes to one task.
SALTS = 64
_PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity; a leaf holds the number of open bins with that much left."""

    def __init__(self, capacity: int):
        self.leaves = 1 << (capacity + 1 - 1).bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, left: int, n: int) -> None:
        i = left + self.leaves
        while i:
            self.count[i] += n
            i >>= 1

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity of at least need that an open bin has."""
        i = need + self.leaves
        if self.count[i]:
            return need
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, pieces, first bin, pieces a bin, offset of the first): best-fit decreasing of so many pieces by length."""
    tree, bins, new, out = CapacityTree(capacity), {}, 0, []
    for length in sorted((n for n in counts if counts[n] and n), reverse=True):
        rank, rest = 0, counts[length]
        while rest:
            left = tree.tightest(length)
            if left is None:  # open as many as the rest of this length fills
                left, per = capacity, capacity // length
                first, size = new, common.ceil_div(rest, per)
                new += size
            else:
                per = left // length
                first, size = bins[left].pop()
                if not bins[left]:
                    del bins[left]
                tree.add(left, -size)
            full = min(size, rest // per)
            used = [(first, full, per)] if full else []
            if full < size and rest - full * per:  # a last bin that is not filled to the end
                used.append((first + full, 1, rest - full * per))
            for at, n, k in used:
                out.append((length, rank, n * k, at, k, capacity - left))
                rank += n * k
                rest -= n * k
                bins.setdefault(left - k * length, []).append((at, n))
                tree.add(left - k * length, n)
            touched = sum(n for _, n, _ in used)
            if touched < size:
                bins.setdefault(left, []).append((first + touched, size - touched))
                tree.add(left, size - touched)
    return out


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document: its ids, then end_id, cut at capacity only where longer."""

    def encode(batches):
        e, end = encoder(path), end_id.to_bytes(4, "little")
        for batch in (part for whole in batches for part in common.slices(whole)):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = e.ids(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _PIECE.types, strict=True)], schema=_PIECE)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(encode, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece that holds end_id only; rows with the same id are packed each by itself; other
    columns take no part; an empty table gives no rows.
    """
    cut = common.checkpointed(pieces(docs, path or vocabulary_path(WORD_FILE), capacity, end_id).withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS))))
    by_salt = {(r["length"], r["salt"]): r["n"] for r in cut.groupBy("length", "salt").agg(F.count("*").alias("n")).collect()}  # capacity x SALTS rows at most
    counts: dict[int, int] = {}
    before = []
    for (length, salt), n in sorted(by_salt.items()):
        before.append((length, salt, counts.get(length, 0)))
        counts[length] = counts.get(length, 0) + n
    spark = docs.sparkSession
    base = spark.createDataFrame(before, "length long, salt long, before long")
    slots = spark.createDataFrame(plan(counts, capacity), "length long, rank0 long, n long, bin0 long, per long, at long")
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = cut.withColumn("r", F.row_number().over(order) - 1).join(F.broadcast(base), ["length", "salt"]).withColumn("rank", F.col("r") + F.col("before"))
    placed = ranked.join(F.broadcast(slots), "length").where((F.col("rank") >= F.col("rank0")) & (F.col("rank") < F.col("rank0") + F.col("n")))
    inside = F.col("rank") - F.col("rank0")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("bin0") + F.floor(inside / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("at") + (inside % F.col("per")) * F.col("length")).cast("long").alias("offset"),
    )


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"))


QUERIES = {"op10_best_fit_packing": op10_best_fit_packing}
ORACLES: dict[str, str] = {}
