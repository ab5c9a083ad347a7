"""Exact top-k search with a bit-sliced index.

Whole-number vectors are laid out in blocks. A block's index has, for each component, SLICES bitmaps over its rows: the
high bits of the component, counted from the block's least value of it. A query adds slices with bitmap arithmetic: each bit
of a query component gives a slice its weight (the complement of the slice where the component is negative), and carry-save
adders of three bitmaps to two bring all of them down to one bitmap for each bit of the sum. The k-th largest sum is then
found from the most significant slice downward. The low bits that were left out can change a score by a bounded amount only
(Cauchy-Schwarz), so all rows that may still be among the first k are read off the slices by comparison with that bound, and
just these boundary rows are scored exactly. Spark joins blocks with chunks of the query set and merges the k best of
each block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

K = 5
SLICES = 6
BLOCK, CHUNK = 32768, 256


class BitSlicedBlock:
    """The index of one block: ids, exact components, and the bitmaps of their high bits."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, slices: int = SLICES):
        self.ids, self.x, self.n = ids, x, len(ids)
        self.low = x.min(0)
        spread = int((x - self.low).max())
        self.shift = max(0, spread.bit_length() - slices)
        high = (x - self.low) >> self.shift
        rest = (x - self.low) - (high << self.shift)
        self.centre = ((1 << self.shift) - 1) / 2
        self.rest_norm = float(np.sqrt(((rest - self.centre) ** 2).sum(1).max()))
        words = common.ceil_div(self.n, 64)
        padded = np.zeros((words * 64, x.shape[1]), np.int64)
        padded[: self.n] = high
        by_component = np.ascontiguousarray(padded.T)
        self.maps = np.stack([np.packbits((by_component >> s & 1).astype(np.uint8), axis=1, bitorder="little").view(np.uint64) for s in range(slices)], 1)
        mask = np.zeros(words * 64, np.uint8)
        mask[: self.n] = 1
        self.mask = np.packbits(mask, bitorder="little").view(np.uint64)

    def sums(self, q: np.ndarray) -> list[np.ndarray]:
        """Bitmaps, least significant first, of sum(q+ * high) + sum(|q-| * (full - high))."""
        slices = self.maps.shape[1]
        levels: list[list[np.ndarray]] = []
        size = np.abs(q)
        for bit in range(int(size.max()).bit_length() if len(q) else 0):
            plus, minus = np.flatnonzero((q > 0) & (size >> bit & 1)), np.flatnonzero((q < 0) & (size >> bit & 1))
            for s in range(slices):
                while len(levels) <= bit + s:
                    levels.append([])
                levels[bit + s] += [part for part in (self.maps[plus, s], ~self.maps[minus, s]) if len(part)]
        out, i = [], 0
        while i < len(levels):
            rows = np.concatenate(levels[i]) if levels[i] else np.zeros((0, len(self.mask)), np.uint64)
            while len(rows) > 1:
                if len(rows) == 2:
                    carry, rows = rows[:1] & rows[1:], rows[:1] ^ rows[1:]
                else:
                    third = len(rows) // 3
                    a, b, c = rows[:third], rows[third : 2 * third], rows[2 * third : 3 * third]
                    half = a ^ b
                    carry, rows = (a & b) | (half & c), np.concatenate([half ^ c, rows[3 * third :]])
                if i + 1 == len(levels):
                    levels.append([])
                levels[i + 1].append(carry)
            out.append(rows[0] & self.mask if len(rows) else np.zeros_like(self.mask))
            i += 1
        return out

    def candidates(self, q: np.ndarray, k: int, skip: np.ndarray) -> np.ndarray:
        """Places of all rows that may be among the k with the highest score, without those at skip."""
        open_ = self.mask.copy()
        for i in skip.tolist():
            open_[i // 64] &= ~(np.uint64(1) << np.uint64(i % 64))
        if int(np.bitwise_count(open_).sum()) <= k:
            return self._places(open_)
        maps = self.sums(q)
        above, equal, kth = np.zeros_like(open_), open_.copy(), 0
        for i in range(len(maps) - 1, -1, -1):  # the k-th largest sum, from the most significant slice downward
            one = equal & maps[i]
            if int(np.bitwise_count(above).sum() + np.bitwise_count(one).sum()) >= k:
                equal, kth = one, kth | 1 << i
            else:
                above, equal = above | one, equal & ~maps[i]
        width = 2 * float(np.sqrt((q.astype(np.float64) ** 2).sum())) * self.rest_norm
        least = kth - int(np.ceil(width / (1 << self.shift))) - 1
        if least <= 0:
            return self._places(open_)
        above, equal = np.zeros_like(open_), open_.copy()
        for i in range(max(len(maps), least.bit_length()) - 1, -1, -1):  # sums of at least `least`
            m = maps[i] if i < len(maps) else np.zeros_like(open_)
            if least >> i & 1:
                equal = equal & m
            else:
                above, equal = above | (equal & m), equal & ~m
        return self._places(above | equal)

    def _places(self, bits: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little")[: self.n])

    def top(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(vec_id, score) of the k best rows with another id; ties go to the smaller id."""
        own = np.searchsorted(self.ids, [query_id, query_id + 1]) if query_id < np.iinfo(np.int64).max else np.array([np.searchsorted(self.ids, query_id), self.n])
        at = self.candidates(q, k, np.arange(own[0], own[1]))
        score = self.x[at] @ q
        best = np.lexsort((self.ids[at], -score))[:k]
        return list(zip(self.ids[at][best].tolist(), score[best].tolist(), strict=True))


def quantised(vectors: DataFrame, scale: int = 256, embedding: str = "embedding") -> DataFrame:
    """(vec_id, q): floor(scale * component) of each usable vector. Products of components have to sum up within 63 bits."""
    v = vectors.where(F.col("vec_id").isNotNull() & F.col(embedding).isNotNull() & (F.size(embedding) > 0))
    v = v.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(embedding, lambda x: x.cast("double")).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.where(~F.coalesce(bad, F.lit(False))).select("vec_id", F.transform("v", lambda x: F.floor(x * scale)).alias("q"))


def top_k(rows: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK, chunk: int = CHUNK, slices: int = SLICES) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query with all rows of another id.

    rows and queries are (vec_id, q). Ties go to the smaller id; fewer rows than k give them all; empty tables give none.
    Shorter vectors count as if filled up with zeros. Rows with the same id are rows each by itself, and so are queries
    (their results are then ranked together).
    """
    n_rows, dims, n_queries = rows.agg(F.count("*"), F.coalesce(F.max(F.size("q")), F.lit(1))).first() + (queries.count(),)
    n_blocks, n_chunks = max(1, common.ceil_div(n_rows, block)), max(1, common.ceil_div(n_queries, chunk))

    def stack(values) -> np.ndarray:
        out = np.zeros((len(values), dims), np.int64)
        for i, v in enumerate(values):
            out[i, : len(v)] = v
        return out

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(left) and len(right):
            left = left.sort_values("vec_id", kind="stable")
            index = BitSlicedBlock(left["vec_id"].to_numpy(), stack(left["q"].tolist()), slices)
            for query_id, q in zip(right["vec_id"].tolist(), stack(right["q"].tolist()), strict=True):
                out += [(query_id, vec_id, score) for vec_id, score in index.top(query_id, q, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    blocks = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    asked = queries.withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_chunks)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    best = blocks.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInPandas(search, "query_id long, vec_id long, score long")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op1_bsi_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quantised(common.table(spark, sf_dir, "embeddings"))
    return top_k(rows, rows.where(F.pmod(F.col("vec_id"), F.lit(50)) == 0))


QUERIES = {"op1_bsi_top_k": op1_bsi_top_k}
ORACLES = {
    "op1_bsi_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_inner_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
}
