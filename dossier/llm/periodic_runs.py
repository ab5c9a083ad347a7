"""Periodic runs of words: stretches that repeat with a short period, found by Karp-Miller-Rosenberg naming.

Words get names by document. A stretch of 2^k words is named by the pair of names of its halves, level by level, so two
stretches are equal if their names are; stretches that no other one equals need no further pairs and are left out of the
sort. How far two places agree, forward or backward, is read by descending the levels, for all pairs of places at once.

A run of period q and length L has L - q places that agree with the place q words on, and L - q is at least some multiple
of q: so each q looks at a grid of that spacing only, n / 3 * log(n) candidates in all, and extends those that agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .filter_audit import words

#: A run has LEAST_WORDS words and TIMES periods at least.
LEAST_WORDS, TIMES = 6, 4
#: Candidates looked at together.
_CHUNK = 1 << 19


def levels(kind: np.ndarray, longest: int) -> list[np.ndarray]:
    """names[k][i] of the 2^k words from place i on: equal exactly if the words are. Up to `longest` words, or until all names differ."""
    _, names, times = np.unique(kind, return_inverse=True, return_counts=True)
    out, alone, half = [names.astype(np.int32)], times[names] == 1, 1
    while 2 * half <= longest and not alone.all():
        n = len(kind) - 2 * half + 1
        names, live = out[-1], np.flatnonzero(~(alone[:n] | alone[half : half + n]))
        pairs = names[live].astype(np.int64) * (2 * len(kind)) + names[live + half]
        _, rank, times = np.unique(pairs, return_inverse=True, return_counts=True)
        fresh = np.arange(len(times), len(times) + n, dtype=np.int32)  # a name of its own for each stretch that nothing equals
        fresh[live] = rank
        alone = np.ones(n, bool)
        alone[live] = times[rank] == 1
        out.append(fresh)
        half *= 2
    return out


def agree(names: list[np.ndarray], i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
    """How many words from places i and j > i on are equal, or with `back`, how many before them."""
    x, y = i.copy(), j.copy()
    for k in reversed(range(len(names))):
        step = 1 << k
        at = np.flatnonzero(x >= step) if back else np.flatnonzero(y < len(names[k]))
        shift = step if back else 0
        at = at[names[k][x[at] - shift] == names[k][y[at] - shift]]
        x[at] += -step if back else step
        y[at] += -step if back else step
    return i - x if back else x - i


def runs_of(kind: np.ndarray, longest: int, least: int = LEAST_WORDS, times: int = TIMES) -> np.ndarray:
    """(start, length, period) of all runs, by start and period. Names of words have to differ between documents; longest: words of the longest one."""
    n, most = len(kind), longest // times
    if not most or n < least:
        return np.zeros((0, 3), np.int64)
    names, found = levels(kind, longest), []
    q = np.arange(1, most + 1)
    space = np.maximum(least, times * q) - q
    count = -(-(n - q) // space)
    block = (np.cumsum(count) - 1) // _CHUNK
    for part in np.split(np.arange(most), np.flatnonzero(np.diff(block)) + 1):
        of = np.repeat(part, count[part])
        i = (np.arange(len(of)) - np.repeat(np.cumsum(count[part]) - count[part], count[part])) * space[of]
        j = i + q[of]
        hit = names[0][i] == names[0][j]
        i, j, p = i[hit], j[hit], q[of][hit]
        start, end = i - agree(names, i, j, back=True), j + agree(names, i, j)
        good = end - start >= np.maximum(least, times * p)
        found.append(np.unique(np.stack([start, end, p], 1)[good], axis=0))
    runs = np.unique(np.concatenate(found), axis=0)  # by start, end and period
    first = np.ones(len(runs), bool)  # a stretch with several periods: the smallest divides the others
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    runs = runs[first]
    runs[:, 1] -= runs[:, 0]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _read(texts: list[bytes | None]) -> tuple[list[list[bytes]], list[np.ndarray]]:
    """The words of each text, and the runs of each text by place in it."""
    split, kinds, base = [(t or b"").split() for t in texts], [], 0
    for w in split:
        place = {x: k for k, x in enumerate(dict.fromkeys(w), base)}
        kinds.append(np.fromiter(map(place.__getitem__, w), np.int64, len(w)))
        base += len(place)
    first = np.zeros(len(split) + 1, np.int64)
    np.cumsum([len(w) for w in split], out=first[1:])
    runs = runs_of(np.concatenate(kinds) if kinds else np.zeros(0, np.int64), int(np.diff(first).max(initial=0)))
    cut = np.searchsorted(runs[:, 0], first)
    return split, [runs[a:b] - [s, 0, 0] for a, b, s in zip(cut, cut[1:], first, strict=False)]


def collapsed(w: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(w)
    depth = np.zeros(len(w) + 1, np.int32)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([w[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs, collapsed of every row of docs.

    runs: (start, length, period) of each maximal stretch of words that has LEAST_WORDS words and TIMES of its smallest
    periods at least, by start and period; collapsed: the text's words, joined by one space, without those that a run
    holds after its first period. Words are runs of anything but ASCII white space, compared as they are. Null texts and
    texts without words have no runs and collapse to ''. Rows with the same id are read each by itself, columns other than
    doc_id and text aren't read, an empty table gives no rows. Texts stay in their task: nothing is shuffled, and memory
    follows a megabyte of text, or the longest one: four bytes a word for each doubling up to its longest repeat.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def find(batches):
        for batch in batches:
            for part in common.slices(batch):
                split, runs = _read(part.column("text").to_pylist())
                flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
                offsets = np.zeros(len(runs) + 1, np.int32)
                np.cumsum([len(r) for r in runs], out=offsets[1:])
                structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
                texts = pa.array([collapsed(w, r) for w, r in zip(split, runs, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), structs).cast(kind), texts], ["doc_id", "runs", "collapsed"])

    # bytes: words of text that isn't valid UTF-8 would otherwise change on the way
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    found = source.mapInArrow(find, "doc_id long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def repeating(doc_id: Column, text: Column) -> Column:
    """The text; for one id in ten (by crc32 of the id as text, a null id as empty text), its words from some place on repeat a block of them over and over."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def again(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n).cast("int")
        times = (F.pmod(g, F.lit(8)) + 3).cast("int")
        p = (1 + F.floor((n - a) / times)).cast("int")
        block = F.slice(w, a + 1, p)
        return F.when(n > 0, F.concat_ws(" ", F.slice(F.concat(F.slice(w, F.lit(1), a), F.flatten(F.array_repeat(block, times))), F.lit(1), n))).otherwise(text)

    return F.when(h % 10 == 0, F.transform(F.array(words(F.coalesce(text, F.lit("")))), again)[0]).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(docs.withColumn("text", repeating(F.col("doc_id"), F.col("text"))))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    out = found.withColumn("longest", longest)
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        (-F.col("longest.less")).alias("length"),
        F.col("longest.period").alias("period"),
        F.expr("-1000 * longest.less div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
ORACLES: dict[str, str] = {}
