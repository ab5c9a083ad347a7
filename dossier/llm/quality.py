"""Quality: histogram gradient-boosted trees over document statistics.

statistics() turns texts into numbers: lengths, shares of kinds of characters, of words and of lines, repetition. Trees are
grown level by level on histograms: each statistic is cut at quantiles of the sample into BINS bins, sums of gradients and
curvatures by node and bin come from one count, and the best cut of a node is read from their running sums. The trees are
then flattened into arrays of statistic, cut, children and value; a leaf is its own child, so a batch of documents goes
down all trees at once, DEPTH steps of indexing without a branch.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .wordhash import SPACE, batches, byte_class, encode, hash_spans, mix, spans

#: Bound of the training sample: documents of each label.
PER_LABEL = 2000
BINS, TREES, DEPTH, RATE, RIDGE, LEAST_CURVATURE = 64, 80, 4, 0.2, 1.0, 3.0
FOLDS, HELD_OUT = 3, 1

_UPPER, _LOWER_CASE, _DIGIT = byte_class((0x41, 0x5A)), byte_class((0x61, 0x7A)), byte_class((0x30, 0x39))
_STOP = np.zeros(256, bool)
_STOP[np.frombuffer(b".,;:!?", np.uint8)] = True
_QUOTE = np.zeros(256, bool)
_QUOTE[np.frombuffer(b"'\"()-", np.uint8)] = True
_SYMBOL = byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)) & ~_STOP & ~_QUOTE
_WIDE, _LATER = byte_class((0x80, 0xFF)), byte_class((0x80, 0xBF))
_NEWLINE = byte_class((0x0A, 0x0A))
NAMES = (
    "log_points log_words word_bytes word_spread longest_word distinct_words top_word distinct_pairs repeated_next upper lower digit stop quote symbol wide control "
    "words_of_letters words_ending_in_stop words_with_symbol one_byte_words words_from_capital words_of_capitals log_lines words_per_line distinct_lines"
).split()


def _groups(doc: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the values of each document: how many differ, and how often the most frequent one occurs."""
    if not len(value):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((value, doc))
    d, v = doc[order], value[order]
    new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (v[1:] != v[:-1])]))
    most = np.zeros(n)
    np.maximum.at(most, d[new], np.diff(new, append=len(d)).astype(float))
    return np.bincount(d[new], minlength=n).astype(float), most


def _table(part: list[bytes]) -> np.ndarray:
    n = len(part)
    buf = np.frombuffer(b"\n".join(part) + b"\n", np.uint8)
    at = np.zeros(n + 1, np.int64)
    np.cumsum([len(x) + 1 for x in part], out=at[1:])

    def held(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(buf) + 1, np.int64)
        np.cumsum(mask[buf], out=total[1:])
        return total

    def by_doc(total: np.ndarray) -> np.ndarray:
        return np.diff(total[at]).astype(float)

    upper, lower, symbol = held(_UPPER), held(_LOWER_CASE), held(_SYMBOL)
    wide = held(_WIDE)
    points = np.diff(at) - 1 - by_doc(held(_LATER))
    starts, ends = spans(buf, SPACE)
    doc = np.searchsorted(at, starts, "right") - 1
    size = (ends - starts).astype(float)

    def mean(x: np.ndarray, of: np.ndarray = doc, weight: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(of, x, minlength=n) / np.maximum(1, np.bincount(of, minlength=n) if weight is None else weight)

    inside = lambda total: total[ends] - total[starts]
    n_words, word = np.bincount(doc, minlength=n).astype(float), hash_spans(buf, starts, ends)
    distinct, top = _groups(doc, word, n)
    same = doc[1:] == doc[:-1]
    pairs, _ = _groups(doc[1:][same], mix(word[:-1] * np.uint64(3) + word[1:])[same], n)
    longest = np.zeros(n)
    np.maximum.at(longest, doc, size)
    w_bytes = mean(size)
    line_from, line_to = spans(buf, _NEWLINE)
    line_doc = np.searchsorted(at, line_from, "right") - 1
    lines = np.bincount(line_doc, minlength=n).astype(float)
    of_points, of_words = np.maximum(1, points), np.maximum(1, n_words)
    columns = [
        np.log1p(points), np.log1p(n_words), w_bytes, np.sqrt(np.maximum(0, mean(size * size) - w_bytes**2)), np.log1p(longest), distinct / of_words, top / of_words,
        pairs / np.maximum(1, n_words - 1), mean((word[1:] == word[:-1])[same].astype(float), doc[1:][same], of_words),
        by_doc(upper) / of_points, by_doc(lower) / of_points, by_doc(held(_DIGIT)) / of_points, by_doc(held(_STOP)) / of_points, by_doc(held(_QUOTE)) / of_points, by_doc(symbol) / of_points,
        (points - (by_doc(held(~_WIDE)) - 1)) / of_points, np.maximum(0, by_doc(held(byte_class((0, 0x1F), (0x7F, 0x7F)) & ~SPACE))) / of_points,
        mean((inside(upper) + inside(lower) + inside(wide) == size).astype(float)), mean(_STOP[buf[ends - 1]].astype(float)), mean((inside(symbol) > 0).astype(float)), mean((size == 1).astype(float)),
        mean(_UPPER[buf[starts]].astype(float)), mean(((inside(upper) > 1) & (inside(lower) == 0)).astype(float)),
        np.log1p(lines), n_words / np.maximum(1, lines), _groups(line_doc, hash_spans(buf, line_from, line_to), n)[0] / np.maximum(1, lines),
    ]
    return np.stack(columns, 1)


def statistics(texts: list[str | None]) -> np.ndarray:
    """A row of NAMES for each text, a null text as an empty one; each depends on its own text only."""
    out = [_table(part) for _, _, part in batches(texts)]
    return np.concatenate(out) if out else np.zeros((0, len(NAMES)))


@dataclass
class Trees:
    """Trees flattened into arrays; documents go left where statistic <= cut. value: what a leaf adds to the logit."""

    base: float = 0.0
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    statistic: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def logits(self, x: np.ndarray) -> np.ndarray:
        node = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            node = np.where(x[row, self.statistic[node]] <= self.cut[node], self.left[node], self.right[node])
        return self.base + self.value[node].sum(1)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """0 to 1 for each text."""
        x = statistics(texts)
        out = [1 / (1 + np.exp(-np.clip(self.logits(x[k : k + 4096]), -40, 40))) for k in range(0, len(x), 4096)]
        return np.concatenate(out) if out else np.zeros(0)


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """Trees boosted on the logistic loss of labels y (0 and 1). Without both labels there are no trees: the score is the label there is, or 0.5."""
    if not len(y) or y.min() == y.max():
        return Trees(base=0.0 if not len(y) else 40.0 * (2 * float(y[0]) - 1))
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for k in range(x.shape[1])]
    code = np.stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)], 1)  # bin b: cuts[b - 1] < x <= cuts[b]
    n, width = x.shape
    share = float(np.average(y, weights=weight))
    base = float(np.log(share / (1 - share)))
    logit, nodes, roots = np.full(n, base), [], []  # a node: [statistic, cut, left, right, value]
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-logit))
        g, h = weight * (y - p), weight * p * (1 - p)
        roots.append(len(nodes))
        nodes.append([0, 0.0, len(nodes), len(nodes), 0.0])
        at = np.full(n, roots[-1])
        open_ = [roots[-1]]
        for depth in range(DEPTH + 1):
            place = np.full(len(nodes), -1)
            place[open_] = np.arange(len(open_))
            live = np.flatnonzero(place[at] >= 0)
            here, m = place[at[live]], len(open_)
            sums = [np.bincount(here, v[live], m) for v in (g, h)]
            for k, node in enumerate(open_):
                nodes[node][4] = RATE * sums[0][k] / (sums[1][k] + RIDGE)
            if depth == DEPTH:
                break
            key = ((here[:, None] * width + np.arange(width)) * BINS + code[live]).ravel()
            gl, hl = (np.cumsum(np.bincount(key, np.repeat(v[live], width), m * width * BINS).reshape(m, width, BINS), 2) for v in (g, h))
            gr, hr = sums[0][:, None, None] - gl, sums[1][:, None, None] - hl
            gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - (sums[0] ** 2 / (sums[1] + RIDGE))[:, None, None]
            gain[(hl < LEAST_CURVATURE) | (hr < LEAST_CURVATURE)] = 0
            best = gain.reshape(m, -1).argmax(1)
            goes, bin_, splits = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, bool)
            child, open_next = np.zeros((m, 2), np.int64), []
            for k, node in enumerate(open_):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] <= 1e-6 or b >= len(cuts[f]):
                    continue
                child[k] = len(nodes), len(nodes) + 1
                nodes[node][:4] = [f, float(cuts[f][b]), *child[k].tolist()]
                nodes.extend([0, 0.0, int(c), int(c), 0.0] for c in child[k])
                open_next += child[k].tolist()
                goes[k], bin_[k], splits[k] = f, b, True
            move = live[splits[here]]
            k = place[at[move]]
            at[move] = np.where(code[move, goes[k]] <= bin_[k], child[k, 0], child[k, 1])
            open_ = open_next
            if not open_:
                break
        logit += np.array([v[4] for v in nodes[roots[-1] :]])[at - roots[-1]]
    a = list(zip(*nodes, strict=True))
    return Trees(base, np.array(roots), np.array(a[0]), np.array(a[1]), np.array(a[2]), np.array(a[3]), np.array(a[4]))


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo FOLDS; HELD_OUT isn't learned from. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


def fold_of(doc_id: int | None) -> int:
    return zlib.crc32(encode(None if doc_id is None else str(doc_id))) % FOLDS


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Trees:
    """Fitted on about per_label documents of each label at most, none held out; which ones follows a hash of the id.

    Statistics of the sample are made where its texts are read; only they go to the task that fits. Labels count by how
    many documents have them, not by the sample.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold() != HELD_OUT)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    n = {r["quality"]: r["n"] for r in usable.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, per_label / max(1, n.get(k, 0))) for k in (0, 1)}
    picked = usable.where(common.sample_share(F.when(F.col("quality") == 1, share[1]).otherwise(share[0]), "doc_id"))  # 2 * per_label rows, a little more or less

    def measure(batches_):
        for batch in batches_:
            for part in common.slices(batch):
                x = statistics(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), part.column("place"), pa.array(x.tolist(), pa.list_(pa.float64()))], ["doc_id", "quality", "place", "x"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id").select("doc_id", "quality", F.xxhash64("text").alias("place"), "text")
    sample = texts.mapInArrow(measure, "doc_id long, quality int, place long, x array<double>")

    def learn(rows: dict[str, list]) -> Trees:
        y = np.array(rows["quality"], float)
        return fit(np.array([list(v) for v in rows["x"]], float).reshape(len(y), len(NAMES)), y, np.where(y > 0, 1 / share[1], 1 / share[0]) * min(share.values()))

    return common.trained(sample, learn, ["doc_id", "place"])


def score(docs: DataFrame, labels: DataFrame | None = None, trees: Trees | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs.

    A null text counts as an empty one, which gets a score as any other. Rows with the same id are scored each by itself; of
    several labels of one id the highest counts. Without documents of both labels to learn from, the score is the one
    label, or 0.5 without any. An empty table gives no rows; columns other than doc_id and text aren't read.
    """
    model = docs.sparkSession.sparkContext.broadcast(trees or train(docs, labels))  # TREES trees of at most 2^(DEPTH + 1) nodes

    def rate(batches_):
        for batch in batches_:
            for part in common.slices(batch):
                s = model.value.scores(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rate, "doc_id long, score double, predicted int")
    return out.select("doc_id", (fold() == HELD_OUT).alias("held_out"), "score", "predicted")


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


QUERIES = {"op13_quality": op13_quality}
ORACLES: dict[str, str] = {}
