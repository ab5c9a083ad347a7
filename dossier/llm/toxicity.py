"""Toxicity: a bidirectional gated recurrent network with attention pooling over word and character inputs, in numpy.

A word's input is its own vector (hashed) beside the mean of the vectors of its character n-grams (hashed as well), so forms
that weren't seen are judged by their letters. Words and n-grams of fewer than LEAST documents of the sample have no vector.
Long words are read piece by piece with all their n-grams. Windows of WINDOW words, each beginning STRIDE words after the
one before, cover every text. Two gated recurrent units read a window from both ends; attention weighs their states into one
vector, a linear layer gives the window's logit. A document's score is the logistic of a line fitted to its highest logit.

Training uses a bounded sample of labelled documents. The first round learns from random windows; later ones from the
window of each document that the network now finds worst, as a document is toxic if one of its windows is.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .wordhash import _LOWER, NOT_WORD, batches, hash_spans, mix, spans

WINDOW, STRIDE = 32, 16
#: Bounds of the training sample: documents of each label, and bytes of a text to learn from (longer ones are scored whole like all others).
PER_LABEL, LEARN_BYTES = 900, 1 << 18
#: Passes over the sample, and steps at least; a step takes 64 documents.
ROUNDS, STEPS = 5, 140
#: Words and n-grams of fewer documents of the sample have no vector, so nothing is learned by heart.
LEAST = 5
WORD_BITS, GRAM_BITS, DIM, HIDDEN = 15, 16, 8, 8
_GRAMS = (4, 5)
#: Words of more than WHOLE bytes, as in text without spaces, are read as pieces of PIECE bytes, each an input of its own.
WHOLE, PIECE = 64, 32
#: Texts of more bytes are scored in stretches.
LONG = 2 << 20


def _pieces(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of these words, and which pieces go on with a word; those begin early enough that no n-gram is lost between two."""
    n = np.where(ends - starts > WHOLE, -(-(ends - starts) // PIECE), 1)
    word = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
    begin, later = starts[word] + nth * PIECE, nth > 0
    return begin - np.where(later, max(_GRAMS) - 1, 0), np.where(n[word] > 1, np.minimum(begin + PIECE, ends[word]), ends[word]), later


@dataclass
class Words:
    """Words of a run of texts: word i is kind[i]; kinds have a place among word vectors and a run of n-gram places."""

    kind: np.ndarray
    first: np.ndarray
    word: np.ndarray
    gram: np.ndarray
    gram_first: np.ndarray

    @staticmethod
    def of(part: list[bytes]) -> Words:
        buf = _LOWER[np.frombuffer(b" ".join(part) + b" ", np.uint8)]
        at = np.zeros(len(part) + 1, np.int64)
        np.cumsum([len(x) + 1 for x in part], out=at[1:])
        starts, ends, later = _pieces(*spans(buf, NOT_WORD))
        return Words._of(buf, starts, ends, later, np.searchsorted(starts, at))

    @staticmethod
    def stretches(text: bytes, n: int = 1 << 15):
        """The words of one long text, so many at once, with exactly the windows that the whole text has."""
        buf = _LOWER[np.frombuffer(text + b" ", np.uint8)]
        starts, ends, later = _pieces(*spans(buf, NOT_WORD))
        for lo in range(0, max(1, len(starts) - (WINDOW - STRIDE)), n):
            to = slice(lo, lo + n + WINDOW - STRIDE)
            yield Words._of(buf, starts[to], ends[to], later[to], np.array([0, len(starts[to])]))

    @staticmethod
    def _of(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, later: np.ndarray, first: np.ndarray) -> Words:
        hashes = hash_spans(buf, starts, ends)
        hashes[later] = mix(hashes[later] + np.uint64(1))  # it has other n-grams than a word of the same bytes
        distinct, where, kind = np.unique(hashes, return_index=True, return_inverse=True)
        s, e, mark = starts[where], ends[where], np.where(later[where], 0, 1)
        size = e - s + mark
        put = np.zeros(len(s) + 1, np.int64)
        np.cumsum(size, out=put[1:])
        flat = np.full(int(put[-1]), ord("<"), np.uint8)
        src = np.arange(int(put[-1])) - np.repeat(put[:-1] + mark - s, size)
        inner = np.ones(len(flat), bool)
        inner[put[:-1][mark > 0]] = False
        flat[inner] = buf[src[inner]]
        left = np.repeat(put[1:], size) - np.arange(len(flat))
        grams, owners = [], []
        owner = np.repeat(np.arange(len(s)), size)
        wide = np.concatenate([flat, np.zeros(8, np.uint8)]).astype(np.uint64)
        for n in _GRAMS:
            ok = np.flatnonzero((left >= n) | ((left == size[owner]) & (left < n)))  # a shorter word is one n-gram
            code = np.zeros(len(ok), np.uint64)
            for k in range(n):
                code = code * np.uint64(257) + np.where(left[ok] > k, wide[ok + k], 0).astype(np.uint64)
            grams.append(mix(code + np.uint64(n)) >> np.uint64(64 - GRAM_BITS))
            owners.append(owner[ok])
        order = np.argsort(np.concatenate(owners), kind="stable") if len(s) else np.zeros(0, np.int64)
        gram = np.concatenate(grams)[order].astype(np.int64) if len(s) else np.zeros(0, np.int64)
        gram_first = np.searchsorted(np.concatenate(owners)[order], np.arange(len(s) + 1)) if len(s) else np.zeros(1, np.int64)
        return Words(kind, first, (mix(distinct) >> np.uint64(64 - WORD_BITS)).astype(np.int64), gram, gram_first)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, kinds or -1) of all windows: every STRIDE words, and one at least of a text that has words."""
        n = np.diff(self.first)
        per = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
        text = np.repeat(np.arange(len(n)), per)
        begin = (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)) * STRIDE
        at = begin[:, None] + np.arange(WINDOW)
        inside = at < n[text][:, None]
        padded = np.append(self.kind, -1)
        return text, np.where(inside, padded[np.where(inside, at + self.first[text][:, None], len(self.kind))], -1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


class Network:
    """Weights: word and n-gram vectors; for each direction input weights w, recurrent weights u (update, reset, new) and bias; attention; output."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)

        def normal(*shape: int, by: float) -> np.ndarray:
            return (rng.standard_normal(shape) * by).astype(np.float32)

        self.p = {"word": normal(1 << WORD_BITS, DIM, by=0.05), "gram": normal(1 << GRAM_BITS, DIM, by=0.05)}
        for d in "fb":
            self.p |= {f"w{d}": normal(2 * DIM, 3 * HIDDEN, by=0.3), f"u{d}": normal(HIDDEN, 3 * HIDDEN, by=0.3), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"a": normal(2 * HIDDEN, HIDDEN, by=0.3), "av": normal(HIDDEN, by=0.3), "o": normal(2 * HIDDEN, by=0.3), "ob": np.zeros(1, np.float32)}
        self.line = (1.0, 0.0)
        self.fitted = False
        self._mean: dict[str, np.ndarray] = {}
        self._known: dict[str, np.ndarray] = {}

    def keep_known(self, groups: list[Words]) -> None:
        """Only places that LEAST documents of the sample use keep a vector."""
        n = {"word": np.zeros(1 << WORD_BITS, np.int64), "gram": np.zeros(1 << GRAM_BITS, np.int64)}
        for w in groups:
            for a, b in zip(w.first[:-1], w.first[1:], strict=True):
                kinds = np.unique(w.kind[a:b])
                n["word"][np.unique(w.word[kinds])] += 1
                grams = [w.gram[w.gram_first[k] : w.gram_first[k + 1]] for k in kinds]
                if grams:
                    n["gram"][np.unique(np.concatenate(grams))] += 1
        for name, count in n.items():
            self._known[name] = count >= LEAST
            self.p[name][~self._known[name]] = 0

    def inputs(self, w: Words) -> np.ndarray:
        """A row for each kind of word, and one of zeros for places beyond a text's end."""
        out = np.zeros((len(w.word) + 1, 2 * DIM), np.float32)
        if len(w.word):
            out[:-1, :DIM] = self.p["word"][w.word]
            out[:-1, DIM:] = np.add.reduceat(self.p["gram"][w.gram], w.gram_first[:-1], axis=0) / np.diff(w.gram_first)[:, None].astype(np.float32)
        return out

    def _read(self, d: str, pre: np.ndarray, ids: np.ndarray, keep: list | None) -> np.ndarray:
        """States after each word, read from one end; pre: input part of the gates by kind."""
        u, n, steps = self.p[f"u{d}"], len(ids), range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1)
        h, states = np.zeros((n, HIDDEN), np.float32), np.zeros((WINDOW, n, HIDDEN), np.float32)
        for t in steps:
            x = pre[ids[:, t]]
            zr = _sigmoid(x[:, : 2 * HIDDEN] + h @ u[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            new = np.tanh(x[:, 2 * HIDDEN :] + (r * h) @ u[:, 2 * HIDDEN :])
            if keep is not None:
                keep.append((t, h, z, r, new))
            h = h + z * (new - h)
            states[t] = h
        return states

    def logits(self, w: Words, ids: np.ndarray) -> np.ndarray:
        x = self.inputs(w)
        pre = {d: x @ self.p[f"w{d}"] + self.p[f"c{d}"] for d in "fb"}
        out = np.empty(len(ids), np.float32)
        for i in range(0, len(ids), 2048):
            part = ids[i : i + 2048]
            states = np.concatenate([self._read(d, pre[d], part, None) for d in "fb"], axis=2)
            out[i : i + 2048] = self._pool(states, part)[0]
        return out

    def _pool(self, states: np.ndarray, ids: np.ndarray):
        e = np.tanh(states @ self.p["a"])
        s = e @ self.p["av"]
        s[ids.T < 0] = -1e9
        s -= s.max(0)
        weight = np.exp(s)
        weight /= weight.sum(0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        return pooled @ self.p["o"] + self.p["ob"], e, weight, pooled

    def step(self, w: Words, ids: np.ndarray, target: np.ndarray, weight_of: np.ndarray, rate: float) -> None:
        """One step of gradient descent on the logistic loss of these windows, each parameter scaled by its past gradients."""
        p, x = self.p, self.inputs(w)
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self._read(d, x @ p[f"w{d}"] + p[f"c{d}"], ids, kept[d]) for d in "fb"], axis=2)
        logit, e, att, pooled = self._pool(states, ids)
        g = ((_sigmoid(logit) - target) * weight_of).astype(np.float32)
        grad = {"o": pooled.T @ g, "ob": np.array([g.sum()])}
        dp = g[:, None] * p["o"]
        ds = att[:, :, None] * dp
        da = np.einsum("tnh,nh->tn", states, dp)
        dscore = att * (da - (att * da).sum(0))
        de = dscore[:, :, None] * p["av"] * (1 - e * e)
        grad["av"] = np.einsum("tnk,tn->k", e, dscore)
        grad["a"] = np.einsum("tnh,tnk->hk", states, de)
        ds += de @ p["a"].T
        dx = np.zeros_like(x)
        for k, d in enumerate("fb"):
            u, w_in = p[f"u{d}"], p[f"w{d}"]
            du, dpre, dh = np.zeros_like(u), np.zeros((len(x), 3 * HIDDEN), np.float32), np.zeros((len(ids), HIDDEN), np.float32)
            for t, h, z, r, new in reversed(kept[d]):
                dh = dh + ds[t][:, k * HIDDEN : (k + 1) * HIDDEN]
                dnew = dh * z * (1 - new * new)
                dz = dh * (new - h) * z * (1 - z)
                drh = dnew @ u[:, 2 * HIDDEN :].T
                dr = drh * h * r * (1 - r)
                dzr = np.concatenate([dz, dr], axis=1)
                du[:, : 2 * HIDDEN] += h.T @ dzr
                du[:, 2 * HIDDEN :] += (r * h).T @ dnew
                np.add.at(dpre, ids[:, t], np.concatenate([dzr, dnew], axis=1))
                dh = dh * (1 - z) + drh * r + dzr @ u[:, : 2 * HIDDEN].T
            grad |= {f"u{d}": du, f"w{d}": x.T @ dpre, f"c{d}": dpre.sum(0)}
            dx += dpre @ w_in.T
        for name, value in grad.items():
            past = self._mean.setdefault(name, np.zeros_like(p[name]))
            past += value**2
            p[name] -= (rate * value / (np.sqrt(past) + 1e-6)).astype(np.float32)
        dx = dx[:-1]
        many = np.diff(w.gram_first)
        for name, at, value in (("word", w.word, dx[:, :DIM]), ("gram", w.gram, np.repeat(dx[:, DIM:] / many[:, None], many, axis=0) if len(many) else dx[:, DIM:])):
            known = self._known[name][at]
            rows, place = np.unique(at[known], return_inverse=True)
            total = np.zeros((len(rows), DIM), np.float32)
            np.add.at(total, place, value[known])
            past = self._mean.setdefault(name, np.zeros_like(p[name]))
            past[rows] += total**2
            p[name][rows] -= (rate * total / (np.sqrt(past[rows]) + 1e-6)).astype(np.float32)

    def worst(self, texts: list[str | None]) -> np.ndarray:
        """The highest logit of each text's windows; that of no words at all is -20."""
        out = np.full(len(texts), -20.0, np.float32)
        for i, j, part in batches(texts):
            whole = part[:-1] if len(part[-1]) > LONG else part
            if whole:
                w = Words.of(whole)
                text, ids = w.windows()
                np.maximum.at(out[i:j], text, self.logits(w, ids))
            for w in Words.stretches(part[-1]) if len(whole) < len(part) else []:
                out[j - 1] = max(out[j - 1], self.logits(w, w.windows()[1]).max(initial=-20))
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.fitted:
            return np.zeros(len(texts))
        slope, shift = self.line
        return 1 / (1 + np.exp(-np.clip(slope * self.worst(texts).astype(np.float64) + shift, -40, 40)))


def fit(texts: list[str], labels: list[int], seed: int = 5) -> Network:
    """Trained on these texts; without both labels, a network whose scores are all 0."""
    net, rng, y = Network(), np.random.default_rng(seed), np.array(labels, np.float32)
    if len(set(labels)) < 2:
        return net
    share = {v: 0.5 * len(y) / max(1, (y == v).sum()) for v in (0.0, 1.0)}
    groups = []
    order = rng.permutation(len(texts))
    for i in range(0, len(order), 64):
        at = order[i : i + 64]
        w = Words.of([texts[k].encode("utf-8", "surrogatepass") for k in at])
        groups.append((w, *w.windows(), y[at]))
    net.keep_known([g[0] for g in groups])
    rounds = max(ROUNDS, common.ceil_div(STEPS, max(1, len(groups))))
    for r in range(rounds):
        for k in rng.permutation(len(groups)):
            w, text, ids, target = groups[k]
            if not len(text):
                continue
            if r == 0:
                rank = rng.random(len(text))
                pick = np.lexsort((rank, text))
                nth = np.arange(len(text)) - np.searchsorted(text[pick], text[pick])
                pick = pick[nth < 4]
            else:
                rank = net.logits(w, ids)
                pick = np.lexsort((-rank, text))
                nth = np.arange(len(text)) - np.searchsorted(text[pick], text[pick])
                pick = pick[nth < np.where(target[text[pick]] > 0, 1, 3)]
            goal = target[text[pick]]
            each = np.array([share[float(v)] for v in goal], np.float32) / len(pick)
            net.step(w, ids[pick], goal, each, rate=0.15 if r < 0.6 * rounds else 0.05)
    worst = net.worst(texts).astype(np.float64)
    slope, shift = 1.0, 0.0
    for _ in range(300):  # logistic regression on the highest logit, labels weighted alike
        p = 1 / (1 + np.exp(-np.clip(slope * worst + shift, -40, 40)))
        e = (p - y) * np.where(y > 0, share[1.0], share[0.0]) / len(y)
        slope, shift = slope - 0.3 * float((e * worst).sum()), shift - 0.3 * float(e.sum())
    net.line, net.fitted = (max(slope, 1e-3), shift), True
    net._mean, net._known = {}, {}
    return net


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Network:
    """Fitted on at most about per_label documents of each label, none held out; which ones follows a hash of the id."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (common.fold() != 0)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, per_label / max(1, n.get(1, 0)))).otherwise(min(1.0, per_label / max(1, n.get(0, 0))))
    picked = usable.where(common.sample_share(share, "doc_id"))  # 2 * per_label rows, a little more or less
    sample = docs.where(F.octet_length("text") <= LEARN_BYTES).select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id").select("doc_id", "text", "toxic")
    return common.trained(sample, lambda rows: fit(rows["text"], rows["toxic"]), ["doc_id", "text"])


def score(docs: DataFrame, labels: DataFrame | None = None, network: Network | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Null texts and those without words have the least score. Rows with the same id are scored each by itself; of several
    labels of one id the highest counts; without documents of both labels to learn from all scores are 0. An empty table
    gives no rows; columns other than doc_id and text aren't read.
    """
    net = docs.sparkSession.sparkContext.broadcast(network or train(docs, labels))  # its size is fixed

    def rate(batches_):
        for batch in batches_:
            for part in common.slices(batch):
                s = net.value.scores(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rate, "doc_id long, score double, predicted int")
    return out.select("doc_id", (common.fold() == 0).alias("held_out"), "score", "predicted")


def clean_only(docs: DataFrame, labels: DataFrame | None = None, network: Network | None = None) -> DataFrame:
    """The rows of docs, all columns, that aren't predicted toxic."""
    net = docs.sparkSession.sparkContext.broadcast(network or train(docs, labels))

    return common.rows_where(docs, lambda texts: net.value.scores(texts) < 0.5)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


QUERIES = {"op2_toxicity": op2_toxicity}
ORACLES: dict[str, str] = {}
