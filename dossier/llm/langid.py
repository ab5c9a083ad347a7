"""Language ID: the language family first, then one-versus-one linear support vector machines inside the family.

Features are counts of byte 3-grams of the whole text (A-Z lower-cased), hashed to DIMS places and scaled to length 1. The
models are trained in numpy on a bounded sample of labelled documents; every document is then scored on its whole text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .wordhash import _LOWER, encode

DIMS = 1 << 12
#: Bound of the training sample: documents of each language.
PER_LANGUAGE = 400
UNKNOWN = "und"
#: Families by language code; other codes are a family of their own.
FAMILIES = {
    "germanic": "af da de en fy is nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "indic": "bn gu hi mr ne pa si ur",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "semitic": "am ar he mt",
    "celtic": "br cy ga gd",
    "baltic": "lt lv",
}
_LETTER = regex.compile(r"\p{L}")


def family_of(lang: str) -> str:
    code = re.split(r"[-_]", lang.lower())[0]
    return next((f for f, codes in FAMILIES.items() if code in codes.split()), lang)


def grams(text: str) -> np.ndarray:
    """Hashed byte 3-grams of a text, a blank at either end."""
    b = _LOWER[np.frombuffer(b" " + encode(text) + b" ", np.uint8)].astype(np.uint32)
    h = (b[:-2] * np.uint32(0x1F123BB5) ^ b[1:-1] * np.uint32(0x85EBCA6B) ^ b[2:] * np.uint32(0xC2B2AE35)) if len(b) > 2 else np.zeros(0, np.uint32)
    return (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - 12)


def features(text: str) -> np.ndarray:
    x = np.zeros(DIMS, np.float32)
    step = 1 << 20
    g = grams(text)
    for i in range(0, len(g), step):
        x += np.bincount(g[i : i + step], minlength=DIMS)
    return x / max(1e-9, float(np.linalg.norm(x)))


def linear_svm(x: np.ndarray, y: np.ndarray, rounds: int = 12, ridge: float = 1e-4, seed: int = 7) -> np.ndarray:
    """Weights (bias last) of a hinge-loss classifier of y = +-1, classes weighted alike, by averaged subgradient steps."""
    rng, n = np.random.default_rng(seed), len(y)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * n
    x = np.hstack([x, np.full((n, 1), 0.3, np.float32)])
    w, mean, t = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0
    for _ in range(rounds):
        order = rng.permutation(n)
        for i in range(0, n, 16):
            part, t = order[i : i + 16], t + 1
            rate = 4.0 / (1 + 0.02 * t)
            short = (y[part] * (x[part] @ w) < 1) * share[part] * y[part]
            w = (1 - rate * ridge) * w + rate * (short @ x[part]) / len(part)
            mean += w
    return (mean / max(1, t)).astype(np.float32)


@dataclass
class LanguageModel:
    families: list[str]
    members: dict[str, list[str]]
    family_weights: np.ndarray
    pair_weights: dict[str, np.ndarray]

    @staticmethod
    def train(texts: list[str], langs: list[str]) -> LanguageModel:
        x = np.stack([features(t) for t in texts]) if texts else np.zeros((0, DIMS), np.float32)
        lang = np.array(langs, dtype=object)
        known = sorted(set(langs))
        members: dict[str, list[str]] = {}
        for k in known:
            members.setdefault(family_of(k), []).append(k)
        families = sorted(members)
        fam = np.array([family_of(k) for k in langs], dtype=object)
        of_family = [linear_svm(x, np.where(fam == f, 1.0, -1.0)) for f in families] if len(families) > 1 else []
        pairs = {}
        for f in families:
            for i, a in enumerate(members[f]):
                for b in members[f][i + 1 :]:
                    rows = (lang == a) | (lang == b)
                    pairs[f"{a}\t{b}"] = linear_svm(x[rows], np.where(lang[rows] == a, 1.0, -1.0))
        return LanguageModel(families, members, np.array(of_family), pairs)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and how sure: from the smallest margin by which a decision was made, 0 to 1."""
        if text is None or not self.families or not _LETTER.search(text):
            return UNKNOWN, 0.0
        x = np.append(features(text), np.float32(0.3))
        sure, family = np.inf, self.families[0]
        if len(self.families) > 1:
            m = self.family_weights @ x
            best = int(np.argmax(m))
            family, sure = self.families[best], float(m[best] - np.partition(m, -2)[-2])
        names = self.members[family]
        votes, margin = dict.fromkeys(names, 0), dict.fromkeys(names, np.inf)
        for i, a in enumerate(names):
            for b in names[i + 1 :]:
                m = float(self.pair_weights[f"{a}\t{b}"] @ x)
                win = a if m >= 0 else b
                votes[win] += 1
                margin[win] = min(margin[win], abs(m))
        lang = max(names, key=lambda k: (votes[k], margin[k] if votes[k] else -1.0))
        sure = min(sure, margin[lang])
        return lang, float(1 / (1 + np.exp(-2 * min(max(sure, 0.0), 40.0))))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Fitted on at most about per_language documents of each language, none of them held out; which ones follows a hash of the id.

    Every language is learned. The driver holds the list of languages and the model, which has DIMS weights for each family
    and each pair of languages of one family.
    """
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (common.fold() != 0)).select("doc_id", "text", "lang")
    n = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    if not n:
        return LanguageModel.train([], [])
    share = F.create_map(*(F.lit(v) for k, c in n.items() for v in (k, min(1.0, 1.1 * per_language / c))))
    picked = usable.where(common.sample_share(share[F.col("lang")], "doc_id"))

    def fit(rows: dict[str, list]) -> LanguageModel:
        kept, seen = [], dict.fromkeys(rows["lang"], 0)
        for lang, text in zip(rows["lang"], rows["text"], strict=True):
            if _LETTER.search(text) and seen[lang] < per_language:
                seen[lang] += 1
                kept.append((text, lang))
        return LanguageModel.train([t for t, _ in kept], [k for _, k in kept])

    return common.trained(picked.select("doc_id", "text", "lang"), fit, ["lang", "doc_id", "text"])


def identify(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs; null texts and those without a letter are `und` with score 0.

    Rows with the same id are predicted each by itself, columns other than doc_id, text and lang aren't read, an empty
    table gives no rows, and where no row can be learned from, all are `und`.
    """
    fitted = model or train(docs)
    model_ref = docs.sparkSession.sparkContext.broadcast(fitted)  # DIMS floats for each family and pair

    def predict(batches):
        m = model_ref.value
        for batch in batches:
            for part in common.slices(batch):
                got = [m.predict(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(predict, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", (common.fold() == 0).alias("held_out"), "lang_pred", "score")


def known_only(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """The rows of docs, all columns, whose language isn't `und`."""
    model_ref = docs.sparkSession.sparkContext.broadcast(model or train(docs))

    return common.rows_where(docs, lambda texts: [model_ref.value.predict(t)[0] != UNKNOWN for t in texts])


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(common.table(spark, sf_dir, "documents"))


QUERIES = {"op9_language_id": op9_language_id}
ORACLES: dict[str, str] = {}
