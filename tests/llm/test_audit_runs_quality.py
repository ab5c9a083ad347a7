import hashlib
import math
import random
import zlib
from itertools import permutations

import duckdb
import numpy as np
import pytest

from dossier.llm import filter_audit, periodic_runs, quality
from pyspark.sql import functions as F

from .brute import SPACE

SCHEMA = "doc_id long, text string, lang string, source string, words string, part string, n long, digest string, runs int"
LABELS = "doc_id long, quality int, toxic int, text string"


def crc(i):
    return zlib.crc32(b"" if i is None else str(i).encode())


def rows_of(rng, n=300):
    """Texts that fail each filter and combinations of them, with copies, nulls, repeated ids and languages."""
    out, seen = [], []
    for i in range(n):
        kind = rng.randrange(8)
        w = [rng.choice("abcdefgh") + str(rng.randrange(600 if kind & 1 else 40)) for _ in range(rng.choice([0, 3, 150, 199, 200, 201, 320]))]
        if kind & 2:
            w = [x.upper() if rng.random() < 0.2 else x for x in w]
        text = rng.choice(["", " ", "\n"]).join(["", " ".join(w) + rng.choice(["", "", " $", " |x"]), ""])
        if seen and rng.random() < 0.3:
            text = rng.choice(seen)
        seen.append(text)
        out.append((rng.choice([i, i, i, rng.randrange(n), None]), rng.choice([text] * 9 + [None]), rng.choice(["en", "de", "", None])))
    return out


def audited(rows, labels):
    """The audit as the contract has it, one order after the other."""
    mark = {}
    for i, q, t in labels:
        a = mark.setdefault(i, [0, 0])
        a[0] |= q == 1
        a[1] |= t == 1
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    docs = []
    for i, text, lang in rows:
        t = text or ""
        w = SPACE.findall(t)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": any(c in "#$%&*|" for c in t), "E": i is not None and least[t] < i,
        }
        docs.append((lang or "", fails, mark.get(i, [0, 0]) if i is not None else [0, 0]))
    out = {}
    for part in {d[0] for d in docs}:
        mine, shapley = [d for d in docs if d[0] == part], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone, kept = [d for d in left if d[1][f]], [d for d in left if not d[1][f]]
                out[part, "".join(order), k + 1] = [
                    len(kept), len(gone), sum(d[1][f] for d in mine) - len(gone), sum(d[1][f] and sum(d[1].values()) == 1 for d in mine), sum(d[2][0] for d in gone), sum(d[2][1] for d in gone),
                ]
                shapley[f] += len(gone)
                left = kept
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                out[part, "".join(order), k + 1].append(shapley[f])
    return {k: tuple(map(int, v)) for k, v in out.items()}


FIGURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_is_every_order_run_by_itself(spark):
    rng = random.Random(1)
    rows = rows_of(rng)
    marks = [(rng.choice([*range(300), None]), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(200)]
    docs = spark.createDataFrame([(i, t, k, "s", "clash", "clash", 1, "clash", 0) for i, t, k in rows], SCHEMA).repartition(5)
    labels = spark.createDataFrame([(*m, "clash") for m in marks], LABELS).repartition(3)
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in FIGURES) for r in filter_audit.audit(docs, labels).collect()}
    want = audited(rows, marks)
    assert got == want and len(want) == 3 * 600
    assert all(any(v[k] for v in want.values()) for k in range(len(FIGURES)))
    assert filter_audit.audit(docs.limit(0), labels).collect() == []
    assert {k: v[:4] for k, v in audited(rows, []).items()} == {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in FIGURES[:4]) for r in filter_audit.audit(docs, labels.limit(0)).collect()}


def test_audit_of_a_hot_text(spark):
    """A text of a third of all rows, one part: counts of copies, whichever language they have."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same $ text").otherwise(F.concat(F.lit("w "), F.col("id").cast("string"))).alias("text"), F.lit("en").alias("lang"))
    r = filter_audit.audit(docs, spark.createDataFrame([(3, 1, 1, ""), (0, 1, 1, "")], LABELS)).where("filter_order = 'EDABC'").orderBy("step").collect()
    assert [tuple(x[c] for c in FIGURES[:6]) for x in r[:3]] == [(2001, 999, 0, 0, 1, 1), (2000, 1, 999, 0, 1, 1), (0, 2000, 1000, 2000, 0, 0)]


def test_audit_query_is_its_sql(spark):
    d = duckdb.connect()
    for t in ("documents", "labels"):
        d.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    columns = ["part", "filter_order", "step", *FIGURES]
    got = filter_audit.op11_filter_audit(spark, "/root/testdata/sf0.001").select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(d.execute(f"select {', '.join(columns)} from ({filter_audit.ORACLES['op11_filter_audit']})").fetchall())


def runs_of(w):
    """All runs by trying every start and period."""
    out, n = [], len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(w, runs):
    gone = set()
    for s, length, q in runs:
        gone |= set(range(s + q, s + length))
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def periodic(rng, n):
    """Words of few kinds with stretches of short and long periods, some of them nested or side by side."""
    w = []
    while len(w) < n:
        block = [rng.choice("abc") for _ in range(rng.choice([1, 1, 2, 3, 5, 17]))]
        if rng.random() < 0.3:
            block = block * 4 + ["x"]
        w += block * rng.choice([1, 1, 3, 4, 5, 9])
        w = w[: len(w) - rng.randrange(2)]
    return w[:n]


def test_runs_are_those_of_every_start_and_period():
    rng, seen = random.Random(3), 0
    for trial in range(150):
        texts = [[rng.choice("ab") for _ in range(rng.randrange(40))] if rng.random() < 0.3 else periodic(rng, rng.randrange(90)) for _ in range(rng.randrange(1, 6))]
        split, got = periodic_runs._read([" ".join(w).encode() for w in texts])
        for w, s, r in zip(texts, split, got, strict=True):
            want = runs_of(w)
            seen += len(want)
            assert [tuple(x) for x in r.tolist()] == want, (trial, w)
            assert periodic_runs.collapsed(s, r).decode() == kept(w, want)
    assert seen > 300


def test_runs_of_repeated_words_and_long_blocks():
    w = ["a"] * 5000
    assert periodic_runs._read([" ".join(w).encode()])[1][0].tolist() == [[0, 5000, 1]]
    rng = random.Random(4)
    block = [str(rng.randrange(10**6)) for _ in range(3001)]
    text = ["z", *(block * 5)[:13000], "y"]
    assert periodic_runs._read([b"", " ".join(text).encode(), None])[1][1].tolist() == [[1, 13000, 3001]]


def test_agreement_forward_and_back():
    rng = random.Random(5)
    kind = np.array([rng.randrange(2) for _ in range(200)])
    names = periodic_runs.levels(kind, 200)
    i, j = (np.array(x) for x in zip(*[(a, b) for a in range(200) for b in range(a + 1, 200)], strict=True))
    w = kind.tolist()

    def ahead(a, b):
        k = 0
        while b + k < 200 and w[a + k] == w[b + k]:
            k += 1
        return k

    def behind(a, b):
        k = 0
        while a - k > 0 and w[a - k - 1] == w[b - k - 1]:
            k += 1
        return k

    assert periodic_runs.agree(names, i, j).tolist() == [ahead(*p) for p in zip(i.tolist(), j.tolist(), strict=True)]
    assert periodic_runs.agree(names, i, j, back=True).tolist() == [behind(*p) for p in zip(i.tolist(), j.tolist(), strict=True)]


def expected(i, text):
    w = SPACE.findall(text or "")
    h = crc(i)
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    runs = runs_of(w)
    s = min(((-x[1], x[0], x[2]) for x in runs), default=None)
    best = (None,) * 4 if s is None else (s[1], -s[0], s[2], math.floor(1000 * -s[0] / s[2]))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (i, len(runs), *best, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(kept(w, runs)))


DIGEST = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_periodic_query_is_brute_force(spark, tmp_path):
    rng = random.Random(6)
    texts = [(i, rng.choice([" ", "\n", " \t"]).join(periodic(rng, rng.randrange(120)))) for i in range(250)]
    texts += [(None, "a b " * 9), (7, None), (8, ""), (9, " \n\x0b "), (None, None), (510, "日 本 " * 20), (510, "日 本 " * 20), (11, "x y\x1c z " * 12), (12, "w" * 70_000)]
    assert sum(crc(i) % 10 == 0 for i, _ in texts) > 10
    spark.createDataFrame([(i, t, "en", "s", "clash", "clash", 1, "clash", 0) for i, t in texts], SCHEMA).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r[c] for c in DIGEST) for r in periodic_runs.op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((expected(i, t) for i, t in texts), key=str)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert periodic_runs.periodic_runs(docs.limit(0)).collect() == []
    rows = periodic_runs.periodic_runs(docs).where("doc_id = 510").collect()
    assert [([tuple(x) for x in r["runs"]], r["collapsed"]) for r in rows] == [([(0, 40, 2)], "日 本")] * 2


def test_periodic_query_on_a_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    short = {i for i, t in texts.items() if len((t or "").split()) < 400}
    got = {r["doc_id"]: tuple(r[c] for c in DIGEST) for r in periodic_runs.op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == set(texts) and len(short) > 50
    assert all(got[i] == expected(i, texts[i]) for i in short)


def test_statistics_depend_on_their_own_text_only():
    rng = random.Random(7)
    texts = [None, "", " \n ", "A", "aé b\nc\n\nc", "x" * 700_000, *(" ".join(periodic(rng, rng.randrange(200))) for _ in range(40))]
    whole = quality.statistics(texts)
    assert whole.shape == (len(texts), len(quality.NAMES)) and np.isfinite(whole).all()
    for k, t in enumerate(texts):
        assert np.allclose(quality.statistics([t])[0], whole[k], atol=1e-12)
    one = dict(zip(quality.NAMES, quality.statistics(["Ab ab, ab\n12 #é\n12 #é"])[0], strict=True))
    want = {"log_points": math.log1p(21), "log_words": math.log1p(7), "distinct_words": 5 / 7, "top_word": 2 / 7, "distinct_pairs": 5 / 6, "upper": 1 / 21, "digit": 4 / 21, "stop": 1 / 21, "symbol": 2 / 21, "wide": 2 / 21, "log_lines": math.log1p(3), "distinct_lines": 2 / 3, "words_ending_in_stop": 1 / 7, "words_with_symbol": 2 / 7, "words_from_capital": 1 / 7}
    assert {k: pytest.approx(v) for k, v in want.items()} == {k: one[k] for k in want}


def test_flat_trees_are_their_nodes():
    rng = np.random.default_rng(8)
    x = rng.random((900, len(quality.NAMES)))
    x[:, 3] = np.round(x[:, 3] * 3)
    y = ((x[:, 0] > 0.4) ^ (x[:, 3] >= 2) | (x[:, 5] > 0.9)).astype(float)
    t = quality.fit(x, y, np.ones(900))
    fresh = rng.random((500, len(quality.NAMES)))

    def plain(row):
        out = t.base
        for node in t.roots.tolist():
            while t.left[node] != node:
                node = t.left[node] if row[t.statistic[node]] <= t.cut[node] else t.right[node]
            out += t.value[node]
        return out

    assert np.allclose(t.logits(fresh), [plain(r) for r in fresh])
    truth = (fresh[:, 0] > 0.4) ^ (fresh[:, 3] >= 2) | (fresh[:, 5] > 0.9)
    assert np.mean((t.logits(fresh) > 0) == truth) > 0.95 and np.mean((t.logits(x) > 0) == y) > 0.97
    assert quality.fit(x[:0], y[:0], y[:0]).scores(["a", None]).tolist() == [0.5, 0.5]
    assert quality.fit(x, np.ones(900), np.ones(900)).scores(["a"])[0] > 0.99


def test_first_split_is_the_best_of_all():
    """With one tree of one level, the cut is the one that trying every bin edge finds."""
    rng = np.random.default_rng(9)
    x, y = rng.random((400, len(quality.NAMES))), np.zeros(400)
    y[x[:, 7] > 0.3] = 1
    y[::11] = 1 - y[::11]
    t = quality.fit(x, y, np.ones(400))
    p, best = np.full(400, y.mean()), (-1.0, None, None)
    for k in range(x.shape[1]):
        for c in np.unique(np.quantile(x[:, k], np.linspace(0, 1, quality.BINS + 1)[1:-1], method="lower")):
            side = x[:, k] <= c
            gain = sum((y - p)[s].sum() ** 2 / ((p * (1 - p))[s].sum() + quality.RIDGE) for s in (side, ~side))
            if min((p * (1 - p))[side].sum(), (p * (1 - p))[~side].sum()) >= quality.LEAST_CURVATURE and gain > best[0] + 1e-9:
                best = (gain, k, c)
    assert (t.statistic[0], t.cut[0]) == best[1:] and best[1] == 7


def test_quality_of_held_out_documents(spark):
    """Recall of both labels, so that a constant fails."""
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    got = [(truth[r["doc_id"]], r["predicted"]) for r in quality.op13_quality(spark, "/root/testdata/sf0.1").where("held_out").collect() if r["doc_id"] in truth]
    assert np.mean([p == 1 for y, p in got if y == 1]) > 0.98 and np.mean([p == 0 for y, p in got if y == 0]) > 0.8 and len(got) > 1000


def test_quality_learns_and_handles_odd_rows(spark):
    rng = random.Random(10)
    texts = {i: " ".join(("x#y" if i % 4 == 0 and rng.random() < 0.3 else rng.choice("abcdef") * rng.randrange(1, 6)) for _ in range(rng.randrange(20, 80))) for i in range(400)}
    odd = [(900, None), (901, ""), (None, "a b"), (902, "x " * 5000), (902, "q")]
    docs = spark.createDataFrame([(i, t, "en", "s", "clash", "clash", 1, "clash", 0) for i, t in [*texts.items(), *odd]], SCHEMA).repartition(3)
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0, "clash") for i in texts] + [(901, None, 1, ""), (None, 1, 1, ""), (5, 0, 0, "")], LABELS)
    rows = quality.score(docs, labels).collect()
    got = {r["doc_id"]: r for r in rows}
    held = [i for i in texts if crc(i) % 3 == 1]
    assert len(rows) == 405 and all(r["held_out"] == (crc(r["doc_id"]) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert np.mean([got[i]["predicted"] == int(i % 4 != 0) for i in held]) > 0.9
    assert got[900]["score"] == got[901]["score"]
    assert sorted(map(tuple, quality.score(docs.repartition(7), labels.repartition(2)).collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert quality.score(docs.limit(0), labels).collect() == []
    assert {r["score"] for r in quality.score(docs, labels.limit(0)).collect()} == {0.5}
    flipped = labels.withColumn("quality", F.when(quality.fold() == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(map(tuple, quality.score(docs, flipped).collect()), key=str) == sorted(map(tuple, rows), key=str)
