import pathlib
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from dossier.llm import common, langid, minhash, substring, toxicity

from .brute import near, repeats


def words(rng, n, stem=""):
    return [stem + "".join(rng.choice("abdeilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """id -> (text, toxic): toxic ones hold words of two made-up stems, in forms that mostly differ."""
    rng = random.Random(9)
    out = {}
    for i in range(400):
        w, toxic = words(rng, rng.randint(20, 150)), int(i % 4 == 0)
        for _ in range(4 if toxic else 0):
            w.insert(rng.randint(0, len(w)), rng.choice(["zzgrak", "qqwex"]) + words(rng, 1)[0][:2])
        out[i] = (" ".join(w), toxic)
    return out


def test_toxicity_learns_from_letters(spark, corpus):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in corpus.items()] + [(900, None), (901, ""), (None, "a b"), (902, "x " * 5000)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in corpus.items()] + [(901, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    held = [i for i in corpus if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (i in held) for i in corpus)
    assert np.mean([got[i]["predicted"] == corpus[i][1] for i in held]) > 0.8
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values()) and len(got) == 404
    assert got[900]["predicted"] == got[901]["predicted"] == 0
    assert toxicity.score(docs.limit(0), labels).collect() == []
    assert {r["score"] for r in toxicity.score(docs, labels.limit(0)).collect()} == {0.0}


def test_gradients_of_the_network():
    """A step moves each parameter against its gradient, as differences of the loss have it."""
    rng = random.Random(7)
    w = toxicity.Words.of([" ".join(words(rng, 40)).encode() for _ in range(3)])
    text, ids = w.windows()
    goal, weight = np.array([1.0, 0.0, 1.0], np.float32)[text], np.full(len(text), 0.7, np.float32)

    def loss(net):
        z = net.logits(w, ids).astype(np.float64)
        return float((weight * (np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - goal * z)).sum())

    net = toxicity.Network(3)
    net._known = {"word": np.ones(1 << toxicity.WORD_BITS, bool), "gram": np.ones(1 << toxicity.GRAM_BITS, bool)}
    before = {k: v.copy() for k, v in net.p.items()}
    net.step(w, ids, goal, weight, rate=1e-12)
    gradient = {k: np.sqrt(v) for k, v in net._mean.items()}  # after one step the sum of squares is the square
    for name in ("wf", "wb", "uf", "ub", "cf", "cb", "a", "av", "o", "ob", "word", "gram"):
        size = np.abs(gradient[name]).ravel()
        for at in np.argsort(-size)[:3].tolist():
            step, sides = 2e-3, []
            for sign in (1, -1):
                net.p = {k: v.copy() for k, v in before.items()}
                net.p[name].ravel()[at] += sign * step
                sides.append(loss(net))
            assert abs((sides[0] - sides[1]) / (2 * step)) == pytest.approx(float(size[at]), rel=0.05, abs=2e-3), name


def test_network_is_the_plain_recurrence():
    """Logits in batches equal those of the recurrence written out for one window."""
    rng, net = random.Random(8), toxicity.Network(5)
    w = toxicity.Words.of([" ".join(words(rng, n)).encode() for n in (5, 32, 70)])
    _, ids = w.windows()
    x, got = net.inputs(w), net.logits(w, ids)

    def sigmoid(v):
        return 1 / (1 + np.exp(-v))

    for row, logit in zip(ids, got, strict=True):
        states, h8 = {}, toxicity.HIDDEN
        for d in "fb":
            h, places = np.zeros(h8), range(len(row)) if d == "f" else range(len(row) - 1, -1, -1)
            for t in places:
                g = x[row[t]] @ net.p[f"w{d}"] + net.p[f"c{d}"]
                u = net.p[f"u{d}"]
                z, r = sigmoid(g[:h8] + h @ u[:, :h8]), sigmoid(g[h8 : 2 * h8] + h @ u[:, h8 : 2 * h8])
                h = h + z * (np.tanh(g[2 * h8 :] + (r * h) @ u[:, 2 * h8 :]) - h)
                states[d, t] = h
        s = np.array([np.concatenate([states["f", t], states["b", t]]) for t in range(len(row))])[row >= 0]
        a = np.exp(np.tanh(s @ net.p["a"]) @ net.p["av"])
        assert logit == pytest.approx(float((a / a.sum()) @ s @ net.p["o"] + net.p["ob"][0]), abs=1e-4)


def test_toxicity_of_held_out_documents(spark):
    """Recall and false alarms, so that a constant fails."""
    folder = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = [(truth[r["doc_id"]], r["predicted"]) for r in toxicity.op2_toxicity(spark, folder).where("held_out").select("doc_id", "predicted").collect() if r["doc_id"] in truth]
    assert len(got) > 500 and np.mean([p for y, p in got if y == 1]) > 0.8 and np.mean([p for y, p in got if y == 0]) < 0.04


def test_windows_cover_every_word():
    w = toxicity.Words.of([b"", b"a b", b" ".join(b"w%d" % i for i in range(100))])
    text, ids = w.windows()
    assert set(text.tolist()) == {1, 2}
    assert {int(k) for k in ids[text == 2].ravel() if k >= 0} == set(w.kind[w.first[2] : w.first[3]].tolist())


def test_toxicity_reads_texts_without_spaces_to_their_end():
    rng = random.Random(4)
    toxic = [int(i % 3 == 0) for i in range(600)]
    texts = ["".join(rng.choice([chr(0x4E00 + k) for k in range(400)]) for _ in range(rng.randint(80, 200))) + "毒蛇咬人" * y for y in toxic]
    net = toxicity.fit(texts[:400], toxic[:400])
    assert np.mean((net.scores(texts[400:]) >= 0.5) == np.array(toxic[400:])) > 0.9


def test_pieces_have_every_gram_of_a_long_word():
    rng = random.Random(6)
    for n in [1, 4, 63, 64, 65, 68, 96, 97, 500]:
        word = bytes(rng.choice(b"abcdefgh") for _ in range(n))
        got = toxicity.Words.of([b"x " + word])
        marked = b"<" + word
        want = [marked[i : i + g] for g in (4, 5) for i in range(len(marked) - g + 1)] or [marked]
        assert len(got.kind) == 1 + (-(-n // 32) if n > 64 else 1)
        for gram in want:
            code = 0
            for k in range(len(gram)):
                code = code * 257 + gram[k]
            place = toxicity.mix(np.array([(code + len(gram)) % 2**64], np.uint64)) >> np.uint64(64 - toxicity.GRAM_BITS)
            assert n < 4 or place[0] in got.gram


def test_stretches_have_the_windows_of_the_text():
    rng = random.Random(8)
    for n in [0, 1, 16, 32, 48, 49, 63, 64, 65, 500]:
        text = " ".join(words(rng, n)).encode() + b"z" * (40 * n)
        whole = toxicity.Words.of([text])
        net = toxicity.Network()
        want = sorted(net.logits(whole, whole.windows()[1]).tolist())
        got = sorted(x for w in toxicity.Words.stretches(text, 48) for x in net.logits(w, w.windows()[1]).tolist())
        assert np.allclose(got, want, atol=1e-6)


def test_rows_of_one_id_are_decided_by_their_own_text(spark, tmp_path):
    rng = random.Random(3)
    a, b, c = (words(rng, 120) for _ in range(3))
    docs = spark.createDataFrame([(3, " ".join(a)), (7, " ".join(a)), (7, " ".join(b)), (8, None)], "doc_id long, text string").repartition(2)
    got = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in got) == sorted([(3, " ".join(a)), (7, " ".join(b)), (8, "")])
    rows = [(3, " ".join(a)), (7, " ".join(c[:50] + a[:90])), (7, " ".join(b)), (8, None)]
    got = corpus_pipeline.substring_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in got) == sorted([(3, " ".join(a)), (7, " ".join(c[:50])), (7, " ".join(b)), (8, "")])


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, new_text string, text_md5 string, row int, `a.b` int, kept string, component_id long, n_removed string"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "mine", "mine", 7, 8, "mine", 9, "mine") for i, t in rows], CLASHING).repartition(2)


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    rng = random.Random(11)
    a, b = " ".join(words(rng, 120)), words(rng, 130)
    rows = [(1, a), (2, a), (2, a), (3, a + " more of it"), (4, " ".join(b)), (5, " ".join(words(rng, 10) + b[20:100])), (6, ""), (7, None), (None, a), (8, "12 34 !!")]
    spark.createDataFrame([(i, 1, int(i == 4)) for i in range(1, 9)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = clashing(spark, rows)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        got = out.collect()
        assert {(r["new_text"], r["text_md5"], r["row"], r["a.b"], r["kept"], r["component_id"], r["n_removed"]) for r in got} == {("mine", "mine", 7, 8, "mine", 9, "mine")}, name
        if k == 2:
            assert sorted((r["doc_id"] or 0) for r in got) == [0, 1, 4, 5, 6, 7, 8]
        if k == 3:
            kept = {i: " ".join(w) for i, (_, w) in repeats({i: t for i, t in rows if i is not None}, substring.WINDOW).items()}
            assert all((r["text"] or "") == kept[r["doc_id"]] for r in got if r["doc_id"] in (1, 2, 4, 5)) and kept[5] != rows[5][1]
            assert all(r["n_chars"] == len(r["text"] or "") for r in got)
    assert {r["doc_id"] for r in corpus_pipeline.best_fit(spark, docs, "").collect()} == {i for i, _ in rows}


def test_every_stage_takes_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = clashing(spark, [(1, "a")]).limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0 and (name == "best-fit packing" or out.columns == docs.columns), name


def test_a_run_leaves_its_result_only(spark, tmp_path):
    spark.createDataFrame([(1, "some words in a row", "en"), (2, "some words in a row", "en")], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    folder = pathlib.Path(common.shared_folder(spark).removeprefix("file:"))
    before = set(folder.rglob("*.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [(r["doc_id"], r["piece"], r["start"], r["offset"]) for r in rows] == [(1, 0, 0, 0)]
    assert {p.parent.name for p in set(folder.rglob("*.parquet")) - before} == {"best-fit_packing"}


def test_pipeline_is_its_stages(spark, corpus, tmp_path):
    rng, docs = random.Random(2), {i: (t, "en") for i, (t, _) in corpus.items() if i < 120}
    base = words(rng, 200)
    for i in range(500, 506):
        base[rng.randint(0, 199)] = f"edit{i}"
        docs[i] = (" ".join(base), "en")
    for i in range(600, 604):
        docs[i] = (" ".join(words(rng, 30) + base[20:90] + words(rng, 40)), "en")
    docs |= {700: ("12 34 !!", "en"), 701: (None, None), 702: ("", "fr")}
    spark.createDataFrame([(i, t, k, "s", len(t or "")) for i, (t, k) in docs.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in corpus.items()], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {i: t for i, (t, _) in docs.items()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, str(tmp_path)).write.parquet(str(tmp_path / f"out{k}"))
        out = spark.read.parquet(str(tmp_path / f"out{k}"))
        if k == 4:
            assert {r["doc_id"] for r in out.select("doc_id").collect()} == set(kept)
            break
        assert out.columns == columns
        got = {r["doc_id"]: r["text"] for r in out.collect()}
        if k == 0:
            m = langid.train(at)
            want = {i: t for i, t in kept.items() if m.predict(t)[0] != "und"}
            assert not {700, 701, 702} & set(want)
        elif k == 1:
            net = toxicity.train(at, labels)
            ids = sorted(kept)
            want = {i: kept[i] for i, s in zip(ids, net.scores([kept[i] for i in ids]), strict=True) if s < 0.5}
            assert sum(corpus[i][1] for i in want if i in corpus) <= 8
        elif k == 2:
            want = {i: kept[i] for i, (_, c) in near(kept, minhash.SHINGLE).items() if c == i}
            assert len(want) < len(kept)
        else:
            want = {i: kept[i] if len(w) == len(x) else " ".join(x) for i, (w, x) in repeats(kept, substring.WINDOW).items()}
            assert want != kept
        assert got == want, name
        at, kept = out, got
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in whole.select("doc_id").collect()} == set(kept)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "toxicity", "MinHash near-dedup", "substring dedup", "best-fit packing"]
