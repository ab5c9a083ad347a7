import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from dossier.llm import bpe, langid, license_scan, minhash, packing, substring, token_counts
from dossier.llm.encoder import BYTE_FILE, WORD_FILE, encoder, vocabulary_path

from .brute import WORD, Union, lower, near, repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, labels string, shelf int"
HELLO = "hello big wide world of words "
ROWS = [
    (1, None), (2, ""), (3, HELLO * 30), (4, HELLO * 30), (None, HELLO * 30), (5, "word " * 400 + "x" * 50_000), (6, "one"), (7, " \n\t "), (8, "<|endoftext|> a b <|startoftext|>x"),
    (9, "日本語 ÄÖÜ é İΣ ﬁ é don't we'll    　x\x1cy"), (10, HELLO * 29 + "and then another end of it all"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", "a", 0, "clash", 1) for i, t in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").cache()


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def library(file):
    return Tokenizer.from_file(vocabulary_path(file))


def encoded(df):
    t = library(BYTE_FILE)
    out = []
    for r in df.collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        text = t.decode(ids, skip_special_tokens=False)
        out.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


def test_bpe_is_the_library(docs, odd, empty):
    for df in (docs, odd, empty):
        for size in (1 << 12, 1 << 23):
            assert Counter(map(tuple, bpe.round_trip(df, shelf_bytes=size).collect())) == encoded(df)


def test_bpe_decodes_by_join(spark, odd):
    some = odd.where("doc_id in (2, 3, 8, 9, 10)")
    back = texts(bpe.decode_documents(bpe.encode_documents(some), step=7))
    assert back == {i: t or "" for i, t in texts(some).items()}


def test_packing_plan_is_best_fit_decreasing():
    rng = random.Random(4)
    for cap, n in ((10, 60), (37, 300), (64, 0)):
        lengths = [rng.randint(1, cap) for _ in range(n)]
        bins = []
        for x in sorted(lengths, reverse=True):
            fits = [(b, i) for i, b in enumerate(bins) if b >= x]
            if fits:
                bins[min(fits)[1]] -= x
            else:
                bins.append(cap - x)
        left: dict[int, int] = {}
        for length, _, k, first, per, at in packing.plan(dict(Counter(lengths)), cap):
            for j in range(k):
                left[first + j // per] = left.get(first + j // per, cap) - length
        assert sorted(left.values()) == sorted(bins)


def test_packing(docs, odd, empty):
    t = library(WORD_FILE)
    assert packing.pack(empty).collect() == []
    for df in (docs, odd):
        want = Counter()
        for r in df.collect():
            ids = np.array([*t.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
            for k in range(0, len(ids), 2048):
                part = ids[k : k + 2048]
                want[r["doc_id"], k // 2048, k, len(part), zlib.crc32(part.tobytes())] += 1
        got = packing.pack(df).collect()
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
        bins: dict[int, list] = {}
        for r in got:
            bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for parts in bins.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at <= 2048


def test_language_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_odd(odd, empty):
    got = {r["doc_id"]: r for r in langid.identify(odd).collect()}
    assert {i for i, r in got.items() if r["lang_pred"] == "und"} == {1, 2, 7}
    assert langid.identify(empty).collect() == []
    assert langid.LanguageModel(["a"], {"a": ["a"]}, np.zeros((0, 1)), {}).predict("½ ² ① Ⅷ 12 !")[0] == "und"
    assert 1 not in texts(langid.known_only(odd)) and 3 in texts(langid.known_only(odd))
    assert langid.family_of("de") == langid.family_of("en-GB") != langid.family_of("fr") and langid.family_of("xx") == "xx"


LICENSES = {
    1: "Released under the MIT License.\nmore", 2: "GNU GENERAL Public License, gnu general public license", 3: "a cc-by b CC BY", 4: "apache  license", 5: "the license apache", 6: None,
    7: license_scan.TEMPLATES["bsd"].replace("modification", "change"), 8: "x " * 500 + license_scan.TEMPLATES["isc"] + " y" * 300, 9: "redistribution and use of source",
    11: "released under the bsd license today", 12: "licensed under the Eclipse Public License, Version 2.0", 13: "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 International License",
    14: "under the terms of the GNU Lesser General Public License", 15: "a " * 300 + license_scan.TEMPLATES["mit-text"] + " b" * 300, 16: license_scan.TEMPLATES["bsd-3-text"].replace("copyright holder", "regents"), None: "under the MIT License, x", 17: "word " * 100_000 + "cc by",
}


def test_license_base_and_join(spark, docs, odd, empty):
    assert license_scan.scan(empty).collect() == [] and len(license_scan.scan(odd.union(odd)).collect()) == 2 * len(ROWS)
    made = spark.createDataFrame(list(LICENSES.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.scan(made).collect()}
    assert got[7]["labels"] == "bsd" and "isc" in got[8]["labels"] and got[9]["labels"] == "" and all(got[i]["labels"] == "" and got[i]["score"] == 0 for i in (11, 12, 13, 14)) and {"mit", "mit-text"} <= set(got[15]["labels"].split(",")) and got[16]["labels"] == "bsd,bsd-3-text" and got[None]["base_labels"] == "mit" and got[6]["n_words"] == 0 and got[6]["first_word"] is None
    for df, found in ((made, got), (docs, {r["doc_id"]: r for r in license_scan.scan(docs).collect()})):
        for i, text in texts(df).items():
            w = WORD.findall(lower(text))
            at = [(k, label) for p, label in license_scan.BASE.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
            r = found[i]
            assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(w), len(at), ",".join(sorted({x for _, x in at})))
            assert (r["first_word"], r["last_word"]) == ((min(at)[0], max(at)[0]) if at else (None, None))
            best = {}
            for name, template in license_scan.TEMPLATES.items():  # every block against every template
                tw = WORD.findall(lower(template))
                distinct, half = set(tw), 2 ** math.ceil(math.log2(len(tw)))
                for b in range(0, max(1, len(w)), half):
                    share = len(distinct & set(w[b : b + 2 * half])) / len(distinct)
                    if share >= license_scan.THRESHOLD and f" {license_scan.NAMING[name]} " in f" {' '.join(w[b : b + 2 * half])} ":
                        best[name] = max(best.get(name, 0), share)
            assert r["labels"] == ",".join(sorted({x for _, x in at} | set(best)))
            assert r["score"] == pytest.approx(1.0 if at else max(best.values(), default=0.0))


def test_near_duplicates(spark, docs, odd, empty):
    rng = random.Random(1)
    base = [rng.choice("abcdefghij") + str(rng.randint(0, 40)) for _ in range(120)]
    made = {}
    for i in range(100, 130):  # a chain of small changes: ends of it don't link by themselves
        base[rng.randint(0, 119)] = f"n{i}"
        made[i] = " ".join(base).upper() if i % 3 == 0 else " ".join(base)
    made |= {i: t for i, t in texts(docs).items() if i < 60}
    df = spark.createDataFrame([(i, t) for i, t in made.items()], "doc_id long, text string").repartition(3)
    for width in (2, 5):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df, width, shelf_bytes=1 << 14).collect()}
        assert got == near(made, width)
    rows = minhash.near_duplicates(odd, 2).collect()
    assert len(rows) == len(ROWS) and minhash.near_duplicates(empty).collect() == []
    by = {r["doc_id"]: r for r in rows}
    assert by[4]["component_id"] == 3 and not by[4]["kept"] and by[3]["kept"] and by[None]["kept"] and by[None]["component_id"] is None
    assert by[1]["n_shingles"] == by[7]["n_shingles"] == 0 and by[6]["n_shingles"] == 1


def test_every_near_copy_of_a_table_is_found(spark):
    """All pairs of distinct shingle sets of sf0.01 at 0.8 or more, found without any candidate search, make the same components."""
    d = texts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    value, first = minhash.shingle_sets([d[i] for i in sorted(d)], 2)
    order, holders = {v: k for k, v in enumerate(np.unique(value).tolist())}, {}
    sets = [set(order[v] for v in value[first[k] : first[k + 1]].tolist()) for k in range(len(d))]
    ids, u = sorted(d), Union(d)
    links = 0
    for k, own in enumerate(sets):  # sets of a similarity of 0.8 share one of the first fifth of either
        for v in sorted(own)[: len(own) // 5 + 1]:
            for j in holders.setdefault(v, []):
                both = len(own & sets[j])
                if 100 * both >= 80 * (len(own) + len(sets[j]) - both):
                    links += 1
                    u.join(ids[k], ids[j])
            holders[v].append(k)
    got = {r["doc_id"]: r["component_id"] for r in minhash.op5_minhash_near_dedup(spark, "/root/testdata/sf0.01").collect()}
    assert links > 100 and got == {i: u.find(i) for i in ids}


def test_near_duplicates_of_one_hot_group(spark):
    """Hundreds of copies with small changes, equal ones, and texts that share half of their words with all of them."""
    rng, base = random.Random(5), [f"w{i}" for i in range(150)]
    made = {i: " ".join(w if rng.random() > 0.02 else f"x{rng.randint(0, 9999)}" for w in base) for i in range(250)}
    made |= {i: made[i % 7] for i in range(300, 350)}
    made |= {i: " ".join(base[:75] + [f"y{i}x{k}" for k in range(75)]) for i in range(400, 450)}
    df = spark.createDataFrame(list(made.items()), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df, 2, shelf_bytes=1 << 13).collect()}
    assert got == near(made, 2)


def test_sketch_bound_is_exact():
    """Bitmaps never differ in more bits than the sets differ in shingles, so no pair that is alike enough is dropped."""
    rng = np.random.default_rng(3)
    for n, changed in [(1, 0), (1, 1), (9, 1), (200, 22), (200, 80), (5000, 300)]:
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[changed:], rng.integers(0, 2**63, changed, dtype=np.uint64)]))
        bits = int(np.unpackbits((minhash.sketch(a) ^ minhash.sketch(b)).view(np.uint8)).sum())
        assert len(minhash.sketch(a)) == minhash.SKETCH and bits <= len(np.setxor1d(a, b))


def test_repeated_windows(spark, docs, odd, empty):
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    made = {}
    for i in range(12):
        w = [f"w{rng.randint(0, 3)}" for _ in range(rng.randint(0, 80))]
        k = rng.randint(0, len(w))
        made[i] = "\n ".join(w[:k] + passage[rng.randint(0, 20) : rng.randint(30, 60)] + w[k:])
    for source, window in ((made, 6), (made, 7), (texts(docs), 50)):
        df = spark.createDataFrame(list(source.items()), "doc_id long, text string").repartition(3)
        want = {i: (len(w), len(w) - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest()) for i, (w, k) in repeats(source, window).items()}
        for size in (1 << 10, 1 << 23):
            got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring.removed_words(df, window, size).collect()}
            assert got == want
    got = {r["doc_id"]: r for r in substring.removed_words(odd).collect()}
    assert got[4]["n_removed"] == got[4]["n_words"] == 180 and got[3]["n_removed"] == 0 and got[None]["n_removed"] == 0 and got[1]["n_words"] == 0
    assert substring.removed_words(empty).collect() == []


def test_token_trees():
    e, rng = encoder(vocabulary_path(BYTE_FILE)), random.Random(3)
    bits = ["a", "the", " ", "  ", "\n", "\n\n", "'s", "é", "<|endoftext|>", "<|", "endoftext|>", "12", "!!", "xxxxx", "日本", " \t"]
    for leaf in (2, 64):
        token_counts.LEAF = leaf
        for _ in range(60):
            s = "".join(rng.choice(bits) for _ in range(rng.randint(0, 60)))
            tree = token_counts.TokenTree(s, e)
            for _ in range(6):
                p, r = rng.randint(0, len(s) + 3), rng.choice([0, 0, 1, 5, 20])
                put = "".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 3, 30])))
                s = s[: min(p, len(s))] + put + s[min(p, len(s)) + r :]
                assert tree.edit(p, r, put) == len(e.library.encode(s, add_special_tokens=False).ids) and tree.text == s


def test_growth_encodes_only_what_is_new():
    """A large insertion counts the words put in and some context, whatever the document's length."""
    e = encoder(vocabulary_path(BYTE_FILE))
    tree = token_counts.TokenTree("word " * 100_000, e)
    encoded = []
    count = tree._count
    tree._count = lambda words: encoded.append(len(words)) or count(words)
    n = tree.edit(250_000, 0, "new " * 2000)
    assert sum(encoded) < 2000 + 4 * 64 * 4 and tree.reencoded < 2000 + 4 * 64 * 4
    assert n == len(e.library.encode(tree.text, add_special_tokens=False).ids)


def test_token_counts(spark, docs, odd, empty):
    t = library(BYTE_FILE)
    for df in (docs, odd):
        got = {r["doc_id"]: r for r in token_counts.edited_counts(df, token_counts.sample_edits()).collect()}
        for i, text in texts(df).items():
            s = text or ""
            n = len(s)
            for p, r, put in ((n // 2, 0, " edited"), (n // 4, 10, ""), (max(0, n - 4), 1, "! ")):
                p = min(p, len(s))
                s = s[:p] + put + s[p + r :]
            assert (got[i]["n_tokens"], got[i]["n_tokens_edited"]) == (len(t.encode(text or "", add_special_tokens=False).ids), len(t.encode(s, add_special_tokens=False).ids))
    assert token_counts.edited_counts(empty, token_counts.sample_edits()).collect() == []
