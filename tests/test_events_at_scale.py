"""Attachments, same-event pairs and greedy groups against plain loops, and on chains, stars and hot keys."""

import random
import re

import pytest
from pyspark.sql import functions as F

from dossier.operators import attachments, events, greedy, sameness, skew


def fold(pairs, leaders):
    near, group = {}, {}
    for a, b in pairs:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for o in sorted(near):
        found = [group[n] for n in near[o] if n < o and (not leaders or group[n] == n)]
        group[o] = min(found) if found else o
    return group


@pytest.mark.parametrize("leaders", [False, True])
def test_groups_are_those_of_the_fold(spark, leaders):
    rng = random.Random(1)
    pairs, base = [], 0
    for _ in range(60):  # parts of many shapes beside each other: sparse, dense, bands, ladders with dead ends
        n, kind = rng.randrange(2, 30), rng.randrange(4)
        if kind < 2:
            part = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randrange(1, 4 * n if kind else n + 1))]
        elif kind == 2:
            part = [(i, i + k) for i in range(n) for k in (1, 2) if i + k < n]
        else:
            part = [(n + i, n + i + 1) for i in range(n)] + [(i, n + i) for i in range(n) if rng.random() < 0.6]
        order = list(range(3 * n + 3))
        if rng.random() < 0.5:
            rng.shuffle(order)
        pairs += [(base + order[a], base + order[b]) for a, b in part]
        base += 3 * n + 3
    rows = spark.range(base).select(F.col("id").alias("ord"))
    got = {r["ord"]: r["group"] for r in events.greedy_groups(rows, spark.createDataFrame(pairs, "a long, b long"), leaders=leaders).collect()}
    want = fold(pairs, leaders)
    assert got == {i: want.get(i, i) for i in range(base)}
    none = spark.createDataFrame([], "a long, b long")
    assert events.greedy_groups(rows.limit(3), none, leaders=leaders).where("ord <> group").count() == 0


def test_a_chain_and_a_star_of_100000_rows(spark):
    n = 100_000
    chain = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(1, n).select(F.lit(n).cast("long").alias("a"), (F.col("id") + n).alias("b"))
    tail = star.unionByName(star.where("b < 1.5e5").select(F.lit(2 * n).cast("long").alias("a"), "b"))  # a late row that half of it is paired with
    both = chain.unionByName(tail)
    joined = greedy.joined_groups(both)
    assert [tuple(r) for r in joined.groupBy("group").count().orderBy("group").collect()] == [(0, n), (n, n + 1)]
    led = greedy.led_groups(both)
    assert led.where(f"o < {n} and `group` <> o - o % 2").isEmpty() and led.where(f"o > {n} and `group` <> {n} and o <> {2 * n}").isEmpty()
    assert led.where(f"o = {2 * n} and `group` = o").count() == 1


def test_hot_keys_are_joined_where_they_lie(spark):
    big = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    small = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = skew.by_key(big, small, ["k"], floor=100, most=5)
    want = sorted((7 if i % 3 == 0 else i, i, 14 if i % 3 == 0 else 2 * i) for i in range(4000))
    assert sorted(map(tuple, out.select("k", "id", "v").collect())) == want
    left, right = skew.celled(big, big.withColumnRenamed("id", "id2"), ["k"], "id", "id2", cell=50)
    met = left.join(right, ["k", "cell"])
    assert met.count() == met.select("id", "id2").distinct().count() == 1334 * 1334 + sum(1 for i in range(4000) if i % 3 and i != 7) + 0 - 0 + (0 if 7 % 3 == 0 else 2 * 1334 + 1)
    assert left.groupBy("k", "cell").count().agg(F.max("count")).first()[0] < 120


def bare(t):
    t = re.sub(r"\s+", " ", t or "").strip()
    t = re.sub(r"^(?:附件\s*[一二三四五六七八九十\d]+[：:]?\s*)", "", t)
    return re.sub(r"[\W_]+", "", t).lower()


def meet(a, b):
    x, y = bare(a), bare(b)
    if not x or not y:
        return False
    if {x[i : i + 4] for i in range(len(x) - 3)} & {y[i : i + 4] for i in range(len(y) - 3)}:
        return True
    words = [set(re.findall("[a-z0-9]{4,}", re.sub(r"\s+", " ", t or "").strip().lower())) for t in (a, b)]
    return len(words[0] & words[1]) >= 2


def titles(rng, n):
    out = [None, "", " ", "附件", "附件1：", "abc", "附件 12345 67890", "附件67890 x 12345", "附件 1234ab ef 5678", "附件 5678：1234ab y", "附件十：化妆品备案公告", "化妆品备案"]
    for _ in range(n):
        w = ["".join(rng.choice("abcde12") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 4))]
        out.append(rng.choice(["", "", "附件 3 ", f"附件{rng.choice(w)}", f"附件 {rng.randrange(1000, 1004)}", f"附件 {rng.randrange(1000, 1004)}："]) + rng.choice([" ", "-"]).join(w + rng.choice([[], [], [str(rng.randrange(1000, 1004))]])))
    return out


def test_keys_are_shared_exactly_by_titles_that_meet(spark):
    t = titles(random.Random(2), 170)
    rows = [(i, x) for i, x in enumerate(t)]
    df = spark.createDataFrame(rows, "i long, title string").repartition(3)
    keyed = df.select("i", "title", attachments.title_keys("title").alias("k"))
    pairs = keyed.alias("a").crossJoin(keyed.alias("b")).select(F.col("a.i").alias("i"), F.col("b.i").alias("j"), F.arrays_overlap("a.k", "b.k").alias("keys"), attachments.titles_meet(F.col("a.title"), F.col("b.title")).alias("meet"))
    got = pairs.collect()
    assert all(bool(r["keys"]) == r["meet"] == meet(t[r["i"]], t[r["j"]]) for r in got)
    arm_two = [r for r in got if r["meet"] and not {bare(t[r["i"]])[k : k + 4] for k in range(len(bare(t[r["i"]])) - 3)} & {bare(t[r["j"]])[k : k + 4] for k in range(len(bare(t[r["j"]])) - 3)}]
    assert arm_two  # the second rule is needed


def test_first_meetings_are_those_of_the_double_loop(spark, monkeypatch):
    monkeypatch.setattr(skew, "FLOOR", 20)
    rng = random.Random(3)
    t = titles(rng, 200)
    att = [(i, x, rng.choice([1, 2, None])) for i, x in enumerate(t + t[:30])]
    ev = [(1000 + i, x, rng.choice([1, 2, None])) for i, x in enumerate(titles(rng, 60))]
    a = spark.createDataFrame([(*r, "clash", 5) for r in att], "ord long, title string, rec int, event_ string, cell int").repartition(3)
    e = spark.createDataFrame([(*r, "clash") for r in ev], "ord long, title string, rec int, key string").repartition(2)
    got = {r["ord"]: r["event"] for r in attachments.first_meetings(a, e).collect()}
    assert got == {i: min((o for o, y, _ in ev if meet(x, y)), default=None) for i, x, _ in att} and len(set(got.values())) > 5
    within = {r["ord"]: r["event"] for r in attachments.first_meetings(a, e, scope="rec").collect()}
    assert within == {i: min((o for o, y, s in ev if s == r and meet(x, y)), default=None) for i, x, r in att}
    assert attachments.first_meetings(a.limit(0), e).collect() == [] and attachments.first_meetings(a, e.limit(0)).where("event is not null").isEmpty()


def grams(t):
    t = re.sub(r"20\d{2}[年./-]\d{1,2}(?:[月./-]\d{1,2}日?)?", "", re.sub(r"\s+", " ", t or "").strip().lower())
    t = re.sub(r"[\W_]", "", re.sub("关于|发布|公告|通知|最新|本周|化妆品|美妆|监管", "", t))
    return {t[i : i + 2] for i in range(len(t) - 1)} if len(t) >= 2 else {t} - {""}


def alike(a, b):
    x, y = grams(a), grams(b)
    return bool(x and y) and len(x & y) / min(len(x), len(y)) >= 0.72


def same(p, q):
    touch = len(grams(p[2]) & grams(q[2])) >= 2 and all(len(r[3] or "") >= 18 for r in (p, q)) and alike(p[3], q[3])
    return (p[1] or "") == (q[1] or ""), alike(p[2], q[2]), touch


def test_same_events_are_those_of_the_double_loop(spark, monkeypatch):
    monkeypatch.setattr(skew, "FLOOR", 30)
    monkeypatch.setattr(skew, "CELL", 15)
    rng = random.Random(5)
    text = lambda k, n: "".join(rng.choice("abcdefghij"[:k]) for _ in range(n))
    rows = []
    for i in range(170):
        title, facts = text(rng.choice([4, 10]), rng.randrange(14)), text(10, rng.choice([0, 17, 18, 40, 60]))
        if rows and rng.random() < 0.5:
            old = rng.choice(rows)
            title = rng.choice([title, old[2], (old[2] or "")[:6] + text(10, 6)])
            facts = rng.choice([facts, old[3], (old[3] or "")[:30] + text(10, 4)])
        rows.append((i, rng.choice([f"id{i}", f"id{i}", None, "x", f"id{i - 3}"]), rng.choice([title] * 9 + [None]), rng.choice([facts] * 9 + [None])))
    rows += [(200 + k, "copy", "the same title of all", "facts that all of them have") for k in range(80)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "ord long, identity string, title string, facts string, class string, n int").repartition(3)
    members, kinds = sameness.classes(df)
    of = {r["ord"]: r["class"] for r in members.collect()}
    first = {}
    assert of == {r[0]: first.setdefault(tuple(x or "" for x in r[1:]), r[0]) for r in rows}
    got = {(r["a"], r["b"]): (r["by_identity"], r["by_title"], r["by_facts"]) for r in sameness.event_pairs(kinds).collect()}
    reps = [r for r in rows if of[r[0]] == r[0]]
    want = {(p[0], q[0]): s for i, p in enumerate(reps) for q in reps[i + 1 :] if any(s := same(p, q))}
    assert got == want and sum(s == (False, False, True) for s in want.values()) > 5
    leaders, lead = [], {}
    for r in rows:
        lead[r[0]] = next((p[0] for p in leaders if any(same(p, r))), r[0])
        leaders += [r] if lead[r[0]] == r[0] else []
    out = sameness.one_of_each_event(df).collect()
    assert {r["ord"]: r["leader"] for r in out} == lead
    assert {r["ord"]: r["n_rows"] for r in out} == {o: sum(v == o for v in lead.values()) for o in lead}
    assert sameness.one_of_each_event(df.limit(0)).collect() == []


def _pairs_of_anchors(rows):
    """Every pair of rows, kind by kind, by plain Python."""
    core = lambda v: re.sub(events.PARTY_SUFFIX, "", v)

    def party(a, b):
        s, t = sorted((core(a), core(b)), key=len)
        told = any(len(re.sub(events.PARTY_NOISE, "", s[i : i + 8])) >= 4 and s[i : i + 8] in t for i in range(len(s) - 7))
        return a == b or (len(s) >= 4 and s in t) or told

    def met(kind, a, b):
        if kind == "parties":
            return party(a, b)
        return a == b or (kind == "products_or_batches" and min(len(a), len(b)) >= 4 and (a in b or b in a))

    found = {}
    for i, x in rows:
        for j, y in rows:
            if i < j:
                kinds = sorted(k for k in x if any(met(k, a, b) for a in x[k] for b in y.get(k, ())))
                if kinds:
                    found[i, j] = kinds
    return found


def test_anchor_pairs_are_those_of_comparing_all(spark):
    rng = random.Random(8)
    parts = ["杭州", "甲乙", "美妆", "化妆品", "品牌", "主体", "母公司", "abcd1234", "efg5", "有限公司", "股份有限公司", "公司", "丙", "商行"]
    name = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(1, 6)))
    rows = [(i, {"parties": [name() for _ in range(rng.randrange(3))], "products_or_batches": [name() for _ in range(rng.randrange(2))], "amounts": [str(rng.randrange(40))]}) for i in range(150)]
    df = spark.createDataFrame(rows, "ord long, anchors map<string,array<string>>")
    got = {(r["a"], r["b"]): r["kinds"] for r in events.anchor_pairs(df).collect()}
    assert got == _pairs_of_anchors(rows) and any("parties" in k for k in got.values()) and any("products_or_batches" in k for k in got.values())


def test_names_with_a_common_ending_do_not_all_meet(spark):
    """4,000 names that end alike, as shops' names do: few share a run of eight letters, so few rows are compared."""
    names = spark.range(4000).select(F.col("id").alias("o"), F.lit("parties").alias("kind"), F.concat(F.substring(F.md5(F.col("id").cast("string")), 1, 12), F.lit("某某商行")).alias("v"))
    assert events.names_to_compare(names).count() < 4000  # 8 million share their last four letters
