"""Phrase tables, publishers and repaired portfolios against plain loops."""

import random
import re

from pyspark.sql import functions as F

from dossier.functions import phrases
from dossier.operators import joins, portfolio, publishers, select
from dossier.queries import stories


def one_after_the_other(text, table):
    for phrase, by in table:
        text = re.sub("".join(re.escape(c[0]) + c[1:] for c in re.findall(r"[^?]\?|[^?]", phrase)), lambda m, by=by: by, text, flags=re.I)
    return text


def test_rewriting_is_replacing_one_after_the_other(spark):
    rng = random.Random(1)
    texts = ["", " ", *("".join(rng.choice("aabbcxAB. ") for _ in range(rng.randrange(60))) for _ in range(120))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(900, None)], "i long, t string").repartition(2)
    tables, staged = [], 0
    for _ in range(40):
        table = [("".join(rng.choice("abcx?") for _ in range(rng.randrange(1, 6))).lstrip("?").replace("??", "?") or "a", "".join(rng.choice("abZ#") for _ in range(rng.randrange(3)))) for _ in range(rng.randrange(1, 7))]
        tables.append([(p, b) for p, b in table if re.sub(r".\?", "", p)])
    got = df.select("i", *(phrases.rewrite("t", phrases.phrases(t)).alias(f"r{k}") for k, t in enumerate(tables))).collect()
    for r in got:
        for k, t in enumerate(tables):
            assert r[f"r{k}"] == one_after_the_other(texts[r["i"]] if r["i"] < 900 else "", t), (texts[r["i"]] if r["i"] < 900 else "", t)
    staged = [len(phrases.phrases(t).stages) for t in tables]
    assert min(staged) <= 1 < max(staged)


def test_brief_phrases_take_few_passes():
    compiled = phrases.phrases(phrases.BRIEF)
    words = [p for stage in compiled.stages for p, _ in stage]
    assert len(compiled.stages) == 4  # "... chemical risk" and "risk case" may share a word, for example
    assert "withdrawal" in words and "withdrawal of the product from the market" not in words  # an earlier phrase takes it
    rng = random.Random(2)
    bits = [x for p, _ in phrases.BRIEF for x in phrases._forms(p)] + ["the", "product", "market", "x"]
    passes = [(re.compile(phrases.trie([p for p, _ in stage]), re.I), dict(reversed(stage))) for stage in compiled.stages]
    for _ in range(3000):
        t = rng.choice([" ", "", ". "]).join(rng.choice(bits) for _ in range(rng.randrange(6)))
        t = out = rng.choice([t, t.upper(), t[: rng.randrange(len(t) + 1)]])
        for pattern, by in passes:
            out = pattern.sub(lambda m, by=by: by[m[0].lower()], out)
        assert out == one_after_the_other(t, phrases.BRIEF)
    long_ = phrases.phrases([(f"word {k} of", f"<{k}>") for k in range(500)])
    assert len(long_.stages) == 1


def test_briefing_texts(spark):
    rows = [
        (1, "Risk level:  Serious\nNotifying country: France. Recalled from end users;", ""),
        (2, "www.abc.com 标题 - 搜狐财经 | x", "甲公司"),
        (3, "商家被处罚", "甲公司"),
        (4, None, "甲公司"),
        (5, "栏目一 | 两家公司 Product Recall: 面霜", "乙公司"),
        (6, "[我们认为](https://a.com/x) 我国发布 https://b.com/y 新规 | 我们的", ""),
    ]
    df = spark.createDataFrame(rows, "i long, t string, party string")
    got = {r["i"]: r for r in df.select("i", phrases.translated("t").alias("a"), phrases.brief_part("t").alias("b"), phrases.named_title("t", "party").alias("c"), phrases.briefing("t").alias("d"), phrases.brief_lines(F.array("t", F.lit("。"))).alias("e")).collect()}
    assert got[1]["a"] == "风险等级：严重 通报国家：France. 已从终端用户召回;" and got[1]["b"] == "风险等级：严重 通报国家：France. 已从终端用户召回"
    assert [got[i]["c"] for i in (2, 3, 4, 5)] == ["标题", "甲公司被处罚", "", "乙公司 产品召回： 面霜"]
    assert got[6]["d"] == "中国发布 新规" or "我们" not in got[6]["d"] and "http" not in got[6]["d"]
    assert got[4]["a"] == got[4]["d"] == "" and got[4]["e"] == [] and len(got[3]["e"]) == 1


def test_publishers_are_those_of_the_loop(spark):
    rng = random.Random(3)
    hosts = ["a.com", "b.a.com", "c.b.a.com", "xa.com", "gov.cn", "d.gov.cn", "com"]
    rules = list({(rng.choice(hosts), rng.choice(["", "/", "/x", "/x/y", "/xy"]), f"n{k % 9}") for k in range(14)})
    urls = [None, "", "no address", *(f"http{rng.choice(['', 's'])}://{rng.choice(['', 'www.', 'B.'])}{rng.choice([*hosts, 'other.org'])}{rng.choice(['', ':80', ':8080'])}{rng.choice(['', '/', '/x', '/x/', '/x/y/z', '/xy', '/xyz', '/x?y'])}" for _ in range(150))]

    def named(u):
        m = re.match(r"https?://([^/:?]+)(?::\d+)?([^?]*)", u or "")
        if not m:
            return None
        h, p = m[1].lower(), [s for s in m[2].split("/") if s]
        fits = [(-len(a), -len(b.rstrip("/")), n) for a, b, n in rules if (h == a or h.endswith("." + a)) and p[: len([s for s in b.split("/") if s])] == [s for s in b.split("/") if s]]
        return min(fits)[2] if fits else None

    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "i long, url string, name string").repartition(3)
    table = spark.createDataFrame(rules, "host string, path string, name string")
    assert {r["i"]: r["publisher"] for r in publishers.published_by(df, table).collect()} == {i: named(u) for i, u in enumerate(urls)}
    assert publishers.published_by(df.limit(0), table).collect() == [] and publishers.published_by(df, table.limit(0)).where("publisher is not null").isEmpty()


def test_known_publishers(spark):
    cases = [
        ("http://www.nmpa.gov.cn/a", "x", "n", "", "国家药品监督管理局", "国家药品监督管理局"), ("", "国家药监局发布", "n", "", "国家药品监督管理局", "国家药品监督管理局"), ("http://www.fda.gov/a", "x", "n", "", "", "美国食品药品监督管理局（FDA）"),
        ("http://scjgj.sh.gov.cn/a", "上海市市场监督管理局通告", "n", "", "", "上海市市市场监督管理局"), ("http://scjgj.sh.gov.cn/a", "通告", "n", "", "", "地方市场监督管理局"), ("http://yjj.sh.gov.cn/a", "x", "n", "", "", "地方药品监督管理局"),
        ("http://x.gov.cn/a", "杭州市人民法院判决", "n", "", "", "杭州市人民法院"), ("http://x.gov.cn/a", "别的", "n", "", "", "政府网站"), ("http://www.sohu.com/a", "x", "搜狐", "据海关总署消息", "", "海关总署（转载）"),
        ("http://www.sohu.com/a", "x", "搜狐", "据杭州市市场监督管理局", "", "据杭州市市场监督管理局（转载）"), ("http://www.sohu.com/a", "x", "搜狐", "", "", "搜狐财经"), ("http://www.sohu.com/a", "x", "某号", "", "", "某号"), ("http://r.com", "x", "reach24h", "", "", "瑞欧科技"), (None, None, None, None, "", ""),
    ]
    df = spark.createDataFrame([(i, *c[:4]) for i, c in enumerate(cases)], "i int, u string, t string, n string, b string")
    got = {r["i"]: (r["a"], r["s"]) for r in df.select("i", publishers.canonical_authority("u", "t").alias("a"), publishers.canonical_source("u", "t", "n", "b").alias("s")).collect()}
    assert got == {i: c[4:] for i, c in enumerate(cases)}


def chosen(rows, seeds, groups, target, most, least, seeded, moves):
    """The fold over all rows."""
    taken, n, seen = [], {}, set()

    def take(r, place, how):
        seen.add(r[2])
        n[place] = n.get(place, 0) + 1
        taken.append((r[0], place, how))

    for r in rows:
        if r[2] in seen or n.get(r[1], 0) >= most:
            continue
        if len(taken) >= target:
            break
        take(r, r[1], "quota")
    had = n.get(seeded, 0)
    if had < least:
        for s in seeds:
            if s[2] in seen:
                continue
            if n.get(seeded, 0) >= most:
                continue
            take(s, seeded, "seed")
            if had + 1 >= least:
                break
    for g in groups:
        while n.get(g, 0) < least and len(taken) < target:
            own = next((r for r in rows if r[1] == g and r[2] not in seen), None)
            other = own or next((r for r in rows if g in moves and r[1] == moves[g] and r[3] and r[2] not in seen), None)
            if other is None:
                break
            take(other, g, "fill" if own else "moved")
    return taken


def test_repaired_portfolios_are_those_of_the_fold(spark):
    rng, seen = random.Random(4), set()
    for trial in range(14):
        groups = tuple("abcd")
        n = rng.choice([0, 3, 8, 20, 40])
        rows = [(i, rng.choice("aaabbc" if trial % 2 else "abcd"), f"k{rng.randrange(max(2, n))}", rng.random() < 0.6) for i in range(n)]
        seeds = [(100 + i, "x", f"k{rng.randrange(8)}", False) for i in range(rng.choice([0, 2, 6]))]
        target, most = rng.choice([4, 7, 12]), rng.choice([2, 3])
        moves = {"d": "a", "c": "b"}
        schema = "ord long, module string, key string, ok boolean"
        rules = portfolio.Rules(groups, target, most, 2, "d", {k: (v, F.col("ok")) for k, v in moves.items()})
        got = portfolio.repaired(spark.createDataFrame(rows, schema), rules, seeds=spark.createDataFrame(seeds, schema))
        want = chosen(rows, seeds, groups, target, most, 2, "d", moves)
        assert [(r["ord"], r["placed"], r["how"]) for r in got.orderBy("turn").collect()] == want, trial
        seen |= {h for _, _, h in want}
    assert seen >= {"quota", "seed", "moved"}


def test_portfolio_of_orders_is_that_of_the_fold(spark):
    folder = "/root/testdata/sf0.001"
    o = [r.asDict() for r in spark.read.parquet(f"{folder}/orders.parquet").collect()]
    rows = [(r["o_orderkey"], r["o_orderpriority"], r["o_custkey"], r["o_orderstatus"] == "P") for r in sorted(o, key=lambda r: (-r["o_totalprice"], r["o_orderkey"])) if not (r["o_orderpriority"] == "5-LOW" and r["o_totalprice"] < 4e5)]
    c = sorted((r.asDict() for r in spark.read.parquet(f"{folder}/customer.parquet").collect()), key=lambda r: (-r["c_acctbal"], r["c_custkey"]))
    seeds = [(-1 - r["c_custkey"], None, r["c_custkey"], False) for r in c if r["c_mktsegment"] == "BUILDING"]
    want = chosen(rows, seeds, stories.PRIORITIES, 24, 5, 4, "5-LOW", {"1-URGENT": "2-HIGH"})
    got = stories.order_portfolio(spark, folder).orderBy("turn").collect()
    assert [(r["order_or_customer"], r["placed"], r["how"]) for r in got] == want and len(want) > 20


def test_widths_are_those_of_rendering_each(spark):
    rng = random.Random(6)
    rows = [(m, i, f := rng.randrange(30), max(0, f - rng.randrange(-2, 12)), rng.randrange(10)) for m in range(60) for i in range(rng.randrange(1, 9))] + [(99, 0, None, None, None)]
    df = spark.createDataFrame(rows, "m int, i int, f int, c int, s int").repartition(3)
    for each in (True, False):
        got = {(r["m"], r["i"]): (r["width"], r["bytes"], r["fits"]) for r in select.widths(df, "m", 60, ("f", "c", "s"), F.col("i"), base=5, each=each).collect()}
        want = {}
        for m in {r[0] for r in rows}:
            items = sorted(tuple(x or 0 for x in r) for r in rows if r[0] == m)
            size = lambda k, items=items: 5 + sum(r[3] if j < k else r[2] for j, r in enumerate(items))
            k = next((k for k in (range(len(items) + 1) if each else (0, len(items))) if size(k) <= 60), None)
            total = 5 + sum(r[4] for r in items) if k is None else size(k)
            for j, r in enumerate(items):
                want[m, r[1]] = ("minimal" if k is None else "compact" if j < k else "full", total, total <= 60)
        assert got == want and {w for w, _, _ in want.values()} == {"full", "compact", "minimal"} and any(not f for _, _, f in want.values())


def test_corroboration_comes_back_to_records(spark):
    kinds = "evidence_grade string, verification_status string, supporting_sources array<string>, agreed_anchors array<string>"
    records = [
        (1, "http://a.com/x/#top", "primary", "lead_only", "own", ["s"], ["t"]), (2, "http://a.com/y", "secondary", "hard_fact_ready", "own", ["s"], ["t"]), (3, "http://a.com/z", "primary", "hard_fact_ready", "own", ["s"], ["t"]),
        (4, None, "secondary", "hard_fact_ready", None, None, None), (5, "http://a.com/w", "secondary", "lead_only", None, None, None), (6, "http://a.com/v", "secondary", "hard_fact_ready", "own", ["s"], ["t"]),
    ]
    verified = [(1, "http://a.com/x", "single", "x", ["p"], ["q"], "e0"), (2, "http://a.com/x/", "corroborated_fact_ready", "corroborated", ["a", "b"], ["n", "m"], "e1"), (3, "http://a.com/v", "", None, [], None, "e2"), (4, "", "z", "z", ["z"], ["z"], "z")]
    df = spark.createDataFrame(records, f"ord int, url string, tier string, {kinds}")
    v = spark.createDataFrame(verified, f"ord int, url string, {kinds}, event_id string")
    got = {r["ord"]: tuple(r[c] for c in ("evidence_grade", "verification_status", "supporting_sources", "agreed_anchors", "event_id")) for r in joins.with_corroboration(df, v, F.col("tier")).collect()}
    assert got[1] == ("corroborated_fact_ready", "corroborated", ["a", "b"], ["n", "m"], "e1")
    assert got[2] == ("lead_only", "unverified", [], [], None) == got[4]
    assert got[3] == ("hard_fact_ready", "own", ["s"], ["t"], None) and got[5] == ("lead_only", None, None, None, None)
    assert got[6] == ("hard_fact_ready", "own", [], ["t"], "e2")
    assert joins.with_corroboration(df, v.limit(0), F.col("tier")).where("ord = 2").first()["evidence_grade"] == "lead_only" and joins.with_corroboration(df.limit(0), v, F.col("tier")).collect() == []
