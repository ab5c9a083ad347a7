"""Searches for authorities against plain loops."""

import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from dossier.operators import authority
from dossier.queries import deliveries


def squeezed(s):
    return re.sub(r"\s+", " ", s or "").strip()


def queries_by_loop(title, snippet, body, module):
    source = f"{squeezed(title)} {squeezed(snippet)} {squeezed(body)}"
    found = [squeezed(m[0]) for p in authority.TOKENS for m in re.finditer(p, source)]
    core = " ".join(x for x in [squeezed(title), *list(dict.fromkeys(t for t in found if t))[:10]] if x)
    anchors = [a for a in [authority.ANCHORS.get(squeezed(module))] if a] + [a for p, a in authority.TOPICS.items() if re.search(p, core)]
    return list(dict.fromkeys(squeezed(f"{core} {a}") for a in anchors or [authority.OTHERWISE]))


def test_queries_of_leads(spark):
    rows = [
        (1, "某公司 因刷单 被罚款 30 万元", "ABC-12 商标", "爱马仕商标 3,000 件", "知识产权动态"), (2, None, None, None, None), (3, "海关 HS 编码", "", "", "进出口动态"), (4, "  a \n b ", "AAA BBB AAA", "", "x"),
        (5, "征求意见稿", " ".join(f"TOK{i}" for i in range(30)), "", "广告合规及处罚案例"),
    ]
    df = spark.createDataFrame(rows, "i long, t string, s string, b string, m string")
    for r in df.select("*", authority.queries("t", "s", "b", "m").alias("q")).collect():
        assert r["q"] == queries_by_loop(r["t"], r["s"], r["b"], r["m"])


def test_rows_of_one_round(spark):
    leads = spark.createDataFrame([(i, f"t{i}", f"http://h/{i}", "media" if i % 2 else "official_site", None) for i in range(9)], "ord long, title string, url string, source_type string, region string")
    place = lambda n: [(r["lead_title"], bool(r["lead_url"])) for r in authority.search_rows(leads, n).orderBy("place").collect()]
    assert place(8) == [("t1", True), ("t3", True), *[("", False)] * 6]
    assert place(3) == [("t1", True), ("t3", True), ("t5", True)]
    assert place(24)[:5] == [("t1", True), ("t3", True), ("t5", True), ("t7", True), ("", False)] and len(place(24)) == 10
    assert place(0) == [] and len(authority.search_rows(leads.where("false"), 3).collect()) == 3


def hops_by_loop(pages, per_host, per_seed=6, per_query=4, most=3):
    n, names = len(pages), [*authority.ANCHORS, ""]
    front = {}
    for p, url in sorted(pages.items()):
        front.setdefault(url.lower(), (p, url, f"NO-{p}{(' 公告', ' 海关处罚', '')[p % 3]}", names[p % 7]))
    met, asked, out, seeds, hosts = set(front), {}, [], Counter(), Counter()
    for hop in range(1, most + 1):
        new, now = [], []
        for k, (seed, url, title, module) in front.items():
            new += [(seed, k, i, q, url, title, module) for i, q in enumerate(queries_by_loop(title, "", "", module))]
        by_seed, by_host, known = Counter(), Counter(), set()
        for seed, _, _, q, url, title, module in sorted(new):
            if q in asked or q in known:
                continue
            known.add(q)  # a query counts as seen even where a budget refuses it
            if seeds[seed] + by_seed[seed] >= per_seed:
                continue
            by_seed[seed] += 1
            host = re.sub(r"^https?://([^/:]+).*", r"\1", url)
            if hosts[host] + by_host[host] >= per_host:
                continue
            by_host[host] += 1
            now.append((seed, q, url, title, module, host))
        front, leads = {}, []
        for seed, q, url, title, module, host in now:
            asked[q] = hop
            seeds[seed] += 1
            hosts[host] += 1
            h = hashlib.md5(q.encode()).hexdigest()
            for i in range(5):
                p = int(h[i * 6 : i * 6 + 6], 16) % n
                if i < per_query and p % 5 == 0:
                    out.append((seed, hop, h, p, module, url, title))
                elif i < per_query and p % 3 == 0:
                    leads.append((seed, q, i, p))
        for seed, _, _, p in sorted(leads):
            if pages[p].lower() not in met:
                met.add(pages[p].lower())
                front[pages[p].lower()] = (seed, pages[p], str(p), "")
    return out, seeds, hosts


def test_hops_follow_the_loop(spark):
    folder = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()}
    want, _, _ = hops_by_loop(pages, 40)
    got = deliveries.page_authority_hops(spark, folder).collect()
    # all pages are leads of the first hop, so no later hop has news
    assert Counter((r["seed"], r["hop"], r["query_md5"], r["page_id"], r["module"], r["lead_url"], r["lead_title"]) for r in got) == Counter(want) and want


def test_three_hops_within_budgets(spark):
    leads = spark.createDataFrame([(1, "ONE", "http://a.com/1", "media", "x"), (2, "TWO", "http://a.com/2", "media", "x"), (3, "THREE", None, "media", "x"), (4, "FOUR", "http://g.gov.cn/4", "official_site", "x")], "ord long, title string, url string, source_type string, note string")

    def search(asked):
        word = F.regexp_extract("query", "^([A-Z0-9-]+)", 1)
        step = lambda k: F.struct(F.lit(k).alias("position"), F.concat(word, F.lit(f"-N{k}")).alias("title"), F.concat(F.lit("http://"), F.lit(("m.com", "m.com", "s.gov.cn")[k]), F.lit("/"), word, F.lit(f"-N{k}")).alias("url"), F.lit(("media", "media", "")[k]).alias("source_type"))
        return asked.select("query", F.explode(F.array(*(step(k) for k in range(3)))).alias("r")).select("query", "r.*")

    found, asked = authority.hops(leads, search, most=3, per_seed=4, per_host=8)
    rows = asked.collect()
    assert {r["hop"] for r in rows} == {1, 2, 3} and len({r["query"] for r in rows}) == len(rows)
    assert max(Counter(r["seed"] for r in rows).values()) == 4 and max(Counter(r["host"] for r in rows if r["host"]).values()) == 8
    assert 4 not in {r["seed"] for r in rows}
    assert found.count() == len(rows) and {r["source_type"] for r in found.collect()} == {"official_site"}
    one, two = authority.hops(leads.where("false"), search)
    assert one.isEmpty() and two.isEmpty()
