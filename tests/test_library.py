"""Rules on small fixtures: each fires at least once and stays quiet at least once."""

import io
import random
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from dossier import lexicons as lx
from dossier.functions import dates, urls
from dossier.functions import facts as fx
from dossier.functions import text as tx
from dossier.operators import aggregates, cards, dedupe, events, gates, joins, scoring, select, state
from dossier.plans import report, weekly
from dossier.sources import catalog_rules, readers
from dossier.streaming import seen


def one(spark, **columns):
    """The values of these expressions on one row."""
    return spark.range(1).select(*(c.alias(k) for k, c in columns.items())).first().asDict(recursive=True)


def test_text(spark):
    got = one(
        spark,
        squeeze=tx.squeeze(F.lit(" a　b\n c ")), first=tx.first_text(F.lit(" "), F.lit(None).cast("string"), F.lit(" x ")), values=tx.first_values(F.array(F.lit(" ")), F.array(F.lit("b"), F.lit(""))),
        unique=tx.unique_values(F.array(F.lit("b a"), F.lit("ba"), F.lit("c"), F.lit(" "))), wrap=tx.wrap(F.lit("abcdefgh"), 3, 2), h=tx.hash31(F.lit("abc")), none=tx.hash31(F.lit("")),
        bold=tx.emphasize(F.lit("x罚款y罚款z罚款w罚款"), "罚款"), html=tx.escape_html(F.lit("<a&\"'>")), cell=tx.table_cell(F.lit("a|b\nc")), alias=tx.module_name(F.lit("进出口")), same=tx.module_name(F.lit("other")),
        cut=tx.cut_at_mark(F.lit("一" * 30 + "，" + "二" * 30), 40), short=tx.cut_at_mark(F.lit("abc"), 40), hard=tx.cut_at_mark(F.lit("x" * 50), 40), quote=tx.quote_window(F.lit("0123456789abc"), F.lit("56"), 2, 3), missing=tx.quote_window(F.lit("abc"), F.lit("z")),
        key=tx.event_identity(F.lit(None).cast("string"), F.lit("原标题：A，b（转载）!")), select=tx.selection_key(F.lit(""), F.lit("！"), F.lit("HTTP://X")), grams=tx.bigrams(F.lit("关于2026年1月2日 香水ab")), single=tx.bigrams(F.lit("公告x")), over=tx.overlap(tx.bigrams(F.lit("abcd")), tx.bigrams(F.lit("abc"))),
        reply=tx.envelope(F.lit('```json\n{"a": 1}\n```')).cast("string"), broken=tx.envelope(F.lit("no")).cast("string"), title=tx.title_key(F.lit("某标题 A1 - 新浪网")),
    )
    assert got == {
        "squeeze": "a b c", "first": "x", "values": ["b"], "unique": ["b a", "c"], "wrap": ["abc", "def"], "h": "17862", "none": "0", "bold": "x**罚款**y**罚款**z**罚款**w罚款", "html": "&lt;a&amp;&quot;&#39;&gt;",
        "cell": "a\\|b c", "alias": "进出口动态", "same": "other", "cut": "一" * 30 + "...", "short": "abc", "hard": "x" * 40 + "...", "quote": "3456789", "missing": "", "key": "ab", "select": "http://x|！",
        "grams": ["香水", "水a", "ab"], "single": ["x"], "over": 1.0, "reply": '{"a":1}', "broken": None, "title": "某标题a1",
    }


def test_evidence_lines(spark):
    raw = "# 标题 处罚公告\n| a | b |\n|---|---|\n首页 > 新闻\n打印\n- 罚款10万元 [详情](http://x)\n罚款10万元 详情\n***\n普通的一行文字内容足够长。"
    got = one(spark, clean=tx.clean_evidence(F.lit(raw)), lead=tx.substantive(F.lit(raw), 1), first=tx.first_sentence(F.lit("备受关注的处罚公告引发关注内容很长很长。市场监管局对某公司作出罚款的决定书已经公布。")))
    assert got["clean"] == "标题 处罚公告\na b\n罚款10万元 详情\n普通的一行文字内容足够长。"
    assert got["lead"] == "普通的一行文字内容足够长。" and got["first"].startswith("市场监管局")


PAGE = """<html><head><title>T</title><meta property="og:image" content="http://x/p.jpg"></head><body><nav>menu</nav><!-- c --><article><h1>Head &amp; more</h1>
<p>One</p><p>Two<script>bad()</script></p><a href="/a.html">A <b>link</b></a></article><img src="logo.png"></body></html>"""


def test_pages(spark):
    got = one(spark, a=tx.article(F.lit(PAGE)), links=tx.anchors(F.lit(PAGE)), image=tx.page_image(F.lit(PAGE)), other=tx.page_image(F.lit('<img src="icon.svg"><img src="b.jpg">')), bare=tx.article(F.lit("<p>x</p>")))
    assert got["a"] == {"title": "Head & more", "text": "Head & more One Two A link", "has_container": True, "paragraphs": 2}
    assert got["links"] == [{"href": "/a.html", "title": "A link"}] and got["image"] == "http://x/p.jpg" and got["other"] == "b.jpg" and not got["bare"]["has_container"]
    long_ = "y" * 300
    rows = [("", "z", True, 0), ("Sign in", long_, True, 0), ("a", long_, False, 1), ("a", long_, True, 0), ("a", "y" * 120_001, True, 2)]
    reasons = [r["r"] for r in spark.createDataFrame(rows, "t string, x string, c boolean, p int").select(gates.article_failure("t", "x", "c", "p").alias("r")).collect()]
    assert reasons == ["insufficient-text", "access-or-error-page", "page-shell", None, "article-too-long"]
    assert one(spark, r=gates.article_failure(F.lit(""), F.lit(long_), F.lit(True), F.lit(2), F.lit("application/pdf")))["r"] == "unsupported-content-type"


def test_urls(spark):
    u = F.lit("HTTPS://M.Example.com:443/a/b/?B=2&utm_x=1&a=1&from=q#top")
    got = one(spark, d=urls.dedup_key(u), s=urls.source_key(u), i=urls.identity_key(u), r=urls.record_key(u), x=urls.display_key(u), h=urls.host(u), no=urls.dedup_key(F.lit("not a url/#x")), alias=urls.dedup_key(F.lit("http://www.nifdc.org.cn/directory/web/nifdc/1.html")))
    assert got == {
        "d": "https://example.com/a/b?a=1&b=2", "s": "https://m.example.com/a/b?B=2&a=1", "i": "m.example.com/a/b?B=2&a=1", "r": "https://m.example.com/a/b?B=2&utm_x=1&a=1&from=q",
        "x": "https://m.example.com/a/b?B=2&a=1", "h": "m.example.com", "no": "not a url", "alias": "http://nifdc.org.cn/nifdc/1.html",
    }
    flags = one(
        spark, article=urls.is_article(F.lit("http://a.com/x")), root=urls.is_article(F.lit("http://a.com/")), index=urls.is_article(F.lit("http://a.com/b/index.html")), news=urls.is_article(F.lit("https://news.google.com/x")),
        portal=urls.is_portal(F.lit("http://www.nmpa.gov.cn/xxgk/")), detail=urls.is_portal(F.lit("http://www.nmpa.gov.cn/xxgk/1.html")), home=urls.is_root_or_index(F.lit("http://a.com/xxgk/index.html")),
        www=urls.with_scheme(F.lit("www.a.com")), token=urls.last_segment(F.lit("https://news.google.com/rss/articles/CBM1")), rel=urls.resolve(F.lit("../c.html"), F.lit("http://a.com/x/y/z.html")), bad=urls.resolve(F.lit("javascript:void(0)"), F.lit("http://a.com")),
        files=urls.attachments(F.lit("[a](/f.pdf) [b](http://b.com/g.xlsx) [c](h.html)"), F.lit("http://a.com/x/")), pub=urls.publisher_host(F.lit(""), F.lit("http://www.B.com/x")), cut=urls.without_label(F.lit('/a/b.html "title"')),
    )
    assert flags == {
        "article": True, "root": False, "index": False, "news": False, "portal": True, "detail": False, "home": True, "www": "https://www.a.com", "token": "CBM1", "rel": "http://a.com/x/c.html", "bad": "",
        "files": ["http://a.com/f.pdf", "http://b.com/g.xlsx"], "pub": "b.com", "cut": "/a/b.html",
    }


def test_dates(spark):
    got = one(
        spark, iso=dates.iso_day(F.lit("2026-02-30")), loose=dates.loose_day(F.lit("2026年3月5日")).cast("string"), found=dates.found_date(F.lit("x 13/7/2026 "), F.lit("2025.1.2")), mdy=dates.found_date(F.lit("7-31-2026")), ok=dates.is_day(F.lit("至2026-04-01")), bad=dates.is_day(F.lit("2026-13-01")),
        near=dates.chosen_date(F.lit("2026-01-01"), F.lit("2026-01-04")), far=dates.chosen_date(F.lit("2026-01-01"), F.lit("2026-01-05")), none=dates.chosen_date(F.lit(""), F.lit("2026-01-05")), ms=dates.state_day(F.lit("1767225600000")), t=dates.state_day(F.lit("2026-01-02T01:02")), x=dates.state_day(F.lit("soon")),
        norm=dates.normal_day(F.lit("发布 20260203 号")).cast("string"), start=dates.window_start(F.lit("2026-01-15").cast("date"), 15).cast("string"),
    )
    assert got == {
        "iso": None, "loose": "2026-03-05", "found": "2025-01-02", "mdy": "2026-7-31".replace("7", "07"), "ok": True, "bad": False, "near": "2026-01-04", "far": "2026-01-01", "none": "2026-01-05", "ms": "2026-01-01",
        "t": "2026-01-02", "x": "", "norm": "2026-02-03", "start": "2026-01-01",
    }


NOTICE = "国家药品监督管理局通报：当事人：上海某某化妆品有限公司，文号：沪市监处〔2026〕12号，罚款：63.5万元，没收违法所得。依据《化妆品监督管理条例》第六十一条。自2026-03-01起实施。反馈截止日期：2026-02-30。HS编码：33049900。"


def test_facts_and_grades(spark):
    rows = [(1, NOTICE, "通报", "https://a.gov.cn/x/1.html"), (2, "", "", ""), (3, "食品抽检不合格", "x", "http://a.com/1"), (4, "欢迎访问首页", "首页", "http://a.com/"), (5, "", "t", "http://a.com/f.pdf"), (6, "某公告附件", "公告", "http://a.com/2"), (7, "天气很好", "日记", "http://a.com/3")]
    df = spark.createDataFrame(rows, "ord long, t string, title string, url string").withColumn("f", fx.hard_facts("t"))
    df = df.select("ord", "f", fx.fact_count(F.col("f")).alias("n"), fx.grade("t", F.col("f"), "url", "title", F.lit(""), F.lit("")).alias("g")).orderBy("ord").collect()
    f = df[0]["f"].asDict()
    assert (f["involved_party"], f["document_number"], f["penalty_amount"], f["effective_date"], f["deadline"], f["hs_code"]) == ("上海某某化妆品有限公司", "沪市监处〔2026〕12号", "63.5万元", "2026-03-01", "", "33049900")
    assert f["legal_basis"] == "《化妆品监督管理条例》第六十一条" and f["signal_type"] == "风险案例" and f["risk_tier"] == "立即处理" and df[0]["n"] >= 7
    assert [r["g"]["evidence_grade"] for r in df] == ["hard_fact_ready", "reject", "reject", "lead_only", "attachment_pending", "lead_only", "reject"]
    assert [r["g"]["evidence_reason"] for r in df][1:5] == ["empty-evidence", "food-only-event", "lead-or-navigation-page", "attachment-without-text"]
    assert "63.5万元" in df[0]["g"]["evidence_quotes"]["penalty_amount"]
    merged = one(spark, m=fx.merge_facts(F.struct(F.lit("a").alias("x"), F.lit("b").alias("y")), F.struct(F.lit("c").alias("x"), F.lit(" ").alias("y")), fields=["x", "y"]))
    assert merged["m"] == {"x": "c", "y": "b"}


GOOD = ("国家药监局通报化妆品抽检不合格处罚", "国家药监局2026年1月5日通报某化妆品公司产品抽检不合格并罚款10万元。", "https://www.nmpa.gov.cn/a/1.html", "2026-01-05", "国家药监局", "official_site", "regulator", "", "")


def test_editorial_gate(spark):
    def but(**k):
        names = ["title", "article_text", "url", "published_at", "source_name", "source_type", "authority_type", "source_scope", "detail_status"]
        return tuple(k.get(n, v) for n, v in zip(names, GOOD, strict=True))

    cases = {
        None: but(), "non-publisher-url": but(url="https://news.google.com/x"), "missing-direct-url": but(url="http://a.com/"), "missing-valid-date": but(published_at="2026-1-5"), "service-promotion": but(title="双清包税"),
        "promotional-content": but(title="企业供稿"), "navigation-shell": but(title="网站地图"), "non-authoritative-source": but(source_type="media", authority_type="media", source_name="搜狐"), "not-beauty-industry": but(title="国家统计局通报罚款", article_text="国家统计局2026年1月5日通报某公司罚款10万元情况说明。"),
        "no-concrete-event": but(title="护肤", article_text="护肤小知识与生活的一些想法记录在这里。"), "generic-opinion": but(title="行业观察：化妆品公司", article_text="化妆品公司2026年1月5日发布年度报告内容较多说明。"),
    }
    schema = "title string, article_text string, url string, published_at string, source_name string, source_type string, authority_type string, source_scope string, detail_status string"
    df = spark.createDataFrame([(*row, want) for want, row in cases.items()], schema + ", want string").withColumn("snippet", F.lit(""))
    for got in gates.editorial_gate(df).collect():
        assert got["reason"] == got["want"] and got["accepted"] == (got["want"] is None)
        if got["want"] is None:
            assert got["inferred_module"] == "产品质量/召回与安全风险" and got["home_relevant"]


def test_freshness_boundaries(spark):
    end = F.lit("2026-01-31").cast("date")
    rows = [("2026-01-31", "current-week"), ("2026-01-17", "current-week"), ("2026-01-16", "stale"), ("2026-02-01", "future-date"), ("2026-02-30", "date-unknown"), ("", "date-unknown")]
    got = spark.createDataFrame(rows, "d string, want string").select("want", gates.freshness("d", end).alias("f")).collect()
    assert all(r["f"]["status"] == r["want"] for r in got)
    old = F.lit("2025-06-01")
    more = one(
        spark, node=gates.freshness(old, end, deadlines=[F.lit("2026年3月1日")], hints=F.lit("征求意见")), late=gates.freshness(old, end, deadlines=[F.lit("2026-05-02")], exception=F.lit("upcoming_deadline")), going=gates.freshness(old, end, exception=F.lit("ongoing_enforcement"), change=F.lit("x")),
        action=gates.freshness(old, end, hints=F.lit("公开征集"), open_action=F.lit("x")), upd=gates.freshness(old, end, updated=F.lit("2026-01-30")),
    )
    assert {k: v["status"] for k, v in more.items()} == {"node": "historical-node", "late": "stale", "going": "historical-ongoing", "action": "historical-action", "upd": "current-week-update"}


def test_other_gates(spark):
    got = one(
        spark, timeout=gates.fetch_failure(F.lit(0), F.lit("timeout"), F.lit("")), gone=gates.fetch_failure(F.lit(404), F.lit("http"), F.lit("")), busy=gates.fetch_failure(F.lit(503), F.lit("http"), F.lit("")), login=gates.fetch_failure(F.lit(200), F.lit("http"), F.lit("Login required")),
        lead=gates.authority_trust(F.lit("搜狐"), F.lit("http://a.com"), F.lit(""), F.lit(""), F.lit("")), first=gates.authority_trust(F.lit("淘宝规则"), F.lit("http://a.com"), F.lit(""), F.lit(""), F.lit("")), official=gates.authority_trust(F.lit("x"), F.lit("http://www.fda.gov/x"), F.lit(""), F.lit(""), F.lit("")),
        ok=gates.recovery(F.array(F.struct(F.lit("direct").alias("method"), F.lit(False).alias("ok"), F.lit("e").alias("error")), F.struct(F.lit("browser").alias("method"), F.lit(True).alias("ok"), F.lit("").alias("error")))),
        msg=gates.message_reason(F.lit("来源"), ["来源", "期间"], "建议"), cap=gates.access_kind(F.lit("x"), F.lit("captcha")), fine=gates.access_kind(F.lit("x"), F.lit("y")),
    )
    assert (got["timeout"]["retryable"], got["gone"]["retryable"], got["busy"]["retryable"], got["login"]["terminal"]) == (True, False, True, True) and got["gone"]["reason"] == "http-404"
    assert [got[k]["level"] for k in ("lead", "first", "official")] == ["lead_only", "official_first_party", "primary_authority"]
    assert got["ok"]["status"] == "recovered" and got["ok"]["recovery_method"] == "browser" and got["msg"] == "missing:期间" and got["cap"] == "captcha" and got["fine"] is None
    fresh = F.struct(F.lit(True).alias("accepted"), F.lit("action").alias("allowed_tier"))
    facts, seen_ = F.array(F.lit("某化妆品公司因虚假宣传被罚款63.5万元并责令改正，处罚决定书已公布在官网上。")), F.array(F.lit("跟踪 2026-03-01 的生效及配套执行口径。"))

    def item(fs, conf):
        return gates.report_item(fs, seen_, F.lit("http://a.com/1"), F.lit("regulator"), F.lit(conf), F.lit("direct"), F.lit("high"), F.lit("2026-01-30"), F.lit("案例"), F.lit(""), fresh, F.lit("2026-01-31").cast("date"))

    r = one(spark, good=item(facts, "high"), bad=item(F.array(F.lit("无关")), "low"), why=gates.failed_dimensions(item(F.array(F.lit("无关")), "low")))
    assert r["good"]["tier"] == "action" and r["good"]["score"] == 10 and r["bad"]["tier"] == "reject" and r["why"] == ["evidence", "relevance", "depth"]


def rows(spark, data, schema, parts=3):
    return spark.createDataFrame(data, schema).repartition(parts)


def test_winners_do_not_depend_on_partitions(spark):
    data = [(i, f"k{i % 4}", i % 3) for i in range(40)] + [(90, None, 0), (91, "", 1)]
    for parts in (1, 7):
        df = rows(spark, data, "ord long, k string, s int", parts)
        assert sorted(r["ord"] for r in dedupe.first_wins(df, "k").collect()) == [0, 1, 2, 3]
        assert sorted(r["ord"] for r in dedupe.last_wins(df, "k").collect()) == [36, 37, 38, 39]
        assert sorted(r["ord"] for r in dedupe.first_wins(df, "k", keep_null=True).collect()) == [0, 1, 2, 3, 90, 91]
        assert sorted((r["ord"], r["place"]) for r in dedupe.best_wins(df, F.when(F.col("k") != "", F.col("k")), F.col("s")).collect()) == [(2, 2), (5, 1), (8, 0), (11, 3)]
    a, b = rows(spark, [(1, "x"), (2, "y")], "ord long, k string"), rows(spark, [(1, "y"), (2, "z")], "ord long, k string")
    assert sorted((r["k"], r["source_rank"]) for r in dedupe.priority_union([a, b], "k").collect()) == [("x", 0), ("y", 0), ("z", 1)]
    assert [r["k"] for r in dedupe.unseen(a, "k", b.withColumnRenamed("k", "u")).collect()] == ["x"]
    assert dedupe.same_sets(a, a).isEmpty() and dedupe.same_sets(a, b).count() == 4


def test_selections(spark):
    df = rows(spark, [(0, "a", 5), (1, "a", 9), (2, "b", 1), (3, "a", 7), (4, "c", 8), (5, "b", 2)], "ord long, g string, s int")
    assert [r["ord"] for r in select.round_robin(df, "g", 5).orderBy("turn").collect()] == [0, 2, 4, 1, 5]
    assert [r["ord"] for r in select.floor_then_fill(df, "g", 1, 5, -F.col("s"), F.col("ord"), most=2).orderBy("turn").collect()] == [1, 4, 5, 3, 2]
    assert sorted(r["ord"] for r in select.cap_where(df, F.col("g") == "a", "g", 1, F.col("ord")).collect()) == [0, 2, 4, 5]
    got = {r["ord"]: r["reason"] for r in select.joint_quota(rows(spark, [(i, h, m) for i, (h, m) in enumerate([("h", "x"), ("h", "y"), ("h", "x"), ("i", "x"), ("i", "x"), ("j", "y"), ("k", "z")])], "ord long, host string, module string"), {"host": 2, "module": 2}, 5).collect()}
    assert got == {0: None, 1: None, 2: "host-capacity", 3: None, 4: "module-capacity", 5: None, 6: None}
    assert sorted((r["ord"], r["batch"]) for r in select.batches(df, 2, "g", F.col("ord")).collect()) == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 0), (5, 0)]
    chunks = one(spark, c=select.byte_chunks(F.array(F.lit("一二"), F.lit("abc"), F.lit("x" * 20), F.lit("y")), 12, "\n"), none=select.byte_chunks(F.array().cast("array<string>"), 12))
    assert chunks == {"c": ["一二\nabc", "x" * 20, "y"], "none": []}
    assert one(spark, f=select.fitting([F.lit("x" * 30), F.lit("short")], 10))["f"] == "short"
    assert {r["ord"] for r in select.quota_swap(df, F.col("g") == "b", 2, 3, F.desc("s"), F.col("ord")).collect()} == {5, 2, 1}


def test_joint_quota_in_rounds_is_the_fold(spark, monkeypatch):
    monkeypatch.setattr(select, "STRETCH", 7)
    rng = random.Random(5)
    for total, caps in [(3, {"host": 2, "module": 2}), (12, {"host": 3, "module": 5}), (500, {"host": 2, "module": 9}), (0, {"host": 1}), (4, {"host": 0})]:
        data = [(rng.choice([1, None, *range(60)]), rng.choice("abcdefgh") if rng.random() < 0.9 else None, rng.choice("xyz"), rng.choice(["u", "v", *map(str, range(40))])) for _ in range(120)]
        data += data[:20]
        for unique in [None, "url"]:
            got = [tuple(r) for r in select.joint_quota(rows(spark, data, "ord long, host string, module string, url string"), caps, total, unique=unique).collect()]
            order = ["ord", *caps, *([unique] if unique else [])]
            at = {"ord": 0, "host": 1, "module": 2, "url": 3}
            key = lambda r: (r[0] is None, *((r[at[k]] is not None, r[at[k]] if r[at[k]] is not None else 0) for k in order))  # noqa: B023, E731
            want, taken, used, seen = [], 0, {}, set()
            for r in sorted(data, key=key):
                why = "total" if taken >= total else "duplicate" if unique and r[3] in seen else next((f"{c}-capacity" for c in caps if used.get((c, r[at[c]]), 0) >= caps[c]), None)
                if why is None:
                    taken += 1
                    seen.add(r[3])
                    for c in caps:
                        used[c, r[at[c]]] = used.get((c, r[at[c]]), 0) + 1
                want.append((*(r[at[k]] for k in order), why))
            assert sorted(map(repr, ((*(r[at[k]] for k in order), r[4]) for r in got))) == sorted(map(repr, want))


def test_joins(spark):
    c = rows(spark, [(0, "A", "u1", "t1", ""), (1, "B", "u2", "t2", ""), (2, "C", "u9", "", "")], "ord long, title string, k1 string, k2 string, k3 string")
    r = rows(spark, [(0, "R0", "t2", "z", True), (1, "R1", "u2", "q", True), (2, "", "u1", "", True), (3, "R3", "n1", "", True), (4, "R4", "n1", "", True), (5, "R5", "n5", "", False)], "ord long, title string, a string, b string, hard boolean")
    got = joins.merge_by_keys(c, r, ["k1", "k2", "k3"], ["a", "b"], ["title"], F.col("hard")).select("matched", "title").collect()
    assert sorted(map(tuple, got)) == [("appended", "R3"), ("merged", "A"), ("merged", "R1"), ("unmatched", "C")]
    t = rows(spark, [(0, "x", "1"), (1, "x", "2")], "ord long, k string, v string")
    assert joins.lookup(t.select("k").distinct(), t, "k", ["v"], last=True).first()["v"] == "2" and joins.lookup(t.select("k").distinct(), t, "k", ["v"]).first()["v"] == "1"
    p, d = rows(spark, [(1, "b c d e f"), (2, "zz"), (3, "not there at all here"), (4, "")], "i int, p string"), rows(spark, [(7, "a b c d e fg"), (8, "b c  d e f"), (9, "xzzy")], "d int, t string")
    assert sorted((r["i"], r["d"]) for r in joins.substring_matches(p, d, "p", "t").collect()) == [(1, 7), (2, 9)]
    e = joins.bijection_errors(rows(spark, [(1,), (2,), (2,), (3,)], "k int"), rows(spark, [(1,), (2,), (4,)], "k int"), "k")
    assert sorted(map(tuple, e.collect())) == [(2, "left-repeated"), (3, "left-only"), (4, "right-only")]


def test_coverage_and_funnel(spark):
    s = rows(spark, [(0, "a", "high", "中国", False), (1, "b", "low", "美国", False), (2, "c", "high", "中国", True), (3, "d", "low", "", False)], "ord long, name string, priority string, country string, monitor_only boolean").withColumn("region", F.lit(""))
    res = rows(spark, [(0, "a", "failed", 0), (1, "a", "ok", 3), (2, "b", "ok", 0), (3, "d", "empty", 0)], "ord long, name string, status string, candidate_count int")
    got = aggregates.coverage(s, res).first()
    assert (got["total"], got["covered"], got["critical"], got["failed_sources"], got["monitored_failed_sources"]) == (3, 2, 1.0, ["b"], ["c"]) and got["overall"] == pytest.approx(2 / 3)
    with pytest.raises(aggregates.GateError, match="overall-coverage"):
        aggregates.require_coverage(aggregates.coverage(s, res))
    assert aggregates.require_coverage(aggregates.coverage(s.limit(0), res.limit(0)))["overall"] == 1.0
    modules = aggregates.dimension(spark, lx.MODULES, "module")
    f = aggregates.funnel({"discovered": rows(spark, [("进出口动态",), ("x",)], "m string"), "final": rows(spark, [("进出口动态",)], "m string")}, "m", modules).collect()
    assert len(f) == 6 and sum(r["discovered"] for r in f) == 1 and {r["module"]: r["final"] for r in f}["进出口动态"] == 1
    acc = rows(spark, [(0, "a", "2026-01-02", True, "m"), (1, "A!", "2026-01-03", True, "m"), (2, "b", "2025-01-01", True, "n")], "ord long, title string, published_at string, home_relevant boolean, module string")
    p = aggregates.proof(acc, tx.event_identity(F.lit(""), "title"), F.lit("2026-01-01"), F.lit("2026-01-31"), items=1, home=1, modules=2).first()
    assert (p["primary_count"], p["duplicates"], p["failure_codes"], p["pass"]) == (1, 1, ["minimum-modules"], False)


def test_scores(spark):
    got = one(spark, a=scoring.amount_points(F.lit("罚款1,200元")), b=scoring.amount_points(F.lit("12万元")), c=scoring.amount_points(F.lit("1亿元")), d=scoring.amount_points(F.lit("none")), rank=scoring.module_rank(F.lit("进出口")), last=scoring.module_rank(F.lit("?")), s=scoring.candidate_score(F.lit("high"), F.lit("regulator"), F.lit("official_site"), F.lit("2026-01-20"), F.lit("2026-01-31").cast("date")))
    assert got == {"a": 18, "b": 32, "c": 45, "d": 0, "rank": 3, "last": 6, "s": 145}


RECORDS = [
    (0, "某通报A", "http://www.nmpa.gov.cn/1.html", "国家药监局", "official_site", "上海甲乙化妆品有限公司被罚款10万元，文号：沪市监处〔2026〕12号。"),
    (1, "转载B", "http://news.a.com/2.html", "某报", "", "上海甲乙化妆品有限公司因虚假宣传被罚款10万元。"),
    (2, "C", "http://b.com/3.html", "另一报", "", "北京丙丁化妆品有限公司被罚款10万元，文号：沪市监处〔2026〕12号。"),
    (3, "D", "http://c.com/4.html", "报", "", "天津戊己商行召回产品，原因不明。"),
    (4, "E", "http://d.com/5.html", "报", "", "上海甲乙化妆品有限公司被罚款20万元，2026-01-02。"),
]


def test_event_groups(spark):
    df = rows(spark, RECORDS, "ord long, title string, url string, source_name string, source_type string, article_text string")
    for c, v in {"authority_type": "", "module": "", "country": "中国", "published_at": "2026-01-02", "publisher_host": "", "fit_markdown": "", "raw_markdown": ""}.items():
        df = df.withColumn(c, F.lit(v))
    graded = weekly.hydrated(df).persist()
    got = {r["group"]: r.asDict() for r in weekly.corroborated(graded).collect()}
    assert set(got) == {0, 2, 3} and got[0]["n_rows"] == 3 and got[0]["verification_status"] == "primary_verified" and got[0]["canonical_ord"] == 0
    assert got[3]["verification_status"] == "unverified" and got[3]["n_sources"] == 1 and "amounts" not in got[0]["conflicts"]
    pairs = spark.createDataFrame([(0, 1), (1, 2), (2, 3)], "a long, b long")
    chain = rows(spark, [(i,) for i in range(5)], "ord long")
    assert sorted((r["ord"], r["group"]) for r in events.greedy_groups(chain, pairs).collect()) == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 4)]
    assert sorted((r["ord"], r["group"]) for r in events.greedy_groups(chain, pairs, leaders=True).collect()) == [(0, 0), (1, 0), (2, 2), (3, 2), (4, 4)]


def test_state(spark):
    raw = rows(spark, [("http://m.a.com/x?utm_source=1", "2026-01-01"), ("http://a.com/x", "2026-01-05"), ("http://b.com/", ""), ("http://c.com/", "2025-10-01"), ("", "2026-01-01")], "u string, t string")
    now = F.lit("2026-01-31").cast("date")
    seen_ = state.load_seen(raw, F.col("u"), F.col("t"))
    assert sorted(map(tuple, seen_.collect())) == [("http://a.com/x", "2026-01-05"), ("http://b.com", ""), ("http://c.com", "2025-10-01")] or seen_.count() == 4
    merged = {r["u"]: r["t"] for r in state.merge_seen(seen_, rows(spark, [("http://d.com/1",), ("http://a.com/x/",)], "url string"), now).collect()}
    assert merged["http://d.com/1"] == "2026-01-31" and "http://c.com" not in merged and merged["http://a.com/x"] == "2026-01-05"
    items = rows(spark, [("http://a.com/1",), ("http://a.com/2",)], "source_url string")
    ts = F.lit("2026-01-31 00:00:00").cast("timestamp")
    kv = state.mark(spark.createDataFrame([("old", None)], "h string, ts timestamp").where("ts is not null"), items, ts)
    assert state.all_seen(state.seen_hashes(items, kv, ts)).first()["is_duplicate"] is True
    assert state.all_seen(state.seen_hashes(items, kv.limit(1), ts)).first()["is_duplicate"] is False
    assert state.all_seen(state.seen_hashes(items.limit(0), kv, ts)).first()["is_duplicate"] is False


def test_readers(spark, tmp_path):
    def sheet(rows_):
        cells = "".join(f'<row r="{i}">' + "".join(f'<c r="{k}{i}" t="inlineStr"><is><t>{v}</t></is></c>' for k, v in r.items()) + "</row>" for i, r in enumerate(rows_, 1))
        return f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{cells}</sheetData></worksheet>'

    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet([{"A": "序号", "B": "name"}, {"A": "1", "B": "m1", "C": "n1", "D": "www.a.com"}, {"A": "2", "C": "n2", "D": "http://b.com"}, {"A": "3", "C": "n2", "D": "http://b.com"}, {"A": "4", "C": "no url"}]))
    (tmp_path / "book.xlsx").write_bytes(data.getvalue())
    got = readers.with_scope(readers.catalog(readers.read_workbooks(spark, str(tmp_path / "*.xlsx")), {"module": "B", "name": "C", "url": "D"})).orderBy("id").collect()
    assert [(r["id"], r["module"], r["name"], r["url"], r["source_scope"]) for r in got] == [(1, "m1", "n1", "https://www.a.com", "portal"), (2, "m1", "n2", "http://b.com", "portal")]
    texts = rows(spark, [('{"records": [{"url": "http://a"}, {"url": null}]}',), ('[{"url": "http://b"}]',), ("junk",)], "value string")
    assert sorted(str(r["url"]) for r in readers.envelope_rows(texts, "value", "url: string").collect()) == ["None", "http://a", "http://b"]
    feed = '<rss><item><title>A &amp; B - Src</title><link>https://news.google.com/x</link><pubDate>Mon, 05 Jan 2026 23:00:00 GMT</pubDate><source url="http://s.com">Src</source></item><item><title>no link</title><link>http://x</link><pubDate>Mon, 05 Jan 2026 23:00:00 GMT</pubDate></item></rss>'
    got = readers.feed_items(rows(spark, [(feed, "m")], "x string, module string"), "x", "module").collect()
    assert [(r["title"], r["published_at"], r["publisher_url"], r["module"]) for r in got] == [("A & B", "2026-01-05", "http://s.com", "m")]
    p = one(spark, a=readers.decoding_params(F.lit('<div data-n-a-ts="1" data-n-a-sg="x">')), b=readers.decoding_params(F.lit("<div>")), u=readers.batch_target(F.lit(")]}'\n\n" + '[["wrb.fr","Fbv4je","[\\"garturlres\\",\\"https://a.com/1\\"]"]]')))
    assert p == {"a": {"timestamp": "1", "signature": "x"}, "b": None, "u": "https://a.com/1"}

    def client(url):
        if "bad" in url:
            raise OSError("timed out")
        return 200, "<p>x</p>", url

    pages = {r["url"]: (r["status"], r["error"]) for r in readers.fetched(rows(spark, [("http://a",), ("http://bad",)], "url string"), client).collect()}
    assert pages == {"http://a": (200, ""), "http://bad": (0, "timed out")}


def test_discovery_and_reports(spark):
    data = [(0, "resolved", "http://a.com/1", "2026-01-05", "化妆品 处罚"), (1, "failed", "", "", ""), (2, "resolved", "http://a.com/1", "2026-01-05", "化妆品 处罚"), (3, "resolved", "http://a.com/2", "2026-01-05", "化妆品 罚款"), (4, "resolved", "http://b.com/2", "2025-01-05", "罚款"), (5, "resolved", "http://b.com/3", "2026-01-06", "选购指南 罚款"), (6, "resolved", "http://b.com/4", "2026-01-06", "天气")]
    df = rows(spark, data, "ord long, resolution_status string, url string, published_at string, title string").withColumn("module", F.lit("广告合规及处罚案例")).withColumn("discovery_module", F.lit("")).withColumn("discovery_beauty_scoped", F.lit(False))
    got = {r["ord"]: r["reason"] for r in weekly.discovered(df, F.lit("2026-01-01"), F.lit("2026-01-31"), per_host=1).collect()}
    assert got == {0: None, 1: "resolution-failed", 2: "duplicate", 3: "publisher_host-capacity", 4: "outside-period", 5: "promotional-content", 6: "missing-module-event"}
    items = rows(spark, [(0, "HTTP://a.com/1/"), (1, "https://a.com/1"), (2, "http://z.com")], "ord long, source_url string")
    seen_ = rows(spark, [(0, "http://a.com/1"), (1, "http://a.com/1?utm_x=2")], "ord long, url string")
    assert {r["ord"]: r["source_url"] for r in weekly.observed_only(items, seen_).collect()} == {0: "http://a.com/1?utm_x=2", 1: "http://a.com/1?utm_x=2"}
    cards = rows(spark, [(0, "进出口", "美国", 90), (1, "美妆动态", "中国", 50), (2, "美妆动态", "美国", 60)], "ord long, module string, country string, score int")
    assert [r["ord"] for r in report.module_order(cards).orderBy("turn").collect()] == [1, 2, 0]
    msgs = report.messages(rows(spark, [(i, "x" * 700) for i in range(4)], "turn int, markdown string"), 1500).orderBy("id").collect()
    assert [(m["id"], m["bytes"]) for m in msgs] == [("weekly-report-1", 1402), ("weekly-report-2", 1402)]
    shown = rows(spark, [(0, "进出口", "美国", 5.0), (1, "行业新闻简讯", "中国", 1.0), (2, "进出口", "美国", 9.0)], "ord long, display_module string, country string, rank double")
    assert [r["ord"] for r in report.editorial_rows(shown).orderBy("number").collect()] == [1, 2, 0]
    cand = rows(spark, [(i, "m", "中国" if i % 2 else "x") for i in range(20)], "ord long, module string, country string")

    def analyse(module, pdf):
        if pdf["ord"].min() == 0:
            raise ValueError("model failed")
        return pd.DataFrame({"module": [module], "n": [len(pdf)]})

    assert sorted(r["n"] for r in weekly.grouped_analysis(cand, analyse, "module string, n int").collect()) == [4, 8]


def test_stream_keeps_the_first(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("http://a.com/x?utm_a=1", "2026-01-01 00:00:00"), ("http://m.a.com/x".replace("m.a", "a"), "2026-01-02 00:00:00"), ("http://b.com", "2026-01-02 00:00:00"), ("", "2026-01-02 00:00:00")], "url string, at string").withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("url string, at timestamp").parquet(src)
    q = seen.start_memory(seen.unseen_stream(stream, "url", "at"), "unseen_rows")
    q.awaitTermination(60)
    assert sorted(r["u"] for r in spark.table("unseen_rows").collect()) == ["http://a.com/x", "http://b.com"]
    q.stop()


def test_topics_come_from_name_address_module_and_country(spark):
    """A row for each rule, by the word in the name, and for rules that a module or a place meets."""
    words = [(w, topic) for ws, topic in catalog_rules.TOPIC_WORDS for w in ws]
    named = [(i, f"x{w.lower()}x", "", "") for i, (w, _) in enumerate(words)]
    more = [(100, "上海市场监督管理局", "http://www.a.gov.cn/x", ""), (101, "商标报", "https://t.com", ""), (102, "blog", "https://b.org", ""), (103, "blog", "https://b.org", "进出口动态"), (104, None, None, None)]
    df = spark.createDataFrame([*named, *more], "index long, name string, url string, category string")
    got = {r["index"]: r["topics"] for r in catalog_rules.classified(df).collect()}
    assert all(topic in got[i] for i, (_, topic) in enumerate(words))
    assert got[100] == ["广告合规", "行政处罚", "广告合规及处罚案例", "中国"] and got[101] == ["知识产权", "知识产权动态"]
    assert got[102] == got[104] == ["美妆", "美妆行业动态"] and got[103] == ["进出口", "跨境电商", "进出口/跨境电商动态"]


def test_what_may_be_selected(spark):
    facts = "product_or_batch string, penalty_amount string"
    cases = [
        (("面霜", None), "标题", "hard_fact_ready", "", True), (("[]( javascript:void", None), "标题", "hard_fact_ready", "", False), (("见原文", None), "标题", "hard_fact_ready", "", False),
        (("见原文", None), "关于发布《化妆品标签管理办法》的公告", "hard_fact_ready", "", True), ((None, "undefined"), "标题", "hard_fact_ready", "", False), ((None, None), "标题", "reject", "", False), ((None, None), "标题", "lead_only", "", False),
        ((None, None), "标题", "", "hard_fact_list", True), ((None, None), "标题", "", "portal", False), ((None, None), "标题", "", "", True), (None, "标题", "", "", True),
    ]
    df = spark.createDataFrame([(i, c[0], c[1], c[2], c[3]) for i, c in enumerate(cases)], f"i int, hard_facts struct<{facts.replace(' string', ':string')}>, title string, evidence_grade string, source_scope string")
    got = {r["i"]: r["ok"] for r in cards.cards(df.withColumn("url", F.lit("http://a.com/x"))).select("i", cards.may_select().alias("ok")).collect()}
    assert got == {i: c[4] for i, c in enumerate(cases)}
    assert [r["p"] for r in df.select(cards.policy_product("title").alias("p"), "i").orderBy("i").collect()][3] == "化妆品标签管理办法"
