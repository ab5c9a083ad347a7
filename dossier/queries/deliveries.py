"""Queries over deliveries: each customer's orders as a portfolio; pages fetched again by a ladder of attempts, and official pages behind them by hops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import authority, delivery, ladder
from .stories import PRIORITIES

TERMS = delivery.Terms(PRIORITIES, target=11, fewest=4, most=12, floor=2, cap=3, home=2, graded=3)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of their customer's portfolio: of each quarter one counts; dear ones are strict, two of three graded, open ones home, early ones may stand in."""
    price, day, dear = F.col("o_totalprice"), F.col("o_orderdate"), F.col("o_custkey") % 4 * 90000
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("ord"), F.col("o_custkey").alias("portfolio"), F.col("o_orderpriority").alias("module"), (F.year(day) * 4 + F.quarter(day)).alias("key"), price.alias("score"),
        (price >= 150000 + dear).alias("strict"), ((price >= 100000 + dear) & (F.year(day) < 1999)).alias("fallback"), (F.col("o_orderstatus") == "O").alias("home"), (F.col("o_orderkey") % 3 != 0).alias("graded"),
    )


def customer_portfolios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's orders in the order in which they are taken: floors of all priorities first, then by price."""
    out = delivery.chosen(_orders(spark, sf_dir), TERMS, F.desc("score"))
    return out.select(F.col("portfolio").alias("o_custkey"), F.col("ord").alias("o_orderkey"), F.col("place").cast("long").alias("place"))


def customer_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's orders as delivered: strict ones, home ones that stand in for those missing, or stand-ins only."""
    out = delivery.delivered(_orders(spark, sf_dir), TERMS, F.desc("score"))
    return out.select(F.col("portfolio").alias("o_custkey"), F.col("ord").alias("o_orderkey"), "how", F.col("place").cast("long").alias("place"))


def customer_delivery_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each customer's delivery has, what it is short of and which gates it doesn't pass."""
    rows = _orders(spark, sf_dir)
    out = delivery.audit(rows, delivery.delivered(rows, TERMS, F.desc("score")), TERMS, partial=True)
    lists = ("pool_by_module", "taken_by_module", "missing", "underfilled", "out_of_pool", "codes")
    joined = {c: F.concat_ws(",", F.transform(c, lambda x: x.cast("string"))) for c in lists}
    return out.withColumns(joined).withColumnRenamed("portfolio", "o_custkey")


#: Outcomes of an attempt by its draw from 0 to 99: below this bound, status, kind, error, has text.
OUTCOMES = ((14, 200, "http", "", True), (34, 503, "http", "", False), (48, 429, "http", "slow down", False), (62, 404, "http", "", False), (68, 401, "http", "", False), (78, 0, "timeout", "timed out", False), (86, 200, "http", "", False), (92, 403, "captcha", "", False), (100, 0, "", "Sign in required", False))


def _draw(n: str) -> str:
    """SQL of both engines: a draw for a page's n-th attempt."""
    return f"(page_id * 7919 + {n} * 104729 + page_id * {n} * 37) % 10007 % 100"


def page_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page fetched by the ladder; what an attempt brings is drawn from page and attempt. The rounds carry where the text is, its length comes from the page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    others = F.transform(F.slice(F.array(F.lit(1), F.lit(2), F.lit(3)), F.lit(1), (F.col("page_id") % 4).cast("int")), lambda i: F.concat(F.col("url"), F.lit("#"), i.cast("string")))
    sources = pages.select("page_id", "url", F.coalesce(others, F.array().cast("array<string>")).alias("alternate_urls"))

    def attempt(df: DataFrame) -> DataFrame:
        draw, at = F.expr(_draw("attempt_number")), [F.lit(None)] * 4
        for bound, *values in reversed(OUTCOMES):
            at = [F.when(draw < bound, F.lit(v)).otherwise(rest) for v, rest in zip(values, at, strict=True)]
        status, kind, error, text = at
        return df.withColumns({"ok": status == 200, "status": status, "kind": kind, "error": error, "html": F.when(text, F.concat(F.lit("text of "), F.col("page_id").cast("string"))).otherwise(" "), "final_url": F.lit(""), "duration_ms": draw - 50})

    out = ladder.recovered(sources, attempt, jitter=F.lit(0))
    tried = F.concat_ws(",", F.transform("attempts", lambda a: F.concat_ws(":", a["method"], a["status"].cast("string"), a["duration_ms"].cast("string"), a["error"])))
    whole = out.join(pages.select("page_id", F.length("html").cast("long").alias("_size")), "page_id", "left")
    size = F.when(F.col("html") != "", F.col("_size")).otherwise(F.lit(0).cast("long"))
    return whole.select("page_id", "recovery_status", "recovery_method", "final_error", "final_url", F.col("waited_ms").cast("long").alias("waited_ms"), size.alias("n_html"), tried.alias("tried"))


def _found_pages(pages: DataFrame, n: int):
    """A search over pages: the digest of a query draws five of n page numbers; every third page is a publisher's, every fifth an official one."""

    def search(asked: DataFrame) -> DataFrame:
        drawn = asked.select("query", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.conv(F.substring(F.md5(F.col("query").cast("binary")), 1 + i * 6, 6), 16, 10).cast("long") % max(1, n))).alias("position", "page_id"))
        kind = F.when(F.col("page_id") % 5 == 0, "official_site").when(F.col("page_id") % 3 == 0, "media").otherwise("")
        return drawn.join(pages, "page_id").select("query", "position", F.col("page_id").cast("string").alias("title"), "url", kind.alias("source_type"))

    return search


def page_authority_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a lead: the official pages that three hops of searches find behind it, six searches a page and 40 a host at most."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    modules = F.element_at(F.array(*(F.lit(m) for m in authority.ANCHORS), F.lit("")), (F.col("page_id") % 7 + 1).cast("int"))
    title = F.concat(F.lit("NO-"), F.col("page_id").cast("string"), F.element_at(F.array(F.lit(" 公告"), F.lit(" 海关处罚"), F.lit("")), (F.col("page_id") % 3 + 1).cast("int")))
    leads = pages.select(F.col("page_id").alias("ord"), "url", title.alias("title"), modules.alias("module"), F.lit("media").alias("source_type"))
    found, _ = authority.hops(leads, _found_pages(pages, pages.count()), per_host=40)
    return found.select("seed", "hop", F.md5(F.col("query").cast("binary")).alias("query_md5"), F.col("title").cast("long").alias("page_id"), "trust_level", "module", "lead_url", "lead_title")


QUERIES = {f.__name__: f for f in (customer_portfolios, customer_deliveries, customer_delivery_audit, page_recovery, page_authority_hops)}

_IN = "(" + ", ".join(f"'{p}'" for p in PRIORITIES) + ")"
_LIST = "[" + ", ".join(f"'{p}'" for p in PRIORITIES) + "]"
_ROWS = """
WITH o AS (SELECT o_orderkey AS ord, o_custkey AS p, o_orderpriority AS m, year(o_orderdate) * 4 + quarter(o_orderdate) AS k, o_totalprice AS s,
  o_totalprice >= 150000 + o_custkey % 4 * 90000 AS strict, o_totalprice >= 100000 + o_custkey % 4 * 90000 AND year(o_orderdate) < 1999 AS fallback, o_orderstatus = 'O' AS home, o_orderkey % 3 <> 0 AS graded FROM orders),
pool AS (SELECT * FROM o WHERE strict AND graded QUALIFY row_number() OVER (PARTITION BY p, k ORDER BY ord) = 1)"""
_DELIVERED = (
    _ROWS
    + f""",
st0 AS (SELECT * FROM o WHERE strict QUALIFY row_number() OVER (PARTITION BY p, k ORDER BY ord) = 1),
st1 AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY p, m ORDER BY s DESC, ord) = 1 AND m IN {_IN} THEN 0 ELSE 1 END AS lead_ FROM st0),
st AS (SELECT * FROM st1 QUALIFY row_number() OVER (PARTITION BY p ORDER BY lead_, s DESC, ord) <= 11),
short AS (SELECT p, least(2, 11, (SELECT count(*) FROM o WHERE o.p = st.p AND home AND graded)) - count(*) FILTER (home) AS n FROM st GROUP BY p),
fb AS (SELECT * FROM o WHERE fallback QUALIFY row_number() OVER (PARTITION BY p, k ORDER BY s DESC, ord) = 1),
ho AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY s DESC, ord) AS i FROM fb WHERE home AND NOT EXISTS (FROM st WHERE st.p = fb.p AND st.k = fb.k)),
de AS (SELECT p, ord, m, s, strict, home, graded, 'strict' AS how FROM st UNION ALL SELECT ho.p, ord, m, s, strict, home, graded, 'home' FROM ho JOIN short USING (p) WHERE i <= n
  UNION ALL SELECT p, ord, m, s, strict, home, graded, 'fallback' FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY s DESC, ord) AS i FROM fb WHERE p NOT IN (SELECT p FROM st)) WHERE i <= 11)"""
)


def _by_module(table: str) -> str:
    return "[" + ", ".join(f"count(*) FILTER ({table}.m = '{p}')" for p in PRIORITIES) + "]"


def _names(of: str, condition: str) -> str:
    """SQL of a list of the modules whose count meets a condition."""
    return f"list_filter({_LIST}, lambda x: {of}[list_position({_LIST}, x)] {condition})"


_CASE = ["CASE " + " ".join(f"WHEN d < {o[0]} THEN {value(o)}" for o in OUTCOMES) + " END" for value in (lambda o: o[1], lambda o: f"'{o[2]}'", lambda o: f"'{o[3]}'", lambda o: o[4])]
ORACLES = {
    "customer_portfolios": _ROWS
    + f""", r AS (SELECT *, row_number() OVER (PARTITION BY p, m ORDER BY s DESC, ord) AS i FROM pool),
c AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY CASE WHEN m IN {_IN} THEN least(i, 3) ELSE 3 END, s DESC, ord) AS place FROM r WHERE i <= 3)
SELECT p AS o_custkey, ord AS o_orderkey, place FROM c WHERE place <= 11""",
    "customer_deliveries": _DELIVERED + " SELECT p AS o_custkey, ord AS o_orderkey, how, row_number() OVER (PARTITION BY p ORDER BY s DESC, ord) AS place FROM de",
    "customer_delivery_audit": _DELIVERED
    + f""",
a AS (SELECT p, count(*) AS rows, count(*) FILTER (home) AS home_rows FROM o GROUP BY p),
b AS (SELECT p, count(*) AS pool, count(*) FILTER (home) AS pool_home, {_by_module('pool')} AS pm FROM pool GROUP BY p),
c AS (SELECT p, count(*) AS taken, count(*) FILTER (home) AS taken_home, count(*) FILTER (graded) AS taken_graded, count(*) FILTER (NOT strict) AS stand_ins, {_by_module('de')} AS tm FROM de GROUP BY p),
j AS (SELECT a.p, rows, home_rows, coalesce(pool, 0) AS pool, coalesce(pool_home, 0) AS pool_home, coalesce(pm, [0, 0, 0, 0, 0]) AS pm, coalesce(taken, 0) AS taken, coalesce(taken_home, 0) AS taken_home,
  coalesce(taken_graded, 0) AS taken_graded, coalesce(stand_ins, 0) AS stand_ins, coalesce(tm, [0, 0, 0, 0, 0]) AS tm FROM a LEFT JOIN b USING (p) LEFT JOIN c USING (p)),
e AS (SELECT *, least(2, 11, pool_home) AS needed, {_names('tm', '= 0')} AS missing, {_names('tm', '< 2')} AS underfilled, pool >= 4 AND list_min(pm) >= 2 AS achievable, {_names('pm', '< 2')} AS dry FROM j),
f AS (SELECT *, list_filter([CASE WHEN home_rows > 0 AND taken = 0 THEN 'no-items' END, CASE WHEN home_rows > 0 AND taken_home = 0 THEN 'no-home' END, CASE WHEN home_rows > 0 AND taken_home < needed THEN 'few-home' END,
  CASE WHEN taken_graded < least(3, taken) THEN 'few-graded' END, CASE WHEN taken < 4 OR taken > 12 THEN 'item-count' END, CASE WHEN len(missing) > 0 THEN 'missing-module' END, CASE WHEN len(underfilled) > 0 THEN 'underfilled-module' END],
  lambda x: x IS NOT NULL) AS codes FROM e)
SELECT p AS o_custkey, rows, home_rows, pool, pool_home, array_to_string(pm, ',') AS pool_by_module, taken, taken_home, taken_graded, stand_ins, array_to_string(tm, ',') AS taken_by_module, needed,
  array_to_string(missing, ',') AS missing, array_to_string(underfilled, ',') AS underfilled, achievable, array_to_string(list_filter(underfilled, lambda x: list_contains(dry, x)), ',') AS out_of_pool, array_to_string(codes, ',') AS codes,
  CASE WHEN len(codes) = 0 THEN 'whole' WHEN taken BETWEEN 1 AND 12 AND len(list_filter(codes, lambda x: x NOT IN ('item-count', 'missing-module', 'underfilled-module'))) = 0 THEN 'partial' ELSE 'refused' END AS status FROM f""",
    "page_recovery": f"""
WITH RECURSIVE pg AS (SELECT page_id, url, length(html) AS size, page_id % 4 AS others FROM pages),
steps AS (SELECT page_id, n, {_draw('n')} AS d FROM pg, range(1, 8) r(n)),
seen AS (SELECT page_id, n, d - 50 AS ms, {_CASE[0]} AS status, {_CASE[1]} AS kind, {_CASE[2]} AS error, {_CASE[3]} AS text FROM steps),
out AS (SELECT *, status = 200 AND text AS ok, CASE WHEN error <> '' THEN error WHEN status <> 0 THEN 'http-' || status ELSE coalesce(nullif(kind, ''), 'network') END AS why,
  status IN (401, 407) OR kind = 'captcha' OR contains(lower(error), 'sign in required') AS terminal FROM seen),
kinds AS (SELECT *, NOT terminal AND (status IN (0, 408, 425, 429) OR status >= 500) AS again FROM out),
go AS (SELECT page_id, 1 AS n, 'direct' AS method, 0 AS other, 0 AS waited FROM pg
  UNION ALL SELECT go.page_id, go.n + 1, CASE WHEN go.method IN ('direct', 'retry') AND k.again AND go.n < 3 THEN 'retry' WHEN go.method IN ('direct', 'retry') AND NOT k.terminal THEN 'browser' ELSE 'alternate' END,
    CASE WHEN go.method IN ('direct', 'retry') AND (k.again AND go.n < 3 OR NOT k.terminal) THEN 0 ELSE go.other + 1 END, go.waited + CASE WHEN go.method IN ('direct', 'retry') AND k.again AND go.n < 3 THEN [1500, 4000][go.n] ELSE 0 END
  FROM go JOIN kinds k ON k.page_id = go.page_id AND k.n = go.n JOIN pg ON pg.page_id = go.page_id
  WHERE NOT k.ok AND (go.method IN ('direct', 'retry') AND (k.again AND go.n < 3 OR NOT k.terminal) OR go.other < pg.others)),
l AS (SELECT go.*, k.ok, k.status, k.why, greatest(k.ms, 0) AS ms, pg.size, pg.url FROM go JOIN kinds k ON k.page_id = go.page_id AND k.n = go.n JOIN pg ON pg.page_id = go.page_id)
SELECT page_id, CASE WHEN NOT arg_max(ok, n) THEN 'failed' WHEN arg_max(method, n) = 'direct' THEN 'ok' ELSE 'recovered' END AS recovery_status, CASE WHEN arg_max(ok, n) THEN arg_max(method, n) ELSE '' END AS recovery_method,
  CASE WHEN arg_max(ok, n) THEN '' ELSE arg_max(why, n) END AS final_error, CASE WHEN arg_max(ok, n) THEN any_value(url) ELSE '' END AS final_url, max(waited)::BIGINT AS waited_ms,
  CASE WHEN arg_max(ok, n) THEN any_value(size) ELSE 0 END::BIGINT AS n_html, string_agg(method || ':' || status || ':' || ms || ':' || CASE WHEN ok THEN '' ELSE why END, ',' ORDER BY n) AS tried FROM l GROUP BY page_id""",
}
