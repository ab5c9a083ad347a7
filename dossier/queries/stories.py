"""Queries over stories: attachments of events, documents of one event, publishers, rewritten texts, messages and a portfolio of orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lexicons as lx
from ..functions import phrases
from ..operators import attachments, portfolio, publishers, sameness, select
from .documents import _GRAMS, _SQUEEZED
from .pages import _ARTICLES, _KEYS, _articles, _text, page_links


def page_attachment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every link of every page as a numbered attachment: whether it belongs to its own page's story, and the first page whose story it belongs to, -1 for none."""
    events = _articles(spark, sf_dir).select(F.col("page_id").alias("ord"), "page_id", "title")
    links = page_links(spark, sf_dir).select("page_id", "pos", F.concat(F.lit("附件"), F.col("pos").cast("string"), F.lit("："), F.col("title")).alias("title"))
    own = attachments.first_meetings(links, events, scope="page_id").withColumnRenamed("event", "own")
    first = attachments.first_meetings(own, events)
    return first.select("page_id", "pos", F.col("own").isNotNull().alias("own_page"), F.coalesce("event", F.lit(-1).cast("long")).alias("first_page"))


def _name(*parts: Column, n: int) -> Column:
    """A name of n letters (ten at most) of an alphabet of 4,096 that these values decide."""
    h = F.md5(F.concat(*parts).cast("binary"))
    return F.decode(F.unhex(F.concat(*(F.concat(F.lit("5"), F.substring(h, 1 + 3 * i, 3)) for i in range(n)))), "UTF-16BE")


def _stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A story for each document: three in a row have one name, twelve a common beginning, two the same facts; the last of twelve has the next one's identity."""
    k = F.col("doc_id")
    part = lambda n: F.floor(k / n).cast("string")
    title = F.concat(_name(F.lit("p"), part(12), n=3), _name(F.lit("t"), part(3), n=7), F.when(k % 3 == 1, _name(F.lit("e"), part(1), n=1)).otherwise(""))
    facts = F.concat(_name(F.lit("f"), part(2), n=10), _name(F.lit("g"), part(2), n=10), F.lit(" "), _name(F.lit("h"), part(1), n=2))
    identity = F.concat(F.lit("id"), (k + F.when(k % 12 == 11, 1).otherwise(0)).cast("string"))
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(k.alias("ord"), identity.alias("identity"), title.alias("title"), facts.alias("facts"))


def doc_event_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose stories are of one event: by identity, by title, or by titles that touch and alike facts. All three rules decide, alone and together."""
    _, kinds = sameness.classes(_stories(spark, sf_dir))
    return sameness.event_pairs(kinds)


def doc_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stands for its event, taken in order."""
    return sameness.one_of_each_event(_stories(spark, sf_dir)).select(F.col("ord").alias("doc_id"), "leader", "n_rows")


#: Phrases that overlap, hold each other and complete each other.
PHRASES = [("in the", "[in]"), ("the ", "[t] "), ("ing th", "[x]"), ("tion", "[n]"), ("en", ""), ("der", "[d]"), ("que", "[q]"), ("nd", "[&]"), ("[n]s", "[ns]"), ("ción", "[c]")]
PUBLISHERS = [
    ("example.com", "", "Com"), ("example.org", "", "Org"), ("example.net", "/en", "Net in English"), ("example.net", "/fr/", "Net in French"), ("ththan.example.net", "", "Than"), ("blog.ththan.example.net", "/en", "Than's blog"),
    ("cheap-pills.example.com", "", "Pills"), ("ample.com", "", "none"), ("ththre.example.com", "/fr/825", "Page 825"),
]
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def doc_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text with a table of phrases replaced, as its digest and its length."""
    out = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", phrases.rewrite("text", phrases.phrases(PHRASES)).alias("text"))
    return out.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.length("text").cast("long").alias("n_chars"))


def page_publishers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its publisher by the longest host and path of a table; none is an empty string."""
    table = spark.createDataFrame(PUBLISHERS, "host string, path string, name string")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return publishers.published_by(pages, table).select("page_id", F.coalesce("publisher", F.lit("")).alias("publisher"))


def _by_value(value: str, key: str) -> Column:
    """A number that orders rows by falling value (in cents), then by key (below 10 to the power of 10)."""
    return F.col(key) - F.round(F.col(value) * 100).cast("long") * F.lit(10**10)


def order_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 orders of different customers by price, five of a priority at most, low ones from 400,000 on; low ones are seeded with customers of large balance, urgent ones filled with high ones in progress."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderpriority <> '5-LOW' or o_totalprice >= 400000")
    rows = o.select(_by_value("o_totalprice", "o_orderkey").alias("ord"), "o_orderkey", F.col("o_orderpriority").alias("module"), F.col("o_custkey").alias("key"), (F.col("o_orderstatus") == "P").alias("open"))
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_mktsegment = 'BUILDING'")
    seeds = c.select(_by_value("c_acctbal", "c_custkey").alias("ord"), (-1 - F.col("c_custkey")).alias("o_orderkey"), F.col("c_custkey").alias("key"))
    rules = portfolio.Rules(PRIORITIES, target=24, most=5, least=4, seeded="5-LOW", moves={"1-URGENT": ("2-HIGH", F.col("open"))})
    return portfolio.repaired(rows, rules, seeds=seeds).select(F.col("o_orderkey").alias("order_or_customer"), "placed", "how", "turn")


def customer_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's orders as a message of 400 bytes at most: the cheapest orders are shortened first, and all of them to their number where that isn't enough."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    key = F.col("o_orderkey").cast("string")
    full = F.concat(F.lit("Order "), key, F.lit(", status "), "o_orderstatus", F.lit(", priority "), "o_orderpriority", F.lit("; "))
    sized = o.withColumns({"full": F.octet_length(full), "compact": F.octet_length(key) + 8, "minimal": F.octet_length(key) + 1})
    out = select.widths(sized, "o_custkey", 400, ("full", "compact", "minimal"), F.col("o_totalprice"), F.col("o_orderkey"), base=20)
    return out.select("o_orderkey", "o_custkey", "width", "bytes", "fits")


QUERIES = {f.__name__: f for f in (page_attachment_events, doc_event_pairs, doc_events, doc_rewritten, page_publishers, order_portfolio, customer_messages)}

_BARE = "lower(regexp_replace(regexp_replace({0}, '^(?:附件\\s*[一二三四五六七八九十\\d]+[：:]?\\s*)', ''), '[\\s\\x{{00A0}}\\x{{3000}}\\p{{P}}\\p{{S}}]+', '', 'g'))"


def _runs(x: str) -> str:
    return f"list_distinct(list_transform(range(1, greatest(length({x}) - 2, 1)), lambda i: substr({x}, i, 4)))"


def _grams(table: str, column: str, name: str) -> str:
    """The CTE `name` of (page_id, s): bigrams of a column."""
    plain = f"regexp_replace(regexp_replace(regexp_replace(lower({_SQUEEZED.replace('text', column)}), '20\\d{{2}}[年./-]\\d{{1,2}}(?:[月./-]\\d{{1,2}}日?)?', '', 'g'), '{lx.TITLE_STOP}', '', 'g'), '[^\\p{{L}}\\p{{N}}]', '', 'g')"
    return f"{name}0 AS (SELECT page_id, {plain} AS s FROM {table}), {name} AS (SELECT page_id, {_GRAMS} AS s FROM {name}0)"


def _spelt(kind: str, n: int, letters: int) -> str:
    """SQL of _name for a part of the document's number."""
    h = f"md5('{kind}' || (doc_id // {n}))"
    return " || ".join(f"chr(('0x5' || substr({h}, {1 + 3 * i}, 3))::INT)" for i in range(letters))


def _replaced() -> str:
    """The phrases one after the other, whatever their case."""
    out = "coalesce(text, '')"
    for phrase, by in PHRASES:
        out = f"regexp_replace({out}, '(?i){phrase.replace('[', chr(92) + '[').replace(']', chr(92) + ']')}', '{by}', 'g')"
    return out


_RULES = ", ".join(f"('{h}', '{p.rstrip('/')}', '{n.replace(chr(39), chr(39) * 2)}')" for h, p, n in PUBLISHERS)
ORACLES = {
    "customer_messages": """
WITH s AS (SELECT o_orderkey, o_custkey, o_totalprice, length('Order ' || o_orderkey || ', status ' || o_orderstatus || ', priority ' || o_orderpriority || '; ') AS f, length(o_orderkey::VARCHAR) + 8 AS c, length(o_orderkey::VARCHAR) + 1 AS m FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS i FROM s),
n AS (SELECT a.o_custkey, a.i AS k, 20 + sum(CASE WHEN b.i <= a.i THEN b.c ELSE b.f END) AS size FROM r a JOIN r b USING (o_custkey) GROUP BY a.o_custkey, a.i
  UNION ALL SELECT o_custkey, 0, 20 + sum(f) FROM r GROUP BY o_custkey),
k AS (SELECT o_custkey, min(k) FILTER (size <= 400) AS k, arg_min(size, k) FILTER (size <= 400) AS size FROM n GROUP BY o_custkey),
l AS (SELECT o_custkey, 20 + sum(m) AS least FROM r GROUP BY o_custkey)
SELECT o_orderkey, o_custkey, CASE WHEN k.k IS NULL THEN 'minimal' WHEN i <= k.k THEN 'compact' ELSE 'full' END AS width, coalesce(size, least)::BIGINT AS bytes, coalesce(size, least) <= 400 AS fits
FROM r JOIN k USING (o_custkey) JOIN l USING (o_custkey)""",
    "doc_rewritten": f"SELECT doc_id, md5(t) AS text_md5, length(t)::BIGINT AS n_chars FROM (SELECT doc_id, {_replaced()} AS t FROM documents)",
    "page_publishers": _KEYS
    + f""", r AS (SELECT * FROM (VALUES {_RULES}) t(h, p, name))
SELECT k.page_id, coalesce(arg_max(r.name, length(r.h) * 1000 + length(r.p)), '') AS publisher
FROM keys k LEFT JOIN r ON (k.host = r.h OR ends_with(k.host, '.' || r.h)) AND (r.p = '' OR k.path = r.p OR starts_with(k.path, r.p || '/')) GROUP BY k.page_id""",
    "page_attachment_events": _ARTICLES
    + f""", e AS (SELECT page_id, {_BARE.format('title')} AS b, list_distinct(regexp_extract_all(lower(title), '[a-z0-9]{{4,}}')) AS w FROM articles),
er AS (SELECT page_id, {_runs('b')} AS r, w FROM e),
la AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\\b[^>]*?href=["'']([^"'']*)["''][^>]*>(.*?)</a>', 2) AS t FROM pages),
lt AS (SELECT page_id, unnest(range(1, len(t) + 1)) AS pos, t FROM la),
l AS (SELECT page_id, pos, '附件' || pos || '：' || {_text('t[pos]')} AS title FROM lt),
lb AS (SELECT page_id, pos, {_BARE.format('title')} AS b, list_distinct(regexp_extract_all(lower(title), '[a-z0-9]{{4,}}')) AS w FROM l),
lr AS (SELECT page_id, pos, {_runs('b')} AS r, w FROM lb),
m AS (SELECT l.page_id, l.pos, er.page_id AS event FROM lr l JOIN er ON list_has_any(l.r, er.r) OR len(list_intersect(l.w, er.w)) >= 2)
SELECT l.page_id, l.pos, count(*) FILTER (m.event = l.page_id) > 0 AS own_page, coalesce(min(m.event), -1) AS first_page FROM lr l LEFT JOIN m ON m.page_id = l.page_id AND m.pos = l.pos GROUP BY l.page_id, l.pos""",
    "doc_event_pairs": f"""
WITH st AS (SELECT doc_id AS page_id, 'id' || (doc_id + CASE WHEN doc_id % 12 = 11 THEN 1 ELSE 0 END) AS identity, {_spelt('p', 12, 3)} || {_spelt('t', 3, 7)} || CASE WHEN doc_id % 3 = 1 THEN {_spelt('e', 1, 1)} ELSE '' END AS title,
  {_spelt('f', 2, 10)} || {_spelt('g', 2, 10)} || ' ' || {_spelt('h', 1, 2)} AS facts FROM documents),
{_grams('st', 'title', 'gt')}, {_grams('st', 'facts', 'gu')},
c AS (SELECT st.page_id AS o, identity, length(facts) >= 18 AS big, gt.s AS t, gu.s AS f FROM st JOIN gt USING (page_id) JOIN gu USING (page_id)),
p AS (SELECT a.o AS a, b.o AS b, a.identity = b.identity AS by_identity, coalesce(len(list_intersect(a.t, b.t)) / nullif(least(len(a.t), len(b.t)), 0), 0) >= 0.72 AS by_title,
  a.big AND b.big AND len(list_intersect(a.t, b.t)) >= 2 AND coalesce(len(list_intersect(a.f, b.f)) / nullif(least(len(a.f), len(b.f)), 0), 0) >= 0.72 AS by_facts FROM c a JOIN c b ON a.o < b.o)
SELECT * FROM p WHERE by_identity OR by_title OR by_facts""",
}
