"""Queries over raw pages: reading, identities, gates, duplicates and host-balanced selections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lexicons as lx
from ..functions import text as tx
from ..functions import urls
from ..operators import aggregates, dedupe, gates, select
from ..plans import weekly


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", "url", tx.article("html").alias("a")).select("page_id", "url", "a.*")


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", tx.html_to_text("html").alias("text"))


def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _articles(spark, sf_dir).select("page_id", "title", "text", "has_container", F.col("paragraphs").cast("long").alias("paragraphs"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _pages(spark, sf_dir).select("page_id", F.posexplode(tx.anchors("html")).alias("pos", "a"))
    return out.select("page_id", (F.col("pos") + 1).cast("long").alias("pos"), "a.href", "a.title")


def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", tx.page_image("html").alias("image"))


def page_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _articles(spark, sf_dir).select("page_id", gates.article_failure("title", "text", "has_container", "paragraphs").alias("reason"))


def page_reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.reasons(page_reasons(spark, sf_dir))


def page_url_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return _pages(spark, sf_dir).select(
        "page_id", urls.dedup_key(u).alias("dedup_key"), urls.source_key(u).alias("source_key"), urls.identity_key(u).alias("identity_key"), urls.record_key(u).alias("record_key"),
        urls.display_key(u).alias("display_key"), urls.host(u).alias("host"), urls.is_article(u).alias("is_article"), urls.is_root_or_index(u).alias("is_root"), urls.is_portal(u).alias("is_portal"),
    )


def page_first_of_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _pages(spark, sf_dir).select(F.col("page_id").alias("ord"), F.regexp_replace(urls.dedup_key("url"), r"\?.*$", "").alias("key"))
    return dedupe.first_wins(keyed, "key").select(F.col("ord").alias("page_id"), "key")


def page_host_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = _pages(spark, sf_dir).select("page_id", urls.host("url").alias("host"))
    return select.cap_where(hosts, F.contains("host", F.lit("blog.")), "host", 2, F.col("page_id"))


def page_host_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = _pages(spark, sf_dir).select(F.col("page_id").alias("ord"), urls.host("url").alias("host"))
    return select.round_robin(hosts, "host", 80).select(F.col("ord").alias("page_id"), "host", F.col("turn").cast("long").alias("turn"))


def page_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: pages read, judged, kept once for each key and taken one of each host in turn."""
    out = weekly.pages_to_rows(_pages(spark, sf_dir))
    return out.select(F.col("turn").cast("long").alias("turn"), F.col("ord").alias("page_id"), "host", "key", "title", F.col("n_chars").cast("long").alias("n_chars"))


QUERIES = {f.__name__: f for f in (page_text, page_articles, page_links, page_images, page_reasons, page_reason_histogram, page_url_keys, page_first_of_key, page_host_cap, page_host_round_robin, page_selection)}


def _text(x: str) -> str:
    out = f"regexp_replace(regexp_replace(regexp_replace(coalesce({x}, ''), '(?is)<script.*?</script>', ' ', 'g'), '(?is)<style.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g')"
    for a, b in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        out = f"replace({out}, '{a}', '{b}')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


def _tag(tag: str) -> str:
    return _text(f"regexp_extract(html, '(?is)<{tag}\\b[^>]*>(.*?)</{tag}>', 1)")


_PARTS = "(?:script|style|noscript|svg|nav|header|footer|aside|form)"
_ARTICLES = f"""
WITH raw AS (SELECT page_id, url, html, coalesce(nullif(regexp_extract(html, '(?is)<article\\b[^>]*>(.*?)</article>', 1), ''), nullif(regexp_extract(html, '(?is)<main\\b[^>]*>(.*?)</main>', 1), ''), html) AS body0 FROM pages),
cut AS (SELECT *, regexp_replace(regexp_replace(body0, '(?is)<{_PARTS}\\b.*?</{_PARTS}>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g') AS body FROM raw),
articles AS (SELECT page_id, url, coalesce(nullif({_tag("h1")}, ''), {_tag("title")}) AS title, {_text("body")} AS text,
  regexp_matches(html, '(?is)<article\\b[^>]*>.*?</article>|<main\\b[^>]*>.*?</main>') AS has_container, len(regexp_extract_all(body, '(?i)<p\\b'))::BIGINT AS paragraphs FROM cut),
judged AS (SELECT *, CASE WHEN regexp_matches(title || ' ' || substr(text, 1, 600), '{lx.ACCESS_PAGE}') THEN 'access-or-error-page' WHEN length(text) < 240 THEN 'insufficient-text'
  WHEN length(text) > 120000 THEN 'article-too-long' WHEN NOT has_container AND paragraphs < 2 THEN 'page-shell' END AS reason FROM articles)
"""
_URL = "(?i)^([a-z][a-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::(\\d+))?([^?#]*)(?:\\?([^#]*))?(?:#.*)?$"
_MOBILE = ", ".join(f"'{m}'" for m in lx.MOBILE_LABELS)
_TRACK = ", ".join(f"'{t}'" for t in lx.TRACKING_KEYS)


def _joined(list_: str) -> str:
    return f"(CASE WHEN len({list_}) > 0 THEN '?' || array_to_string(list_transform({list_}, lambda p: p.k || '=' || p.v), '&') ELSE '' END)"


_KEYS = f"""
WITH p0 AS (SELECT page_id, trim(url) AS u, lower(regexp_extract(trim(url), '{_URL}', 1)) AS scheme, lower(regexp_extract(trim(url), '{_URL}', 2)) AS host, regexp_extract(trim(url), '{_URL}', 3) AS port0,
  coalesce(nullif(regexp_extract(trim(url), '{_URL}', 4), ''), '/') AS path, regexp_extract(trim(url), '{_URL}', 5) AS query FROM pages),
p1 AS (SELECT *, CASE WHEN port0 = '' OR (scheme = 'http' AND port0 = '80') OR (scheme = 'https' AND port0 = '443') THEN '' ELSE ':' || port0 END AS port,
  list_transform(list_filter(string_split(query, '&'), lambda x: x <> ''), lambda x: {{'k': regexp_extract(x, '^([^=]*)', 1), 'v': regexp_extract(x, '^[^=]*=(.*)$', 1)}}) AS pairs FROM p0),
p2 AS (SELECT *, list_filter(list_transform(pairs, lambda p, i: {{'k': lower(p.k), 'i': i, 'v': p.v}}), lambda p: p.k NOT IN ({_TRACK}) AND NOT starts_with(p.k, 'utm_')) AS d,
  list_filter(list_transform(pairs, lambda p, i: {{'k': p.k, 'i': i, 'v': p.v}}), lambda p: NOT regexp_matches(p.k, '(?i)^(?:utm_.+|fbclid|gclid|spm|from|source)$')) AS s,
  list_filter(pairs, lambda p: NOT regexp_matches(p.k, '(?i)^(?:utm_|spm$|from$|source$|ref$)')) AS x,
  CASE WHEN len(string_split(host, '.')) > 2 AND string_split(host, '.')[1] IN ({_MOBILE}) THEN array_to_string(string_split(host, '.')[2:], '.') ELSE host END AS dhost FROM p1),
keys AS (SELECT page_id, host, path, scheme,
  scheme || '://' || dhost || port || regexp_replace(path, '/+$', '') || {_joined("list_sort(d)")} AS dedup_key,
  regexp_replace(scheme || '://' || host || port || coalesce(nullif(regexp_replace(path, '/$', ''), ''), '/') || {_joined("list_sort(s)")}, '/$', '') AS source_key,
  regexp_replace(host || coalesce(nullif(regexp_replace(path, '/$', ''), ''), '/') || {_joined("list_sort(s)")}, '/$', '') AS identity_key,
  scheme || '://' || host || port || regexp_replace(path, '/+$', '') || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS record_key,
  scheme || '://' || host || port || coalesce(nullif(regexp_replace(path, '/+$', ''), ''), '/') || {_joined("x")} AS display_key FROM p2)
"""

ORACLES = {
    "page_text": f"SELECT page_id, {_text('html')} AS text FROM pages",
    "page_articles": _ARTICLES + "SELECT page_id, title, text, has_container, paragraphs FROM articles",
    "page_links": f"""
WITH a AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\\b[^>]*?href=["'']([^"'']*)["''][^>]*>(.*?)</a>', 1) AS h, regexp_extract_all(html, '(?is)<a\\b[^>]*?href=["'']([^"'']*)["''][^>]*>(.*?)</a>', 2) AS t FROM pages),
e AS (SELECT page_id, unnest(range(1, len(h) + 1)) AS pos, h, t FROM a)
SELECT page_id, pos, h[pos] AS href, {_text("t[pos]")} AS title FROM e""",
    "page_images": """
WITH i AS (SELECT page_id, regexp_extract(html, '(?is)<meta\\b[^>]*?(?:property|name)=["'']og:image["''][^>]*?content=["'']([^"'']+)["'']', 1) AS og,
  regexp_extract(html, '(?is)<meta\\b[^>]*?(?:property|name)=["'']twitter:image["''][^>]*?content=["'']([^"'']+)["'']', 1) AS tw,
  list_filter(regexp_extract_all(html, '(?is)<img\\b[^>]*?src=["'']([^"'']+)["'']', 1), lambda u: NOT regexp_matches(lower(u), 'logo|icon|avatar|sprite|blank|placeholder|loading|qrcode|qr_|\\.svg(?:$|\\?)|^data:')) AS im FROM pages)
SELECT page_id, coalesce(nullif(og, ''), nullif(tw, ''), im[1], '') AS image FROM i""",
    "page_reasons": _ARTICLES + "SELECT page_id, reason FROM judged",
    "page_reason_histogram": _ARTICLES + "SELECT reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY reason",
    "page_url_keys": _KEYS
    + """SELECT page_id, dedup_key, source_key, identity_key, record_key, display_key, host, scheme IN ('http', 'https') AND path <> '/' AND NOT regexp_matches(path, '(?i)/index(?:\\.html?)?$') AS is_article,
  regexp_matches(regexp_replace(path, '/+', '/', 'g'), '(?i)^/(?:index\\.html?)?$|/(?:xw|ggjgs|zwgk|hdjl|bsfw|xxgk)/(?:index\\.html?)?$') AS is_root, regexp_matches(path, '(?i)^(?:/|/index(?:\\.html?)?)$') AS is_portal FROM keys""",
    "page_first_of_key": _KEYS + "SELECT min(page_id) AS page_id, regexp_replace(dedup_key, '\\?.*$', '') AS key FROM keys GROUP BY 2",
    "page_host_cap": _KEYS + "SELECT page_id, host FROM (SELECT page_id, host, row_number() OVER (PARTITION BY host ORDER BY page_id) AS r FROM keys) WHERE host NOT LIKE '%blog.%' OR r <= 2",
    "page_host_round_robin": _KEYS
    + """, r AS (SELECT page_id, host, row_number() OVER (PARTITION BY host ORDER BY page_id) AS r, min(page_id) OVER (PARTITION BY host) AS f FROM keys)
SELECT page_id, host, row_number() OVER (ORDER BY r, f, page_id) AS turn FROM r ORDER BY r, f, page_id LIMIT 80""",
    "page_selection": _ARTICLES
    + ", "
    + _KEYS.strip().removeprefix("WITH ")
    + f""", one AS (SELECT k.dedup_key AS key, arg_min(j.page_id, j.page_id) AS page_id, arg_min(j.title, j.page_id) AS title, arg_min(length(j.text), j.page_id)::BIGINT AS n_chars FROM judged j JOIN keys k USING (page_id) WHERE j.reason IS NULL GROUP BY 1),
h AS (SELECT *, lower(regexp_extract(key, '{_URL}', 2)) AS host FROM one),
r AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS r, min(page_id) OVER (PARTITION BY host) AS f FROM h)
SELECT row_number() OVER (ORDER BY r, f, page_id) AS turn, page_id, host, key, title, n_chars FROM r ORDER BY r, f, page_id LIMIT 60""",
}
