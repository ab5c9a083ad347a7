"""Queries over documents, labels and benchmark passages: cleaning, quotes, duplicates, quotas, funnels and reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lexicons as lx
from ..functions import text as tx
from ..operators import aggregates, dedupe, events, gates, joins, select


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def doc_clean_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _docs(spark, sf_dir).select("doc_id", tx.clean_evidence("text").alias("evidence"))
    return out.select("doc_id", F.md5(F.col("evidence").cast("binary")).alias("evidence_md5"), F.length("evidence").cast("long").alias("n_chars"))


def doc_first_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", tx.substantive("text", 5).alias("lead"))


def doc_quote_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", tx.quote_window("text", F.lit("License")).alias("quote"))


def doc_excerpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", tx.excerpt_around("text", r"(?i)licen[cs]e", 40, 160).alias("excerpt"))


def doc_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", tx.cut_at_mark("text", 220).alias("short"), tx.compact("text", 60).alias("brief"))


def doc_identity_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _docs(spark, sf_dir).select(F.col("doc_id").alias("ord"), "source", F.md5(tx.letters("text").cast("binary")).alias("key"))
    return dedupe.first_wins(keyed, "key").select(F.col("ord").alias("doc_id"), "source")


def doc_repeated_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _docs(spark, sf_dir).select(F.md5(tx.letters("text").cast("binary")).alias("key"))
    return dedupe.repeated(keyed, "key")


def doc_cap_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.cap(_docs(spark, sf_dir).select("doc_id", "source", "n_chars"), "source", 5, F.desc("n_chars"), F.col("doc_id"))


def doc_floor_then_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = select.floor_then_fill(_docs(spark, sf_dir).select("doc_id", "source", "n_chars"), "source", 2, 60, -F.col("n_chars"), F.col("doc_id"), most=5)
    return out.withColumn("turn", F.col("turn").cast("long"))


def doc_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = select.leaders(_docs(spark, sf_dir).select("doc_id", "lang", "n_chars"), "lang", 25, -F.col("n_chars"), F.col("doc_id"))
    return out.withColumn("turn", F.col("turn").cast("long"))


def _reason() -> Column:
    return gates.first_reason(
        (tx.blank("text") == "", "empty"), (F.col("n_chars") < lx.MIN_ARTICLE, "insufficient-text"), (F.col("n_chars") > 20000, "article-too-long"),
        (F.col("text").rlike(r"(?i)licen[cs]e"), "license-line"), (F.col("lang") != "en", "other-language"),
    )


def doc_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.gate(_docs(spark, sf_dir), _reason()).select("doc_id", "reason", "accepted")


def doc_reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.reasons(gates.gate(_docs(spark, sf_dir), _reason()), "reason", "lang")


def doc_failed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = F.array_compact(F.array(F.when(F.col("n_chars") < 1000, "short"), F.when(F.col("lang") != "en", "language"), F.when(~F.contains("text", F.lit("\n")), "one-line")))
    return aggregates.exploded_reasons(_docs(spark, sf_dir).select(checks.alias("failed")), "failed")


def doc_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir)
    sources = aggregates.dimension(spark, [f"src{i}" for i in range(22)], "source")
    stages = {"discovered": d, "hydrated": d.where("n_chars >= 240"), "accepted": d.where((F.col("n_chars") >= 240) & (F.col("lang") == "en")), "final": d.where((F.col("n_chars") >= 2000) & (F.col("lang") == "en"))}
    return aggregates.funnel(stages, "source", sources)


def doc_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.dense_matrix(_docs(spark, sf_dir), "source", aggregates.dimension(spark, [f"src{i}" for i in range(22)], "source"), "lang", ["en", "de", "fr", "es", "it"])


def doc_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.top_values(_docs(spark, sf_dir), ["lang", "source"], 3)


def doc_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = select.batches(_docs(spark, sf_dir).select("doc_id", "source"), 8, "source", F.col("doc_id"))
    return out.select("doc_id", "source", F.col("batch").cast("long").alias("batch"))


def doc_priority_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir).select(F.col("doc_id").alias("ord"), "source", "lang", "n_chars")
    key = F.concat_ws(":", "source", "lang")
    out = dedupe.priority_union([d.where("n_chars > 5000"), d.where("lang = 'en'"), d], key)
    return out.select(F.col("ord").alias("doc_id"), "source", "lang", F.col("source_rank").cast("long").alias("source_rank"))


def doc_stronger_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir).select(F.col("doc_id").alias("ord"), "source", "lang", "n_chars")
    out = dedupe.stronger_wins(d, F.concat_ws(":", "source", "lang"), F.col("n_chars") > 3000)
    return out.select(F.col("ord").alias("doc_id"), "source", "lang", F.col("place").alias("place"))


def doc_hash31(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", tx.hash31(F.concat_ws("/", "source", "lang", "doc_id")).alias("h"))


def doc_byte_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document packed into messages of at most 1200 bytes."""
    out = _docs(spark, sf_dir).select("doc_id", F.posexplode(select.byte_chunks(F.filter(F.split(tx.blank("text"), "\n"), lambda x: x != ""), 1200, "\n")).alias("i", "chunk"))
    return out.select("doc_id", F.col("i").cast("long").alias("i"), F.octet_length("chunk").cast("long").alias("bytes"))


def label_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _docs(spark, sf_dir).join(_labels(spark, sf_dir), "doc_id", "left")
    n = j.groupBy("lang").agg(F.count("*").alias("total"), F.count("toxic").alias("covered"), F.count(F.when(F.col("toxic") == 1, 1)).alias("critical_total"), F.count(F.when((F.col("toxic") == 1) & (F.col("quality") == 1), 1)).alias("critical_covered"))
    return n.select("lang", "total", "covered", F.round(aggregates.ratio(F.col("covered"), F.col("total")), 9).alias("overall"), F.round(aggregates.ratio(F.col("critical_covered"), F.col("critical_total")), 9).alias("critical"))


def label_gate_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = gates.gate(_docs(spark, sf_dir), _reason()).join(_labels(spark, sf_dir), "doc_id")
    return judged.groupBy("accepted", "quality").agg(F.count("*").alias("n"))


def benchmark_overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(F.col("item_id").alias("ord"), "text")
    return events.overlap_pairs(b, "text", least=0.8).select("a", "b", F.round("overlap", 9).alias("overlap"))


def benchmark_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", F.col("text").alias("passage"))
    return joins.substring_matches(b, _docs(spark, sf_dir).select("doc_id", "text"), "passage", "text").select("item_id", "doc_id").distinct()


def benchmark_not_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id")
    met = b.join(benchmark_quotes(spark, sf_dir).withColumnRenamed("doc_id", "match"), "item_id", "left")
    return joins.exactly_one(met, "item_id")


QUERIES = {
    f.__name__: f
    for f in (
        doc_clean_evidence, doc_first_paragraphs, doc_quote_window, doc_excerpt, doc_compact, doc_identity_dedupe, doc_repeated_identities, doc_cap_per_source, doc_floor_then_fill, doc_leaders, doc_reasons,
        doc_reason_histogram, doc_failed_checks, doc_funnel, doc_matrix, doc_top_values, doc_batches, doc_priority_union, doc_stronger_wins, doc_hash31, doc_byte_chunks, label_coverage, label_gate_confusion,
        benchmark_overlap_pairs, benchmark_quotes, benchmark_not_once,
    )
}


def _chain(x: str, steps: list[tuple[str, str]]) -> str:
    for pattern, by in steps:
        x = f"regexp_replace({x}, '{pattern}', '{by}', 'g')"
    return x


_PLAIN = _chain(
    "regexp_replace(text, '\\r\\n?', chr(10), 'g')",
    [("\\x{00A0}", " "), ("(?s)<!--.*?-->", " "), ("!\\[([^\\]]*)\\]\\([^)]+\\)", "\\1"), ("\\[([^\\]]+)\\]\\([^)]+\\)", "\\1"), ("\\[\\s*\\]\\([^)]+\\)", ""), ("<[^>]+>", " "), ("\\s*⟨\\d+⟩", "")],
)
_TRIM = "^\\s+|\\s+$"
_LINE = _chain(
    "line0",
    [(_TRIM, ""), ("^\\s{0,3}#{1,6}\\s*", ""), ("^\\s{0,3}>+\\s*", ""), ("^\\s{0,3}(?:[-*+] |\\d+[.)]\\s+)", ""), ("\\*\\*|__|`+", ""), (lx.PAGE_CONTROLS, " "), ("\\|", " "), ("\\s+", " "), ("^[>＞|｜:：/·\\s-]+|[>＞|｜:：/·\\s-]+$", ""), (_TRIM, "")],
)
_CLEAN = f"""
WITH l0 AS (SELECT doc_id, unnest(regexp_split_to_array({_PLAIN}, '\\n+')) AS line0, unnest(range(1, 1 + len(regexp_split_to_array({_PLAIN}, '\\n+')))) AS pos FROM documents),
l1 AS (SELECT doc_id, pos, line0, {_LINE} AS line FROM l0),
l2 AS (SELECT doc_id, pos, line FROM l1 WHERE line <> '' AND NOT regexp_matches(regexp_replace(line0, '{_TRIM}', '', 'g'), '^\\s*\\|?\\s*:?-{{3,}}:?\\s*(?:\\|\\s*:?-{{3,}}:?\\s*)+\\|?\\s*$')
  AND NOT (regexp_matches(line, '{lx.PAGE_SHELL}') AND NOT regexp_matches(line, '{lx.EVENT_WORDS}'))
  AND NOT (len(regexp_extract_all(line, '{lx.NAVIGATION_WORDS}')) >= 2 AND NOT regexp_matches(regexp_replace(line, '{lx.NAVIGATION_WORDS}', ' ', 'g'), '{lx.SUBSTANCE_WORDS}'))
  AND NOT regexp_matches(line, '^[\\p{{P}}\\p{{S}}\\s]+$')),
l3 AS (SELECT *, row_number() OVER (PARTITION BY doc_id, regexp_replace(line, '\\s+', '', 'g') ORDER BY pos) AS r FROM l2),
clean AS (SELECT d.doc_id, coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (l.r = 1), '') AS evidence FROM documents d LEFT JOIN l3 l USING (doc_id) GROUP BY d.doc_id)
"""
_SQUEEZED = "trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))"
_LETTERS = f"regexp_replace(lower({_SQUEEZED}), '[\\s\\p{{P}}\\p{{S}}]+', '', 'g')"
_REASON = "CASE WHEN coalesce(text, '') = '' THEN 'empty' WHEN n_chars < 240 THEN 'insufficient-text' WHEN n_chars > 20000 THEN 'article-too-long' WHEN regexp_matches(text, '(?i)licen[cs]e') THEN 'license-line' WHEN lang <> 'en' THEN 'other-language' END"
_SOURCES = "(SELECT 'src' || i AS source, i::INT AS source_ord FROM range(22) t(i))"
_GRAMS = "list_distinct(list_transform(range(1, length(s)), lambda i: substr(s, i, 2)))"
_PAIRS = f"""
WITH g0 AS (SELECT item_id, regexp_replace(regexp_replace(regexp_replace(lower({_SQUEEZED}), '20\\d{{2}}[年./-]\\d{{1,2}}(?:[月./-]\\d{{1,2}}日?)?', '', 'g'), '{lx.TITLE_STOP}', '', 'g'), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS s FROM benchmark),
g AS (SELECT item_id, {_GRAMS} AS s FROM g0),
p AS (SELECT x.item_id AS a, y.item_id AS b, len(list_intersect(x.s, y.s)) / least(len(x.s), len(y.s)) AS overlap FROM g x JOIN g y ON x.item_id < y.item_id WHERE len(x.s) > 0 AND len(y.s) > 0)
"""

ORACLES = {
    "doc_clean_evidence": _CLEAN + "SELECT doc_id, md5(evidence) AS evidence_md5, length(evidence)::BIGINT AS n_chars FROM clean",
    "doc_first_paragraphs": _CLEAN
    + f""", s AS (SELECT doc_id, list_transform(regexp_split_to_array(regexp_replace(evidence, '([。！？!?])\\s+', '\\1' || chr(10), 'g'), '\\n+'), lambda p: trim(regexp_replace(p, '\\s+', ' ', 'g'))) AS ps FROM clean)
SELECT doc_id, array_to_string(list_filter(ps, lambda p: length(p) >= 12 AND NOT regexp_matches(p, '{lx.SHELL_LINE}'))[1:5], ' ') AS lead FROM s""",
    "doc_quote_window": """
WITH w AS (SELECT doc_id, text, instr(text, 'License') - 1 AS p FROM documents)
SELECT doc_id, CASE WHEN p >= 0 THEN substr(text, (greatest(0, p - 28) + 1)::INT, (least(length(text), p + 7 + 40) - greatest(0, p - 28))::INT) ELSE '' END AS quote FROM w""",
    "doc_excerpt": """
WITH w AS (SELECT doc_id, text, CASE WHEN regexp_matches(text, '(?i)licen[cs]e') THEN length(regexp_extract(text, '(?is)^(.*?)licen[cs]e', 1)) ELSE 0 END AS p FROM documents)
SELECT doc_id, substr(text, (greatest(0, p - 40) + 1)::INT, (p + 160 - greatest(0, p - 40))::INT) AS excerpt FROM w""",
    "doc_compact": f"""
WITH w AS (SELECT doc_id, {_SQUEEZED} AS s FROM documents)
SELECT doc_id, CASE WHEN length(s) <= 220 THEN s ELSE regexp_replace(coalesce(nullif(regexp_extract(substr(s, 1, 220), '(?s)^(.{{120,219}}[。！？!?；;，,]).*$', 1), ''), substr(s, 1, 220)), '[，,；;\\s]+$', '') || '...' END AS short,
  CASE WHEN length(s) > 60 THEN substr(s, 1, 59) || '…' ELSE s END AS brief FROM w""",
    "doc_identity_dedupe": f"SELECT min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY md5({_LETTERS})",
    "doc_repeated_identities": f"SELECT md5({_LETTERS}) AS key, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1",
    "doc_cap_per_source": "SELECT doc_id, source, n_chars FROM (SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS r FROM documents) WHERE r <= 5",
    "doc_floor_then_fill": """
WITH r AS (SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS r FROM documents)
SELECT doc_id, source, n_chars, row_number() OVER (ORDER BY least(r, 3), n_chars DESC, doc_id) AS turn FROM r WHERE r <= 5 ORDER BY least(r, 3), n_chars DESC, doc_id LIMIT 60""",
    "doc_leaders": """
WITH r AS (SELECT doc_id, lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS r FROM documents)
SELECT doc_id, lang, n_chars, row_number() OVER (ORDER BY least(r, 2), n_chars DESC, doc_id) AS turn FROM r ORDER BY least(r, 2), n_chars DESC, doc_id LIMIT 25""",
    "doc_reasons": f"SELECT doc_id, {_REASON} AS reason, ({_REASON}) IS NULL AS accepted FROM documents",
    "doc_reason_histogram": f"SELECT lang, {_REASON} AS reason, count(*) AS n FROM documents WHERE ({_REASON}) IS NOT NULL GROUP BY ALL",
    "doc_failed_checks": "SELECT reason, count(*) AS n FROM (SELECT 'short' AS reason FROM documents WHERE n_chars < 1000 UNION ALL SELECT 'language' FROM documents WHERE lang <> 'en' UNION ALL SELECT 'one-line' FROM documents WHERE NOT contains(text, chr(10))) GROUP BY 1",
    "doc_funnel": f"""SELECT s.source, count(d.doc_id) AS discovered, count(*) FILTER (d.n_chars >= 240) AS hydrated, count(*) FILTER (d.n_chars >= 240 AND lang = 'en') AS accepted, count(*) FILTER (d.n_chars >= 2000 AND lang = 'en') AS "final"
FROM {_SOURCES} s LEFT JOIN documents d USING (source) GROUP BY 1""",
    "doc_matrix": f"SELECT s.source, {', '.join(f'''count(*) FILTER (lang = '{k}') AS "{k}"''' for k in ('en', 'de', 'fr', 'es', 'it'))} FROM {_SOURCES} s LEFT JOIN documents d USING (source) GROUP BY 1",
    "doc_top_values": """
WITH c AS (SELECT 'lang' AS dimension, lang AS value, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY 2)
SELECT dimension, value, n FROM (SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY n DESC, value) AS r FROM c) WHERE r <= 3""",
    "doc_batches": "SELECT doc_id, source, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 8 AS batch FROM documents",
    "doc_priority_union": """
WITH u AS (SELECT *, 0 AS k FROM documents WHERE n_chars > 5000 UNION ALL SELECT *, 1 FROM documents WHERE lang = 'en' UNION ALL SELECT *, 2 FROM documents)
SELECT doc_id, source, lang, k::BIGINT AS source_rank FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY k, doc_id) AS r FROM u) WHERE r = 1""",
    "doc_stronger_wins": "SELECT doc_id, source, lang, place FROM (SELECT doc_id, source, lang, min(doc_id) OVER (PARTITION BY source, lang) AS place, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars > 3000 DESC, doc_id) AS r FROM documents) WHERE r = 1",
    "doc_hash31": "SELECT doc_id, lower(to_hex(list_reduce(list_transform(string_split(source || '/' || lang || '/' || doc_id, ''), lambda c: ascii(c)::BIGINT), lambda a, b: (a * 31 + b) % 4294967296))) AS h FROM documents",
    "label_coverage": """
SELECT lang, count(*) AS total, count(toxic) AS covered, round(count(toxic) / count(*), 9) AS overall,
  round(CASE WHEN count(*) FILTER (toxic = 1) = 0 THEN 1.0::DOUBLE ELSE count(*) FILTER (toxic = 1 AND quality = 1) / count(*) FILTER (toxic = 1) END, 9) AS critical FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""",
    "label_gate_confusion": f"SELECT ({_REASON}) IS NULL AS accepted, quality, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL",
    "benchmark_overlap_pairs": _PAIRS + "SELECT a, b, round(overlap, 9) AS overlap FROM p WHERE overlap >= 0.8",
    "benchmark_quotes": "SELECT DISTINCT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)",
    "benchmark_not_once": """
WITH n AS (SELECT b.item_id, count(d.doc_id) AS n FROM benchmark b LEFT JOIN documents d ON contains(d.text, b.text) GROUP BY 1)
SELECT item_id, n, CASE WHEN n = 0 THEN 'none' ELSE 'several' END AS problem FROM n WHERE n <> 1""",
}
