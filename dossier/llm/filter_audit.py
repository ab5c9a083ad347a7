"""Filter interaction audit: what each of five filters removes in each order, from one SQL CUBE.

A document is five failure flags. CUBE over the flags and the part has, for every subset of filters, a row in which exactly
those flags are selected and all false: the documents that survive the subset. A step of an order goes from one subset to
the next, so each of its figures is a difference of two such rows, which a join of subsets brings together; no order is
ever run. Rows are counted before the CUBE, so it reads at most 128 rows for each part, however many documents there are.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

LETTERS = "ABCDE"
#: Bounds of the conditions: words, distinct words in 100, capitals in 100 code points.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
_FLAGS = [k.lower() for k in LETTERS]
_COUNTS = ["n", "good", "toxic"]


def words(text: Column) -> Column:
    """The maximal runs of what isn't ASCII white space."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, a .. e, n, good, toxic: how many documents of a part have these failure flags, and how many of them have quality 1 and toxic 1.

    Null texts are empty, a null lang is the part ''. Every row counts, rows with the same id each by itself; E fails where a
    smaller id has the same text, so rows without an id never fail it and make none fail. Of several labels of one id any 1
    counts. Other columns than doc_id, text and lang (doc_id, quality and toxic) aren't read; an empty table gives no rows.

    Texts are read once and leave the scan as a digest. Equal texts are counted before each shuffle, by digest, part and
    labels, so neither a text that a third of all rows share nor a part is a load.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    d = d.select("doc_id", "part", "text", words(F.col("text")).alias("words"))
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    rows = d.select(
        "doc_id",
        "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        (F.size("words") < LEAST_WORDS).alias("a"),
        (100 * F.size(F.array_distinct("words")) < LEAST_DISTINCT * F.size("words")).alias("b"),
        (100 * capitals > MOST_CAPITALS * F.length("text")).alias("c"),
        F.col("text").rlike(r"[#$%&*|]").alias("d"),
    )
    alike = rows.groupBy("doc_id", "part", "digest", *_FLAGS[:4]).agg(F.count("*").alias("n"))
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c)
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality"), one("toxic"))
    known = known.where(F.col("quality") | F.col("toxic"))
    judged = alike.join(known, "doc_id", "left").withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("quality", "toxic")})
    named = F.col("doc_id").isNotNull()
    texts = judged.groupBy("digest", "part", *_FLAGS[:4], "quality", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.when(named, F.struct("doc_id", "n"))).alias("first"), F.sum(F.when(named, F.lit(0)).otherwise(F.col("n"))).alias("nameless")
    )
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))  # a row for each part and label of a text
    passing = F.col("nameless") + F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    counted = texts.withColumn("passing", passing).select("*", F.explode(F.array(F.struct(F.lit(False).alias("e"), F.col("passing").alias("m")), F.struct(F.lit(True).alias("e"), (F.col("n") - F.col("passing")).alias("m")))).alias("x"))
    count = lambda c: F.sum(F.col("x.m") * c).cast("long")
    return counted.where("x.m > 0").groupBy("part", *_FLAGS[:4], F.col("x.e").alias("e")).agg(count(F.lit(1)).alias("n"), count(F.col("quality").cast("long")).alias("good"), count(F.col("toxic").cast("long")).alias("toxic"))


def survivors(flags: DataFrame) -> DataFrame:
    """part, subset, n, good, toxic for each part and each of the 32 subsets of filters, zeros included; bit k of subset is filter k."""
    cube = flags.cube(*_FLAGS, "part").agg(*(F.sum(c).alias(c) for c in _COUNTS), *(F.grouping(c).alias(f"no_{c}") for c in (*_FLAGS, "part")))
    selected_pass = [(F.col(f"no_{c}") == 1) | ~F.col(c) for c in _FLAGS]
    kept = cube.where(F.col("no_part") == 0)
    for passes in selected_pass:
        kept = kept.where(passes)
    subset = sum(((1 - F.col(f"no_{c}").cast("int")) * (1 << k) for k, c in enumerate(_FLAGS)), F.lit(0))
    kept = common.checkpointed(kept.select("part", subset.alias("subset"), *_COUNTS))  # a few rows for each part
    every = kept.where("subset = 0").select("part", F.explode(F.sequence(F.lit(0), F.lit((1 << len(_FLAGS)) - 1))).alias("subset"))
    return every.join(kept, ["part", "subset"], "left").fillna(0, _COUNTS)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley for each part, order and step.

    What flagged() says of nulls, ties and empty tables holds here. A step joins the survivors of its filters so far, with
    and without its own: the difference is what it removes. fails and unique_fails of a filter are differences as well, of
    no filter and this one, and of all others and all.
    """
    spark, bit = docs.sparkSession, {k: 1 << i for i, k in enumerate(LETTERS)}
    alone = survivors(flagged(docs, labels))
    state = F.struct(*_COUNTS)
    by_subset = alone.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("subset", F.col("n")))).alias("n_of"))  # 32 entries
    steps = [("".join(o), s + 1, o[s], sum(bit[k] for k in o[:s]), bit[o[s]]) for o in permutations(LETTERS) for s in range(len(o))]
    plan = spark.createDataFrame(steps, "filter_order string, step int, filter string, before int, bit int")
    before = alone.select("part", F.col("subset").alias("before"), state.alias("x"))
    after = alone.select("part", F.col("subset").alias("after"), state.alias("y"))
    pairs = before.join(plan, "before").withColumn("after", F.col("before") + F.col("bit")).join(after, ["part", "after"]).join(by_subset, "part")
    removed, all_, at = F.col("x.n") - F.col("y.n"), (1 << len(LETTERS)) - 1, lambda k: F.col("n_of")[k]
    return pairs.select(
        "part",
        "filter_order",
        "step",
        F.col("y.n").alias("kept"),
        removed.alias("removed"),
        (at(F.lit(0)) - at(F.col("bit")) - removed).alias("redundant"),
        (at(F.lit(all_) - F.col("bit")) - at(F.lit(all_))).alias("unique_fails"),
        (F.col("x.good") - F.col("y.good")).alias("good_lost"),
        (F.col("x.toxic") - F.col("y.toxic")).alias("toxic_lost"),
        F.sum(removed).over(Window.partitionBy("part", "filter")).cast("long").alias("shapley"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


QUERIES = {"op11_filter_audit": op11_filter_audit}
ORACLES = {
    "op11_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
l AS (SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, {'A': len(ws) < 200, 'B': 100 * len(list_distinct(ws)) < 50 * len(ws), 'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
                'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(least < w.doc_id, false)} AS fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
g AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
k AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
o AS (
  SELECT [a.k, b.k, c.k, d.k, e.k] AS ks FROM k a, k b, k c, k d, k e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
r AS (  -- the place of the first filter that fails, 6 if none does
  SELECT part, array_to_string(ks, '') AS filter_order, ks, good, toxic, n, fails,
    list_min(list_concat([6], list_filter([1, 2, 3, 4, 5], lambda s: CASE ks[s] WHEN 'A' THEN fails.A WHEN 'B' THEN fails.B WHEN 'C' THEN fails.C WHEN 'D' THEN fails.D ELSE fails.E END))) AS gone,
    fails.A::INT + fails.B::INT + fails.C::INT + fails.D::INT + fails.E::INT AS failed
  FROM g, o),
s AS (
  SELECT part, filter_order, step, ks[step] AS k, sum(n) FILTER (gone > step) AS kept, sum(n) FILTER (gone = step) AS removed,
    sum(n) FILTER (gone < step AND own) AS redundant, sum(n) FILTER (own AND failed = 1) AS unique_fails,
    sum(n) FILTER (gone = step AND good = 1) AS good_lost, sum(n) FILTER (gone = step AND toxic = 1) AS toxic_lost
  FROM (SELECT *, CASE ks[step] WHEN 'A' THEN fails.A WHEN 'B' THEN fails.B WHEN 'C' THEN fails.C WHEN 'D' THEN fails.D ELSE fails.E END AS own
        FROM r, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step))
  GROUP BY part, filter_order, step, k)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  sum(coalesce(removed, 0)) OVER (PARTITION BY part, k)::BIGINT AS shapley
FROM s"""
}
