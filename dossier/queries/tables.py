"""Queries over events, conversations and the star schema: freshness, state, lookups, dense counts, coverage, quotas and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import aggregates, dedupe, gates, joins, scoring, select

END = "2024-01-30"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    f = e.select("event_id", gates.freshness("day", F.lit(END).cast("date")).alias("f"))
    return f.select("event_id", "f.accepted", "f.allowed_tier", "f.status", F.col("f.age_days").cast("long").alias("age_days"))


def event_freshness_exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older events stay where their kind names a node ahead or an open action."""
    e = _table(spark, sf_dir, "events").select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), (F.pmod("user_id", F.lit(120)).cast("int")).alias("k"))
    ahead = F.date_format(F.date_add(F.lit(END).cast("date"), F.col("k")), "yyyy-MM-dd")
    kind = F.when(F.pmod("event_id", F.lit(3)) == 0, "upcoming_deadline").when(F.pmod("event_id", F.lit(3)) == 1, "open_action").otherwise("")
    f = e.select(gates.freshness("day", F.date_sub(F.lit(END).cast("date"), 0), deadlines=[ahead], exception=kind, open_action=F.when(F.col("event_type") == "purchase", "x")).alias("f"))
    return f.groupBy("f.status", "f.allowed_tier").agg(F.count("*").alias("n")).select("status", "allowed_tier", "n")


def event_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = aggregates.period(_table(spark, sf_dir, "events"), "ts", F.lit(END).cast("date"), 20)
    return out.select(*(F.col(c).cast("string").alias(c) for c in out.columns))


def event_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the period's last ten days by users who weren't there in the thirty days before."""
    e = _table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    end = F.lit(END).cast("date")
    recent = e.where((F.col("day") > F.date_sub(end, 10)) & (F.col("day") <= end))
    seen = e.where((F.col("day") <= F.date_sub(end, 10)) & (F.col("day") > F.date_sub(end, 40))).select(F.col("user_id").alias("u")).distinct()
    return dedupe.unseen(recent, F.col("user_id"), seen).select("event_id", "user_id")


def event_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after a run: latest day of each user, pruned to ten days."""
    e = _table(spark, sf_dir, "events").groupBy("user_id").agg(F.max(F.to_date("ts")).alias("t"))
    return e.where(F.col("t") >= F.date_sub(F.lit(END).cast("date"), 10)).withColumn("t", F.col("t").cast("string"))


def event_dense_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = aggregates.dimension(spark, ["view", "click", "purchase", "signup", "refund", "never"], "event_type")
    return aggregates.dense_counts(_table(spark, sf_dir, "events"), "event_type", kinds)


def event_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.top_values(_table(spark, sf_dir, "events"), ["event_type", "user_id"], 5)


def event_joint_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events with the reason why they aren't among the first hundred under joint quotas of users and kinds."""
    e = _table(spark, sf_dir, "events").select(F.col("event_id").alias("ord"), "user_id", "event_type")
    return select.joint_quota(e, {"user_id": 2, "event_type": 40}, 100)


def turn_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "conversations")
    return select.running_number(c, "conv_id", F.col("turn")).select("conv_id", "turn", F.col("number").cast("long").alias("number"))


def _turn_lookups(spark: SparkSession, sf_dir: str, said: Column) -> DataFrame:
    c = _table(spark, sf_dir, "conversations").select("conv_id", "role", F.col("turn").alias("ord"), said.alias("said"), F.concat_ws("/", "conv_id", "role").alias("key"))
    keys = c.select("key").distinct()
    first = joins.lookup(keys, c.select("key", "ord", F.col("said").alias("first_said")), "key", ["first_said"])
    return joins.lookup(first, c.select("key", "ord", F.col("said").alias("last_said")), "key", ["last_said"], last=True)


def turn_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 40 characters of each conversation's first and last words of each role; turn_text_lookups has the whole texts."""
    return _turn_lookups(spark, sf_dir, F.substring("text", 1, 40))


def turn_text_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation's first and last words of each role, whole: both rules for repeated keys."""
    return _turn_lookups(spark, sf_dir, F.col("text"))


def turn_first_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "conversations")
    users, others = F.when(F.col("role") == "user", F.col("text")), F.when(F.col("role") != "user", F.col("text"))
    one = c.groupBy("conv_id").agg(F.min_by(users, F.when(users.isNotNull(), F.col("turn"))).alias("u"), F.min_by(others, F.when(others.isNotNull(), F.col("turn"))).alias("o"))
    return one.select("conv_id", tx.compact(tx.first_text("u", "o"), 80).alias("opening"))


def nation_dense_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rich = _table(spark, sf_dir, "customer").where("c_acctbal > 9800")
    return aggregates.dense_counts(rich, "c_nationkey", nations)


def nation_segment_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = _table(spark, sf_dir, "nation").select("n_nationkey")
    return aggregates.dense_matrix(_table(spark, sf_dir, "customer"), "c_nationkey", nations, "c_mktsegment", ["BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD", "FURNITURE"])


def nation_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of a nation's customers have ordered, 1 where there is nobody to cover."""
    ordered = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("has", F.lit(1))
    c = _table(spark, sf_dir, "customer").join(ordered, "c_custkey", "left")
    n = c.groupBy("c_nationkey").agg(F.count("*").alias("total"), F.count("has").alias("covered"))
    out = _table(spark, sf_dir, "nation").select("n_nationkey").join(n, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    total, covered = F.coalesce("total", F.lit(0)), F.coalesce("covered", F.lit(0))
    return out.select("n_nationkey", total.alias("total"), covered.alias("covered"), F.round(aggregates.ratio(covered, total), 9).alias("ratio"))


def supplier_floor_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return select.floor_then_fill(s, "s_nationkey", 1, 40, -F.col("s_acctbal"), F.col("s_suppkey"), most=3).withColumn("turn", F.col("turn").cast("long"))


def supplier_top_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _table(spark, sf_dir, "supplier")
    have = s.where("s_acctbal > 5000").groupBy("s_nationkey").agg(F.count("*").alias("n"))
    return select.top_up(s.where("s_acctbal <= 5000").select("s_suppkey", "s_nationkey"), "s_nationkey", have, 4, F.col("s_suppkey"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    score = scoring.points((F.col("o_orderpriority").startswith("1"), 30), (F.col("o_orderpriority").startswith("2"), 15), (F.col("o_orderstatus") == "F", 25), (F.col("o_totalprice") > 200000, 20), (F.col("o_totalprice") < 1000, -10))
    return o.select("o_orderkey", score.cast("long").alias("score"), F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("later"))


def order_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of the top 200 orders by additive scores: critical ones first, then by score, then by key; scored_orders has all."""
    return _scored(spark, sf_dir).orderBy("later", F.desc("score"), "o_orderkey").limit(200).select("o_orderkey", "score")


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The additive score of every order."""
    return _scored(spark, sf_dir).select("o_orderkey", "score")


def order_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return select.quota_swap(o, F.col("o_orderpriority").startswith("1"), 30, 50, F.desc("o_totalprice"), F.col("o_orderkey"))


def order_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ord"), "o_custkey", "o_orderstatus")
    return dedupe.last_wins(o, F.col("o_custkey")).select("o_custkey", F.col("ord").alias("o_orderkey"), "o_orderstatus")


def order_best_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ord"), "o_custkey", "o_totalprice")
    return dedupe.best_wins(o, F.col("o_custkey"), F.col("o_totalprice")).select("o_custkey", F.col("ord").alias("o_orderkey"), "place")


def order_phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dearest order of each priority, then of each status, then all others, eighty in total."""
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice", (-F.col("o_totalprice")).alias("ord"))
    frames = [select.cap(o, "o_orderpriority", 1, F.col("ord"), F.col("o_orderkey")), select.cap(o, "o_orderstatus", 1, F.col("ord"), F.col("o_orderkey")), o.orderBy("ord", "o_orderkey").limit(80)]
    return select.phases(frames, "o_orderkey", 80).select("o_orderkey", F.col("phase").cast("long").alias("phase"))


def order_bijection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and first lines don't pair one to one where an order has no first line."""
    lines = _table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("key"))
    return joins.bijection_errors(_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key")), lines, "key")


def order_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without any order."""
    c = _table(spark, sf_dir, "customer").select("c_custkey")
    return joins.subset_errors(c, _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


def part_same_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that were sold, against parts that are listed."""
    sold = _table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("key")).distinct()
    return dedupe.same_sets(_table(spark, sf_dir, "part").where("p_size < 25").select(F.col("p_partkey").alias("key")), sold)


def part_tiered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part with the last other part of its type, else of its brand."""
    p = _table(spark, sf_dir, "part")
    table = p.where("p_size <= 5").select(F.col("p_partkey").alias("ord"), F.col("p_type").alias("k1"), F.col("p_brand").alias("k2"), F.col("p_partkey").alias("found_key"))
    out = joins.tiered_lookup(p.where("p_size > 45").select("p_partkey", F.col("p_type").alias("k1"), F.col("p_brand").alias("k2")), table, ["k1", "k2"], "found_key")
    return out.select("p_partkey", "found")


def supplier_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers merged with suppliers over two keys, then the suppliers nobody met."""
    c = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ord"), F.col("c_name").alias("name"), F.concat_ws(":", "c_nationkey", F.floor(F.col("c_acctbal") / 50)).alias("k1"), F.concat_ws(":", F.lit("id"), "c_custkey").alias("k2"))
    s = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ord"), F.col("s_name").alias("name"), F.concat_ws(":", "s_nationkey", F.floor(F.col("s_acctbal") / 50)).alias("k1"), F.concat_ws(":", F.lit("id"), F.col("s_suppkey") * 40).alias("k2"))
    out = joins.merge_by_keys(c, s, ["k2", "k1"], ["k1", "k2"], ["name"], F.lit(True))
    return out.groupBy("matched").agg(F.count("*").alias("n"), F.count_distinct("name").alias("names"))


def revenue_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue of each nation's suppliers, pre-aggregated by supplier before the dimension joins."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long") * F.round((1 - F.col("l_discount")) * 100).cast("long")
    by = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.sum(cents).alias("r"))
    s = _table(spark, sf_dir, "supplier").join(by, "s_suppkey").groupBy("s_nationkey").agg(F.sum("r").alias("revenue"))
    return _table(spark, sf_dir, "nation").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left").select("n_name", F.coalesce("revenue", F.lit(0)).alias("revenue"))


QUERIES = {
    f.__name__: f
    for f in (
        event_freshness, event_freshness_exceptions, event_period, event_unseen, event_state, event_dense_counts, event_top_values, event_joint_quota, turn_numbers, turn_lookups, turn_text_lookups, turn_first_text, nation_dense_counts,
        nation_segment_matrix, nation_coverage, supplier_floor_cap, supplier_top_up, order_scores, scored_orders, order_quota, order_last_wins, order_best_wins, order_phases, order_bijection, order_subset, part_same_sets,
        part_tiered_lookup, supplier_merge, revenue_by_nation,
    )
}

_E = f"DATE '{END}'"
_AGE = f"date_diff('day', ts::DATE, {_E})"
ORACLES = {
    "event_freshness": f"""SELECT event_id, {_AGE} >= 0 AND {_AGE} <= 14 AS accepted, CASE WHEN {_AGE} BETWEEN 0 AND 14 THEN 'action' ELSE 'reject' END AS allowed_tier,
  CASE WHEN {_AGE} BETWEEN 0 AND 14 THEN 'current-week' WHEN {_AGE} < 0 THEN 'future-date' ELSE 'stale' END AS status, {_AGE}::BIGINT AS age_days FROM events""",
    "event_freshness_exceptions": f"""
WITH c AS (SELECT CASE WHEN {_AGE} BETWEEN 0 AND 14 THEN 'current-week' WHEN {_AGE} < 0 THEN 'future-date' WHEN event_id % 3 = 0 AND user_id % 120 BETWEEN 0 AND 90 THEN 'historical-node'
  WHEN event_id % 3 = 1 AND event_type = 'purchase' THEN 'historical-action' ELSE 'stale' END AS status FROM events)
SELECT status, CASE WHEN status IN ('future-date', 'stale') THEN 'reject' ELSE 'action' END AS allowed_tier, count(*) AS n FROM c GROUP BY ALL""",
    "event_period": f"""SELECT coalesce(min(ts::DATE) FILTER (ts::DATE BETWEEN {_E} - 20 AND {_E}), {_E})::DATE::VARCHAR AS "start", coalesce(max(ts::DATE) FILTER (ts::DATE BETWEEN {_E} - 20 AND {_E}), {_E})::DATE::VARCHAR AS "end" FROM events""",
    "event_unseen": f"SELECT event_id, user_id FROM events WHERE ts::DATE > {_E} - 10 AND ts::DATE <= {_E} AND user_id NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL AND ts::DATE <= {_E} - 10 AND ts::DATE > {_E} - 40)",
    "event_state": f"SELECT user_id, max(ts::DATE)::VARCHAR AS t FROM events GROUP BY 1 HAVING max(ts::DATE) >= {_E} - 10",
    "event_dense_counts": "SELECT k.event_type, k.i::INT AS event_type_ord, count(e.event_id) AS n FROM (VALUES ('view', 0), ('click', 1), ('purchase', 2), ('signup', 3), ('refund', 4), ('never', 5)) k(event_type, i) LEFT JOIN events e USING (event_type) GROUP BY ALL",
    "event_top_values": """
WITH c AS (SELECT 'event_type' AS dimension, event_type AS value, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'user_id', user_id::VARCHAR, count(*) FROM events GROUP BY 2)
SELECT dimension, value, n FROM (SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY n DESC, value) AS r FROM c) WHERE r <= 5""",
    "turn_numbers": "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS number FROM conversations",
    "turn_lookups": "SELECT conv_id || '/' || role AS key, arg_min(substr(text, 1, 40), turn) AS first_said, arg_max(substr(text, 1, 40), turn) AS last_said FROM conversations GROUP BY 1",
    "turn_text_lookups": "SELECT conv_id || '/' || role AS key, arg_min(text, turn) AS first_said, arg_max(text, turn) AS last_said FROM conversations GROUP BY 1",
    "turn_first_text": """
WITH o AS (SELECT conv_id, trim(regexp_replace(coalesce(arg_min(text, turn) FILTER (role = 'user'), ''), '\\s+', ' ', 'g')) AS u, trim(regexp_replace(coalesce(arg_min(text, turn) FILTER (role <> 'user'), ''), '\\s+', ' ', 'g')) AS o FROM conversations GROUP BY 1),
s AS (SELECT conv_id, coalesce(nullif(u, ''), nullif(o, ''), '') AS s FROM o)
SELECT conv_id, CASE WHEN length(s) > 80 THEN substr(s, 1, 79) || '…' ELSE s END AS opening FROM s""",
    "nation_dense_counts": "SELECT n_nationkey, n_name, count(c_custkey) AS n FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey AND c_acctbal > 9800 GROUP BY ALL",
    "nation_segment_matrix": f"SELECT n_nationkey, {', '.join(f'''count(*) FILTER (c_mktsegment = '{m}') AS "{m}"''' for m in ('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD', 'FURNITURE'))} FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY 1",
    "nation_coverage": """
WITH c AS (SELECT n_nationkey, count(c_custkey) AS total, count(c_custkey) FILTER (c_custkey IN (SELECT o_custkey FROM orders)) AS covered FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY 1)
SELECT n_nationkey, total, covered, round(CASE WHEN total = 0 THEN 1.0::DOUBLE ELSE covered / total END, 9) AS ratio FROM c""",
    "supplier_floor_cap": """
WITH r AS (SELECT s_suppkey, s_nationkey, s_acctbal, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS r FROM supplier)
SELECT s_suppkey, s_nationkey, s_acctbal, row_number() OVER (ORDER BY least(r, 2), s_acctbal DESC, s_suppkey) AS turn FROM r WHERE r <= 3 ORDER BY least(r, 2), s_acctbal DESC, s_suppkey LIMIT 40""",
    "supplier_top_up": """
WITH h AS (SELECT s_nationkey, count(*) AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY 1), r AS (SELECT s_suppkey, s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS r FROM supplier WHERE s_acctbal <= 5000)
SELECT s_suppkey, r.s_nationkey FROM r LEFT JOIN h USING (s_nationkey) WHERE r <= 4 - coalesce(n, 0)""",
    "order_scores": """
WITH s AS (SELECT o_orderkey, o_orderstatus, (CASE WHEN o_orderpriority LIKE '1%' THEN 30 ELSE 0 END + CASE WHEN o_orderpriority LIKE '2%' THEN 15 ELSE 0 END + CASE WHEN o_orderstatus = 'F' THEN 25 ELSE 0 END
  + CASE WHEN o_totalprice > 200000 THEN 20 ELSE 0 END + CASE WHEN o_totalprice < 1000 THEN -10 ELSE 0 END)::BIGINT AS score FROM orders)
SELECT o_orderkey, score FROM s ORDER BY o_orderstatus <> 'P', score DESC, o_orderkey LIMIT 200""",
    "scored_orders": """
SELECT o_orderkey, (CASE WHEN o_orderpriority LIKE '1%' THEN 30 ELSE 0 END + CASE WHEN o_orderpriority LIKE '2%' THEN 15 ELSE 0 END + CASE WHEN o_orderstatus = 'F' THEN 25 ELSE 0 END
  + CASE WHEN o_totalprice > 200000 THEN 20 ELSE 0 END + CASE WHEN o_totalprice < 1000 THEN -10 ELSE 0 END)::BIGINT AS score FROM orders""",
    "order_quota": """
WITH must AS (SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '1%' ORDER BY o_totalprice DESC, o_orderkey LIMIT 30)
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderkey IN (SELECT o_orderkey FROM must) DESC, o_totalprice DESC, o_orderkey LIMIT 50""",
    "order_last_wins": "SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1",
    "order_best_wins": "SELECT o_custkey, o_orderkey, place FROM (SELECT o_custkey, o_orderkey, min(o_orderkey) OVER (PARTITION BY o_custkey) AS place, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1",
    "order_phases": """
WITH a AS (SELECT o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS p, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS s, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS g FROM orders)
SELECT o_orderkey, (CASE WHEN p = 1 THEN 0 WHEN s = 1 THEN 1 ELSE 2 END)::BIGINT AS phase FROM a WHERE p = 1 OR s = 1 OR g <= 80 ORDER BY phase, o_totalprice DESC LIMIT 80""",
    "order_bijection": """
WITH l AS (SELECT l_orderkey AS key, count(*) AS n FROM lineitem WHERE l_linenumber = 1 GROUP BY 1), o AS (SELECT o_orderkey AS key, count(*) AS n FROM orders GROUP BY 1)
SELECT key, CASE WHEN l.n IS NULL THEN 'left-only' WHEN o.n IS NULL THEN 'right-only' WHEN o.n > 1 THEN 'left-repeated' ELSE 'right-repeated' END AS problem FROM o FULL JOIN l USING (key) WHERE l.n IS NULL OR o.n IS NULL OR o.n > 1 OR l.n > 1""",
    "order_subset": "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
    "part_same_sets": """
WITH a AS (SELECT p_partkey AS key FROM part WHERE p_size < 25), b AS (SELECT DISTINCT l_partkey AS key FROM lineitem)
SELECT key, 'left' AS side FROM (SELECT key FROM a EXCEPT SELECT key FROM b) UNION ALL SELECT key, 'right' FROM (SELECT key FROM b EXCEPT SELECT key FROM a)""",
    "part_tiered_lookup": """
WITH t AS (SELECT * FROM part WHERE p_size <= 5), a AS (SELECT p_type, max(p_partkey) AS v FROM t GROUP BY 1), b AS (SELECT p_brand, max(p_partkey) AS v FROM t GROUP BY 1)
SELECT p_partkey, coalesce(a.v, b.v) AS found FROM part p LEFT JOIN a USING (p_type) LEFT JOIN b ON b.p_brand = p.p_brand WHERE p_size > 45 AND coalesce(a.v, b.v) IS NOT NULL""",
    "supplier_merge": """
WITH s AS (SELECT s_suppkey, s_name, s_nationkey || ':' || floor(s_acctbal / 50)::BIGINT AS k1, 'id:' || s_suppkey * 40 AS k2 FROM supplier),
k AS (SELECT k1 AS key, s_suppkey FROM s UNION ALL SELECT k2, s_suppkey FROM s), w AS (SELECT key, min(s_suppkey) AS s FROM k GROUP BY 1),
c AS (SELECT c_custkey, c_name, c_nationkey || ':' || floor(c_acctbal / 50)::BIGINT AS k1, 'id:' || c_custkey AS k2 FROM customer),
m AS (SELECT c.*, coalesce(b.s, a.s) AS s FROM c LEFT JOIN w b ON b.key = c.k2 LEFT JOIN w a ON a.key = c.k1),
there AS (SELECT k1 AS key FROM c UNION SELECT k2 FROM c UNION SELECT key FROM k WHERE s_suppkey IN (SELECT s FROM m WHERE s IS NOT NULL)),
free AS (SELECT * FROM s WHERE s_suppkey NOT IN (SELECT s FROM m WHERE s IS NOT NULL) AND k1 NOT IN (SELECT key FROM there) AND k2 NOT IN (SELECT key FROM there)),
one AS (SELECT *, row_number() OVER (PARTITION BY k1 ORDER BY s_suppkey) AS r FROM free),
rows AS (SELECT CASE WHEN s IS NULL THEN 'unmatched' ELSE 'merged' END AS matched, coalesce((SELECT s_name FROM s WHERE s_suppkey = m.s), c_name) AS name FROM m UNION ALL SELECT 'appended', s_name FROM one WHERE r = 1)
SELECT matched, count(*) AS n, count(DISTINCT name) AS names FROM rows GROUP BY 1""",
    "revenue_by_nation": """
WITH l AS (SELECT l_suppkey, sum(round(l_extendedprice * 100)::BIGINT * round((1 - l_discount) * 100)::BIGINT) AS r FROM lineitem GROUP BY 1), s AS (SELECT s_nationkey, sum(r) AS revenue FROM supplier JOIN l ON s_suppkey = l_suppkey GROUP BY 1)
SELECT n_name, coalesce(revenue, 0)::BIGINT AS revenue FROM nation LEFT JOIN s ON n_nationkey = s_nationkey""",
}
