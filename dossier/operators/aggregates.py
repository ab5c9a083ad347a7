"""Counts, ratios, dense matrices, histograms and the assertions made on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lexicons as lx
from ..functions.text import blank
from .dedupe import ORD, last_wins, winner


class GateError(Exception):
    """A run-level gate that isn't met; `figures` has what was measured."""

    def __init__(self, message: str, figures: dict):
        super().__init__(message)
        self.figures = figures


def dimension(spark: SparkSession, names: list[str], column: str = "name") -> DataFrame:
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], f"{column} string, {column}_ord int")


def dense_counts(df: DataFrame, column: str, names: DataFrame, by: str | None = None) -> DataFrame:
    """(column, n) for every name of the dimension, 0 where no row has it."""
    key = by or names.columns[0]
    n = df.groupBy(F.col(column).alias(key)).agg(F.count("*").alias("n"))
    return names.join(n, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def dense_matrix(df: DataFrame, row: str, rows: DataFrame, column: str, columns: list[str]) -> DataFrame:
    """Counts of rows by columns, all cells there."""
    key = rows.columns[0]
    counts = df.groupBy(F.col(row).alias(key)).agg(*(F.count(F.when(F.col(column) == c, 1)).alias(c) for c in columns))
    return rows.join(counts, key, "left").select(key, *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in columns))


def reasons(df: DataFrame, reason: str = "reason", *by: str) -> DataFrame:
    """How many rows each reason has turned down, also by other columns."""
    return df.where(F.col(reason).isNotNull()).groupBy(*by, reason).agg(F.count("*").alias("n"))


def exploded_reasons(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.explode(column).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def funnel(stages: dict[str, DataFrame], module: str, modules: DataFrame) -> DataFrame:
    """(module, a count for each stage)."""
    both = None
    for name, df in stages.items():
        part = df.groupBy(F.col(module).alias("module")).agg(F.count("*").alias("n")).withColumn("stage", F.lit(name))
        both = part if both is None else both.unionByName(part)
    key = modules.columns[0]
    wide = both.groupBy(F.col("module").alias(key)).agg(*(F.sum(F.when(F.col("stage") == s, F.col("n"))).alias(s) for s in stages))
    return modules.join(wide, key, "left").select(key, *(F.coalesce(F.col(s), F.lit(0)).alias(s) for s in stages))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 1 where there is nothing to cover."""
    return F.when(whole == 0, F.lit(1.0)).otherwise(part / whole)


def coverage(sources: DataFrame, results: DataFrame, ord_: str = ORD) -> DataFrame:
    """One row: how many required sources, and critical ones among them, a run has covered.

    A source is covered by an empty result, or by an ok or recovered one with candidates. Of repeated results the last counts.
    """
    last = last_wins(results, "name", ord_).select("name", "status", "candidate_count")
    joined = sources.join(last, "name", "left")
    covered = F.coalesce((F.col("status") == "empty") | (F.col("status").isin("ok", "recovered") & (F.col("candidate_count") > 0)), F.lit(False))
    required = ~F.coalesce(F.col("monitor_only"), F.lit(False))
    critical = required & (F.col("priority") == "high") & (F.contains(blank("country"), F.lit(lx.HOME_COUNTRY)) | F.contains(blank("region"), F.lit(lx.HOME_COUNTRY)))

    def count(c: Column) -> Column:
        return F.count(F.when(c, 1))

    def names(c: Column) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.when(c, F.struct(F.col(ord_), F.col("name"))))), lambda s: s["name"])

    side = joined.withColumn("_covered", covered)
    n = side.agg(
        count(required).alias("total"), count(required & F.col("_covered")).alias("covered"),
        count(critical).alias("critical_total"), count(critical & F.col("_covered")).alias("critical_covered"),
        names(required & ~F.col("_covered")).alias("failed_sources"),
        count(~required).alias("monitored_total"), count(~required & F.col("_covered")).alias("monitored_recovered"),
        names(~required & ~F.col("_covered")).alias("monitored_failed_sources"), F.count("*").alias("attempted_total"),
    )
    return n.withColumn("overall", ratio(F.col("covered"), F.col("total"))).withColumn("critical", ratio(F.col("critical_covered"), F.col("critical_total")))


def require(df: DataFrame, *checks: tuple[Column, str]) -> dict:
    """The only row of df; raises GateError with the names of all checks that don't hold."""
    row = df.withColumn("_failed", F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for ok, name in checks)))).first().asDict(recursive=True)
    failed = row.pop("_failed")
    if failed:
        raise GateError("not met: " + ", ".join(failed), row)
    return row


def require_coverage(df: DataFrame, overall: float = 0.9, critical: float = 0.9) -> dict:
    return require(df, (F.col("critical") >= critical, "critical-coverage"), (F.col("overall") >= overall, "overall-coverage"))


def text_stats(records: DataFrame, text: list[str], attachments: str) -> DataFrame:
    """records, home, with_text, attachments."""
    has = F.lit(False)
    for t in text:
        has = has | (blank(t) != "")
    return records.agg(
        F.count("*").alias("records"), F.count(F.when(F.col("country") == lx.HOME_COUNTRY, 1)).alias("home"),
        F.count(F.when(has, 1)).alias("with_text"), F.coalesce(F.sum(F.size(attachments)), F.lit(0)).alias("attachments"),
    )


def text_gate(stats: DataFrame) -> dict:
    """Enough records have text: half of them, one at least and six at most."""
    return require(stats, (F.col("with_text") >= F.least(F.lit(6), F.greatest(F.lit(1), F.ceil(F.col("records") / 2))), "text-records"))


def proof(accepted: DataFrame, identity: Column, start: Column, end: Column, items: int = 20, home: int = 10, modules: int = 4, ord_: str = ORD) -> DataFrame:
    """One row: distinct events inside the period, home and module counts, and the codes of what is short."""
    inside = accepted.where((F.col("published_at") >= start) & (F.col("published_at") <= end)).withColumn("_id", identity)
    first = winner(inside, "_id", F.col(ord_))
    n = first.agg(F.count("*").alias("primary_count"), F.count(F.when(F.col("home_relevant"), 1)).alias("home_count"), F.countDistinct("module").alias("module_count"))
    codes = F.array_compact(F.array(F.when(F.col("primary_count") < items, "minimum-items"), F.when(F.col("home_count") < home, "minimum-home-items"), F.when(F.col("module_count") < modules, "minimum-modules")))
    return n.crossJoin(inside.agg(F.count("*").alias("_all"))).withColumn("duplicates", F.col("_all") - F.col("primary_count")).drop("_all").withColumn("failure_codes", codes).withColumn("pass", F.size("failure_codes") == 0)  # one row each


def portfolio(cards: DataFrame, modules: DataFrame, module: str = "module") -> DataFrame:
    """(module, n, status): missing, underfilled (one card) or filled."""
    n = dense_counts(cards, module, modules)
    return n.withColumn("status", F.when(F.col("n") == 0, "missing").when(F.col("n") < 2, "underfilled").otherwise("filled"))


def require_report(cards: DataFrame, modules: list[str], start: str, end: str, least: int = 20, most: int = 24, per_module: int = 2) -> dict:
    """A report of 1 to 15 days, 20 to 24 cards, two of each module, no address twice."""
    counts = [F.count(F.when(F.col("module") == m, 1)).alias(f"m{i}") for i, m in enumerate(modules)]
    one = cards.agg(F.count("*").alias("cards"), F.countDistinct("source_url").alias("urls"), *counts).withColumn("days", F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date")) + 1)
    return require(one, (F.col("days").between(1, lx.FRESH_DAYS), "period"), (F.col("cards").between(least, most), "card-count"), (F.col("urls") == F.col("cards"), "duplicate-url"), *((F.col(f"m{i}") >= per_module, f"module:{m}") for i, m in enumerate(modules)))


def top_values(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    """(dimension, value, n): the most frequent values of each column, ties by value; all columns in one pass."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns)))
    counted = df.select(cells.alias("x")).select("x.*").where(F.coalesce(F.col("value"), F.lit("")) != "").groupBy("dimension", "value").agg(F.count("*").alias("n"))
    from .select import cap

    return cap(counted, "dimension", n, F.desc("n"), F.col("value"))


def period(df: DataFrame, day: str, end: Column, days: int = 60) -> DataFrame:
    """(start, end): first and last day within so many days, the end itself where there is none."""
    d = F.col(day).cast("date")
    inside = F.when(d.between(F.date_sub(end, days), end), d)
    return df.agg(F.coalesce(F.min(inside), end).alias("start"), F.coalesce(F.max(inside), end).alias("end"))
