"""Duplicates with a stated winner. Every frame carries an order column; no operator depends on partition order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORD = "ord"


def winner(df: DataFrame, key: Column | str, *order: Column, keep_null: bool = False) -> DataFrame:
    """The first row of each key in that order. Rows without a key (null or empty) go, or all stay.

    Minima are taken on each side of the shuffle, so a key that many rows share is one row from each task.
    """
    named = df.withColumn("_key", (F.col(key) if isinstance(key, str) else key).cast("string"))
    has = F.coalesce(F.col("_key") != "", F.lit(False))
    rank = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)))
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    best = named.where(has).groupBy("_key").agg(F.min_by(row, rank).alias("_row")).select("_row.*")
    return best.unionByName(named.where(~has).drop("_key")) if keep_null else best


def first_wins(df: DataFrame, key: Column | str, ord_: str = ORD, keep_null: bool = False) -> DataFrame:
    return winner(df, key, F.col(ord_), keep_null=keep_null)


def last_wins(df: DataFrame, key: Column | str, ord_: str = ORD) -> DataFrame:
    return winner(df, key, -F.col(ord_))


def best_wins(df: DataFrame, key: Column | str, score: Column, ord_: str = ORD) -> DataFrame:
    """The row with the highest score of each key, the first of equals, at the place of the key's first row (column `place`)."""
    named = df.withColumn("_k", F.col(key) if isinstance(key, str) else key)
    place = named.groupBy("_k").agg(F.min(ord_).alias("place"))
    best = winner(named, "_k", -score, F.col(ord_))
    return best.join(place, "_k").drop("_k")


def stronger_wins(df: DataFrame, key: Column | str, strong: Column, ord_: str = ORD) -> DataFrame:
    """The first row of each key, unless it is weak and a strong one follows: then the first strong one, at the first one's place."""
    return best_wins(df, key, F.when(strong, 1).otherwise(0), ord_)


def priority_union(frames: list[DataFrame], key: Column | str, ord_: str = ORD) -> DataFrame:
    """Rows of all frames, of equal keys the one in the earliest frame, then the first; `ord` runs over all."""
    ranked = [f.withColumn("_src", F.lit(i)) for i, f in enumerate(frames)]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
    return winner(both, key, F.col("_src"), F.col(ord_)).withColumnRenamed("_src", "source_rank")


def unseen(df: DataFrame, key: Column | str, seen: DataFrame, seen_key: str = "u") -> DataFrame:
    """Rows whose key isn't among those seen. Rows without a key stay."""
    named = df.withColumn("_key", F.col(key) if isinstance(key, str) else key)
    return named.join(seen.select(F.col(seen_key).alias("_key")), "_key", "left_anti").drop("_key")


def same_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of the frames has, or has more often; empty if both are equal."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def repeated(df: DataFrame, key: str) -> DataFrame:
    """(key, n) of keys that stand more than once."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def distinct_across(df: DataFrame, url: str, kind: str, country: str, title: str, ord_: str = ORD) -> DataFrame:
    """First of each address in lower case, without one of each kind, country and title."""
    address = F.lower(F.trim(F.coalesce(F.col(url), F.lit(""))))
    name = F.lower(F.regexp_replace(F.coalesce(F.col(title), F.lit("")), r"\s+", ""))
    other = F.concat_ws(":", F.coalesce(F.col(kind), F.lit("")), F.coalesce(F.col(country), F.lit("")), name)
    return first_wins(df, F.when(address != "", address).otherwise(other), ord_)
