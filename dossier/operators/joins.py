"""Lookups with a stated rule for repeated keys, multi-key merges, and assertions on joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank, let
from ..functions.urls import record_key
from .dedupe import ORD, first_wins, last_wins
from .graph import cut

#: So many runs of patterns at a time are sent to where texts lie (8 bytes each).
RUNS = 500_000


def lookup(df: DataFrame, table: DataFrame, key: str, values: list[str], last: bool = False, ord_: str = ORD) -> DataFrame:
    """values of the table's first (or last) row with the key; null where there is none."""
    pick = (last_wins if last else first_wins)(table, key, ord_).select(key, *values)
    return df.join(pick, key, "left")


def tiered_lookup(df: DataFrame, table: DataFrame, keys: list[str], value: str, last: bool = True, ord_: str = ORD) -> DataFrame:
    """`found`: value by the first of these keys that is in the table; rows without any go."""
    out, names = df, []
    for i, k in enumerate(keys):
        pick = (last_wins if last else first_wins)(table, k, ord_).select(F.col(k).alias(f"_k{i}"), F.col(value).alias(f"_v{i}"))
        out = out.join(pick, F.col(k) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        names.append(f"_v{i}")
    return out.withColumn("found", F.coalesce(*names)).drop(*names).where(F.col("found").isNotNull())


def merge_by_keys(candidates: DataFrame, records: DataFrame, candidate_keys: list[str], record_keys: list[str], fields: list[str], append: Column, ord_: str = ORD) -> DataFrame:
    """Candidates with the fields of the record they meet, then records that none met and `append` holds for.

    A candidate takes its first key that any record has, and of these records the first; a record's text replaces the
    candidate's unless blank. A record is appended unless one of its keys is already there. `matched` tells what a row is:
    merged, unmatched or appended. Empty keys meet nothing.
    """

    def keyed(df: DataFrame, keys: list[str], tag: str) -> DataFrame:
        pairs = F.array(*(F.struct(F.lit(i).alias(f"{tag}_rank"), blank(k).alias("key")) for i, k in enumerate(keys)))
        return df.select(F.col(ord_).alias(f"{tag}_ord"), F.explode(pairs).alias("p")).select(f"{tag}_ord", "p.*").where("key <> ''")

    ckeys, rkeys = keyed(candidates, candidate_keys, "c"), keyed(records, record_keys, "r")
    owner = rkeys.groupBy("key").agg(F.min("r_ord").alias("r_ord"))
    met = ckeys.join(owner, "key").groupBy("c_ord").agg(F.min_by("r_ord", "c_rank").alias("r_ord"))
    right = records.select(F.col(ord_).alias("r_ord"), *(F.col(f).alias(f"_{f}") for f in fields))
    joined = candidates.join(met, candidates[ord_] == met["c_ord"], "left").join(right, "r_ord", "left")
    for f in fields:
        joined = joined.withColumn(f, F.when(blank(f"_{f}") != "", F.col(f"_{f}")).otherwise(F.col(f)))
    status = F.when(F.col("r_ord").isNotNull(), "merged").otherwise("unmatched")
    merged = joined.withColumn("matched", status).drop("r_ord", "c_ord", *(f"_{f}" for f in fields))
    taken = met.select("r_ord").distinct()
    there = ckeys.select("key").union(rkeys.join(taken, "r_ord", "left_semi").select("key")).distinct()
    blocked = rkeys.join(there, "key", "left_semi").select("r_ord").distinct()
    free = records.where(append).join(taken.union(blocked).distinct(), records[ord_] == F.col("r_ord"), "left_anti")
    repeats = keyed(free, record_keys, "r").groupBy("key").agg(F.min("r_ord").alias("first"), F.collect_set("r_ord").alias("all")).select(F.explode("all").alias("r_ord"), "first").where("r_ord > first").select("r_ord").distinct()
    fresh = free.join(repeats, free[ord_] == F.col("r_ord"), "left_anti").withColumn("matched", F.lit("appended"))
    return merged.unionByName(fresh, allowMissingColumns=True)


def substring_matches(patterns: DataFrame, texts: DataFrame, pattern: str, text: str, width: int = 3) -> DataFrame:
    """Rows of patterns with the rows of texts that hold them: every word run inside a pattern also stands in such a text.

    Both sides are joined on runs of `width` whole words: the pattern gives one run from its inside (its first and last
    word can be cut), so the join is by equality of their hashes; what meets is checked on the texts. The runs of texts
    meet those of patterns where they lie, RUNS of the latter at a time, so only what meets is shuffled. A text goes into
    that join as a digest and comes back only where a run met. Patterns of fewer than width + 2 words are compared with
    every text and have to be few.
    """
    words = F.split(F.trim(F.regexp_replace(blank(pattern), r"\s+", " ")), " ")
    # equal patterns are looked for once
    runs = patterns.select(pattern).distinct().withColumn("_run", F.when(F.size(words) >= width + 2, F.xxhash64(F.array_join(F.slice(words, 2, width), " "))))

    def windows(t: Column) -> Column:
        n = F.size(t) - (width - 1)
        return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.xxhash64(F.concat_ws(" ", *(F.get(t, i + k) for k in range(width)))))))

    at = let(F.split(F.regexp_replace(blank(text), r"\s+", " "), " "), windows)
    known = texts.withColumn("_digest", F.unhex(F.sha2(blank(text), 256)))
    held = known.select("_digest", F.explode(at).alias("_run"))
    keys = cut(runs.where("_run is not null").select("_run").distinct())
    parts = max(1, -(-keys.count() // RUNS))
    near = [held.join(F.broadcast(keys.where(F.pmod("_run", F.lit(parts)) == i)), "_run", "left_semi") for i in range(parts)]
    met = reduce(DataFrame.unionByName, near).distinct().join(runs.where("_run is not null"), "_run").drop("_run")
    long_ = known.join(met, "_digest").drop("_digest").where(F.contains(F.col(text), F.col(pattern))).join(patterns, pattern)
    few = F.broadcast(patterns.join(runs.where("_run is null"), pattern).where("length(trim(coalesce(" + pattern + ", ''))) > 0").drop("_run"))
    short = texts.join(few, F.contains(texts[text], few[pattern]))
    return long_.unionByName(short)


def exactly_one(df: DataFrame, key: str) -> DataFrame:
    """(key, n, problem) of keys that don't stand exactly once: `none` needs a left join's null count, `several` more than one."""
    return df.groupBy(key).agg(F.count("match").alias("n")).where("n <> 1").withColumn("problem", F.when(F.col("n") == 0, "none").otherwise("several"))


def bijection_errors(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, problem): keys that only one side has, or a side has more than once. Empty for a bijection."""
    n = left.groupBy(key).agg(F.count("*").alias("l")).join(right.groupBy(key).agg(F.count("*").alias("r")), key, "full")
    problem = F.when(F.col("r").isNull(), "left-only").when(F.col("l").isNull(), "right-only").when(F.col("l") > 1, "left-repeated").when(F.col("r") > 1, "right-repeated")
    return n.withColumn("problem", problem).where("problem is not null").select(key, "problem")


def subset_errors(part: DataFrame, whole: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of part that aren't in whole."""
    return part.select(*keys).join(whole.select(*keys), keys, "left_anti")


def with_corroboration(records: DataFrame, verified: DataFrame, tier: Column, url: Column | str = "url", verified_url: Column | str = "url", ord_: str = ORD) -> DataFrame:
    """records with what their events were found to be worth: evidence_grade, verification_status, supporting_sources, agreed_anchors, event_id.

    A record takes these of the verified row with its address (urls.record_key), the last one of several; empty or null ones
    leave the record's own. A record without such a row that claims hard facts but has a secondary source (tier) is no more
    than a lead: its grade falls and its support goes. Records without an address meet nothing. Columns that records don't
    have are null before.
    """
    texts, lists = ["evidence_grade", "verification_status", "event_id"], ["supporting_sources", "agreed_anchors"]
    kinds = {c: "string" for c in texts} | {c: "array<string>" for c in lists}
    own = records.withColumns({c: F.lit(None).cast(t) for c, t in kinds.items() if c not in records.columns}).withColumns({"_key": record_key(url), "_tier": tier})
    given = [(F.col(c) if c in verified.columns else F.lit(None)).cast(t).alias(f"_{c}") for c, t in kinds.items()]
    rows = verified.select(record_key(verified_url).alias("_key"), F.col(ord_).alias("_ord"), *given).where("_key <> ''")
    known = rows.groupBy("_key").agg(F.max_by(F.struct(*(f"_{c}" for c in kinds)), "_ord").alias("_v"))
    both = own.join(known, "_key", "left")
    demoted = F.col("_v").isNull() & (F.col("evidence_grade") == "hard_fact_ready") & (F.col("_tier") == "secondary")
    fallen = {"evidence_grade": F.lit("lead_only"), "verification_status": F.lit("unverified"), "event_id": F.col("event_id")} | {c: F.array().cast("array<string>") for c in lists}

    def value(c: str) -> Column:
        new = F.nullif(F.col(f"_v._{c}"), F.lit("")) if c in texts else F.col(f"_v._{c}")
        return F.when(F.coalesce(demoted, F.lit(False)), fallen[c]).otherwise(F.coalesce(new, F.col(c)))

    return both.select(*(value(c).alias(c) if c in kinds else F.col(c) for c in own.columns if c not in ("_key", "_tier")))
