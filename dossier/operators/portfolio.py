"""A portfolio under a cap for each group and a target, repaired where a group stays short of its floor.

Choosing goes over bounded stretches of rows (select.joint_quota); what it takes is bounded by the target. Repairs look at the
counts of what was taken and fetch, for each group that is short, the few rows that fill it.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from .select import joint_quota


@dataclass(frozen=True)
class Rules:
    """target: rows in all; most and least: rows of each group; groups in the order in which they are filled.

    seeded: the group that seeds may fill. moves: for a group, the groups and conditions of rows that may change to it.
    """

    groups: tuple[str, ...]
    target: int = 24
    most: int = 5
    least: int = 2
    seeded: str | None = None
    moves: dict[str, tuple[str, Column]] = field(default_factory=dict)


def repaired(df: DataFrame, rules: Rules, group: str = "module", key: str = "key", ord_: str = "ord", seeds: DataFrame | None = None) -> DataFrame:
    """The chosen rows of df with `placed` (the group they count for), `how` and `turn` (the order in which they were taken).

    1. `quota`: rows in order, each key once, at most `most` of a group, `target` in all. 2. `seed`: if the seeded group has
    less than `least`, seeds in order whose keys aren't taken: one where one is missing, else up to `most`; they don't count
    against the target. 3. group by group, while it has less than `least` and there are less than `target`: `fill`, the next
    row of the group whose key isn't taken, else `moved`, the next row that may change to it.

    A null group or key is a value like any other; of rows equal in ord, key and group any one counts as the first. seeds
    has the columns of df (missing ones are null). Empty tables give the seeds, or no rows. What the driver holds are the
    chosen rows: target + most at most.
    """
    names = df.columns
    taken = [(r, r[group], "quota") for r in joint_quota(df, {group: rules.most}, rules.target, ord_, unique=key).where("reason is null").orderBy(ord_).select(*names).collect()]
    n = Counter(place for _, place, _ in taken)

    def free(rows: DataFrame, limit: int, *order: Column) -> list:
        """The first rows, each key once, whose key isn't taken."""
        used = {r[key] for r, _, _ in taken}
        kept = rows
        if used - {None}:
            kept = kept.where(F.col(key).isNull() | ~F.col(key).isin(*(used - {None})))
        if None in used:
            kept = kept.where(F.col(key).isNotNull())
        place = F.struct(*order, F.col(ord_))
        first = kept.groupBy(key).agg(F.min_by(F.struct(*(F.col(c) for c in names)), place).alias("_row"), F.min(place).alias("_at"))
        return first.orderBy("_at").limit(limit).select("_row.*").collect()

    if seeds is not None and rules.seeded is not None and n[rules.seeded] < rules.least:
        have = n[rules.seeded]
        missing = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in names if c not in seeds.columns]
        new = free(seeds.select(*(F.col(c) for c in seeds.columns if c in names), *missing), 1 if have + 1 >= rules.least else rules.most - have)
        taken += [(r, rules.seeded, "seed") for r in new]
        n[rules.seeded] += len(new)
    for g in rules.groups:
        short = min(rules.least - n[g], rules.target - len(taken))
        if short <= 0:
            continue
        own = F.col(group) == g
        pool, moved = df.where(own), F.lit(0)
        if g in rules.moves:
            source, condition = rules.moves[g]
            movable = (F.col(group) == source) & F.coalesce(condition, F.lit(False))
            pool, moved = df.where(own | movable), F.when(own, 0).otherwise(1)
        new = free(pool, short, moved.alias("moved"))
        taken += [(r, g, "fill" if r[group] == g else "moved") for r in new]
        n[g] += len(new)
    schema = StructType([*df.schema.fields, StructField("placed", StringType()), StructField("how", StringType()), StructField("turn", IntegerType())])
    return df.sparkSession.createDataFrame([(*r, place, how, i + 1) for i, (r, place, how) in enumerate(taken)], schema)
