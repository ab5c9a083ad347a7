"""Connected components by contraction, for any number of links.

Each round points every node at the neighbour that comes first (itself included), replaces both ends of all links by what
they point at and drops what has become a loop. The first round orders nodes by id, which ends stars at once; later rounds
order them by a hash that changes with the round, so chains shrink by a constant share. Minima are taken before the
shuffle, so a node that a third of all links share is no load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

#: Parts of a component's members when something is joined to all of them, so that no task gets a whole hot one.
PARTS = 8


def spread(members: DataFrame, of_component: DataFrame, component: str, member: str) -> DataFrame:
    """members joined with of_component, a row for each component, on component and a part of its members."""
    dealt = members.withColumn("part", F.pmod(F.xxhash64(member), F.lit(PARTS)).cast("int"))
    return dealt.join(of_component.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))), [component, "part"]).drop("part")


def components(links: DataFrame, a: str = "a", b: str = "b", least: bool = True) -> DataFrame:
    """(id, component) of every id on a link between two different ids; component is the smallest id reachable, or without `least` any one of them.

    Links may repeat, run either way and join an id with itself; those with a null end are left out.
    """
    links = checkpointed(links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b").distinct())
    steps: list[DataFrame] = []
    while not links.isEmpty():
        round_ = len(steps)

        def order(c: Column, round_: int = round_) -> Column:
            return F.struct((c if round_ == 0 else F.xxhash64(c, F.lit(round_))).alias("rank"), c.alias("to"))

        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min(order(F.col("b"))).alias("m"))
        step = checkpointed(nearest.select(F.col("a").alias("id"), F.least(F.col("m"), order(F.col("a")))["to"].alias("to")))
        steps.append(step)
        left = links.join(step, links["a"] == step["id"]).select(F.col("to").alias("a"), "b")
        right = left.join(step, left["b"] == step["id"]).select("a", F.col("to").alias("b"))
        links = checkpointed(right.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if not steps:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    root = steps[-1]
    for step in reversed(steps[:-1]):
        onward = root.select(F.col("id").alias("to"), F.col("to").alias("root"))
        root = step.join(onward, "to", "left").select("id", F.coalesce("root", "to").alias("to"))
    if len(steps) > 1 and least:
        root = checkpointed(root)
        return spread(root, root.groupBy("to").agg(F.min("id").alias("component")), "to", "id").select("id", "component")
    return root.select("id", F.col("to").alias("component"))
