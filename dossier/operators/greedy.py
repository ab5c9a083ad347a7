"""Greedy grouping in a stated order, as rounds of joins.

Each row, in order, joins the first group that holds an earlier row it is paired with, else begins one. Run row by row that is
a fold. Here every row looks at its earlier neighbours in all rounds at once, and follows a pointer that doubles its reach
with each round, so chains take as many rounds as their length has binary digits; stars and cliques take one or two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import Steps
from .skew import hot_keys


class _Lookup:
    """Joins edges with a table of rows on their earlier end; ends that many edges share are looked up where the edges lie."""

    def __init__(self, edges: DataFrame):
        self.hot = hot_keys(edges, ["n"])

    def __call__(self, edges: DataFrame, state: DataFrame, *columns: str) -> DataFrame:
        at = state.select(F.col("o").alias("n"), *(F.col(c).alias(f"n_{c}") for c in columns))
        if self.hot is None:
            return edges.join(at, "n")
        hot = F.broadcast(self.hot)
        return edges.join(F.broadcast(at.join(hot, "n", "left_semi")), "n").unionByName(edges.join(hot, "n", "left_anti").join(at, "n"))


def _edges(pairs: DataFrame, steps: Steps) -> DataFrame:
    """(o, n): each row with each earlier one it is paired with."""
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    return steps.keep(pairs.select(F.greatest(a, b).alias("o"), F.least(a, b).alias("n")).where("o <> n").distinct())


def joined_groups(pairs: DataFrame) -> DataFrame:
    """(o, group) of the rows on pairs (a, b): a row's group is the smallest row that steps to earlier neighbours lead to.

    A row knows the smallest label among its earlier neighbours and at its pointer's end, which is a neighbour at first and
    then the end of that one's pointer. Labels that no round lowers are right: a row's is then the least of its neighbours'.
    """
    with Steps(pairs.sparkSession) as steps:
        edges = _edges(pairs, steps)
        least = edges.groupBy("o").agg(F.min("n").alias("m"))
        roots = edges.select("n").distinct().join(least.select(F.col("o").alias("n")), "n", "left_anti")
        # rows without earlier neighbours have no more to tell than their own number, which `m` has
        inner = steps.keep(edges.join(roots, "n", "left_anti"))
        pointer = inner.groupBy("o").agg(F.min("n").alias("jump"))
        state = steps.keep(least.join(pointer, "o", "left").select("o", F.col("m").alias("label"), "jump"))
        look = _Lookup(inner)
        while True:
            near = look(inner, state, "label").groupBy("o").agg(F.min("n_label").alias("near"))
            end = state.select(F.col("o").alias("jump"), F.col("label").alias("j_label"), F.col("jump").alias("j_jump"))
            pointing = state.where("jump is not null").join(end, "jump")  # pointers lead to rows that have a state
            moved = pointing.join(near, "o", "left").select("o", F.least("label", "near", "j_label").alias("label"), F.col("j_jump").alias("jump"), ((F.least("label", "near", "j_label") < F.col("label")) | F.col("j_jump").isNotNull()).alias("moved"))
            rest = state.where("jump is null").join(near, "o", "left").select("o", F.least("label", "near").alias("label"), "jump", F.coalesce(F.col("near") < F.col("label"), F.lit(False)).alias("moved"))
            new = steps.keep(moved.unionByName(rest))
            state = new.drop("moved")
            if new.where("moved").isEmpty():
                return steps.result(roots.select(F.col("n").alias("o"), F.col("n").alias("group")).unionByName(state.select("o", F.col("label").alias("group"))))


def led_groups(pairs: DataFrame) -> DataFrame:
    """(o, group) of the rows on pairs (a, b): rows that no earlier leader is paired with lead; others follow the first leader they are paired with.

    In a round, rows without undecided earlier neighbours lead and rows with a leading one follow. A row that waits for one
    neighbour only will do the opposite of it; such rows point at each other in chains, which pointers shorten by half.
    """
    with Steps(pairs.sparkSession) as steps:
        edges = _edges(pairs, steps)
        look = _Lookup(edges)
        nodes = edges.select("o").union(edges.select(F.col("n").alias("o"))).distinct()
        state = steps.keep(nodes.select("o", F.lit(None).cast("boolean").alias("leads"), F.lit(None).cast("long").alias("ptr"), F.lit(False).alias("flip")))
        open_ = edges
        while True:
            seen = look(open_, state, "leads").groupBy("o").agg(F.bool_or(F.coalesce("n_leads", F.lit(False))).alias("led"), F.count(F.when(F.col("n_leads").isNull(), 1)).alias("waits"), F.min(F.when(F.col("n_leads").isNull(), F.col("n"))).alias("one"))
            end = state.select(F.col("o").alias("ptr"), F.col("leads").alias("p_leads"), F.col("ptr").alias("p_ptr"), F.col("flip").alias("p_flip"))
            both = state.where("leads is null").join(seen, "o", "left").join(end, "ptr", "left")
            told = F.when(F.col("flip"), ~F.col("p_leads")).otherwise(F.col("p_leads"))
            waits = F.coalesce("waits", F.lit(0))
            leads = F.when(F.coalesce("led", F.lit(False)), False).when(waits == 0, True).when(F.col("ptr").isNotNull(), told)
            fresh = F.col("ptr").isNull() & (waits == 1)
            ptr = F.when(fresh, F.col("one")).otherwise(F.coalesce("p_ptr", "ptr"))
            flip = F.when(fresh, True).when(F.col("p_ptr").isNotNull(), F.col("flip") != F.col("p_flip")).otherwise(F.col("flip"))
            state = steps.keep(both.select("o", leads.alias("leads"), ptr.alias("ptr"), flip.alias("flip")).unionByName(state.where("leads is not null")))
            undecided = state.where("leads is null")
            if undecided.isEmpty():
                break
            open_ = steps.keep(look(open_.join(undecided.select("o"), "o", "left_semi"), state, "leads").where("n_leads is null or n_leads").select("o", "n"))
        leader = state.where("leads").select("o", "leads")
        first = look(edges, leader, "leads").groupBy("o").agg(F.min("n").alias("group"))
        return steps.result(state.join(first, "o", "left").select("o", F.when(F.col("leads"), F.col("o")).otherwise(F.col("group")).alias("group")))
