"""Deliveries: many portfolios at once, each under a target, floors and caps of modules and a quota of home rows, and what is short.

Rows have a portfolio, a module, a key (copies of one item share it), an order column `ord` that no two rows of a portfolio
share, and four flags: strict (accepted), fallback (may stand in), home and graded. A null portfolio, module or key is a value
like any other; a null flag is false.

Copies are reduced by aggregates that Spark combines before the shuffle, and every rank is cut at a bound before it, so that
a portfolio with a third of all rows is a bounded number of rows from each task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FLAGS = ("strict", "fallback", "home", "graded")


@dataclass(frozen=True)
class Terms:
    """modules in their order; target: rows to choose; fewest and most: rows that a whole delivery has; floor and cap: rows
    of each module; home and graded: rows of these kinds, as far as there are any."""

    modules: tuple[str, ...]
    target: int = 20
    fewest: int = 20
    most: int = 24
    floor: int = 2
    cap: int = 5
    home: int = 2
    graded: int = 3

    def __post_init__(self):
        if min(self.target, self.floor, self.cap, self.home) < 0 or not self.modules:
            raise ValueError("a delivery needs modules and bounds of 0 or more")


def _flagged(rows: DataFrame) -> DataFrame:
    return rows.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in FLAGS})


def _first(rows: DataFrame, *place: Column) -> DataFrame:
    """The first row of each key of each portfolio."""
    row = F.struct(*(F.col(f"`{c}`") for c in rows.columns))
    return rows.groupBy("portfolio", "key").agg(F.min_by(row, F.struct(*place)).alias("_row")).select("_row.*")


def _places(rows: DataFrame, by: tuple[str, ...], limit: int, *order: Column, name: str) -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= limit)


def selectable(rows: DataFrame) -> DataFrame:
    """Strict and graded rows, of each key the first in `ord`."""
    return _first(_flagged(rows).where("strict and graded"), F.col("ord"))


def chosen(rows: DataFrame, terms: Terms, *order: Column) -> DataFrame:
    """The selectable rows of each portfolio with `place`: first the best of each module, then the second best, until every
    module has its floor; then the best of what is left. At most `cap` of a module and `target` in all. Ties go by `ord`."""
    best = (*order, F.col("ord"))
    ranked = _places(selectable(rows), ("portfolio", "module"), terms.cap, *best, name="_rank")
    step = F.when(F.col("module").isin(*terms.modules), F.least("_rank", F.lit(terms.floor + 1))).otherwise(F.lit(terms.floor + 1))
    return _places(ranked, ("portfolio",), terms.target, step, *best, name="place").drop("_rank")


def delivered(rows: DataFrame, terms: Terms, *order: Column) -> DataFrame:
    """What is delivered of each portfolio, relaxed in this order, with `how` and `place` (in the order of delivery).

    1. `strict`: of each key the first strict row in `ord`; the best of each module, then the best of what is left, `target`
    at most. 2. `home`: where some were chosen and fewer than `home` of them (or than there are graded home rows, or than the
    target) are home rows, the best home rows that may stand in and whose key isn't chosen; they don't count against the
    target. 3. `fallback`: where nothing is strict, the best rows that may stand in, of each key the best.
    """
    all_, best = _flagged(rows), (*order, F.col("ord"))
    ranked = _places(_first(all_.where("strict"), F.col("ord")), ("portfolio", "module"), terms.target, *best, name="_rank")
    leads = F.when((F.col("_rank") == 1) & F.coalesce(F.col("module").isin(*terms.modules), F.lit(False)), 0).otherwise(1)
    strict = _places(ranked, ("portfolio",), terms.target, leads, *best, name="place").select(*all_.columns)
    have = strict.groupBy("portfolio").agg(F.count_if("home").alias("_have"))
    graded = all_.where("home and graded").groupBy("portfolio").agg(F.count("*").alias("_graded"))
    wanted = F.least(F.lit(terms.home), F.lit(terms.target), F.col("_graded"))
    same = lambda a, b, *names: _all(a[n].eqNullSafe(b[n]) for n in names)
    short = have.join(graded, same(have, graded, "portfolio")).select(have["portfolio"], (wanted - F.col("_have")).alias("_short")).where("_short > 0")

    # Struct keys order as the columns do only where none falls, so the best of each key is a rank of one.
    stand_ins = _places(all_.where("fallback"), ("portfolio", "key"), 1, *best, name="_rank").drop("_rank")
    near = _places(stand_ins.where("home"), ("portfolio",), terms.target + terms.home, *best, name="_rank").drop("_rank")
    open_ = near.join(strict, same(near, strict, "portfolio", "key"), "left_anti")
    top = _places(open_, ("portfolio",), terms.home, *best, name="_rank")
    home = top.join(short, same(top, short, "portfolio") & (F.col("_rank") <= F.col("_short"))).select(*(top[c] for c in all_.columns))
    first = _places(stand_ins, ("portfolio",), terms.target, *best, name="_rank").drop("_rank")
    fallback = first.join(have, same(first, have, "portfolio"), "left_anti")
    parts = [df.withColumn("how", F.lit(how)) for df, how in ((strict, "strict"), (home, "home"), (fallback, "fallback"))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.withColumn("place", F.row_number().over(Window.partitionBy("portfolio").orderBy(*best)))


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def audit(rows: DataFrame, taken: DataFrame, terms: Terms, partial: bool = False, foreign: bool = False) -> DataFrame:
    """One row for each portfolio of rows: what there was, what was taken, what is short, and the codes of the gates not met.

    Counts: rows, home_rows; pool, pool_home and pool_by_module (selectable rows); taken, taken_home, taken_graded, stand_ins
    (taken rows that aren't strict) and taken_by_module, the arrays in the order of the modules, zeros included. `needed` home rows; missing
    and underfilled modules; out_of_pool: underfilled modules whose floor the pool can't meet; achievable: the pool could meet all floors and the fewest rows.

    codes, in order: no-items, no-home, few-home (home rows are there, and none, no home row or fewer than needed were
    taken; not with `foreign`), few-graded, item-count, missing-module, underfilled-module. status: whole without codes;
    partial, where that is allowed, rows were taken and only the last three codes stand, with no more rows than `most`; else refused.
    """
    module = lambda n, label: F.array(*(F.count_if((F.col("_of") == n) & (F.col("module") == m)) for m in terms.modules)).alias(label)
    n = lambda of, *flags: F.count_if(_all([F.col("_of") == of, *(F.col(f) for f in flags)]))
    slim = lambda df, of: _flagged(df).select("portfolio", "module", "strict", "home", "graded", F.lit(of).alias("_of"))
    both = slim(rows, "rows").union(slim(selectable(rows), "pool")).union(slim(taken, "taken"))
    counts = both.groupBy("portfolio").agg(
        n("rows").alias("rows"), n("rows", "home").alias("home_rows"), n("pool").alias("pool"), n("pool", "home").alias("pool_home"), module("pool", "pool_by_module"),
        n("taken").alias("taken"), n("taken", "home").alias("taken_home"), n("taken", "graded").alias("taken_graded"), (n("taken") - n("taken", "strict")).alias("stand_ins"), module("taken", "taken_by_module"),
    ).withColumn("needed", F.least(F.lit(terms.home).cast("long"), F.lit(terms.target).cast("long"), F.col("pool_home")))
    names = F.array(*(F.lit(m) for m in terms.modules))

    def modules(of: str, condition) -> Column:
        return F.filter(names, lambda m, i: condition(F.get(F.col(of), i)))

    short = counts.withColumns({
        "missing": modules("taken_by_module", lambda k: k == 0), "underfilled": modules("taken_by_module", lambda k: k < terms.floor),
        "achievable": (F.col("pool") >= terms.fewest) & F.forall("pool_by_module", lambda k: k >= terms.floor),
    }).withColumn("out_of_pool", F.array_intersect("underfilled", modules("pool_by_module", lambda k: k < terms.floor)))
    near = (F.greatest("pool_home", "home_rows") > 0) & F.lit(not foreign)
    checks = (
        (near & (F.col("taken") == 0), "no-items"), (near & (F.col("taken_home") == 0), "no-home"), (near & (F.col("taken_home") < F.col("needed")), "few-home"),
        (F.col("taken_graded") < F.least(F.lit(terms.graded), F.col("taken")), "few-graded"), (~F.col("taken").between(terms.fewest, terms.most), "item-count"),
        (F.size("missing") > 0, "missing-module"), (F.size("underfilled") > 0, "underfilled-module"),
    )
    out = short.withColumn("codes", F.array_compact(F.array(*(F.when(bad, F.lit(code)) for bad, code in checks))))
    mild = F.size(F.array_except("codes", F.array(*(F.lit(c) for _, c in checks[4:])))) == 0
    allowed = F.lit(partial) & mild & F.col("taken").between(1, terms.most)
    return out.withColumn("status", F.when(F.size("codes") == 0, "whole").when(allowed, "partial").otherwise("refused"))
