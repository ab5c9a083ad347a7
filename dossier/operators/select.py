"""Selections in a stated order: round robin, caps, floors and fills, joint quotas, batches and byte packing.

Ranks within groups use windows over the group; where only the first few of each group count, Spark keeps just these before
the shuffle. A selection under joint quotas depends on every earlier choice; it goes over bounded stretches of the rows that
can still be taken, and then gives all rows their reason in one join.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

ORD = "ord"
#: Rows that a round of joint quotas reads at least.
STRETCH = 1000


def ranked(df: DataFrame, group: str, *order: Column, name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order)))


def cap(df: DataFrame, group: str, limit: int, *order: Column) -> DataFrame:
    """The first rows of each group."""
    return ranked(df, group, *order, name="_r").where(F.col("_r") <= limit).drop("_r")


def cap_where(df: DataFrame, condition: Column, group: str, limit: int, *order: Column) -> DataFrame:
    """All rows, but of those that meet the condition only the first of each group."""
    fits = F.coalesce(condition, F.lit(False))
    return df.where(~fits).unionByName(cap(df.where(fits), group, limit, *order))


def round_robin(df: DataFrame, group: str, limit: int, ord_: str = ORD) -> DataFrame:
    """One row of each group in turn, groups in the order they first appear, until there are limit; `turn` numbers them from 1."""
    few = cap(df, group, limit, F.col(ord_))
    out = ranked(few, group, F.col(ord_), name="_round").withColumn("_first", F.min(ord_).over(Window.partitionBy(group)))
    top = out.orderBy("_round", "_first", ord_).limit(limit)
    return top.withColumn("turn", F.row_number().over(Window.orderBy("_round", "_first", ord_))).drop("_round", "_first")  # limit rows


def floor_then_fill(df: DataFrame, group: str, floor: int, limit: int, *order: Column, most: int | None = None, group_order: Column | None = None) -> DataFrame:
    """The first `floor` rows of each group, group by group in each round, then the best of the rest, never more than `most` of a group; `turn` numbers them.

    Keys have to be unique among the rows, since a row's rank decides alone.
    """
    out = ranked(df, group, *order, name="_r").where(F.col("_r") <= min(limit, most or limit))
    inside = F.col("_r") <= floor
    phase = F.struct(F.when(inside, F.col("_r")).otherwise(floor + 1).alias("round"), *([F.when(inside, group_order).alias("g")] if group_order is not None else []), *_keys(order))
    top = out.withColumn("_phase", phase).orderBy("_phase").limit(limit)
    return top.withColumn("turn", F.row_number().over(Window.orderBy("_phase"))).drop("_r", "_phase")  # limit rows


def _keys(order: tuple[Column, ...]) -> list[Column]:
    return [c.alias(f"o{i}") for i, c in enumerate(order)]


def leaders(df: DataFrame, group: str, limit: int, *order: Column) -> DataFrame:
    """The first row of each group, then the best of all others."""
    return floor_then_fill(df, group, 1, limit, *order)


def top_up(df: DataFrame, group: str, have: DataFrame, target: int, *order: Column) -> DataFrame:
    """For each group as many rows as `have` (group, n) is short of target."""
    out = ranked(df, group, *order, name="_r").join(have, group, "left")
    return out.where(F.col("_r") <= target - F.coalesce(F.col("n"), F.lit(0))).drop("_r", "n")


def joint_quota(df: DataFrame, caps: dict[str, int], total: int, ord_: str = ORD, unique: str | None = None) -> DataFrame:
    """`reason` of each row in order, null if it is taken: `total`, `duplicate` or `<column>-capacity`, whichever holds first.

    A row that is turned down uses no quota; a null is a value like any other. Rows are taken in rounds, here and now:
    each one reads the next STRETCH rows whose values still have quota. What was taken, `total` rows at most, then gives
    every row its reason: the places in order at which the total and each value ran full are joined with all rows. Rounds
    read df again, so persist what is dear.
    """
    df = df.drop("reason")
    keys = list(dict.fromkeys([ord_, *caps, *([unique] if unique is not None else [])]))
    place = F.struct(F.col(ord_).isNull().alias("last"), *(F.col(k) for k in keys))
    taken = _taken(df.select(*keys), place, caps, total, ord_, unique)
    fields = [df.schema[k] for k in keys]

    def full(name: str, at: dict) -> DataFrame:
        """The place at which each of these values was used up."""
        schema = StructType([StructField("_value", df.schema[name].dataType), *(StructField(f"_k{i}", f.dataType) for i, f in enumerate(fields))])
        return F.broadcast(df.sparkSession.createDataFrame([(v, *row) for v, row in at.items()], schema))

    def behind(joined: DataFrame, at: DataFrame, name: str, flag: str) -> DataFrame:
        here = F.struct(F.col(f"_k{keys.index(ord_)}").isNull().alias("last"), *(F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)))
        both = joined.join(at, joined[name].eqNullSafe(at["_value"]), "left")
        return both.withColumn(flag, F.coalesce(F.col("_there") & (place >= here), F.lit(False))).drop("_value", "_there", *(f"_k{i}" for i in range(len(keys))))

    out, why = df, [(F.lit(total <= 0), "total")]
    if 0 < total <= len(taken):
        end = F.struct(F.lit(taken[-1][keys.index(ord_)] is None).alias("last"), *(F.lit(v).cast(f.dataType).alias(k) for k, v, f in zip(keys, taken[-1], fields, strict=True)))
        why.append((place >= end, "total"))
    rules = [("duplicate", unique, 1)] if unique is not None else []
    for i, (reason, name, most) in enumerate([*rules, *((f"{c}-capacity", c, n) for c, n in caps.items())]):
        used: dict = {}
        for row in taken:
            used.setdefault(row[keys.index(name)], []).append(row)
        out = behind(out, full(name, {v: rows[most - 1] for v, rows in used.items() if len(rows) >= most > 0}).withColumn("_there", F.lit(True)), name, f"_full{i}")
        why.append((F.col(f"_full{i}") | F.lit(most <= 0), reason))
    reason = F.coalesce(*(F.when(c, F.lit(r)) for c, r in why))
    # rows in the place of a taken one: as many copies as were taken are taken
    n = [(*row, k) for row, k in Counter(taken).items()]
    won = df.sparkSession.createDataFrame(n, StructType([*(StructField(f"_k{i}", f.dataType) for i, f in enumerate(fields)), StructField("_n", IntegerType())]))
    same = reduce(lambda a, b: a & b, (out[k].eqNullSafe(won[f"_k{i}"]) for i, k in enumerate(keys)))
    out = out.withColumn("reason", reason).join(F.broadcast(won), same, "left")
    hit = out.where("_n is not null").withColumn("_r", F.row_number().over(Window.partitionBy(*(f"_k{i}" for i in range(len(keys)))).orderBy(F.lit(0))))
    hit = hit.withColumn("reason", F.when(F.col("_r") > F.col("_n"), F.col("reason")))
    return out.where("_n is null").select(*df.columns, "reason").unionByName(hit.select(*df.columns, "reason"))


def _taken(df: DataFrame, place: Column, caps: dict[str, int], total: int, ord_: str, unique: str | None) -> list[tuple]:
    """The rows that joint quotas take, in order."""
    size, spark = max(STRETCH, 2 * total), df.sparkSession
    limits = ({unique: 1} if unique is not None else {}, caps)
    used: Counter = Counter()
    taken: list[tuple] = []
    if any(n <= 0 for n in caps.values()):
        return taken
    last, again = None, 0
    while len(taken) < total:
        rest = df
        for kind, each in enumerate(limits):
            for c, n in each.items():
                gone = [(v,) for (k, name, v), m in used.items() if (k, name) == (kind, c) and m >= n]
                if gone:
                    full = spark.createDataFrame(gone, StructType([StructField("_value", df.schema[c].dataType)]))
                    rest = rest.join(F.broadcast(full), rest[c].eqNullSafe(full["_value"]), "left_anti")
        if last is not None:
            begin = F.struct(F.lit(last[df.columns.index(ord_)] is None).alias("last"), *(F.lit(v).cast(df.schema[k].dataType).alias(k) for k, v in zip(df.columns, last, strict=True)))
            rest = rest.where(place >= begin)
        rows = [tuple(r) for r in rest.orderBy(place).limit(size).collect()]  # size rows
        new = [r for i, r in enumerate(rows) if i >= again or r != last]  # copies of the last row come again
        for row in new:
            names = [(kind, c, row[df.columns.index(c)]) for kind, each in enumerate(limits) for c in each]
            if len(taken) < total and all(used[k] < limits[k[0]][k[1]] for k in names):
                taken.append(row)
                used.update(names)
        if len(rows) < size:
            break
        last = rows[-1]
        again = taken.count(last)  # if its values still have quota, all its copies so far were taken
    return taken


def phases(frames: list[DataFrame], key: str, budget: int, ord_: str = ORD) -> DataFrame:
    """Selections one after the other under one budget: a key counts in its first phase; `phase` tells which."""
    both = frames[0].withColumn("phase", F.lit(0))
    for i, f in enumerate(frames[1:], 1):
        both = both.unionByName(f.withColumn("phase", F.lit(i)), allowMissingColumns=True)
    first = both.groupBy(key).agg(F.min_by(F.struct(*both.columns), F.struct("phase", ord_)).alias("r")).select("r.*")
    return first.orderBy("phase", ord_).limit(budget)


def batches(df: DataFrame, size: int, group: str, *order: Column) -> DataFrame:
    """`batch` numbers runs of so many rows in each group, from 0."""
    return ranked(df, group, *order, name="_r").withColumn("batch", F.floor((F.col("_r") - 1) / size).cast("int")).drop("_r")


def running_number(df: DataFrame, group: str, *order: Column) -> DataFrame:
    return ranked(df, group, *order, name="number")


def byte_chunks(parts: Column, limit: int, separator: str = "\n\n") -> Column:
    """Neighbouring texts joined as long as they stay within limit UTF-8 bytes; a longer one stands by itself."""
    sep = F.octet_length(F.lit(separator))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def step(a: Column, x: Column) -> Column:
        fits = F.octet_length(a["open"]) + sep + F.octet_length(x) <= limit
        return (
            F.when(a["open"].isNull(), F.struct(a["done"].alias("done"), x.alias("open")))
            .when(fits, F.struct(a["done"].alias("done"), F.concat(a["open"], F.lit(separator), x).alias("open")))
            .otherwise(F.struct(F.concat(a["done"], F.array(a["open"])).alias("done"), x.alias("open")))
        )

    return F.aggregate(parts, start, step, lambda a: F.when(a["open"].isNull(), a["done"]).otherwise(F.concat(a["done"], F.array(a["open"]))))


def fitting(versions: list[Column], limit: int) -> Column:
    """The first of these texts, longest first, that stays within limit bytes; null if none does."""
    return F.coalesce(*(F.when(F.octet_length(v) <= limit, v) for v in versions))


def quota_swap(df: DataFrame, wanted: Column, quota: int, limit: int, *order: Column) -> DataFrame:
    """The best limit rows with at least quota wanted ones among them, as far as there are any."""
    fits = F.coalesce(wanted, F.lit(False))
    head = df.where(fits).orderBy(*order).limit(min(quota, limit)).withColumn("_must", F.lit(1))
    rest = df.withColumn("_must", F.lit(0))
    best = head.unionByName(rest).groupBy(*df.columns).agg(F.max("_must").alias("_must"))
    return best.orderBy(F.desc("_must"), *order).limit(limit).drop("_must")


def widths(df: DataFrame, message: str, limit: int, sizes: tuple[str, str, str], *order: Column, base: int = 0, each: bool = True) -> DataFrame:
    """df with `width` (full, compact, minimal), `bytes` of the whole message and `fits`: how wide each item of a message can be rendered.

    sizes are columns of an item's bytes at the three widths, base what a message takes besides. Items become compact one
    after the other in the given order, which names those first that matter least, until the message fits; with `each`
    False all at once. If that isn't enough all become minimal, and where even that is too much, fits is false. Order ties
    are broken by nothing: give an order without. A null size counts as 0.

    No message is rendered to be measured: running sums of what compact items save tell which is the last one to shrink.
    """
    full, compact, minimal = (F.coalesce(F.col(c), F.lit(0)).cast("long") for c in sizes)
    whole = Window.partitionBy(message)
    before = whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumns({"_full": F.sum(full).over(whole) + base, "_saves": full - compact, "_least": F.sum(minimal).over(whole) + base})
    out = out.withColumn("_saved", F.coalesce(F.sum("_saves").over(before), F.lit(0)))
    # savings may be negative for an item, so the message fits from the first place on where it does, not from the last
    need = F.max(F.when(F.col("_full") - F.col("_saved") <= limit, 1).otherwise(0)).over(whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)) == 0
    shrunk = need if each else F.col("_full") > limit
    out = out.withColumn("_shrunk", shrunk)
    reached = F.col("_full") - F.sum(F.when(F.col("_shrunk"), F.col("_saves")).otherwise(0)).over(whole)
    out = out.withColumn("_bytes", reached)
    width = F.when(F.col("_bytes") > limit, "minimal").when(F.col("_shrunk"), "compact").otherwise("full")
    out = out.withColumns({"width": width, "bytes": F.when(F.col("_bytes") > limit, F.col("_least")).otherwise(F.col("_bytes"))})
    return out.withColumn("fits", F.col("bytes") <= limit).drop("_full", "_saves", "_least", "_saved", "_shrunk", "_bytes")
