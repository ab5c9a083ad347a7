"""Rows that tell of the same event: equal identities, alike titles, or titles that touch and alike facts.

Two rows are of one event if their identities are equal, if their titles' bigram sets overlap by LEAST (shared members by the
smaller set), or if the titles share TOUCH bigrams, both rows have LONG letters of facts and the facts' bigram sets overlap
by LEAST. Of a set of n bigrams the smaller side needs only its rarest n - ceil(LEAST * n) + 1 to meet a set that overlaps
enough; of titles that share TOUCH bigrams, all but the TOUCH - 1 most frequent. So the last rule can be asked of the facts
or of the titles: each row asks the index that answers it with fewer rows.

Rows with equal identity, title and facts are one class, named by its first row; pairs are between classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bigrams, blank, overlap
from .graph import Steps
from .greedy import led_groups
from .skew import by_key, celled

LEAST, TOUCH, LONG = 0.72, 2, 18
#: Words of 64 bits that a set is marked in.
MARKS = 4


def classes(rows: DataFrame, ord_: str = "ord", identity: str = "identity", title: str = "title", facts: str = "facts") -> tuple[DataFrame, DataFrame]:
    """(ord, class) of every row, and a row (o, identity, t, f, long) for each class: sets of bigrams of title and facts.

    facts is a text; nulls count as empty texts. Empty sets overlap with nothing; empty identities are equal like others.
    """
    own = rows.select(F.col(ord_).cast("long").alias("ord"), blank(identity).alias("identity"), blank(title).alias("title"), blank(facts).alias("facts"))
    keyed = own.withColumn("key", F.sha2(F.to_json(F.array("identity", "title", "facts")), 256))
    kinds = keyed.groupBy("key").agg(F.min("ord").alias("o"), F.first("identity").alias("identity"), F.first("title").alias("title"), F.first("facts").alias("facts"))
    members = by_key(keyed.select("ord", "key"), kinds.select("key", F.col("o").alias("class")), ["key"]).select("ord", "class")
    return members, kinds.select("o", "identity", bigrams("title").alias("t"), bigrams("facts").alias("f"), (F.length("facts") >= LONG).alias("long"))


def _marks(c: str) -> Column:
    """A set as MARKS words of 64 bits, each member a bit by its hash."""

    def word(k: int) -> Column:
        def put(acc: Column, g: Column) -> Column:
            place = F.pmod(F.xxhash64(g), F.lit(64 * MARKS))
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
            return F.when(F.floor(place / 64) == k, acc.bitwiseOR(bit)).otherwise(acc)

        return F.aggregate(c, F.lit(0).cast("long"), put)

    return F.struct(*(word(k).alias(f"w{k}") for k in range(MARKS)))


def _can_share(n: Column, own: str, other: str) -> Column:
    """No fewer than a set of n members shares with another, by their marks: a mark that the other lacks is a member that it lacks."""
    lacks = sum((F.bit_count(F.col(f"{own}.w{k}").bitwiseAND(F.bitwise_not(F.col(f"{other}.w{k}")))) for k in range(MARKS)), F.lit(0))
    return n - lacks


def _prefix(kind: str) -> Column:
    """How many of a set's rarest members have to meet the other set."""
    n = F.col("n")
    return n - F.ceil(n * LEAST).cast("int") + 1 if kind == "enough" else n - (TOUCH - 1)


def event_pairs(kinds: DataFrame) -> DataFrame:
    """(a, b, by_identity, by_title, by_facts) of classes a < b that are of one event.

    Keys that many classes have are dealt into cells of a grid (skew.celled), so no task gets all rows of a key. What meets
    under a bound by the sets' marks is verified on the sets. by_facts says whether the third rule holds, by_title the second.
    """
    with Steps(kinds.sparkSession) as steps:
        sets = steps.keep(kinds.withColumns({"tm": _marks("t"), "fm": _marks("f")}))
        able = F.col("long") & (F.size("t") >= TOUCH) & (F.size("f") > 0)
        index = steps.keep(
            sets.select("o", F.lit("i").alias("kind"), F.sha2("identity", 256).alias("g"), F.lit(1).alias("n"), F.lit(False).alias("able"))
            .unionByName(sets.select("o", F.lit("t").alias("kind"), F.explode("t").alias("g"), F.size("t").alias("n"), able.alias("able")))
            .unionByName(sets.where(able).select("o", F.lit("f").alias("kind"), F.explode("f").alias("g"), F.size("f").alias("n"), F.lit(True).alias("able")))
        )
        counts = index.groupBy("kind", "g").agg(F.count("*").alias("df"))
        # a row's own set has at most as many members as there are bigrams
        ranked = by_key(index.where("kind <> 'i'"), counts, ["kind", "g"]).groupBy("o", "kind", "n", "able").agg(F.array_sort(F.collect_list(F.struct("df", "g"))).alias("gs"))

        def asked(kind: str, prefix: str, arm: str) -> DataFrame:
            cut = F.slice("gs", F.lit(1), F.greatest(_prefix(prefix), F.lit(0)))
            out = ranked.where(F.col("kind") == kind).select("o", "kind", "able", cut.alias("gs"), F.lit(arm).alias("arm"))
            return out.withColumn("cost", F.aggregate("gs", F.lit(0).cast("long"), lambda a, x: a + x["df"]))

        alike = asked("t", "enough", "t")
        either = asked("f", "enough", "f").unionByName(asked("t", "touch", "f").where("able"))
        cheaper = either.groupBy("o").agg(F.min_by(F.struct("kind", "able", "gs", "arm"), F.struct("cost", "kind")).alias("x")).select("o", "x.*")
        probes = alike.drop("cost").unionByName(cheaper).select("o", "kind", "arm", F.explode("gs").alias("x")).select("o", "kind", "arm", F.col("x.g").alias("g"))
        probes = probes.unionByName(index.where("kind = 'i'").select("o", "kind", F.lit("i").alias("arm"), "g"))
        marked = sets.select("o", F.size("t").alias("nt"), F.size("f").alias("nf"), "tm", "fm")
        probes = steps.keep(probes.join(marked, "o"))
        entries = steps.keep(index.join(marked, "o").select(F.col("o").alias("q"), "kind", "g", F.col("able").alias("q_able"), *(F.col(c).alias(f"q_{c}") for c in ("nt", "nf", "tm", "fm"))))
        left, right = celled(probes, entries, ["kind", "g"], "o", "q")
        titles, facts = _can_share(F.col("nt"), "tm", "q_tm"), _can_share(F.col("nf"), "fm", "q_fm")
        alike_facts = F.col("q_able") & (F.col("q_nf") >= F.col("nf")) & (facts >= F.col("nf") * LEAST - 1e-9) & (titles >= TOUCH)
        fits = F.when(F.col("arm") == "f", alike_facts).when(F.col("arm") == "t", (F.col("q_nt") >= F.col("nt")) & (titles >= F.col("nt") * LEAST - 1e-9)).otherwise(True)
        met = left.join(right, ["kind", "g", "cell"]).where((F.col("o") != F.col("q")) & fits).select(F.least("o", "q").alias("a"), F.greatest("o", "q").alias("b")).distinct()
        one = lambda k: sets.select(F.col("o").alias(k), *(F.col(c).alias(f"{k}_{c}") for c in ("identity", "t", "f", "long")))
        both = by_key(by_key(steps.keep(met), one("a"), ["a"]), one("b"), ["b"])
        facts = F.col("a_long") & F.col("b_long") & (F.size(F.array_intersect("a_t", "b_t")) >= TOUCH) & (overlap(F.col("a_f"), F.col("b_f")) >= LEAST)
        judged = both.select("a", "b", (F.col("a_identity") == F.col("b_identity")).alias("by_identity"), (overlap(F.col("a_t"), F.col("b_t")) >= LEAST).alias("by_title"), facts.alias("by_facts"))
        return steps.result(judged.where("by_identity or by_title or by_facts"))


def one_of_each_event(rows: DataFrame, ord_: str = "ord", identity: str = "identity", title: str = "title", facts: str = "facts") -> DataFrame:
    """(ord, leader, n_rows): the row that stands for each row's event, itself if no earlier such row is of its event, and how many rows a leader stands for (0 for others).

    Rows are taken in order; one that is of an event with a row that was taken is left out. Equal rows have the same leader,
    as what one is paired with the other is; so classes are grouped and rows follow theirs. Empty tables give no rows.
    """
    members, kinds = classes(rows, ord_, identity, title, facts)
    led = led_groups(event_pairs(kinds)).select(F.col("o").alias("class"), "group")
    of_class = members.select("class").distinct().join(led, "class", "left").select("class", F.coalesce("group", "class").alias("leader"))
    out = by_key(members, of_class, ["class"])
    n = out.groupBy("leader").agg(F.count("*").alias("n")).select(F.col("leader").alias("ord"), "n")
    return out.join(n, "ord", "left").select("ord", "leader", F.coalesce("n", F.lit(0)).alias("n_rows"))
