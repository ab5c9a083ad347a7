"""Same-event grouping: pairs by shared anchors or bigrams through equality joins, then the order-dependent grouping.

Pairs of rows come from equal keys, so nothing is compared with everything. Groups follow the input order and never
merge; they are found in rounds of joins (greedy.py).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bigrams, let, letters, overlap
from .greedy import joined_groups, led_groups

TIERS = ["primary", "first_party", "secondary", "lead_only"]
#: Fixed value: endings a company's name is known without.
PARTY_SUFFIX = r"(?:有限责任公司|股份有限公司|有限公司|公司)$"
PARTY_NOISE = r"化妆品|母公司|主体|品牌|公司|股份|有限"


def party_core(c: Column) -> Column:
    return F.regexp_replace(c, PARTY_SUFFIX, "")


#: Letters of a run that two names have to share, and those of it that must not be noise.
SEGMENT, LEAST = 8, 4


def _cuts(c: Column, n: int) -> Column:
    """All distinct runs of n letters; none where there are fewer."""
    at = F.sequence(F.lit(1), F.greatest(F.length(c) - (n - 1), F.lit(1)))
    return F.array_distinct(F.when(F.length(c) >= n, F.transform(at, lambda i: F.substr(c, i, F.lit(n)))).otherwise(F.array().cast("array<string>")))


def parties_meet(a: Column, b: Column, segment: int = SEGMENT, least: int = LEAST) -> Column:
    """Whether two normalised names are the same but for a suffix, one holds the other, or they share a telling run of letters."""

    def meet(short: Column, long_: Column) -> Column:
        inside = (F.length(short) >= least) & F.contains(long_, short)
        n = F.length(short) - segment + 1
        cuts = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substr(short, i, F.lit(segment)))
        shared = (n > 0) & F.exists(cuts, lambda s: (F.length(F.regexp_replace(s, PARTY_NOISE, "")) >= least) & F.contains(long_, s))
        return inside | shared

    def by_length(x: Column, y: Column) -> Column:
        first = F.length(x) <= F.length(y)
        return let(F.when(first, x).otherwise(y), lambda s: let(F.when(first, y).otherwise(x), lambda t: meet(s, t)))

    return (a == b) | let(party_core(a), lambda x: let(party_core(b), lambda y: by_length(x, y)))


def names_to_compare(named: DataFrame) -> DataFrame:
    """(a, b, kind, x, y) of names in (o, kind, v) that may be of one event.

    Equal has to be a telling run of SEGMENT letters, or, where one name holds the other, the shorter one's first run: of
    SEGMENT letters, or of LEAST where it is shorter than that.
    """
    named = named.where(F.col("kind").isin("parties", "products_or_batches")).withColumn("c", F.when(F.col("kind") == "parties", party_core(F.col("v"))).otherwise(F.col("v"))).where(F.length("c") >= LEAST)
    runs = named.select("o", "kind", "v", "c", F.explode(_cuts(F.col("c"), SEGMENT)).alias("g"))
    telling = (F.col("kind") == "parties") & (F.length(F.regexp_replace("g", PARTY_NOISE, "")) >= LEAST)
    own = runs.where(telling).select("o", "kind", "v", "g")
    first = runs.where(~telling & (F.col("g") == F.substr("c", F.lit(1), F.lit(SEGMENT)))).select("o", "kind", "v", "g")
    short = named.where(F.length("c") < SEGMENT).select("o", "kind", "v", F.substr("c", F.lit(1), F.lit(LEAST)).alias("g"))
    within = named.select("o", "kind", "v", F.explode(_cuts(F.col("c"), LEAST)).alias("g"))

    def meet(left: DataFrame, right: DataFrame, ordered: bool) -> DataFrame:
        side = F.col("l.o") < F.col("r.o") if ordered else F.col("l.o") != F.col("r.o")
        both = left.alias("l").join(right.alias("r"), (F.col("l.kind") == F.col("r.kind")) & (F.col("l.g") == F.col("r.g")) & side)
        return both.select(F.least("l.o", "r.o").alias("a"), F.greatest("l.o", "r.o").alias("b"), F.col("l.kind").alias("kind"), F.col("l.v").alias("x"), F.col("r.v").alias("y"))

    return meet(own, own, True).unionByName(meet(first, runs.where(~telling).select("o", "kind", "v", "g"), False)).unionByName(meet(short, within, False)).distinct()


def anchor_pairs(rows: DataFrame, ord_: str = "ord", anchors: str = "anchors") -> DataFrame:
    """(a, b, kinds) of rows a < b that share anchors: equal values, and for parties and products names that hold each other.

    Names meet by equality before they are compared: two that share a telling run of letters on that run, and one that
    holds another on the shorter one's first run. Short runs, which many names have, are asked for by short names only.
    """
    long_ = rows.select(F.col(ord_).alias("o"), F.explode(anchors).alias("kind", "vs")).select("o", "kind", F.explode("vs").alias("v"))
    equal = long_.alias("l").join(long_.alias("r"), (F.col("l.kind") == F.col("r.kind")) & (F.col("l.v") == F.col("r.v")) & (F.col("l.o") < F.col("r.o")))
    exact = equal.select(F.col("l.o").alias("a"), F.col("r.o").alias("b"), F.col("l.kind").alias("kind"))
    met = names_to_compare(long_)
    fuzzy = met.where(F.when(F.col("kind") == "parties", parties_meet(F.col("x"), F.col("y"))).otherwise(F.contains("x", F.col("y")) | F.contains("y", F.col("x"))))
    return exact.unionByName(fuzzy.select("a", "b", "kind")).groupBy("a", "b").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))


def same_event_pairs(rows: DataFrame, ord_: str = "ord", anchors: str = "anchors") -> DataFrame:
    """Pairs of one event: a shared document number or two shared kinds; never with parties on both sides that don't meet."""
    has = rows.select(F.col(ord_).alias("o"), (F.size(F.try_element_at(F.col(anchors), F.lit("parties"))) > 0).alias("p"))
    pairs = anchor_pairs(rows, ord_, anchors).join(has.withColumnRenamed("o", "a").withColumnRenamed("p", "pa"), "a").join(has.withColumnRenamed("o", "b").withColumnRenamed("p", "pb"), "b")
    veto = F.col("pa") & F.col("pb") & ~F.array_contains("kinds", "parties")
    return pairs.where(~F.coalesce(veto, F.lit(False)) & (F.array_contains("kinds", "document_numbers") | (F.size("kinds") >= 2))).select("a", "b", "kinds")


def greedy_groups(rows: DataFrame, pairs: DataFrame, ord_: str = "ord", leaders: bool = False) -> DataFrame:
    """(ord, group): each row in order joins the first group that holds a row it is paired with, else begins one.

    A group is named by its first row. With leaders only a group's first row counts, and `group` differs from `ord` for
    rows that a leader stands for. pairs (a, b) may repeat, run either way and join a row with itself.
    """
    folded = (led_groups if leaders else joined_groups)(pairs)
    out = rows.select(F.col(ord_).cast("long").alias("o")).join(folded, "o", "left")
    return out.select(F.col("o").alias("ord"), F.coalesce("group", "o").alias("group"))


def overlap_pairs(rows: DataFrame, text: str, ord_: str = "ord", least: float = 0.72) -> DataFrame:
    """(a, b, overlap) of rows whose bigram sets overlap enough, found over shared bigrams.

    The overlap coefficient sets shared pairs against the smaller set, so of each set only its rarest size - ceil(least *
    size) + 1 bigrams need to meet all bigrams of a set that is no smaller (prefix filter).
    """
    sets = rows.select(F.col(ord_).alias("o"), bigrams(text).alias("s")).where(F.size("s") > 0)
    long_ = sets.select("o", F.size("s").alias("n"), F.explode("s").alias("g"))
    counts = long_.groupBy("g").agg(F.count("*").alias("df"))
    ranked = long_.join(counts, "g").groupBy("o", "n").agg(F.array_sort(F.collect_list(F.struct("df", "g"))).alias("gs"))
    prefix = ranked.select("o", "n", F.explode(F.slice("gs", F.lit(1), F.col("n") - F.ceil(F.col("n") * least).cast("int") + 1)).alias("x")).select("o", "n", "x.g")
    met = prefix.alias("p").join(long_.alias("q"), (F.col("p.g") == F.col("q.g")) & (F.col("p.o") != F.col("q.o")) & ((F.col("p.n") < F.col("q.n")) | ((F.col("p.n") == F.col("q.n")))))
    pairs = met.select(F.least("p.o", "q.o").alias("a"), F.greatest("p.o", "q.o").alias("b")).distinct()
    both = pairs.join(sets.select(F.col("o").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("o").alias("b"), F.col("s").alias("y")), "b")
    return both.withColumn("overlap", overlap(F.col("x"), F.col("y"))).where(F.col("overlap") >= least).select("a", "b", "overlap")


def packages(rows: DataFrame, groups: DataFrame, ord_: str = "ord") -> DataFrame:
    """One row for each event: its canonical row, independent sources, agreed anchors, conflicts, status and grade.

    rows: ord, host, tier, evidence_grade, body, anchors. Sources are independent if neither host nor opening text repeats.
    The first two agree on the kinds they share; unlike document numbers or amounts are conflicts.
    """
    kinds = ["parties", "document_numbers", "amounts", "products_or_batches", "dates", "dispositions"]
    rank = F.array_position(F.array(*map(F.lit, TIERS)), F.col("tier"))
    joined = rows.join(groups.withColumnRenamed("ord", "_o"), rows[ord_] == F.col("_o"))
    joined = joined.withColumn("sig", F.substring(letters("body"), 1, 500)).withColumn("rank", F.struct(rank.alias("r"), F.col(ord_).alias("o")))
    # the first of each host and of each opening text among the event's rows, in rank order
    hosts = joined.groupBy("group", "host").agg(F.min("rank").alias("h"))
    sigs = joined.groupBy("group", "sig").agg(F.min("rank").alias("s"))
    marked = joined.join(hosts, ["group", "host"]).join(sigs, ["group", "sig"])
    free = (F.col("tier") != "lead_only") & (F.col("rank") == F.col("h")) & ((F.col("sig") == "") | (F.col("rank") == F.col("s")))
    verified = F.col("tier").isin("primary", "first_party") & (F.col("evidence_grade") == "hard_fact_ready")
    cell = F.struct("rank", F.col(ord_).alias("ord"), "host", "tier", "anchors")
    own = marked.groupBy("group").agg(
        F.count("*").alias("n_rows"),
        F.min("rank").alias("first"),
        F.min(F.when(verified, F.col("rank"))).alias("primary"),
        F.count(F.when(free, 1)).alias("n_sources"),
        F.min_by(F.when(free, cell), F.when(free, F.col("rank"))).alias("x"),
        F.sort_array(F.collect_set(F.when(free, F.col("host")))).alias("hosts"),
    )
    second = marked.where(free).join(own.select("group", F.col("x.rank").alias("xr")), "group").where(F.col("rank") > F.col("xr")).groupBy("group").agg(F.min_by(cell, "rank").alias("y"))
    both = own.join(second, "group", "left")

    def values(side: str, kind: str) -> Column:
        return F.coalesce(F.try_element_at(F.col(f"{side}.anchors"), F.lit(kind)), F.array().cast("array<string>"))

    def meet(kind: str) -> Column:
        same = F.arrays_overlap(values("x", kind), values("y", kind))
        if kind == "parties":
            return same | F.exists(values("x", kind), lambda a: F.exists(values("y", kind), lambda b: parties_meet(a, b)))
        return same

    two = F.col("n_sources") >= 2
    agreed = F.when(two, F.array_compact(F.array(*(F.when(meet(k), F.lit(k)) for k in [*kinds, "event_outcomes"])))).otherwise(F.array().cast("array<string>"))
    against = F.when(two, F.array_compact(F.array(*(F.when((F.size(values("x", k)) > 0) & (F.size(values("y", k)) > 0) & ~F.arrays_overlap(values("x", k), values("y", k)), F.lit(k)) for k in ("document_numbers", "amounts"))))).otherwise(F.array().cast("array<string>"))
    out = both.withColumn("agreed_anchors", agreed).withColumn("conflicts", against)
    told = two & (F.size("conflicts") == 0) & (F.size("agreed_anchors") >= 2) & F.exists("agreed_anchors", lambda k: k.isin(kinds))
    status = F.when(F.col("primary").isNotNull(), "primary_verified").when(told, "corroborated").otherwise("unverified")
    grade = F.when(F.col("primary").isNotNull(), "hard_fact_ready").when(told, "corroborated_fact_ready").otherwise("lead_only")
    return out.select("group", "n_rows", "n_sources", "hosts", F.coalesce("primary.o", "x.ord", "first.o").alias("canonical_ord"), "agreed_anchors", "conflicts", status.alias("verification_status"), grade.alias("evidence_grade"))
