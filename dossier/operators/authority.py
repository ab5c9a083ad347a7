"""From leads to authorities: searches for the original behind a report, hop by hop, under budgets.

A hop is one Spark job: what isn't an authority yet asks its queries, what was asked before is left out by an anti-join, and
budgets of seeds and hosts are ranks that Spark cuts before it shuffles. Nothing but the number of new leads reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.text import blank, let, squeeze
from .gates import RESOLVED_TRUST, authority_trust
from .graph import Steps

# --- Fixed values: words of queries and patterns of tokens -----------------------------------------------------------

ANCHORS = {
    "广告合规及处罚案例": "行政处罚决定书 化妆品 市场监督管理局 site:gov.cn",
    "知识产权动态": "化妆品 商标 侵权 判决 国家知识产权局 法院 site:gov.cn",
    "新规及案例动态": "化妆品 公告 征求意见 国家药监局 site:gov.cn",
    "产品质量/召回与安全风险": "化妆品 不符合规定 召回 通告 药品监督管理局 site:gov.cn",
    "进出口动态": "进口 化妆品 海关 公告 site:customs.gov.cn",
    "美妆动态": "美妆 化妆品 商家 平台规则 公告 淘宝 天猫 京东 抖音电商",
}
TOPICS = {
    "(?i)处罚|罚款|刷单|违法|侵权|商标": "行政处罚决定书 市场监督管理局 site:gov.cn",
    "(?i)标准|办法|征求意见|法规|规定|公告": "征求意见稿 国家药监局 国家市场监督管理总局 site:gov.cn",
    r"(?i)海关|进口|出口|HS\s*编码|清关|报关": "海关总署 进口化妆品 公告 site:customs.gov.cn",
}
OTHERWISE = "化妆品 监管 公告 site:gov.cn"
TOKENS = [
    "[A-Z][A-Z0-9-]{2,}",
    "[一-龥A-Za-z0-9-]{2,}(?:商标|标准|办法|征求意见稿|行政处罚|刷单|爱马仕|玻色因|化妆品)",
    r"[0-9]+(?:\.[0-9]+)?\s*(?:万|亿)?元|[0-9]+(?:,[0-9]{3})*\s*(?:盒|件|单)",
]
UNKNOWN_PLACE = "^(?:未知|不详|不明|全球)$"
HOME_REGION, HOME = "亚洲", "中国"

# --- End of fixed values ----------------------------------------------------------------------------------------------

#: What a lead or a result has; columns that a frame doesn't have count as empty.
LEAD = ("title", "url", "source_name", "source_type", "authority_type", "source_scope", "module", "country", "region", "snippet", "article_text")

#: A host's queries are first cut in so many shares.
SHARES = 32


def known_place(c: Column | str) -> Column:
    """The place, or an empty string where it isn't known."""
    return F.regexp_replace(squeeze(c), UNKNOWN_PLACE, "")


def tokens(title: Column | str, snippet: Column | str, body: Column | str) -> Column:
    """Up to ten distinct names, terms and amounts of a lead, pattern by pattern, in the order of its text."""
    whole = F.concat(squeeze(title), F.lit(" "), squeeze(snippet), F.lit(" "), squeeze(body))
    found = let(whole, lambda s: F.concat(*(F.regexp_extract_all(s, F.lit(p), F.lit(0)) for p in TOKENS)))
    return F.slice(F.array_distinct(F.filter(F.transform(found, squeeze), lambda t: t != "")), 1, 10)


def queries(title: Column | str, snippet: Column | str, body: Column | str, module: Column | str) -> Column:
    """The distinct searches for a lead's original: its title and tokens, with each of the anchors that its module and its words call for."""
    core = F.array_join(F.filter(F.concat(F.array(squeeze(title)), tokens(title, snippet, body)), lambda t: t != ""), " ")
    own = reduce(lambda rest, m: F.when(squeeze(module) == m, F.lit(ANCHORS[m])).otherwise(rest), ANCHORS, F.lit(None).cast("string"))

    def of(text: Column) -> Column:
        anchors = F.array_compact(F.array(own, *(F.when(text.rlike(p), F.lit(a)) for p, a in TOPICS.items())))
        some = F.when(F.size(anchors) > 0, anchors).otherwise(F.array(F.lit(OTHERWISE)))
        return F.array_distinct(F.transform(some, lambda a: squeeze(F.concat(text, F.lit(" "), a))))

    return let(core, of)


def _whole(leads: DataFrame) -> DataFrame:
    return leads.withColumns({c: F.lit("") for c in LEAD if c not in leads.columns})


def tasks(leads: DataFrame) -> DataFrame:
    """Leads that are no authority themselves, with their queries."""
    trust = authority_trust("source_name", "url", "source_type", "authority_type", "source_scope")
    only = _whole(leads).where(trust["level"] == "lead_only")
    return only.withColumn("queries", queries("title", "snippet", "article_text", "module"))


def search_rows(leads: DataFrame, limit: int = 24, ord_: str = "ord") -> DataFrame:
    """One round's searches: the first query of the first leads, then one of each module, `limit` in all (columns query, module,
    region, country, lead_url, lead_title and place, from 0). A limit below the number of modules goes to the leads alone, if there are any.

    Ties in `ord` go by address and query. The result is bounded by the limit.
    """
    first = tasks(leads).select(
        F.get("queries", F.lit(0)).alias("query"), squeeze("module").alias("module"), F.coalesce(F.nullif(squeeze("region"), F.lit("")), F.lit(HOME_REGION)).alias("region"),
        F.coalesce(F.nullif(squeeze("country"), F.lit("")), F.lit(HOME)).alias("country"), squeeze("url").alias("lead_url"), squeeze("title").alias("lead_title"), F.lit(0).alias("_part"), F.col(ord_).cast("long").alias("_at"),
    )
    some = 0 < limit < len(ANCHORS) and not first.isEmpty()
    n_modules = 0 if some else min(len(ANCHORS), max(0, limit))
    taken = first.orderBy("_at", "lead_url", "query").limit(max(0, limit) - n_modules)
    rows = [(q, m, HOME_REGION, HOME, "", "", 1, i) for i, (m, q) in enumerate(list(ANCHORS.items())[:n_modules])]
    both = taken.unionByName(leads.sparkSession.createDataFrame(rows, taken.schema))
    return both.withColumn("place", F.row_number().over(Window.orderBy("_part", "_at", "lead_url", "query")) - 1).drop("_part", "_at")


def provenance(found: DataFrame, asked: DataFrame) -> DataFrame:
    """Authorities among what searches found (column query), with the lead they stand for: module, place, lead_url and lead_title of their search.

    asked has one row for each query; a result of no known query keeps its own module and has no lead.
    """
    trust = authority_trust("source_name", "url", "source_type", "authority_type", "source_scope")
    level = _whole(found).withColumn("_trust", trust).where(F.col("_trust.level").isin(RESOLVED_TRUST))
    by = asked.select(squeeze("query").alias("_query"), *(F.col(c).alias(f"_{c}") for c in ("module", "region", "country", "lead_url", "lead_title")))
    joined = level.join(by, squeeze(level["query"]) == by["_query"], "left")
    place = lambda c, other: F.coalesce(F.nullif(known_place(c), F.lit("")), F.nullif(known_place(f"_{c}"), F.lit("")), F.lit(other))
    out = joined.withColumns({
        "module": F.coalesce(F.nullif(squeeze("_module"), F.lit("")), squeeze("module")), "region": place("region", HOME_REGION), "country": place("country", HOME),
        "lead_url": squeeze("_lead_url"), "lead_title": squeeze("_lead_title"), "trust_level": F.col("_trust.level"), "trust_reason": F.col("_trust.reason"), "source_scope": F.lit("discovered_article"), "source_type": F.lit("official_site"),
        "authority_type": F.when(F.col("_trust.level") == "official_first_party", "official").otherwise("regulator"), "source_name": squeeze("source_name"),
    })
    return out.drop("_trust", *by.columns)


def hops(leads: DataFrame, search: Callable[[DataFrame], DataFrame], most: int = 3, per_seed: int = 6, per_host: int = 1000, per_query: int = 4, ord_: str = "ord") -> tuple[DataFrame, DataFrame]:
    """(found, asked): authorities behind leads, after at most `most` hops; asked is every search with its hop.

    search takes rows (query, hop) and gives rows with query, position and the columns of LEAD; the first `per_query` of each
    query count. Results that are leads themselves and whose address wasn't met before are the next hop's leads, of the seed whose query found them; it ends without new leads. Each
    query is asked once, by its first lead. A seed asks at most `per_seed` queries and a host (of the lead that asks) at most
    `per_host`, over all hops, first come first. Of a hop, the seed's budget is spent first: what it refuses doesn't count for
    the host, what the host refuses counts for the seed in that hop only.

    Order: the seed's `ord` (unique), then the lead's address, then the query's place. Leads of one address count as one, the
    first; leads without an address are kept apart by their `ord`. An empty table gives two empty ones.
    """
    key = lambda: F.coalesce(F.nullif(F.lower(squeeze("url")), F.lit("")), F.concat(F.lit("#"), F.col("seed").cast("string")))
    with Steps(leads.sparkSession) as steps:
        texts = _whole(leads).select(F.col(ord_).cast("long").alias("seed"), *(blank(c).alias(c) for c in LEAD)).withColumn("_key", key())
        row = F.struct("seed", *LEAD)
        frontier = steps.keep(texts.groupBy("_key").agg(F.min_by(row, "seed").alias("r")).select("_key", "r.*"))
        met, asked, results = frontier.select("_key"), [], []
        for hop in range(1, most + 1):
            new = tasks(frontier).select("seed", "_key", "module", "region", "country", F.col("url").alias("lead_url"), F.col("title").alias("lead_title"), F.posexplode("queries").alias("_n", "query"))
            place = F.struct("seed", "_key", "_n")
            one = new.groupBy("query").agg(F.min_by(F.struct(*(c for c in new.columns if c != "query")), place).alias("r")).select("query", "r.*").withColumn("host", urls.host("lead_url"))
            if asked:
                one = one.join(reduce(DataFrame.union, [a.select("query") for a in asked]), "query", "left_anti")
            for by, budget in (("seed", per_seed), ("host", per_host)):
                # a host may have a third of all leads: its shares are cut first, so that what meets in one task is their budgets
                for keys in ((by, F.pmod(F.xxhash64("_key"), F.lit(SHARES))), (by,)) if by == "host" else ((by,),):
                    one = one.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy("seed", "_key", "_n"))).where(F.col("_rank") <= budget)
                if asked:
                    used = reduce(DataFrame.union, [a.select(by) for a in asked]).groupBy(by).agg(F.count("*").alias("_used"))
                    one = one.join(used, by, "left").where(F.col("_rank") + F.coalesce("_used", F.lit(0)) <= budget).drop("_used")
            now = steps.keep(one.select("query", "seed", "host", "module", "region", "country", "lead_url", "lead_title", F.lit(hop).alias("hop")))
            asked.append(now)
            got = _whole(search(now.select("query", "hop"))).select("query", "position", *(blank(c).alias(c) for c in LEAD))
            first = F.row_number().over(Window.partitionBy("query").orderBy("position", "url", "title"))
            got = steps.keep(got.withColumn("_rank", first).where(F.col("_rank") <= per_query).drop("_rank"))
            results.append(provenance(got, now).join(now.select("query", "seed", "hop"), "query"))
            if hop == most:
                break
            trust = authority_trust("source_name", "url", "source_type", "authority_type", "source_scope")
            lead = got.where(trust["level"] == "lead_only").join(now.select("query", "seed"), "query").withColumn("_key", key())
            lead = lead.groupBy("_key").agg(F.min_by(row, F.struct("seed", "query", "position")).alias("r")).select("_key", "r.*")
            frontier = steps.keep(lead.join(met, "_key", "left_anti"))
            if frontier.isEmpty():
                break
            met = steps.keep(met.union(frontier.select("_key")))
        return steps.result(reduce(DataFrame.unionByName, results)), steps.result(reduce(DataFrame.union, asked))
