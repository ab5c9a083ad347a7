"""Who published a page: by a table of hosts and paths, or by the rules for known authorities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import lexicons as lx
from ..functions.text import blank, squeeze
from ..functions.urls import Url, host
from .skew import by_key

# --- Fixed values: names of publishers by address, title and text; the first that fits counts -----------------------------

AUTHORITIES = [(r"(?i)nmpa\.gov\.cn", r"^国家药监局", "国家药品监督管理局"), (r"(?i)nifdc\.org\.cn", r"^中检院", "中检院"), (r"(?i)customs\.gov\.cn", r"^海关", "海关总署")]
FOREIGN = [
    (r"(?i)fda\.gov", "美国食品药品监督管理局（FDA）"), (r"(?i)ftc\.gov", "美国联邦贸易委员会（FTC）"), (r"(?i)gov\.uk", "英国产品安全与标准办公室（OPSS）"), (r"(?i)recalls-rappels\.canada\.ca|healthycanadians\.gc\.ca", "加拿大卫生部"),
]
LOCAL_HOST, LOCAL_OTHER = r"(?i)\.gov\.cn", "政府网站"
MARKET, MARKET_CITY, MARKET_SUFFIX, MARKET_OTHER = r"(?i)scjgj|市场监督|市场监管局", r"([一-龥]{2,6}(?:市|区|县|省))", "市场监督管理局", "地方市场监督管理局"
DRUGS, DRUGS_NAME = r"(?i)yjj|药品监督|药监局", "地方药品监督管理局"
COURT, COURT_NAME, COURT_OTHER = r"(?i)人民法院|court", r"([一-龥]{2,10}(?:市|区|县)人民法院)", "人民法院"
TAKEN_OVER = r"(?i)搜狐|腾讯|网易|新浪|凤凰|头条"
TAKEN_FROM = [("国家药监局|国家药品监督管理局", "国家药品监督管理局（转载）"), ("中检院|中国食品药品检定研究院", "中检院（转载）"), ("海关总署|海关发布", "海关总署（转载）")]
TAKEN_MARKET, TAKEN_MARKET_NAME, TAKEN_MARKET_OTHER, TAKEN = "市场监督管理局", r"([一-龥]{2,10}(?:市|区|县)市场监督管理局)", "地方市场监管局（转载）", "（转载）"
PORTALS = [("搜狐", "搜狐财经"), ("腾讯", "腾讯新闻"), ("网易", "网易新闻"), ("凤凰", "凤凰网"), ("新浪", "新浪财经")]
RAW_NAMES = [(r"(?i)haiwaiwai\.com", "海外外媒"), (r"(?i)nfplus\.nfnews", "南方+"), (r"(?i)reach24h|瑞欧", "瑞欧科技")]

# --- End of fixed values ------------------------------------------------------------------------------------------------


def canonical_authority(url: Column | str, title: Column | str) -> Column:
    """The authority that an address or the beginning of a title names, else an empty string."""
    u, t = squeeze(url), squeeze(title)
    return F.coalesce(*(F.when(u.rlike(a) | t.rlike(b), F.lit(name)) for a, b, name in AUTHORITIES), F.lit(""))


def canonical_source(url: Column | str, title: Column | str, name: Column | str, text: Column | str) -> Column:
    """The publisher's name: authorities by address or title, local ones by what address and title tell, for republishers the one the text takes over from, else the given name."""
    u, t, n, body = squeeze(url), squeeze(title), squeeze(name), squeeze(text)
    both = F.concat(t, u)
    city, court, market = F.regexp_extract(t, MARKET_CITY, 1), F.regexp_extract(t, COURT_NAME, 1), F.regexp_extract(body, TAKEN_MARKET_NAME, 1)
    named = [F.when(u.rlike(a) | t.rlike(b), F.lit(label)) for a, b, label in AUTHORITIES]
    local = (
        F.when(both.rlike(MARKET), F.when(city != "", F.concat(city, F.lit(MARKET_SUFFIX))).otherwise(F.lit(MARKET_OTHER)))
        .when(both.rlike(DRUGS), F.lit(DRUGS_NAME))
        .when(both.rlike(COURT), F.when(court != "", court).otherwise(F.lit(COURT_OTHER)))
        .otherwise(F.lit(LOCAL_OTHER))
    )
    over = F.coalesce(
        *(F.when(body.rlike(p), F.lit(k)) for p, k in TAKEN_FROM),
        F.when(F.contains(body, F.lit(TAKEN_MARKET)), F.when(market != "", F.concat(market, F.lit(TAKEN))).otherwise(F.lit(TAKEN_MARKET_OTHER))),
        *(F.when(F.contains(n, F.lit(p)), F.lit(k)) for p, k in PORTALS),
    )
    republished = host(url).rlike(lx.REPUBLISHER_HOST) | n.rlike(TAKEN_OVER)
    return F.coalesce(*named[:2], *(F.when(u.rlike(p), F.lit(k)) for p, k in FOREIGN), named[2], F.when(u.rlike(LOCAL_HOST), local), F.when(republished, over), *(F.when(n.rlike(p), F.lit(k)) for p, k in RAW_NAMES), n)


def host_suffixes(c: Column) -> Column:
    """A host and what is left of it without its first labels: a.b.c, b.c, c."""
    labels = F.split(c, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def path_prefixes(c: Column) -> Column:
    """A path's beginnings by whole segments: '', /a, /a/b."""
    parts = F.filter(F.split(c, "/"), lambda p: p != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.transform(F.slice(parts, F.lit(1), i), lambda p: F.concat(F.lit("/"), p)), ""))


def published_by(df: DataFrame, table: DataFrame, url: str = "url") -> DataFrame:
    """df with `publisher`: the name that the table (host, path, name) has for the address, null where it has none.

    A rule holds for its host and all below it, and for its path (empty: all) and all below it; of several the one with the
    longest host counts, then the longest path; of equal rules the smallest name. Null addresses and such that are none have no publisher.

    A lookup is a join on equal keys: the beginnings of a host, and for hosts that rules name the beginnings of a path. Each
    host and path is looked up once, however many rows have it.
    """
    u = Url(url)
    own = df.withColumns({"_host": F.when(u.ok, u.host), "_path": F.when(u.ok, u.path)})
    rules = table.select(F.lower(F.trim("host")).alias("_suffix"), F.regexp_replace(blank("path"), r"/+$", "").alias("_prefix"), F.col("name").alias("_name"))
    asked = own.select("_host", "_path").where("_host is not null").distinct()
    hosts = asked.select("_host").distinct().select("_host", F.explode(host_suffixes(F.col("_host"))).alias("_suffix")).join(rules.select("_suffix").distinct(), "_suffix")
    named = by_key(asked, hosts.groupBy("_host").agg(F.collect_set("_suffix").alias("_suffixes")), ["_host"])  # as many as a host has labels
    keys = named.select("_host", "_path", F.explode("_suffixes").alias("_suffix")).select("*", F.explode(path_prefixes(F.col("_path"))).alias("_prefix"))
    best = keys.join(rules, ["_suffix", "_prefix"]).groupBy("_host", "_path").agg(F.min_by("_name", F.struct(-F.length("_suffix"), -F.length("_prefix"), "_name")).alias("publisher"))
    every = asked.join(best, ["_host", "_path"], "left")
    found = by_key(own.where("_host is not null"), every, ["_host", "_path"]).select(*df.columns, "publisher")
    return found.unionByName(own.where("_host is null").select(*df.columns, F.lit(None).cast("string").alias("publisher")))
