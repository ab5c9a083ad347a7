"""What a catalog row says about its source: module, place, kind, authority, priority, topics and id, by keyword in name and address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank, trim
from ..functions.urls import with_scheme

# --- Fixed values: keywords and labels, the first that fits counts ------------------------------------------------------

MODULES = ["新规/修订/废止/生效提醒", "广告合规及处罚案例", "美妆行业动态", "知识产权动态", "进出口/跨境电商动态"]
CATEGORIES = {
    "新规及案例动态": "新规/修订/废止/生效提醒", "新规/修订/废止": "新规/修订/废止/生效提醒", "法规": "新规/修订/废止/生效提醒",
    "案例": "广告合规及处罚案例", "美妆动态": "美妆行业动态", "进出口动态": "进出口/跨境电商动态",
}
MODULE_WORDS = [
    (["广告", "虚假宣传", "处罚", "市监", "市场监督"], "广告合规及处罚案例"), (["知识产权", "商标", "专利"], "知识产权动态"), (["海关", "进出口", "跨境", "进口"], "进出口/跨境电商动态"),
    (["药品监督", "药监", "NMPA", "法规", "监管"], "新规/修订/废止/生效提醒"), (["检察", "法院"], "广告合规及处罚案例"), (["化妆品", "美妆"], "美妆行业动态"),
]
DEFAULT_MODULE = "美妆行业动态"
HOST_PLACES = [
    (r"\.cn$|\.gov\.cn", "亚洲", "中国"), (r"\.go\.th|thai", "亚洲", "泰国"), (r"\.gov\.vn|vietnam", "亚洲", "越南"), (r"\.gov\.ph|philippines", "亚洲", "菲律宾"),
    (r"\.gov\.my|malaysia", "亚洲", "马来西亚"), (r"\.gov\.au", "大洋洲", "澳大利亚"),
]
PLACE_WORDS = [
    (["中国", "国家", "上海", "杭州", "北京", "广州", "浙江", "广东", "海关"], "亚洲", "中国"), (["FDA"], "北美", "美国"), (["欧盟", "EU", "ECHA", "SCCS"], "欧洲", "欧盟"), (["BPOM", "印尼"], "亚洲", "印尼"),
    (["泰国"], "亚洲", "泰国"), (["越南"], "亚洲", "越南"), (["菲律宾"], "亚洲", "菲律宾"), (["马来西亚"], "亚洲", "马来西亚"), (["AICIS", "澳大利亚"], "大洋洲", "澳大利亚"), (["新西兰"], "大洋洲", "新西兰"),
    (["墨西哥"], "北美", "墨西哥"), (["意大利"], "欧洲", "意大利"),
]
NO_PLACE = ("全球", "未分类")
TOPIC_WORDS = [
    (["化妆品"], "化妆品"), (["美妆"], "美妆"), (["药监", "药品监督"], "药监"), (["广告"], "广告合规"), (["市场监督", "市监"], "行政处罚"), (["海关", "进出口"], "进出口"), (["跨境"], "跨境电商"),
    (["知识产权"], "知识产权"), (["法院"], "判决案例"), (["检察"], "执法案例"), (["FDA", "BPOM", "AICIS", "ECHA", "SCCS"], "海外监管"),
]
OFFICIAL_WORDS = ["gov", "政府", "国家", "药监", "药品监督", "市场监督", "海关", "法院", "检察", "FDA", "BPOM", "AICIS", "ECHA", "SCCS", "欧盟", "commission", "europa", "official"]
KIND_WORDS = [(["微信公众号", "公众号", "微信", "mp.weixin.qq.com", "weixin.qq.com"], "wechat_public_account"), (["rss", "atom", "feed"], "rss")]
MEDIUM_MODULES = ["新规/修订/废止/生效提醒", "广告合规及处罚案例", "进出口/跨境电商动态"]

# --- End of fixed values ------------------------------------------------------------------------------------------------


def _holds(text: Column, words: list[str]) -> Column:
    """Whether any of the words stands in a text of capitals."""
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w.upper()))
    return out


def _label(text: Column, rules: list[tuple[list[str], str]], otherwise: Column) -> Column:
    return F.coalesce(*(F.when(_holds(text, words), F.lit(label)) for words, label in rules), otherwise)


def module_of(category: Column | str, text: Column) -> Column:
    """The module that a category names or holds a word of, else that of the first word in name and address."""
    c = trim(category)
    known = F.coalesce(F.when(c.isin(MODULES), c), *(F.when(c == k, F.lit(v)) for k, v in CATEGORIES.items()))
    return F.coalesce(known, _label(F.upper(c), MODULE_WORDS, _label(text, MODULE_WORDS, F.lit(DEFAULT_MODULE))))


def place_of(host: Column, text: Column) -> Column:
    """struct<region, country>."""

    def out(region: str, country: str) -> Column:
        return F.struct(F.lit(region).alias("region"), F.lit(country).alias("country"))

    by_host = [F.when(host.rlike(p), out(r, c)) for p, r, c in HOST_PLACES]
    return F.coalesce(*by_host, *(F.when(_holds(text, words), out(r, c)) for words, r, c in PLACE_WORDS), out(*NO_PLACE))


def topics_of(text: Column, module: Column, country: Column) -> Column:
    """Topics whose words stand in a text of capitals, in the module or in the country, then the module and a known country."""
    whole = F.concat_ws(" ", text, F.upper(module), F.upper(country))
    found = [F.when(_holds(whole, words), F.lit(topic)) for words, topic in TOPIC_WORDS]
    return F.array_distinct(F.array_compact(F.array(*found, module, F.when(~country.isin("", NO_PLACE[1]), country))))


def source_id(url: Column, name: Column, index: Column) -> Column:
    """`src-` with a number of three digits or more and the letters of the host, or `source-` and the number where there is no host."""
    host = F.replace(F.lower(F.regexp_extract(F.when(url != "", url).otherwise(name), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit("www."), F.lit(""))
    base = F.when(host != "", host).otherwise(F.concat(F.lit("source-"), index.cast("string")))
    slug = F.regexp_replace(F.regexp_replace(base, r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    return F.concat(F.lit("src-"), F.format_string("%03d", index.cast("long")), F.lit("-"), F.when(slug == "", "source").otherwise(slug))


def classified(rows: DataFrame, index: str = "index") -> DataFrame:
    """rows (index, name, url, category) as sources: id, module, region, country, source_type, authority_type, priority, topics."""
    n, u = trim("name"), with_scheme("url")
    out = rows.withColumns({"name": n, "url": u})
    out = out.withColumns({"_text": F.upper(F.concat_ws(" ", blank("name"), blank("url"))), "_host": F.lower(F.regexp_extract(blank("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))})
    out = out.withColumns({"module": module_of("category", F.col("_text")), "_place": place_of(F.col("_host"), F.col("_text")), "authority_type": F.when(_holds(F.col("_text"), OFFICIAL_WORDS), "regulator").otherwise("industry")})
    http = F.when(F.col("url").startswith("http"), F.when(F.col("authority_type") == "regulator", "official_site").otherwise("industry_site")).when(F.col("url") != "", "manual_link").otherwise("industry_site")
    out = out.withColumns({"region": F.col("_place.region"), "country": F.col("_place.country"), "source_type": _label(F.col("_text"), KIND_WORDS, http)})
    high = (F.col("authority_type") == "regulator") | (F.col("source_type") == "official_site")
    priority = F.when(high, "high").when(F.col("source_type") == "wechat_public_account", "low").when(F.col("module").isin(MEDIUM_MODULES), "medium").otherwise("low")
    topics = topics_of(F.col("_text"), F.col("module"), F.col("country"))
    return out.withColumns({"priority": priority, "topics": topics, "id": source_id(F.col("url"), F.col("name"), F.col(index))}).drop("_text", "_host", "_place")
