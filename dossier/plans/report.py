"""Report rows, cards and messages as expressions, and their Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import lexicons as lx
from ..functions.dates import found_date
from ..functions.text import blank, col, escape_html, first_text, first_values, letters, squeeze, values
from ..functions.urls import display_key, is_http
from ..operators.scoring import is_home
from ..operators.select import byte_chunks


def candidate(source: DataFrame, items: DataFrame) -> DataFrame:
    """Items (source_id, title, url, snippet, published_at) with their source's fields; a missing date is looked for in title, address and snippet."""
    fields = ["name", "module", "region", "country", "source_type", "authority_type", "priority", "topics"]
    out = items.join(source.select(F.col("id").alias("source_id"), *fields), "source_id").withColumnRenamed("name", "source_name")
    return out.withColumn("published_at", F.coalesce(F.nullif(blank("published_at"), F.lit("")), found_date("title", "url", "snippet")))


def lead_snippet(name: Column | str, module: Column | str, country: Column | str, region: Column | str, topics: Column | str) -> Column:
    """What stands for a source that can't be fetched."""
    unknown = F.lit("未知")
    place = F.concat(first_text(country, unknown), F.lit(" / "), first_text(region, unknown))
    return F.concat_ws("。", F.concat(F.lit("来源："), blank(name)), F.concat(F.lit("分类："), blank(module)), F.concat(F.lit("市场："), place), F.concat(F.lit("主题："), F.array_join(col(topics), "、")))


def split_sources(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fetchable sources, and those that only give leads."""
    lead = F.coalesce((F.col("source_type") == "wechat_public_account") | F.col("monitor_only"), F.lit(False))
    return sources.where(~lead), sources.where(lead)


def objective_facts(fact_summary: Column | str, *others: Column | str) -> Column:
    """The first two facts: stated ones, else those of the other fields in order."""
    own = values(fact_summary)
    rest = F.concat(*(values(o) for o in others)) if others else F.array().cast("array<string>")
    return F.slice(F.when(F.size(own) > 0, own).otherwise(rest), 1, 2)


def objective_observation(next_observation: Column | str, watch: Column | str, feedback: Column | str, effective: Column | str, deadline: Column | str) -> Column:
    stated = F.slice(first_values(next_observation, watch), 1, 1)

    def known(c: Column | str) -> Column:
        return (blank(c) != "") & (blank(c) != "未知")

    dated = (
        F.when(known(feedback), F.array(F.concat(F.lit("跟踪"), blank(feedback), F.lit("意见反馈截止及后续正式稿。"))))
        .when(known(effective), F.array(F.concat(F.lit("跟踪 "), blank(effective), F.lit(" 的生效及配套执行口径。"))))
        .when(known(deadline), F.array(F.concat(F.lit("跟踪"), blank(deadline), F.lit("法定节点及后续公开进展。"))))
        .otherwise(F.array().cast("array<string>"))
    )
    return F.when(F.size(stated) > 0, stated).otherwise(dated)


def display_module(kind: Column | str, module: Column | str, evidence: Column) -> Column:
    t, m = squeeze(kind), squeeze(module)
    rule, ad = "新规及案例动态", "广告合规及处罚案例"
    return (
        F.when((t == "IP") | (m == "知识产权动态"), lx.DISPLAY_MODULES[2])
        .when((t == "进出口") | (m == "进出口动态"), lx.DISPLAY_MODULES[3])
        .when((m == ad) & ((t == "案例") | evidence.rlike("处罚|罚款|责令|没收|违法")), lx.DISPLAY_MODULES[1])
        .when(t.isin("法规", "征求意见", "生效提醒", "废止", "平台规则") | (m.isin(rule, ad) & ~t.isin("案例", "召回")), lx.DISPLAY_MODULES[0])
        .otherwise(lx.DISPLAY_MODULES[4])
    )


def identity(url: Column | str, title: Column | str, country: Column | str, region: Column | str) -> Column:
    u, t = display_key(url), letters(title)
    return F.when(is_http(u), F.concat(F.lit("url:"), u, F.lit("|title:"), t)).otherwise(F.concat(F.lit("title:"), t, F.lit("|"), F.lower(first_text(country, region))))


def editorial_rows(items: DataFrame) -> DataFrame:
    """Numbered rows of the shown report: sections with home items first, in the display order; inside home first, then by rank.

    items: display_module, country, rank, ord, one row for each event.
    """
    order = F.array(*map(F.lit, lx.DISPLAY_MODULES))
    home = F.when(F.col("country") == lx.HOME_COUNTRY, 0).otherwise(1)
    placed = items.withColumn("_section", F.array_position(order, F.col("display_module"))).withColumn("_home", home)
    first = placed.groupBy("display_module").agg(F.min("_home").alias("_section_home"))
    out = placed.join(F.broadcast(first), "display_module")  # one row for each display module
    numbered = Window.orderBy("_section_home", "_section", "_home", F.desc("rank"), "ord")
    return out.withColumn("number", F.row_number().over(numbered)).drop("_section", "_home", "_section_home")  # the rows of one report


def card_text(title: Column | str, facts: Column, url: Column | str, source: Column | str, number: Column | None = None) -> Column:
    head = F.concat(F.lit("### "), *( [number.cast("string"), F.lit(". ")] if number is not None else []), squeeze(title))
    lines = F.array_join(F.transform(facts, lambda f: F.concat(F.lit("- "), f)), "\n")
    return F.concat_ws("\n", head, F.when(lines != "", lines), F.concat(F.lit("["), squeeze(source), F.lit("]("), blank(url), F.lit(")")))


def module_order(cards: DataFrame) -> DataFrame:
    """Cards with `turn`: modules by home cards, best score and place; inside home first, then by score."""
    by = cards.groupBy("module").agg(F.max(F.when(is_home("country"), 1).otherwise(0)).alias("_h"), F.max("score").alias("_s"))
    rank = F.array_position(F.array(*map(F.lit, lx.CARD_MODULES)), F.col("module"))
    rank = F.when(rank == 0, len(lx.CARD_MODULES) + 1).otherwise(rank)
    turn = Window.orderBy(F.desc("_h"), F.desc("_s"), rank, F.when(is_home("country"), 0).otherwise(1), F.desc("score"), "ord")
    return cards.join(by, "module").withColumn("turn", F.row_number().over(turn)).drop("_h", "_s")  # the cards of one report


def messages(cards: DataFrame, limit: int = 18000, title: str = "weekly-report") -> DataFrame:
    """(id, markdown, bytes) of messages that hold the cards (turn, markdown) in order, each within limit bytes."""
    limit = max(1200, limit)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("turn", "markdown"))), lambda s: s["markdown"])
    one = cards.agg(byte_chunks(parts, limit).alias("chunks"))  # the cards of one report
    out = one.select(F.size("chunks").alias("total"), F.posexplode("chunks").alias("i", "markdown"))
    name = F.when(F.col("total") > 1, F.concat(F.lit(f"{title}-"), (F.col("i") + 1).cast("string"))).otherwise(title)
    return out.select(name.alias("id"), "markdown", F.octet_length("markdown").alias("bytes"))


def html_item(title: Column | str, facts: Column, url: Column | str) -> Column:
    return F.concat(F.lit("<article><h3>"), escape_html(title), F.lit("</h3><ul>"), F.array_join(F.transform(facts, lambda f: F.concat(F.lit("<li>"), escape_html(f), F.lit("</li>"))), ""), F.lit('</ul><a href="'), escape_html(url), F.lit('">link</a></article>'))


def executive(items: DataFrame, text: str, n: int = 3) -> DataFrame:
    """The first n action items in rank order whose text differs but for marks and white space."""
    from ..operators.dedupe import winner

    key = F.regexp_replace(F.lower(blank(text)), r"[\s，。；：、,.!?！？:;()（）《》]", "")
    return winner(items.where("report_tier = 'action'"), key, -F.col("rank"), F.col("ord")).orderBy(F.desc("rank"), "ord").limit(n)
