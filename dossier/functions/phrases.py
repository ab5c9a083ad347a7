"""Rewriting by a table of phrases, one pass over a text for as many phrases as possible, and the texts of a briefing.

A table means: replace each phrase everywhere, one after the other. Phrases that can't disturb each other are put into one
stage; a stage is one pattern, a trie of its phrases, that finds the leftmost and there the longest phrase. phrases() proves
which ones may share a stage, so the result is that of the table's order: a phrase that holds an earlier one never occurs;
one that an earlier one overlaps from the right, or that an earlier one's replacement may complete, begins a new stage.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE, blank, clean_evidence, compact_evidence, filled, let, squeeze, trim

# --- Fixed values: phrases and patterns that have to be equal for equal results; `?` makes the character before it optional ---

BRIEF = [
    ("Product Safety Alerts, Reports and Recalls", "英国化妆品产品安全通报"),
    ("Product Safety Report:", "产品安全报告："),
    ("Product Recall:", "产品召回："),
    ("The product has been withdrawn from the market.", "该产品已被采取撤出市场措施。"),
    ("withdrawn from the market", "已撤出市场"),
    ("Risk case", "风险案例"),
    ("Risk level:? ?Serious", "风险等级：严重"),
    ("Risk type:? ?Chemical", "风险类型：化学"),
    ("Risk type:? ?Microbiological", "风险类型：微生物"),
    ("present a serious chemical risk", "构成严重化学风险"),
    ("Impacts market sales", "影响市场销售"),
    ("Quality team should", "质量团队应"),
    ("market sales", "市场销售"),
    ("monitor follow-up defect and batch information", "跟踪后续缺陷和批次信息"),
    ("UK product safety service", "英国产品安全服务"),
    ("official recall", "正式召回"),
    ("withdrawal", "撤出市场"),
    ("The product presents a serious chemical risk", "该产品构成严重化学风险"),
    ("The product has been recalled from end users", "该产品已从终端用户召回"),
    ("recalled from end users", "已从终端用户召回"),
    ("alert number:? ?", "通报编号："),
    ("notifying country:? ?", "通报国家："),
    ("Product category:? ?Cosmetics", "产品类别：化妆品"),
    ("Corrective measures:? ?", "整改措施："),
    ("Recall of the product from end users", "从终端用户召回产品"),
    ("Withdrawal of the product from the market", "产品撤出市场"),
    ("Removal of the product listings", "下架产品链接"),
]
BRIEFING_MARKS = [
    (r"(?i)\[([^\]]*)\]\(\s*javascript:void\([^)]*\)\s*\)", "$1"), (r"\[\s*\]\([^)]*\)", ""), (r"!\[([^\]]*)\]\(([^)]+)\)", "$1"), (r"(?i)\[https?://[^\]]*\]\([^)]+\)", ""), (r"\[([^\]]+)\]\(([^)]+)\)", "$1"),
    (r"(?i)https?://[^\s 　]+", ""), (r"(?i)\bbegin-->\s*", ""), (r"(?i)\s*end-->\b", ""), (r"(?i)Crawl4AI\s*(?:抓取到|提取到|发现|显示|返回)?", ""),
    (r"(?:本工具|本系统|本文|笔者|本人)(?:认为|判断|看到|发现|建议)?", ""), (r"(?:我们|咱们)(?:认为|判断|看到|发现|注意到|建议|可)?", ""), ("对我们的", "对"), ("我们的", ""), ("我国", "中国"),
    (r"(?i)\bI\b|\bwe\b|\bour\b|\bmy\b|\bme\b", ""), (f"{SPACE}+", " "), (r"^[，,。；;：:\s]+", ""),
]
TITLE_DOMAIN = r"(?i)^(?:https?://)?(?:www\.)?[a-z0-9.-]+\.(?:com|cn|org|net)\s*"
TITLE_SOURCE = r"(?is)\s*[-|_→]\s*(?:搜狐|腾讯|网易|新浪|凤凰|QQ|头条|百度|南方\+|南方plus|财富号|东方财富|界面新闻|36氪|澎湃新闻|新京报|每日经济新闻|第一财经).*$"
TITLE_COLUMN = r"^[^|]{2,20}\s*\|\s*"
VAGUE_SUBJECTS = ["两家美妆企业", "涉案商家", "商家", "相关企业", "两家公司"]

# --- End of fixed values ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Phrases:
    """Stages of (phrase in lower case, replacement), to be taken one after the other."""

    stages: tuple[tuple[tuple[str, str], ...], ...]


def _forms(phrase: str) -> list[str]:
    """The spellings of a phrase with optional characters, the longest first."""
    out = [""]
    for part in re.findall(r"[^?]\?|[^?]", phrase):
        out = [a + b for a in out for b in ((part[0], "") if part[1:] else (part,))]
    return sorted(dict.fromkeys(out), key=len, reverse=True)


def _before(late: str, early: str) -> bool:
    """Whether late can stand in a text so that its end is the beginning of early."""
    return any(late.endswith(early[:k]) for k in range(1, min(len(late), len(early))))


def _completed(late: str, by: str) -> bool:
    """Whether late can come to stand in a text where `by` was put in."""
    return not by or late in by or by in late or any(by.endswith(late[:k]) or by.startswith(late[-k:]) for k in range(1, len(late)))


def phrases(table: list[tuple[str, str]]) -> Phrases:
    """A table of (phrase, replacement) in the order in which they are replaced, whatever their case."""
    stages: list[list[tuple[str, str]]] = [[]]
    for phrase, by in table:
        earlier = [x for s in stages for x in s]
        forms = [f for f in (x.lower() for x in _forms(phrase)) if f]
        # a form that holds an earlier phrase is gone by now, unless a replacement may have made it anew
        kept = [f for f in forms if not any(e in f for e, _ in earlier) or any(_completed(f, b.lower()) for _, b in earlier)]
        if any(e in f or _before(f, e) or _completed(f, b.lower()) for f in kept for e, b in stages[-1]):
            stages.append([])
        stages[-1] += [(f, by) for f in kept]
    return Phrases(tuple(tuple(s) for s in stages if s))


def trie(words: list[str]) -> str:
    """A pattern of these words that reads each letter of a text once for all of them, the longest first."""
    groups: dict[str, list[str]] = {}
    for w in words:
        if w:
            groups.setdefault(w[0], []).append(w[1:])
    branches = [re.escape(c) + trie(rest) for c, rest in groups.items()]
    if not branches:
        return ""
    one = branches[0] if len(branches) == 1 and "" not in words else f"(?:{'|'.join(branches)})"
    return f"{one}?" if "" in words else one


def _one_pass(s: Column, stage: tuple[tuple[str, str], ...]) -> Column:
    """What stands between the phrases, each gap followed by the replacement of the phrase behind it."""
    pattern = F.lit(f"(?iu){trie([p for p, _ in stage])}")
    by = F.create_map(*(F.lit(x) for pair in dict(reversed(stage)).items() for x in pair))
    hits = F.regexp_extract_all(s, pattern, 0)
    return F.array_join(F.zip_with(F.split(s, pattern), hits, lambda gap, hit: F.concat(gap, F.coalesce(F.try_element_at(by, F.lower(hit)), F.lit("")))), "")


def _pass_of(stage: tuple[tuple[str, str], ...]):
    return lambda s: _one_pass(s, stage)


def rewrite(c: Column | str, table: Phrases) -> Column:
    """The text with all phrases replaced; null as an empty text."""
    out = blank(c)
    for stage in table.stages:
        out = let(out, _pass_of(stage))
    return out


_BRIEF = phrases(BRIEF)


def translated(c: Column | str) -> Column:
    """The squeezed text with the phrases of foreign notices in the report's language."""
    return rewrite(squeeze(c), _BRIEF)


def brief_part(c: Column | str) -> Column:
    """Translated, cleaned, cut to 220 characters, without marks at its end."""
    return F.regexp_replace(compact_evidence(translated(c), 220), r"[。；;,\s]+$", "")


def briefing(c: Column | str) -> Column:
    """Text for a briefing: cleaned, without links, tools and first persons."""
    out = squeeze(clean_evidence(c))
    for pattern, by in BRIEFING_MARKS:
        out = F.regexp_replace(out, pattern, by)
    return trim(out)


def brief_lines(cs: Column) -> Column:
    """Members of an array as lines of a briefing, those with nothing to tell left out, bars escaped."""
    parts = F.filter(F.transform(cs, brief_part), lambda p: p != "")
    return F.transform(parts, lambda p: F.replace(briefing(p), F.lit("|"), F.lit("\\|")))


def display_title(c: Column | str) -> Column:
    """A title without the domain before it, the source or what follows behind it, and a column's name; itself where nothing is left."""
    out = blank(c)
    for pattern in (TITLE_DOMAIN, TITLE_SOURCE, TITLE_COLUMN):
        out = F.regexp_replace(out, pattern, "")
    return F.coalesce(filled(out), blank(c))


def named_title(title: Column | str, party: Column | str) -> Column:
    """The translated title to show, with the party (empty: none) in place of a subject that names nobody."""
    who = squeeze(party)
    out = display_title(translated(title))
    for vague in VAGUE_SUBJECTS:
        out = F.when(out.startswith(vague), F.concat(who, F.substr(out, F.lit(len(vague) + 1)))).otherwise(out)
    return F.when(who == "", display_title(translated(title))).otherwise(out)
