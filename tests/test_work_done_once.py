"""Texts are cleaned once for all rules that look at them, and slow patterns only look where they can find something."""

import random
import time

import pytest
from pyspark.sql import functions as F

from dossier import lexicons as lx
from dossier import registry
from dossier.functions import facts as fx
from dossier.functions import text as tx
from dossier.operators import joins

DATA = "/root/testdata/sf0.001"


def times(df, pattern):
    return df._jdf.queryExecution().optimizedPlan().toString().count(pattern)


@pytest.mark.parametrize("name", ["notice_editorial_gate", "notice_corroborated_gate"])
def test_the_gate_cleans_each_text_once(spark, name):
    assert times(registry.QUERIES[name](spark, DATA), lx.PAGE_CONTROLS[:40]) == 1


@pytest.mark.parametrize("name", ["notice_facts", "notice_cards"])
def test_a_grade_looks_for_each_sign_of_a_portal_once(spark, name):
    got = registry.QUERIES[name](spark, DATA)
    assert [times(got, p) for p in (fx.PORTAL_MENUS[2], fx.OTHER_INDUSTRIES[1], fx.LISTING_DATE)] == [1, 1, 1]


def test_slow_patterns_find_what_they_found_and_pass_other_texts(spark):
    """The guard of a pattern is in every text it matches; a long text without it costs no more than one look."""
    rng = random.Random(3)
    words = ["侵权", "冒用", "刷单", "有限公司", "商行", "工作室", "〔2026〕12号", "〔20", "公司", "甲乙丙丁", "abc", "。", "；", " ", "未经授权", "据通报", "**", "\n", "2026年第3号"]
    rows = [("".join(rng.choice(words) for _ in range(rng.randrange(1, 12))),) for _ in range(400)]
    df = spark.createDataFrame(rows, "s string")
    for p in fx.NEEDED:
        assert df.where(fx._extract(F.col("s"), p) != F.regexp_extract("s", p, 1)).isEmpty()
        assert not df.where(F.regexp_extract("s", p, 1) != "").isEmpty()
    long_ = spark.createDataFrame([("甲乙丙丁戊己庚辛" * 20_000,)], "s string")
    began = time.time()
    assert [v for v in long_.select(*(fx._extract(F.col("s"), p) for p in fx.NEEDED)).first()] == ["", "", ""]
    assert time.time() - began < 2


def test_clean_lines_and_marks_are_those_of_all_patterns(spark):
    """Texts in which no mark stands skip the patterns for marks; the others are cleaned as before."""
    rng = random.Random(4)
    parts = ["#", "##", ">", "- ", "* ", "1. ", "**", "__", "`", "|", "---", "|---|---|", "\r\n", "\n", chr(0xA0), "<b>", "<!-- x -->", "[a](b)", "![a](b)", "[ ](b)", "⟨3⟩", "罚款", "甲乙", chr(0x3000), " ", "首页", "打印"]
    rows = [("".join(rng.choice(parts) for _ in range(rng.randrange(1, 9))),) for _ in range(600)]
    df = spark.createDataFrame(rows, "s string")
    plain = F.regexp_replace("s", r"\r\n?", "\n")
    for pattern, by in ((chr(0xA0), " "), (r"(?s)<!--.*?-->", " "), (r"!\[([^\]]*)\]\([^)]+\)", "$1"), (r"\[([^\]]+)\]\([^)]+\)", "$1"), (r"\[\s*\]\([^)]+\)", ""), (r"<[^>]+>", " "), (r"\s*⟨\d+⟩", "")):
        plain = F.regexp_replace(plain, pattern, by)
    stripped = tx.squeeze("s")
    for pattern, by in ((r"!\[([^\]]*)\]\(([^)]+)\)", "$1"), (r"\[([^\]]+)\]\(([^)]+)\)", "$1"), (r"^#{1,6}\s+", ""), (r"^[-*+]\s+", ""), (r"\*\*", ""), (r"`+", "")):
        stripped = F.regexp_replace(stripped, pattern, by)
    line = tx.trim("s")
    for pattern, by in ((r"^\s{0,3}#{1,6}\s*", ""), (r"^\s{0,3}>+\s*", ""), (r"^\s{0,3}(?:[-*+] |\d+[.)]\s+)", ""), (r"\*\*|__|`+", ""), (lx.PAGE_CONTROLS, " "), (r"\|", " "), (f"{tx.SPACE}+", " "), (r"^[>＞|｜:：/·\s-]+|[>＞|｜:：/·\s-]+$", "")):
        line = F.regexp_replace(line, pattern, by)
    got = df.select("s", (tx.plain_lines("s") == plain).alias("a"), (tx.strip_markdown("s") == F.trim(stripped)).alias("b"), tx.clean_line(F.col("s")).isin(F.lit(""), tx.trim(line)).alias("c"))
    assert got.where("not (a and b and c)").isEmpty()
    spaces = "".join(map(chr, [9, 10, 11, 12, 13, 32, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]))
    kept = "".join(map(chr, [0, 8, 14, 0x85, 0x180E, 0x200B, 0x2027, 0x3001, 0x4E00, 0xFEFE])) + "a"
    assert spark.range(1).select(F.regexp_replace(F.lit(spaces + kept), tx.SPACE, "")).first()[0] == kept


def test_only_runs_that_meet_a_pattern_are_shuffled(spark, monkeypatch):
    """Runs of texts meet those of patterns before anything is shuffled, also in several parts, and repeated patterns keep all their rows."""
    p = spark.createDataFrame([(i, t) for i, t in enumerate(["b c d e f", "b c d e f", "c d e f g", "not there at all here", "zz", "", None])], "i int, p string")
    d = spark.createDataFrame([(7, "a b c d e fg h"), (8, "a b c d e fg h"), (9, "xzzy"), (10, None)], "d int, t string")
    want = [(0, 7), (0, 8), (1, 7), (1, 8), (4, 9)]
    for runs in (500_000, 1):
        monkeypatch.setattr(joins, "RUNS", runs)
        got = joins.substring_matches(p, d, "p", "t")
        assert sorted((r["i"], r["d"]) for r in got.collect()) == want
        lines = got._jdf.queryExecution().optimizedPlan().toString().split("\n")
        over = [[x for x in lines[:i] if "- Project" not in x and "- Filter" not in x][-1] for i, x in enumerate(lines) if "Generate explode" in x]
        assert over and all("Join LeftSemi" in x for x in over)


def test_members_are_told_apart_by_their_keys(spark):
    """Arrays without repeats aren't sorted; with or without, members, their order and nulls are those of a plain loop."""
    rng = random.Random(5)
    rows = [([rng.choice(["a", "A ", " a", "b", "", " ", "c d", "cd", None]) for _ in range(rng.randrange(5))],) for _ in range(300)] + [(None,)]
    got = spark.createDataFrame(rows, "xs array<string>").select("xs", tx.distinct_by(F.col("xs"), lambda x: F.replace(x, F.lit(" "), F.lit(""))).alias("got")).collect()
    for r in got:
        want, seen = [], {"", None}
        for x in r["xs"] or []:
            k = x and x.replace(" ", "")
            if k not in seen:
                want.append(x)
                seen.add(k)
        assert r["got"] == (None if r["xs"] is None else want)
