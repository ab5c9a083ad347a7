"""Which attachments belong to which event, by their titles.

A title meets another if, without marks and the number of an attachment, they share a run of four letters, or if they share
two words of four letters or digits. Both rules become equal keys: a run is a key, and so is a pair of words. A word that
stands whole in both bare titles gives a shared run, so pairs of words are needed only where the attachment's number cuts a
word in two; a title has one such word at most and so no more keys than words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import NOT_LETTER, blank, let, squeeze
from .skew import by_key

WIDTH, WORDS = 4, 2
#: Fixed value: how an attachment is numbered.
NUMBERED = r"(?i)^(?:附件[\s 　]*[一二三四五六七八九十\d]+[：:]?[\s 　]*)"
_WORD = r"([a-z0-9]{4,})"


def bare_title(c: Column | str) -> Column:
    """Letters and digits of a title in lower case, without the number of an attachment."""
    return F.lower(F.regexp_replace(F.regexp_replace(squeeze(c), NUMBERED, ""), NOT_LETTER, ""))


def runs(c: Column, width: int = WIDTH) -> Column:
    """The distinct runs of so many letters; none of a shorter text. Reads the text once, however long."""

    def cut(cs: Column) -> Column:
        n = F.size(cs) - width
        return F.when(n >= 0, F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: F.concat(*(F.get(cs, i + k) for k in range(width)))))).otherwise(F.array().cast("array<string>"))

    return let(F.array_remove(F.split(c, ""), ""), cut)


def _words(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(squeeze(c)), F.lit(_WORD), 1))


def titles_meet(a: Column | str, b: Column | str) -> Column:
    """Whether two titles tell of one event."""
    shared = let(runs(bare_title(a)), lambda x: let(runs(bare_title(b)), lambda y: F.arrays_overlap(x, y)))
    return F.coalesce(shared, F.lit(False)) | (F.size(F.array_intersect(_words(F.lit("") if a is None else blank(a)), _words(blank(b)))) >= WORDS)


def title_keys(c: Column | str) -> Column:
    """Keys of which two titles share one exactly if they meet."""

    def pairs(ws: Column, bare: Column) -> Column:
        broken = F.filter(ws, lambda w: ~F.contains(bare, w))
        return F.flatten(F.transform(broken, lambda w: F.transform(F.filter(ws, lambda v: v != w), lambda v: F.concat(F.lit("w"), F.least(w, v), F.lit(" "), F.greatest(w, v)))))

    def keys(bare: Column) -> Column:
        return F.concat(F.transform(runs(bare), lambda r: F.concat(F.lit("r"), r)), let(_words(blank(c)), lambda ws: pairs(ws, bare)))

    return F.array_distinct(let(bare_title(c), keys))


def first_meetings(attachments: DataFrame, events: DataFrame, title: str = "title", ord_: str = "ord", scope: str | None = None) -> DataFrame:
    """attachments with `event`: the first event whose title theirs meets, null where there is none.

    With a scope (a column of both) events of other scopes don't count; a null scope is a scope like any other. Null and
    empty titles meet nothing; rows with the same title have the same event; empty tables give no rows or no events.

    No pairs are made: a key keeps its first event, and a title takes the first of its keys' events. Equal titles count
    once, and keys that many titles share are joined where the titles lie.
    """
    within = F.coalesce(F.concat(F.lit("="), F.col(scope).cast("string")), F.lit("")) if scope else F.lit("")
    own = attachments.withColumns({"_scope": within, "_title": blank(title)})

    def titles(df: DataFrame) -> DataFrame:
        return df.select("_scope", "_title", F.explode(title_keys("_title")).alias("_key"))

    firsts = events.select(within.alias("_scope"), blank(title).alias("_title"), F.col(ord_).alias("_o")).groupBy("_scope", "_title").agg(F.min("_o").alias("_o"))
    key_first = firsts.select("_scope", "_o", F.explode(title_keys("_title")).alias("_key")).groupBy("_scope", "_key").agg(F.min("_o").alias("event"))
    asked = own.select("_scope", "_title").distinct()
    found = by_key(titles(asked), key_first, ["_scope", "_key"]).groupBy("_scope", "_title").agg(F.min("event").alias("event"))
    every = asked.join(found, ["_scope", "_title"], "left")
    return by_key(own, every, ["_scope", "_title"]).drop("_scope", "_title")
