"""Text, HTML and array expressions. All are Column functions except where a fold over bytes needs Python."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .. import lexicons as lx

#: White space as browsers count it; the engine's own class is ASCII only. The range before && is asked first, so an ideograph costs one look and not ten.
SPACE = r"[\x00-\u3000\uFEFF&&[\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]]"
NOT_LETTER = r"[\s\u00A0\u3000\p{P}\p{S}]+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c: Column | str) -> Column:
    """Null as an empty string."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """body(value), the value computed once however often the body names it, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def trim(c: Column | str) -> Column:
    return F.regexp_replace(blank(c), f"^{SPACE}+|{SPACE}+$", "")


def squeeze(c: Column | str) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(blank(c), f"{SPACE}+", " "))


def told(c: Column | str) -> Column:
    """Whether squeeze() of it would leave anything; nothing is looked through where it is empty."""
    return (blank(c) != "") & (squeeze(c) != "")


def filled(c: Column | str) -> Column:
    """The squeezed text, null where nothing is left."""
    return F.nullif(squeeze(c), F.lit(""))


def first_text(*cs: Column | str) -> Column:
    """The first text that isn't blank, squeezed; else an empty string."""
    return F.coalesce(*(filled(c) for c in cs), F.lit(""))


def first_filled(*cs: Column | str) -> Column:
    """The first text that isn't empty, without white space at its ends; its lines stay as they are."""
    return trim(F.coalesce(*(F.nullif(blank(c), F.lit("")) for c in cs), F.lit("")))


def values(c: Column | str) -> Column:
    """Squeezed members of an array that aren't blank, in order."""
    return F.filter(F.transform(F.coalesce(col(c), F.array().cast("array<string>")), squeeze), lambda x: x != "")


def first_values(*cs: Column | str) -> Column:
    """The first array that has a member which isn't blank."""
    found = [values(c) for c in cs]
    return F.coalesce(*(F.when(F.size(v) > 0, v) for v in found), F.array().cast("array<string>"))


def distinct_by(c: Column, key) -> Column:
    """Members of an array in order, without those whose key an earlier one has; empty keys go. Sorts where a key repeats, so long arrays are no harm."""

    def sorted_out(xs: Column, keys: Column) -> Column:
        entries = F.array_sort(F.transform(xs, lambda x, i: F.struct(F.get(keys, i).alias("k"), i.alias("i"), x.alias("x"))))
        first = let(entries, lambda es: F.filter(es, lambda e, j: (e["k"] != "") & ((j == 0) | ~F.get(es, j - 1)["k"].eqNullSafe(e["k"]))))
        return F.transform(F.array_sort(F.transform(first, lambda e: F.struct(e["i"], e["x"]))), lambda e: e["x"])

    def kept(xs: Column, keys: Column) -> Column:
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.filter(xs, lambda x, i: F.get(keys, i) != "")).otherwise(sorted_out(xs, keys))

    return let(c, lambda xs: let(F.transform(xs, key), lambda keys: kept(xs, keys)))


def unique_values(c: Column | str) -> Column:
    """Squeezed members, first spelling of each that is equal but for white space."""
    return distinct_by(values(c), lambda x: F.regexp_replace(x, f"{SPACE}+", ""))


def compact(c: Column | str, limit: int) -> Column:
    """Squeezed text cut to limit characters with an ellipsis."""
    s = squeeze(c)
    return F.when(F.length(s) > limit, F.concat(F.substring(s, 1, limit - 1), F.lit("…"))).otherwise(s)


def table_cell(c: Column | str) -> Column:
    return F.replace(squeeze(c), F.lit("|"), F.lit("\\|"))


def escape_html(c: Column | str) -> Column:
    out = blank(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def wrap(c: Column | str, width: int, lines: int) -> Column:
    """Pieces of width characters, lines at most."""

    def cut(s: Column) -> Column:
        n = F.least(F.ceil(F.length(s) / width), F.lit(lines)).cast("int")
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substr(s, i * width + 1, F.lit(width)))).otherwise(F.array().cast("array<string>"))

    return let(squeeze(c), cut)


def hash31(c: Column | str) -> Column:
    """The rolling hash h * 31 + code unit in 32 bits, as hexadecimal; characters beyond the basic plane count as one unit."""
    units = F.filter(F.split(blank(c), ""), lambda x: x != "")
    h = F.aggregate(units, F.lit(0).cast("long"), lambda a, x: (a * 31 + F.ascii(x)) % F.lit(1 << 32))
    return F.lower(F.hex(h))


def module_name(c: Column | str, aliases: dict[str, str] | None = None, default: str = "") -> Column:
    name = trim(c)
    table = F.create_map(*(F.lit(x) for kv in (aliases or lx.MODULE_ALIASES).items() for x in kv))
    return F.coalesce(F.get(F.map_values(F.map_filter(table, lambda k, _: k == name)), F.lit(0)), F.nullif(name, F.lit("")), F.lit(default))


# --- HTML ---------------------------------------------------------------------------------------------------------------


def html_to_text(html: Column | str) -> Column:
    out = F.regexp_replace(blank(html), r"(?is)<script.*?</script>", " ")
    out = F.regexp_replace(out, r"(?is)<style.*?</style>", " ")
    out = F.regexp_replace(out, r"<[^>]+>", " ")
    for a, b in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return squeeze(out)


def tag_text(html: Column | str, tag: str) -> Column:
    return html_to_text(F.regexp_extract(blank(html), rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1))


def article(html: Column | str) -> Column:
    """title, text, has_container, paragraphs of a page: its article or main element, else all of it, without page furniture."""
    raw = blank(html)
    inner = [F.nullif(F.regexp_extract(raw, rf"(?is)<{t}\b[^>]*>(.*?)</{t}>", 1), F.lit("")) for t in ("article", "main")]
    found = F.coalesce(*inner)
    parts = "script|style|noscript|svg|nav|header|footer|aside|form"
    body = F.regexp_replace(F.coalesce(found, raw), rf"(?is)<(?:{parts})\b.*?</(?:{parts})>", " ")
    body = F.regexp_replace(body, r"(?s)<!--.*?-->", " ")
    return F.struct(
        F.coalesce(F.nullif(tag_text(raw, "h1"), F.lit("")), tag_text(raw, "title")).alias("title"),
        html_to_text(body).alias("text"),
        raw.rlike(r"(?is)<article\b[^>]*>.*?</article>|<main\b[^>]*>.*?</main>").alias("has_container"),
        F.regexp_count(body, F.lit(r"(?i)<p\b")).alias("paragraphs"),
    )


def anchors(html: Column | str) -> Column:
    """All links of a page as array<struct<href, title>>, in order."""
    pattern = r"(?is)<a\b[^>]*?href=[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"
    hrefs, titles = F.regexp_extract_all(blank(html), F.lit(pattern), 1), F.regexp_extract_all(blank(html), F.lit(pattern), 2)
    return F.zip_with(hrefs, titles, lambda h, t: F.struct(h.alias("href"), html_to_text(t).alias("title")))


def is_content_image(url: Column | str) -> Column:
    u = F.lower(blank(url))
    return (u != "") & ~u.rlike(r"logo|icon|avatar|sprite|blank|placeholder|loading|qrcode|qr_|\.svg(?:$|\?)|^data:")


def page_image(html: Column | str) -> Column:
    """The address a page gives for its picture, else its first picture that isn't furniture; else an empty string."""
    raw = blank(html)
    meta = [
        F.nullif(F.regexp_extract(raw, rf"(?is)<meta\b[^>]*?(?:property|name)=[\"']{k}[\"'][^>]*?content=[\"']([^\"']+)[\"']", 1), F.lit(""))
        for k in ("og:image", "twitter:image")
    ]
    shown = F.filter(F.regexp_extract_all(raw, F.lit(r"(?is)<img\b[^>]*?src=[\"']([^\"']+)[\"']"), 1), is_content_image)
    return F.coalesce(*meta, F.get(shown, F.lit(0)), F.lit(""))


# --- Article evidence ---------------------------------------------------------------------------------------------------


def plain_lines(c: Column | str) -> Column:
    """Markdown or HTML as plain text; line ends stay."""
    return let(blank(c), lambda s: F.when(s.rlike(r"[\r\u00A0<\[⟨]"), _unmarked(s)).otherwise(s))


def _unmarked(s: Column) -> Column:
    out = F.regexp_replace(s, r"\r\n?", "\n")
    for pattern, by in (
        (r"\u00A0", " "), (r"(?s)<!--.*?-->", " "), (r"!\[([^\]]*)\]\([^)]+\)", "$1"), (r"\[([^\]]+)\]\([^)]+\)", "$1"),
        (r"\[\s*\]\([^)]+\)", ""), (r"<[^>]+>", " "), (r"\s*⟨\d+⟩", ""),
    ):
        out = F.regexp_replace(out, pattern, by)
    return out


def clean_line(c: Column) -> Column:
    """A line without marks and page controls; an empty string for furniture."""

    def without_marks(s: Column) -> Column:
        for pattern, by in ((r"^\s{0,3}#{1,6}\s*", ""), (r"^\s{0,3}>+\s*", ""), (r"^\s{0,3}(?:[-*+] |\d+[.)]\s+)", ""), (r"\*\*|__|`+", "")):
            s = F.regexp_replace(s, pattern, by)
        return s

    def cleaned(s: Column) -> Column:
        table = F.contains(s, F.lit("---")) & s.rlike(r"^\s*\|?\s*:?-{3,}:?\s*(?:\|\s*:?-{3,}:?\s*)+\|?\s*$")
        line = F.when(s.rlike(r"^\s{0,3}[#>*+\d-]|\*\*|__|`"), without_marks(s)).otherwise(s)
        for pattern, by in ((lx.PAGE_CONTROLS, " "), (r"\|", " "), (f"{SPACE}+", " "), (r"^[>＞|｜:：/·\s-]+|[>＞|｜:：/·\s-]+$", "")):
            line = F.regexp_replace(line, pattern, by)
        return F.when(table, F.lit("")).otherwise(let(trim(line), judged))

    def judged(x: Column) -> Column:
        shell = x.rlike(lx.PAGE_SHELL) & ~x.rlike(lx.EVENT_WORDS)
        menu = (F.regexp_count(x, F.lit(lx.NAVIGATION_WORDS)) >= 2) & ~F.regexp_replace(x, lx.NAVIGATION_WORDS, " ").rlike(lx.SUBSTANCE_WORDS)
        signs = x.rlike(r"^[\p{P}\p{S}\s]+$") | x.rlike(rf"(?i)^(?:{lx.SHARE_WORDS})(?:\s+(?:{lx.SHARE_WORDS}))*$")
        return F.when(shell | menu | signs, F.lit("")).otherwise(x)

    return let(trim(c), cleaned)


def clean_evidence(c: Column | str) -> Column:
    """Cleaned lines, each once, first spelling, joined by line ends."""
    return F.array_join(unique_lines(F.transform(F.split(plain_lines(c), r"\n+"), clean_line)), "\n")


def unique_lines(lines: Column) -> Column:
    return distinct_by(F.filter(lines, lambda x: x != ""), lambda x: F.regexp_replace(x, f"{SPACE}+", ""))


def cut_at_mark(c: Column | str, limit: int = 220) -> Column:
    """Squeezed text; if longer than limit, cut behind the last mark in the window's last 45 percent, else at limit, with dots."""
    low = int(limit * 0.55)

    def cut(s: Column) -> Column:
        head = F.substring(s, 1, limit)
        upto = F.regexp_extract(head, rf"(?s)^(.{{{max(0, low - 1)},{limit - 1}}}[。！？!?；;，,]).*$", 1)
        shown = F.coalesce(F.nullif(upto, F.lit("")), head)
        return F.when(F.length(s) <= limit, s).otherwise(F.concat(F.regexp_replace(shown, r"[，,；;\s]+$", ""), F.lit("...")))

    return let(squeeze(c), cut)


def compact_evidence(c: Column | str, limit: int = 220) -> Column:
    return cut_at_mark(clean_evidence(c), limit)


def first_sentence(c: Column | str, limit: int = 220) -> Column:
    """The first sentence that tells an event, rather not an intro; else the first of 16 characters or more; else all."""

    def pick(whole: Column) -> Column:
        def among(sentences: Column) -> Column:
            event = F.filter(sentences, lambda s: s.rlike(lx.EVENT_WORDS))
            plain = F.filter(sentences, lambda s: s.rlike(lx.EVENT_WORDS) & ~s.rlike(lx.GENERIC_INTRO))
            return F.coalesce(F.get(plain, F.lit(0)), F.get(event, F.lit(0)), F.get(sentences, F.lit(0)))

        sentences = F.filter(F.transform(F.split(whole, r"\n+|(?<=[。！？!?；;])\s*"), trim), lambda s: F.length(s) >= 16)
        return F.coalesce(let(sentences, among), whole)

    return compact_evidence(let(clean_evidence(c), pick), limit)


def substantive(c: Column | str, paragraphs: int = 5) -> Column:
    """The first paragraphs of 12 characters or more that aren't page furniture, joined by blanks."""
    return F.array_join(F.slice(substance(c), 1, paragraphs), " ")


def substance(c: Column | str) -> Column:
    """All paragraphs of 12 characters or more that aren't page furniture."""
    parts = F.transform(F.split(clean_evidence(c), r"\n+|(?<=[。！？!?])\s+"), squeeze)
    return F.filter(parts, lambda p: (F.length(p) >= 12) & ~p.rlike(lx.SHELL_LINE))


def strip_markdown(c: Column | str) -> Column:
    """White space first, then marks: only the very beginning still counts as the start of a line."""

    def without_marks(s: Column) -> Column:
        for pattern, by in ((r"!\[([^\]]*)\]\(([^)]+)\)", "$1"), (r"\[([^\]]+)\]\(([^)]+)\)", "$1"), (r"^#{1,6}\s+", ""), (r"^[-*+]\s+", ""), (r"\*\*", ""), (r"`+", "")):
            s = F.regexp_replace(s, pattern, by)
        return F.trim(s)

    return let(squeeze(c), lambda s: F.when(s.rlike(r"[\[`]|\*\*|^[#*+-]"), without_marks(s)).otherwise(s))


def quote_window(source: Column | str, value: Column | str, before: int = 28, after: int = 40) -> Column:
    """The text around the first place of value; empty where there is none."""

    def cut(s: Column, v: Column, at: Column) -> Column:
        start = F.greatest(F.lit(0), at - before)
        end = F.least(F.length(s), at + F.length(v) + after)
        return F.when((v != "") & (at >= 0), F.substr(s, start + 1, end - start)).otherwise("")

    return let(blank(source), lambda s: let(squeeze(value), lambda v: let(F.instr(s, v) - 1, lambda at: cut(s, v, at))))


def excerpt_around(source: Column | str, pattern: str, before: int = 800, after: int = 4000) -> Column:
    """The text around the first match of pattern; the beginning where there is none."""

    def cut(s: Column, at: Column) -> Column:
        start = F.greatest(F.lit(0), at - before)
        return F.substr(s, start + 1, at + after - start)

    return let(blank(source), lambda s: let(F.greatest(F.regexp_instr(s, F.lit(pattern)) - 1, F.lit(0)), lambda at: cut(s, at)))


# --- Identities and similarity -----------------------------------------------------------------------------------------------


def event_identity(identity: Column | str, title: Column | str) -> Column:
    s = F.lower(F.coalesce(F.nullif(blank(identity), F.lit("")), blank(title)))
    s = F.regexp_replace(s, r"(?i)[（(]转载[）)]|[（(]改写[）)]|[-|｜].*(?:转载|改写).*$", "")
    s = F.regexp_replace(s, r"原标题\s*[:：]", "")
    return F.substring(F.regexp_replace(s, NOT_LETTER, ""), 1, 240)


def letters(c: Column | str) -> Column:
    """Lower case without white space, punctuation and symbols."""
    return F.regexp_replace(F.lower(squeeze(c)), NOT_LETTER, "")


def selection_key(identity: Column | str, title: Column | str, url: Column | str) -> Column:
    key = letters(first_text(identity, title))
    return F.when(key != "", key).otherwise(F.concat(F.lower(squeeze(url)), F.lit("|"), F.regexp_replace(squeeze(title), f"{SPACE}+", "")))


def title_key(c: Column | str) -> Column:
    """Letters, digits and ideographs of a title, without what follows the last dash."""
    s = F.regexp_replace(squeeze(c), r"\s*[-_|｜—]\s*[^-_|｜—]{1,20}$", "")
    return F.regexp_replace(F.lower(s), r"[^一-鿿a-z0-9]", "")


def bigrams(c: Column | str, stop: str = lx.TITLE_STOP) -> Column:
    """Distinct pairs of neighbouring letters, after dates and stop words are taken out; a single letter stands for itself."""
    plain = F.regexp_replace(F.lower(squeeze(c)), r"20\d{2}[年./-]\d{1,2}(?:[月./-]\d{1,2}日?)?", "")
    plain = F.regexp_replace(F.regexp_replace(plain, stop, ""), r"[^\p{L}\p{N}]", "")

    def pairs(s: Column) -> Column:
        n = F.length(s)
        return F.when(n >= 2, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substr(s, i, F.lit(2))))).when(n == 1, F.array(s)).otherwise(F.array().cast("array<string>"))

    return let(plain, pairs)


def overlap(a: Column, b: Column) -> Column:
    """Shared members by the smaller set's size; 0 for an empty one."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(F.lit(0.0))


# --- Messages -------------------------------------------------------------------------------------------------------------------


@F.pandas_udf(ArrayType(StringType()))
def split_bytes(texts: pd.Series, limits: pd.Series) -> pd.Series:
    """Pieces of at most so many UTF-8 bytes, cut between characters."""

    def cut(text: str | None, limit: int) -> list[str]:
        out, piece, size = [], [], 0
        for ch in text or "":
            n = len(ch.encode("utf-8", "surrogatepass"))
            if piece and size + n > limit:
                out.append("".join(piece))
                piece, size = [], 0
            piece.append(ch)
            size += n
        return out + ["".join(piece)] if piece else out

    return pd.Series([cut(t, int(n)) for t, n in zip(texts, limits, strict=True)])


def emphasize(c: Column | str, pattern: str, times: int = 3) -> Column:
    """The first matches in bold. The pattern must have no groups that capture."""
    whole = f"(?s)^(.*?)({pattern})(.*)$"

    def step(a: Column, _: Column) -> Column:
        head, m, rest = (F.regexp_extract(a["rest"], whole, i) for i in (1, 2, 3))
        done = F.concat(a["done"], head, F.lit("**"), m, F.lit("**"))
        return F.when(a["rest"].rlike(whole), F.struct(done.alias("done"), rest.alias("rest"))).otherwise(a)

    start = F.struct(F.lit("").alias("done"), squeeze(c).alias("rest"))
    return F.aggregate(F.array(*(F.lit(i) for i in range(times))), start, step, lambda a: F.concat(a["done"], a["rest"]))


def envelope(c: Column | str) -> Column:
    """A reply without its code fence, parsed as VARIANT; null if it isn't JSON."""
    return F.try_parse_json(trim(F.regexp_replace(blank(c), r"(?i)^\s*```(?:json)?\s*|\s*```\s*$", "")))
