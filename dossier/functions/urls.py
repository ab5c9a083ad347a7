"""URL identities. Each differs in what it drops, so each is kept by itself; all are Column expressions over one parse."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import lexicons as lx
from .text import blank, col, first_text, squeeze, trim

_PARTS = r"(?i)^([a-z][a-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::(\d+))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


class Url:
    """The parts of an absolute address, lower-cased scheme and host; `ok` tells whether it is one."""

    def __init__(self, c: Column | str):
        self.raw = trim(c)
        self.scheme, self.host = F.lower(self._part(1)), F.lower(self._part(2))
        port = self._part(3)
        default = ((self.scheme == "http") & (port == "80")) | ((self.scheme == "https") & (port == "443"))
        self.port = F.when((port == "") | default, F.lit("")).otherwise(F.concat(F.lit(":"), port))
        self.path = F.coalesce(F.nullif(self._part(4), F.lit("")), F.lit("/"))
        self.query = self._part(5)
        self.ok = self.raw.rlike(_PARTS) & (self.host != "")
        self.origin = F.concat(self.scheme, F.lit("://"), self.host, self.port)

    def _part(self, i: int) -> Column:
        return F.regexp_extract(self.raw, _PARTS, i)

    def pairs(self) -> Column:
        """Parameters as array<struct<k, v>>, in order."""
        parts = F.filter(F.split(self.query, "&"), lambda p: p != "")
        return F.transform(parts, lambda p: F.struct(F.regexp_extract(p, r"^([^=]*)", 1).alias("k"), F.regexp_extract(p, r"^[^=]*=(.*)$", 1).alias("v")))


def _text(pairs: Column, equals: bool = True) -> Column:
    joined = F.array_join(F.transform(pairs, lambda p: F.concat(p["k"], F.lit("="), p["v"])), "&")
    return F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise("")


def dedup_key(c: Column | str) -> Column:
    """The key by which an article is known over weeks: no fragment, tracking parameters, default port, mobile label, path alias or trailing slash; parameters by lower-cased name."""
    u = Url(c)
    kept = F.filter(F.transform(u.pairs(), lambda p: F.struct(F.lower(p["k"]).alias("k"), p["v"].alias("v"))), lambda p: ~p["k"].isin(lx.TRACKING_KEYS) & ~p["k"].startswith("utm_"))
    at = F.transform(kept, lambda p, i: F.struct(p["k"].alias("k"), i.alias("i"), p["v"].alias("v")))
    ordered = F.array_sort(at)
    labels = F.split(u.host, r"\.")
    mobile = (F.size(labels) > 2) & F.get(labels, F.lit(0)).isin(lx.MOBILE_LABELS)
    host = F.when(mobile, F.array_join(F.slice(labels, 2, F.size(labels)), ".")).otherwise(u.host)
    path = u.path
    for pattern, prefix in lx.PATH_ALIASES.items():
        path = F.when(host.rlike(pattern) & path.startswith(prefix), F.concat(F.lit("/"), F.substr(path, F.lit(len(prefix) + 1)))).otherwise(path)
    key = F.concat(u.scheme, F.lit("://"), host, u.port, F.regexp_replace(path, r"/+$", ""), _text(ordered))
    bare = F.regexp_replace(F.regexp_replace(u.raw, r"#.*$", ""), r"/+$", "")
    return F.when(u.ok, key).otherwise(bare)


_SOURCE_TRACKING = r"(?i)^(?:utm_.+|fbclid|gclid|spm|from|source)$"


def _source(c: Column | str, scheme: bool) -> Column:
    u = Url(c)
    kept = F.filter(u.pairs(), lambda p: ~p["k"].rlike(_SOURCE_TRACKING))
    ordered = F.array_sort(F.transform(kept, lambda p, i: F.struct(p["k"].alias("k"), i.alias("i"), p["v"].alias("v"))))
    path = F.coalesce(F.nullif(F.regexp_replace(u.path, r"/$", ""), F.lit("")), F.lit("/"))
    key = F.concat(u.origin if scheme else u.host, path, _text(ordered))
    return F.when(u.raw.rlike(r"(?i)^https?://") & u.ok, F.regexp_replace(key, r"/$", "")).otherwise(F.regexp_replace(u.raw, r"/$", ""))


def source_key(c: Column | str) -> Column:
    """No fragment or tracking parameters, sorted parameters, one trailing slash less."""
    return _source(c, True)


def identity_key(c: Column | str) -> Column:
    """As source_key, without scheme and port."""
    return _source(c, False)


def record_key(c: Column | str) -> Column:
    """Origin, path without trailing slashes, all parameters as they are."""
    u = Url(c)
    query = F.when(u.query != "", F.concat(F.lit("?"), u.query)).otherwise("")
    return F.when(u.ok, F.concat(u.origin, F.regexp_replace(u.path, r"/+$", ""), query)).otherwise(u.raw)


def display_key(c: Column | str) -> Column:
    """For the shown report: no fragment, few tracking parameters, parameters in their order; text that is no address in lower case."""
    u = Url(c)
    kept = F.filter(u.pairs(), lambda p: ~p["k"].rlike(r"(?i)^(?:utm_|spm$|from$|source$|ref$)"))
    path = F.coalesce(F.nullif(F.regexp_replace(u.path, r"/+$", ""), F.lit("")), F.lit("/"))
    return F.when(u.ok, F.concat(u.origin, path, _text(kept))).otherwise(F.lower(squeeze(u.raw)))


def host(c: Column | str) -> Column:
    """Host of an address, else an empty string."""
    u = Url(c)
    return F.when(u.ok, u.host).otherwise("")


def publisher_host(given: Column | str, *urls: Column | str) -> Column:
    """The given host, else that of the first address; lower case without `www.`."""
    return F.regexp_replace(F.lower(F.coalesce(F.nullif(squeeze(given), F.lit("")), host(first_text(*urls)))), r"^www\.", "")


def is_http(c: Column | str) -> Column:
    return trim(c).rlike(r"(?i)^https?://")


def is_article(c: Column | str, aggregator: str = lx.AGGREGATOR_HOST) -> Column:
    """A publisher's own page: not an aggregator's, a root or an index."""
    u = Url(c)
    return u.ok & u.scheme.isin("http", "https") & ~u.host.rlike(aggregator) & (u.path != "/") & ~u.path.rlike(r"(?i)/index(?:\.html?)?$")


def is_root_or_index(c: Column | str) -> Column:
    u = Url(c)
    path = F.regexp_replace(u.path, "/+", "/")
    return u.ok & path.rlike(r"(?i)^/(?:index\.html?)?$|/(?:xw|ggjgs|zwgk|hdjl|bsfw|xxgk)/(?:index\.html?)?$")


def is_portal(c: Column | str) -> Column:
    u = Url(c)
    official = u.host.rlike(r"(?i)(?:^|\.)(?:gov\.cn|samr\.gov\.cn|nmpa\.gov\.cn|cnipa\.gov\.cn|customs\.gov\.cn)$")
    door = u.path.rlike(r"(?i)^(?:/|/index(?:\.html?)?|/portal/(?:en/)?index(?:\.html?)?|/(?:syx|pub/sfbgw|customs/syx)/?index(?:\.html?)?)$")
    return is_http(c) & u.ok & (door | (official & u.path.rlike(r"(?i)^/(?:[a-z0-9_-]+/)?$")))


def with_scheme(c: Column | str) -> Column:
    """Bare `www.` addresses with a scheme."""
    s = trim(c)
    return F.when(F.lower(s).startswith("www."), F.concat(F.lit("https://"), s)).otherwise(s)


def without_label(c: Column | str) -> Column:
    """A link target without the title that Markdown puts behind it."""
    s = trim(c)
    return F.coalesce(F.nullif(F.regexp_extract(s, r"(?i)^(\S+?\.s?html?)\b", 1), F.lit("")), F.regexp_extract(s, r"^(\S*)", 1))


def last_segment(c: Column | str, under: str = "articles|read") -> Column:
    """The path segment below one of these, else an empty string."""
    return F.regexp_extract(Url(c).path, rf"(?:^|/)(?:{under})/([^/]+)/?$", 1)


@F.pandas_udf(StringType())
def _resolve(hrefs: pd.Series, bases: pd.Series) -> pd.Series:
    def one(href: str | None, base: str | None) -> str:
        try:
            out = urljoin(base or "", (href or "").strip())
        except ValueError:
            return ""
        return out if out.lower().startswith(("http://", "https://")) else ""

    return pd.Series([one(h, b) if h else "" for h, b in zip(hrefs, bases, strict=True)])


def resolve(href: Column | str, base: Column | str) -> Column:
    """An absolute http address from a link and the page it stands on, else an empty string."""
    return _resolve(col(href), col(base))


def attachments(markdown: Column | str, base: Column | str) -> Column:
    """Links to documents, absolute ones and those below the page's origin, each once."""
    found = F.regexp_extract_all(blank(markdown), F.lit(r"(?i)\(([^()\s]+\.(?:pdf|docx?|xlsx?|csv|zip)(?:\?[^()\s]*)?)\)"), 1)
    u = Url(base)
    whole = F.transform(found, lambda h: F.when(is_http(h), h).when(h.startswith("/"), F.concat(u.origin, h)).otherwise(F.concat(u.origin, F.regexp_replace(u.path, r"[^/]*$", ""), h)))
    return F.array_distinct(whole)
