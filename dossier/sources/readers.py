"""Readers: catalogs in workbooks, JSON envelopes, feeds, crawled records and state files, all as DataFrames with `ord`."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from .. import lexicons as lx
from ..functions.text import blank, squeeze, trim
from ..functions.urls import is_http, is_portal, with_scheme

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def _sheet_rows(data: bytes) -> Iterator[tuple[int, dict[str, str]]]:
    """Rows of a workbook's first sheet that hold a value: number and text by column letter."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
        first = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))[0]
        for row in ElementTree.fromstring(z.read(first)).iter(f"{{{_NS['m']}}}row"):
            cells: dict[str, str] = {}
            for c in row.findall("m:c", _NS):
                v, inline = c.find("m:v", _NS), c.find("m:is", _NS)
                text = "".join(t.text or "" for t in inline.iter(f"{{{_NS['m']}}}t")) if inline is not None else (v.text or "" if v is not None else "")
                if c.get("t") == "s" and text:
                    text = shared[int(text)]
                if text.strip():
                    cells[re.match(r"[A-Z]+", c.get("r", "A"))[0]] = text.strip()
            if cells:
                yield int(row.get("r", "0")), cells


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """(path, row, cells map<string,string>) of the first sheets of workbooks; each workbook is one task's small file."""

    def rows(batches):
        for pdf in batches:
            for p, data in zip(pdf["path"], pdf["content"], strict=True):
                got = list(_sheet_rows(data))
                yield pd.DataFrame({"path": p, "row": [r for r, _ in got], "cells": [c for _, c in got]})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(rows, "path string, row int, cells map<string,string>")


def catalog(rows: DataFrame, columns: dict[str, str], fill_down: str | None = "module", header: str = "序号") -> DataFrame:
    """Sources from workbook rows: columns maps names to letters; blank modules take the one above; the header row and rows without name or address go.

    `id` counts the sources of a workbook from 1; first of each name, address and module.
    """
    df = rows.where(F.coalesce(F.try_element_at("cells", F.lit("A")), F.lit("")) != header)
    df = df.select("path", "row", *(squeeze(F.try_element_at("cells", F.lit(letter))).alias(name) for name, letter in columns.items()))
    if fill_down:
        down = Window.partitionBy("path").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
        df = df.withColumn(fill_down, F.last(F.nullif(F.col(fill_down), F.lit("")), ignorenulls=True).over(down))
    df = df.where((F.col("name") != "") & (F.col("url") != "")).withColumn("url", with_scheme("url"))
    key = Window.partitionBy("path", "name", "url", "module").orderBy("row")
    df = df.withColumn("_first", F.row_number().over(key)).where("_first = 1").drop("_first")
    return df.withColumn("id", F.row_number().over(Window.partitionBy("path").orderBy("row"))).withColumn("ord", F.col("row").cast("long"))


def with_scope(sources: DataFrame) -> DataFrame:
    """source_scope where it isn't given: portal or list."""
    default = F.when(is_portal("url"), "portal").otherwise("hard_fact_list")
    given = F.nullif(blank("source_scope"), F.lit("")) if "source_scope" in sources.columns else F.lit(None).cast("string")
    return sources.withColumn("source_scope", F.coalesce(given, default))


def rule_label(text: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The label of the first pattern that fits."""
    return F.coalesce(*(F.when(text.rlike(p), F.lit(label)) for p, label in rules), F.lit(default))


def slug(name: Column | str, index: Column | str) -> Column:
    """Host letters and a padded number."""
    host = F.regexp_replace(F.lower(blank(name)), r"[^a-z0-9]+", "-")
    i = F.col(index) if isinstance(index, str) else index
    return F.concat(F.regexp_replace(host, r"^-+|-+$", ""), F.lit("-"), F.lpad(i.cast("string"), 3, "0"))


def envelope_rows(texts: DataFrame, column: str, schema: str, keys: tuple[str, ...] = ("records", "candidates", "sources")) -> DataFrame:
    """Rows of JSON texts that are a bare array or hold one under a key, the first that is there; `ord` is (text, place)."""
    bare = F.from_json(column, f"array<struct<{schema}>>")
    inner = F.from_json(column, f"struct<{', '.join(f'{k}: array<struct<{schema}>>' for k in keys)}>")
    rows = F.when(trim(column).startswith("["), bare).otherwise(F.coalesce(*(inner[k] for k in keys)))
    return texts.select(F.posexplode(rows).alias("ord", "r")).select(F.col("ord").cast("long").alias("ord"), "r.*")


def first_payload(spark: SparkSession, inline: str = "", file: str = "", fetch: Callable[[], str] | None = None) -> DataFrame:
    """(value) of the first that is given: inline JSON, a file, a fetched text; else no rows."""
    if inline.strip():
        return spark.createDataFrame([(inline,)], "value string")
    if file:
        return spark.read.text(file, wholetext=True)
    return spark.createDataFrame([(fetch(),)] if fetch else [], "value string")


def feed_items(feeds: DataFrame, column: str, module: str) -> DataFrame:
    """Items of RSS texts that have a title, an aggregator's link and a date: title without the source behind it, day in UTC."""
    items = F.regexp_extract_all(blank(column), F.lit(r"(?s)<item\b[^>]*>(.*?)</item>"), 1)
    df = feeds.select(F.col(module).alias("module"), F.posexplode(items).alias("ord", "item"))

    def tag(name: str) -> Column:
        raw = F.regexp_extract("item", rf"(?s)<{name}\b[^>]*>(.*?)</{name}>", 1)
        out = F.regexp_replace(raw, r"(?s)^\s*<!\[CDATA\[(.*?)\]\]>\s*$", "$1")
        for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
            out = F.replace(out, F.lit(a), F.lit(b))
        return trim(out)

    source, raw = tag("source"), tag("title")
    suffix = F.concat(F.lit(" - "), source)
    title = F.when((source != "") & F.endswith(raw, suffix), trim(F.substr(raw, F.lit(1), F.length(raw) - F.length(suffix)))).otherwise(raw)
    # "Mon, 02 Jan 2026 03:04:05 GMT": the week day isn't needed
    stamp = F.try_to_timestamp(F.regexp_replace(F.regexp_replace(tag("pubDate"), r"^\w+,\s*", ""), r"\s*(?:GMT|UTC|\+0000)$", ""), F.lit("d MMM yyyy HH:mm:ss"))
    out = df.select(
        F.col("ord").cast("long").alias("ord"), title.alias("title"), tag("link").alias("discovery_url"), source.alias("source_name"),
        F.regexp_extract("item", r"(?s)<source\b[^>]*?url=[\"']([^\"']*)[\"']", 1).alias("publisher_url"), F.date_format(stamp, "yyyy-MM-dd").alias("published_at"), "module",
    )
    return out.where((F.col("title") != "") & F.col("discovery_url").rlike(r"(?i)^https://news\.google\.com/") & F.col("published_at").isNotNull())


def news_api_items(texts: DataFrame, column: str) -> DataFrame:
    """Articles of a JSON news reply; compact days get dashes."""
    rows = F.from_json(column, "struct<articles: array<struct<url: string, title: string, seendate: string, domain: string>>>")["articles"]
    out = texts.select(F.posexplode(rows).alias("ord", "a")).select(F.col("ord").cast("long").alias("ord"), "a.*")
    return out.withColumn("published_at", F.regexp_replace(blank("seendate"), r"^(\d{4})(\d{2})(\d{2}).*$", "$1-$2-$3")).where(is_http("url"))


def decoding_params(html: Column | str) -> Column:
    """struct<timestamp, signature> of an aggregator's page; null unless both are there."""
    t, s = (F.regexp_extract(blank(html), rf"(?i)data-n-a-{k}=[\"']([^\"']+)[\"']", 1) for k in ("ts", "sg"))
    return F.when((t != "") & (s != ""), F.struct(t.alias("timestamp"), s.alias("signature")))


def batch_target(reply: Column | str) -> Column:
    """The first address outside the aggregator in a prefixed multi-part reply; else an empty string."""
    parts = F.split(blank(reply), r"\n\n")
    plain = F.transform(parts, lambda p: F.regexp_replace(F.replace(p, F.lit("\\"), F.lit("")), r"^\)\]\}'\s*", ""))
    found = F.filter(F.transform(plain, lambda p: F.regexp_extract(p, r"\"Fbv4je\".*?\"(https?://(?!news\.google\.com)[^\"]+)\"", 1)), lambda u: u != "")
    return F.coalesce(F.get(found, F.lit(0)), F.lit(""))


def resolved(candidates: DataFrame, replay: DataFrame) -> DataFrame:
    """Candidates with what a resolver has found for their discovery_url: replay (discovery_url, url, reason)."""
    out = candidates.join(replay.dropDuplicates(["discovery_url"]).select("discovery_url", "url", "reason"), "discovery_url", "left")
    ok = is_http("url") & ~blank("url").rlike(lx.AGGREGATOR_HOST)
    return out.withColumn("resolution_status", F.when(ok, "resolved").otherwise("failed")).withColumn("resolution_reason", F.when(ok, "").otherwise(F.coalesce("reason", F.lit("not-resolved")))).drop("reason")


def fetched(rows: DataFrame, client: Callable[[str], tuple[int, str, str]], url: str = "url", parallel: int = 8) -> DataFrame:
    """Rows with status, html and error of what a client gets; an error is a row, not a failed task. `ord` keeps the order."""
    out = StructType([*rows.schema.fields, StructField("status", IntegerType()), StructField("html", StringType()), StructField("error", StringType())])

    def get(batches):
        for pdf in batches:
            got = []
            for u in pdf[url]:
                try:
                    status, html, _ = client(u)
                    got.append((status, html, ""))
                except Exception as e:  # noqa: BLE001  any failure of one page is that page's result
                    got.append((0, "", str(e)[:240]))
            yield pdf.assign(status=[g[0] for g in got], html=[g[1] for g in got], error=[g[2] for g in got])

    return rows.repartition(parallel).mapInPandas(get, out)
