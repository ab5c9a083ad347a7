"""Substring dedup by fixed-block anchors.

Every document is cut into non-overlapping reference blocks of BLOCK words; BLOCK is half of WINDOW, so any window of
WINDOW words that stands in a document holds one whole block of it. All blocks are indexed by hash and probed with every
rolling window of BLOCK words of every document. A hit is then extended on both sides: each window of WINDOW words that
holds a hit is looked up by a 96-bit hash, and where it also starts in a document with a smaller id its words go. Runs of
such windows are the maximal exact repeats.

Documents travel once, packed in shelves. A shelf sends each distinct hash once, as differences of sorted values, so a
passage that stands in a third of all documents is one entry for each shelf. Hashes of probes only choose candidates; the
decision is made on the long hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, shelves
from .shelves import expand, squeeze
from .wordhash import SPACE, encode, from_planes, member, pack_sorted, planes, run_hashes, run_starts, unpack_sorted, words

WINDOW = 50
_LAST = np.iinfo(np.int64).max


class Shelf:
    """Word hashes of the documents of one shelf that are long enough and have an id."""

    def __init__(self, ids: list[int | None], texts: list[str | None], window: int):
        self.ids, self.texts, self.window, self.block = ids, texts, window, window // 2
        self.hashes, self.first = words(texts, SPACE, False)
        sizes = np.diff(self.first)
        self.owner = np.repeat(np.arange(len(ids)), sizes)
        self.usable = np.array([i is not None for i in ids], bool) & (sizes >= window)
        self.doc_ids = np.array([_LAST if i is None else i for i in ids], np.int64)

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, hashes and owners of all rolling blocks."""
        ok = run_starts(self.first, self.block)
        ok &= self.usable[self.owner[: len(ok)]]
        at = np.flatnonzero(ok)
        return at, run_hashes(self.hashes, self.block)[at], self.owner[at]

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return run_hashes(self.hashes, self.window)[at], (run_hashes(self.hashes, self.window, 1)[at] >> np.uint64(32)).astype(np.uint32)

    def around(self, hits: np.ndarray) -> np.ndarray:
        """Places of the windows that hold a block which begins at one of hits."""
        ok = run_starts(self.first, self.window)
        change = np.zeros(len(self.hashes) + 1, np.int64)
        np.add.at(change, np.maximum(0, hits - (self.window - self.block)), 1)
        np.add.at(change, hits + 1, -1)
        ok &= self.usable[self.owner[: len(ok)]] & (np.cumsum(change)[: len(ok)] > 0)
        return np.flatnonzero(ok)

    def rows(self, gone: np.ndarray):
        """(doc_id, n_words, n_removed, kept words) once the windows at gone are taken out."""
        change = np.zeros(len(self.hashes) + 1, np.int64)
        np.add.at(change, gone, 1)
        np.add.at(change, gone + self.window, -1)
        out = np.cumsum(change[:-1]) > 0
        for i, text in enumerate(self.texts):
            cut = out[self.first[i] : self.first[i + 1]]
            n = int(cut.sum())
            yield i, len(cut), n, cut


def _split(codes: np.ndarray, top: int, bits: int):
    """(bucket, slice) of ascending codes of `top` bits, by their first `bits`."""
    if not len(codes):
        return
    bucket = (codes >> np.uint64(top - bits)).astype(np.int64) if bits else np.zeros(len(codes), np.int64)
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(codes)], strict=True):
        yield int(bucket[a]), slice(a, b)


def _shared_blocks(shelved: DataFrame, window: int, top: int, bits: int) -> DataFrame:
    """(shelf, bucket, codes): the hashes of a shelf's rolling blocks that are a reference block somewhere and stand more than once."""

    def send(batches):
        for pdf in batches:
            for shelf, (ids, texts) in zip(pdf["shelf"].tolist(), shelves.each(pdf), strict=True):
                s = Shelf(ids, texts, window)
                at, h, owner = s.blocks()
                codes = h >> np.uint64(64 - top)
                anchors = np.unique(codes[(at - s.first[owner]) % s.block == 0])
                distinct, n = np.unique(codes, return_counts=True)
                again = distinct[n > 1]
                a, m = dict(_split(anchors, top, bits)), dict(_split(again, top, bits))
                none = slice(0, 0)
                rows = [(shelf, b, pack_sorted(distinct[c]), squeeze(pack_sorted(anchors[a.get(b, none)])), squeeze(pack_sorted(again[m.get(b, none)]))) for b, c in _split(distinct, top, bits)]
                yield pd.DataFrame(rows, columns=["shelf", "bucket", "codes", "anchors", "again"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = [unpack_sorted(x) for x in pdf["codes"]]
        distinct, n = np.unique(np.concatenate(lists), return_counts=True)
        again = np.unique(np.concatenate([distinct[n > 1], *(unpack_sorted(expand(x)) for x in pdf["again"])]))
        anchors = np.unique(np.concatenate([unpack_sorted(expand(x)) for x in pdf["anchors"]]))
        shared = again[member(again, anchors)]
        rows = [(shelf, bucket, squeeze(pack_sorted(own))) for shelf, bucket, codes in zip(pdf["shelf"].tolist(), pdf["bucket"].tolist(), lists, strict=True) if len(own := codes[member(codes, shared)])]
        return pd.DataFrame(rows, columns=["shelf", "bucket", "codes"])

    sent = shelved.mapInPandas(send, "shelf long, bucket int, codes binary, anchors binary, again binary")
    return sent.groupBy("bucket").applyInPandas(answer, "shelf long, bucket int, codes binary")


def _codes(right: pd.DataFrame, column: str = "codes") -> np.ndarray:
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *(unpack_sorted(expand(x)) for x in right[column])]))


def _repeats(shelved: DataFrame, shared: DataFrame, window: int, top: int, bits: int) -> DataFrame:
    """(shelf, bucket, codes, everywhere): the windows of a shelf that repeat; everywhere tells those that a document with a smaller id outside the shelf has."""

    def send(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        shelves.paired(left)
        rows, hit = [], _codes(right)
        for shelf, (ids, texts) in zip(left["shelf"].tolist(), shelves.each(left), strict=True):
            s = Shelf(ids, texts, window)
            at, h, _ = s.blocks()
            at = s.around(at[member(h >> np.uint64(64 - top), hit)])
            h1, h2 = s.windows(at)
            doc = s.doc_ids[s.owner[at]]
            order = np.lexsort((doc, h2, h1))
            h1, h2, doc = h1[order], h2[order], doc[order]
            new = np.ones(len(h1), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            group = np.cumsum(new) - 1
            many = np.zeros(int(new.sum()), bool)
            many[group[doc != doc[new][group]]] = True
            h1, h2, doc = h1[new], h2[new], doc[new]
            rows += [(shelf, b, pack_sorted(h1[c]), planes(h2[c]), squeeze(planes(doc[c])), squeeze(np.packbits(many[c]).tobytes())) for b, c in _split(h1, 64, bits)]
        return pd.DataFrame(rows, columns=["shelf", "bucket", "h1", "h2", "doc", "many"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        h1 = [unpack_sorted(x) for x in pdf["h1"]]
        size = [len(x) for x in h1]
        h2 = np.concatenate([from_planes(x, np.uint32) for x in pdf["h2"]])
        doc = np.concatenate([from_planes(expand(x), np.int64) for x in pdf["doc"]])
        many = np.concatenate([np.unpackbits(np.frombuffer(expand(x), np.uint8), count=n).astype(bool) for x, n in zip(pdf["many"], size, strict=True)])
        all_h1 = np.concatenate(h1)
        order = np.lexsort((doc, h2, all_h1))
        a, b, d = all_h1[order], h2[order], doc[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        least = np.empty(len(a), np.int64)
        least[order] = d[new][np.cumsum(new) - 1]
        elsewhere, rows, at = least < doc, [], 0
        for shelf, bucket, n in zip(pdf["shelf"].tolist(), pdf["bucket"].tolist(), size, strict=True):
            part = slice(at, at + n)
            at += n
            keep = elsewhere[part] | many[part]
            if keep.any():
                own, flag = all_h1[part][keep], elsewhere[part][keep]
                rows.append((shelf, bucket, squeeze(planes(own)), squeeze(planes(h2[part][keep])), squeeze(np.packbits(flag).tobytes())))
        return pd.DataFrame(rows, columns=["shelf", "bucket", "h1", "h2", "elsewhere"])

    sent = shelved.groupBy("shelf").cogroup(shared.groupBy("shelf")).applyInPandas(send, "shelf long, bucket int, h1 binary, h2 binary, doc binary, many binary")
    return sent.groupBy("bucket").applyInPandas(answer, "shelf long, bucket int, h1 binary, h2 binary, elsewhere binary")


def _apply(shelved: DataFrame, repeats: DataFrame, window: int, finish, schema: str) -> DataFrame:
    """finish(shelf, places of windows that go) for each shelf."""

    def last(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        shelves.paired(left)
        h1 = [from_planes(expand(x), np.uint64) for x in right["h1"]]
        h2 = [from_planes(expand(x), np.uint32) for x in right["h2"]]
        far = [np.unpackbits(np.frombuffer(expand(x), np.uint8), count=len(n)).astype(bool) for x, n in zip(right["elsewhere"], h1, strict=True)]
        key = np.concatenate([np.zeros(0, np.uint64), *h1])
        key2, away = np.concatenate([np.zeros(0, np.uint32), *h2]), np.concatenate([np.zeros(0, bool), *far])
        order = np.lexsort((key2, key))
        key, key2, away = key[order], key2[order], away[order]
        if len(key):  # shelves of equal contents get their answers twice
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (key2[1:] != key2[:-1])
            group = np.cumsum(new) - 1
            any_away = np.zeros(int(new.sum()), bool)
            any_away[group[away]] = True
            key, key2, away = key[new], key2[new], any_away
        rows = []
        for k, (ids, texts) in enumerate(shelves.each(left)):
            s = Shelf(ids, texts, window)
            ok = run_starts(s.first, window)
            ok &= s.usable[s.owner[: len(ok)]]
            at = np.flatnonzero(ok)
            h = run_hashes(s.hashes, window)[at] if len(key) else np.zeros(0, np.uint64)
            at = at[member(h, key)] if len(key) else at[:0]
            gone = at[:0]
            if len(at):
                a, b = s.windows(at)
                place = _find(key, key2, a, b)
                at, place = at[place >= 0], place[place >= 0]
                doc = s.doc_ids[s.owner[at]]
                least = np.full(len(key), _LAST, np.int64)
                np.minimum.at(least, place, doc)
                gone = at[away[place] | (doc > least[place])]
            rows += finish(s, gone)
        return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return shelved.groupBy("shelf").cogroup(repeats.groupBy("shelf")).applyInPandas(last, schema)


def _find(key: np.ndarray, key2: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the pairs (a, b) among the ascending pairs (key, key2), else -1."""
    at = np.searchsorted(key, a, "left")
    out = np.full(len(a), -1, np.int64)
    open_ = np.arange(len(a))
    while len(open_):  # equal first hashes with unlike second ones are rare, so this ends at once
        i = at[open_]
        ok = (i < len(key)) & (key[np.minimum(i, len(key) - 1)] == a[open_])
        open_, i = open_[ok], i[ok]
        same = key2[i] == b[open_]
        out[open_[same]] = i[same]
        open_ = open_[~same]
        at[open_] += 1
    return out


def _run(docs: DataFrame, window: int, finish, schema: str, shelf_bytes: int) -> DataFrame:
    if window < 2:
        raise ValueError("a window has two words at least")
    total = common.text_bytes(docs)
    bits = shelves.buckets(total)
    top = min(60, 12 + common.bits_for(total))  # of the probes' hashes: few of the candidates they choose are chance
    shelved = shelves.shelve(docs, shelf_bytes=shelf_bytes)
    shared = _shared_blocks(shelved, window, top, min(bits, top))
    return _apply(shelved, _repeats(shelved, shared, window, top, bits), window, finish, schema)


def removed_words(docs: DataFrame, window: int = WINDOW, shelf_bytes: int = shelves.SHELF_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row.

    Null and empty texts have no words. Rows without an id lose nothing and nothing is removed because of them; rows with
    the same id count as one document for each other, so neither loses words to the other. Other columns aren't read; an
    empty table gives no rows. docs has to give its rows in the same order whenever a part of it is read again, as a
    written table does; if it doesn't, the job ends with an error.
    """

    def finish(s: Shelf, gone: np.ndarray):
        for i, n_words, n_removed, cut in s.rows(gone):
            own = encode(s.texts[i]).split()
            kept = b" ".join([w for w, c in zip(own, cut.tolist(), strict=True) if not c] if n_removed else own)
            yield s.ids[i], n_words, n_removed, hashlib.sha256(kept).hexdigest()

    return _run(docs, window, finish, "doc_id long, n_words long, n_removed long, kept_sha256 string", shelf_bytes)


def kept_texts(docs: DataFrame, window: int = WINDOW, shelf_bytes: int = shelves.SHELF_BYTES) -> DataFrame:
    """(doc_id, n_removed, text, text_md5) of every row, the last of the text as it was: a text that loses words is its kept words joined by blanks, another stays as it is."""

    def finish(s: Shelf, gone: np.ndarray):
        for i, _, n_removed, cut in s.rows(gone):
            text = s.texts[i]
            was = None if text is None else hashlib.md5(encode(text)).hexdigest()
            if n_removed:
                text = b" ".join([w for w, c in zip(encode(text).split(), cut.tolist(), strict=True) if not c]).decode("utf-8", "surrogatepass")
            yield s.ids[i], n_removed, text, was

    return _run(docs, window, finish, "doc_id long, n_removed long, text string, text_md5 string", shelf_bytes)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_words(common.table(spark, sf_dir, "documents"))


QUERIES = {"op8_substring_dedup": op8_substring_dedup}
ORACLES: dict[str, str] = {}
