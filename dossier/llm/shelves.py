"""Shelves: documents packed by the batch into single compressed rows, so that whole texts are shuffled once and small.

A shelf is a run of documents of about SHELF_BYTES of text that one task has read. Operators that need something about the
contents of all documents (distinct words, equal word runs) send a compact digest of each shelf to buckets, get an answer
back by shelf, and join it with the shelf's texts. One value that stands in a third of all rows is one entry in each shelf's
digest, so no bucket gets more than one entry of it from a shelf.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wordhash import encode

SHELF_BYTES = 4 << 20
_NULL = -1


def squeeze(data: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level, write_content_size=True).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack(ids: list, texts: list[str | None]) -> tuple[int, bytes, bytes, bytes]:
    """(shelf, doc ids, lengths, texts); the shelf's number is a hash of what it holds."""
    enc = [encode(t) for t in texts]
    known = np.array([0 if i is None or i != i else int(i) for i in ids], np.int64)
    sizes = np.array([_NULL if t is None else len(e) for t, e in zip(texts, enc, strict=True)], np.int64)
    nulls = np.array([i is None or i != i for i in ids], np.uint8)
    blob = b"".join(enc)
    shelf = xxhash.xxh64_intdigest(known.tobytes() + sizes.tobytes() + nulls.tobytes(), xxhash.xxh64_intdigest(blob) & 0xFFFFFFFF)
    return int(np.uint64(shelf).view(np.int64)), squeeze(known.tobytes() + nulls.tobytes()), squeeze(sizes.tobytes()), squeeze(blob, 3)


def unpack(ids: bytes, sizes: bytes, blob: bytes) -> tuple[list[int | None], list[str | None]]:
    n_bytes = np.frombuffer(expand(sizes), np.int64)
    raw = expand(ids)
    known, nulls = np.frombuffer(raw[: 8 * len(n_bytes)], np.int64).tolist(), raw[8 * len(n_bytes) :]
    data, at, texts = expand(blob), 0, []
    for n in n_bytes.tolist():
        texts.append(None if n == _NULL else data[at : at + n].decode("utf-8", "surrogatepass"))
        at += max(0, n)
    return [None if z else k for k, z in zip(known, nulls, strict=True)], texts


def shelve(docs: DataFrame, partitions: int | None = None, shelf_bytes: int = SHELF_BYTES) -> DataFrame:
    """(shelf, part, ids, sizes, blob) dealt out by shelf. part tells apart shelves of equal contents."""

    def rows(batches):
        ids, texts, size = [], [], 0
        for pdf in batches:
            for i, t in zip(pdf["doc_id"].tolist(), pdf["text"].tolist(), strict=True):
                ids.append(i)
                texts.append(t)
                size += len(t) if t else 1
                if size >= shelf_bytes:
                    yield pd.DataFrame([pack(ids, texts)], columns=["shelf", "ids", "sizes", "blob"])
                    ids, texts, size = [], [], 0
        if ids:
            yield pd.DataFrame([pack(ids, texts)], columns=["shelf", "ids", "sizes", "blob"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    packed = slim.mapInPandas(rows, "shelf long, ids binary, sizes binary, blob binary")
    return packed.repartition(partitions, "shelf") if partitions else packed.repartition("shelf")


def paired(shelves: pd.DataFrame) -> None:
    """Ends the job where an answer has no shelf: a task that ran again packed its rows in another way, so shelves were lost."""
    if not len(shelves):
        raise RuntimeError("an answer came back for a shelf that isn't there; its input changed between two reads")


def each(pdf: pd.DataFrame):
    """(doc ids, texts) of the shelves in a frame."""
    for ids, sizes, blob in zip(pdf["ids"], pdf["sizes"], pdf["blob"], strict=True):
        yield unpack(ids, sizes, blob)


def buckets(total_bytes: int, each_bytes: int = 12 << 20) -> int:
    """So many bits that a bucket gets the digests of about each_bytes of text."""
    return max(0, int(np.ceil(np.log2(max(1, total_bytes / each_bytes)))))
