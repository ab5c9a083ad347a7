"""BPE encoding and decoding through a table of distinct words.

Documents are packed into shelves. Each shelf sends its distinct pre-tokens, by a hash of the word, to buckets; a bucket
encodes each distinct word once for the whole corpus and answers each shelf with the ids of its words, in the order they were
sent. The shelf joins ids back by position. Decoding joins the ids of a document, in their order, with the table of pieces
by id: the table is as long as the vocabulary, so it is held by each task as one run of bytes with the place of each piece,
and the join is made for a whole document at once. decode_documents() is the same join as DataFrames. Words travel sorted
and compressed, once for each shelf however often they stand in it.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, shelves
from .encoder import BYTE_FILE, Encoder, encoder, vocabulary_path
from .shelves import expand, squeeze
from .wordhash import encode, from_planes, planes

#: Larger shelves here: a word travels once for each shelf it stands in.
SHELF_BYTES = 8 << 20
#: Between words; no UTF-8 text holds this byte.
_STOP = b"\xff"


def _bucketed(texts: list[str | None], path: str, bits: int) -> dict[int, list[bytes]]:
    """Sorted distinct pre-tokens of the texts by bucket."""
    e, distinct = encoder(path), set()
    for t in texts:
        if t:
            distinct.update(e.words(t))
    out: dict[int, list[bytes]] = {}
    for w in sorted(encode(w) for w in distinct):
        out.setdefault(xxhash.xxh32_intdigest(w) >> (32 - bits) if bits else 0, []).append(w)
    return out


def _word_ids(shelved: DataFrame, path: str, bits: int) -> DataFrame:
    """(shelf, bucket, sizes, ids): for each shelf and bucket, how many ids each of its words has, and the ids."""

    def send(batches):
        for pdf in batches:
            for shelf, (_, texts) in zip(pdf["shelf"].tolist(), shelves.each(pdf), strict=True):
                rows = [(shelf, b, squeeze(_STOP.join(words))) for b, words in _bucketed(texts, path, bits).items()]
                yield pd.DataFrame(rows, columns=["shelf", "bucket", "words"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        e = encoder(path)
        lists = [expand(x).split(_STOP) for x in pdf["words"]]
        distinct = sorted(set().union(*lists))
        known = dict(zip(distinct, e.encode_bytes([w.decode("utf-8", "surrogatepass") for w in distinct]), strict=True))
        rows = []
        for shelf, bucket, words in zip(pdf["shelf"].tolist(), pdf["bucket"].tolist(), lists, strict=True):
            got = [known[w] for w in words]
            rows.append((shelf, bucket, squeeze(planes(np.array([len(g) // 4 for g in got], np.uint32))), squeeze(planes(np.frombuffer(b"".join(got), "<u4")))))
        return pd.DataFrame(rows, columns=["shelf", "bucket", "n_ids", "word_ids"])

    sent = shelved.mapInPandas(send, "shelf long, bucket int, words binary")
    return sent.groupBy("bucket").applyInPandas(answer, "shelf long, bucket int, n_ids binary, word_ids binary")


def _joined(shelved: DataFrame, word_ids: DataFrame, path: str, bits: int, finish, schema: str) -> DataFrame:
    """finish(doc ids, texts, words of a text, ids by word) for each shelf, once the ids of its words have come back."""

    def join(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        shelves.paired(left)
        answers = {b: (expand(n), expand(i)) for b, n, i in zip(right["bucket"].tolist(), right["n_ids"], right["word_ids"], strict=True)}
        e, rows = encoder(path), []
        for k, (ids, texts) in enumerate(shelves.each(left)):
            if k and left["shelf"].iloc[k] != left["shelf"].iloc[0]:
                raise RuntimeError("shelves were mixed")
            if k == 0:
                table: dict[str, bytes] = {}
                for b, words in _bucketed(texts, path, bits).items():
                    n, got = from_planes(answers[b][0], np.uint32), from_planes(answers[b][1], np.uint32).astype("<u4").tobytes()
                    ends = (np.cumsum(n, dtype=np.int64) * 4).tolist()
                    if len(ends) != len(words):
                        raise RuntimeError("another number of words came back than was sent")
                    at = 0
                    for w, end in zip(words, ends, strict=True):
                        table[w.decode("utf-8", "surrogatepass")] = got[at:end]
                        at = end
            rows += finish(e, ids, texts, table)
        return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    left = shelved.groupBy("shelf")
    return left.cogroup(word_ids.groupBy("shelf")).applyInPandas(join, schema)


@lru_cache(4)
def piece_places(e: Encoder) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The id-to-piece table: all pieces one after the other, and where the piece of each id begins and how long it is."""
    size = np.array([len(p) for p in e.pieces], np.int64)
    return np.frombuffer(b"".join(e.pieces), np.uint8), np.cumsum(size) - size, size


def joined_pieces(ids: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray, step: int = 1 << 16) -> bytes:
    """The pieces of these ids, in order; `step` ids at a time."""
    out = []
    for i in range(0, len(ids), step):
        part = ids[i : i + step]
        n = size[part]
        shift = np.repeat(start[part] - (np.cumsum(n) - n), n)
        out.append(data[np.arange(len(shift)) + shift].tobytes())
    return b"".join(out)


def round_trip(docs: DataFrame, path: str | None = None, shelf_bytes: int = SHELF_BYTES) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row.

    Null and empty texts have no ids; both hashes are then those of nothing. A special token's string in a text becomes
    its id, as the library does. Rows with the same id are encoded each by itself; other columns aren't read; an empty
    table gives no rows.
    """
    path = path or vocabulary_path(BYTE_FILE)
    bits = shelves.buckets(common.text_bytes(docs))
    shelved = shelves.shelve(docs, shelf_bytes=shelf_bytes)

    def finish(e, ids, texts, table):
        pieces = piece_places(e)
        for doc_id, text in zip(ids, texts, strict=True):
            got = b"".join([table[w] for w in e.words(text)]) if text else b""
            back = joined_pieces(np.frombuffer(got, "<u4"), *pieces).decode("utf-8", "replace").encode()
            yield doc_id, len(got) // 4, hashlib.sha256(got).hexdigest(), hashlib.sha256(back).hexdigest()

    return _joined(shelved, _word_ids(shelved, path, bits), path, bits, finish, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_documents(docs: DataFrame, path: str | None = None, shelf_bytes: int = SHELF_BYTES) -> DataFrame:
    """(doc_id, ids array<int>) of every row; nulls as in round_trip()."""
    path = path or vocabulary_path(BYTE_FILE)
    bits = shelves.buckets(common.text_bytes(docs))
    shelved = shelves.shelve(docs, shelf_bytes=shelf_bytes)

    def finish(e, ids, texts, table):
        for doc_id, text in zip(ids, texts, strict=True):
            yield doc_id, np.frombuffer(b"".join([table[w] for w in e.words(text)]) if text else b"", "<u4").astype(np.int32)

    return _joined(shelved, _word_ids(shelved, path, bits), path, bits, finish, "doc_id long, ids array<int>")


def piece_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(id, piece binary) of a byte-level vocabulary."""
    return spark.createDataFrame([(i, bytearray(p)) for i, p in enumerate(encoder(path or vocabulary_path(BYTE_FILE)).pieces)], "id int, piece binary")


def decode_documents(encoded: DataFrame, path: str | None = None, step: int = 4096) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids): ids by position joined with the pieces, whose bytes are put together again.

    Long id lists are put together in steps, so no aggregate holds single pieces of a whole document. doc_id has to be
    unique and not null here, since positions belong to it.
    """
    spark = encoded.sparkSession
    at = encoded.select("doc_id", F.posexplode("ids").alias("pos", "id"))
    pieces = at.join(F.broadcast(piece_table(spark, path)), "id", "left")  # as long as the vocabulary

    def together(value: Column, order: Column) -> Column:
        parts = F.transform(F.array_sort(F.collect_list(F.struct(order.alias("k"), value.alias("v")))), lambda s: s["v"])
        return F.aggregate(parts, F.lit("").cast("binary"), lambda a, b: F.concat(a, b))

    stepped = pieces.groupBy("doc_id", F.floor(F.col("pos") / step).alias("part")).agg(together(F.col("piece"), F.col("pos")).alias("bytes"))
    whole = stepped.groupBy("doc_id").agg(together(F.col("bytes"), F.col("part")).alias("bytes"))
    return encoded.select("doc_id").join(whole, "doc_id", "left").select("doc_id", F.coalesce(F.decode("bytes", "UTF-8"), F.lit("")).alias("text"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(common.table(spark, sf_dir, "documents"))


QUERIES = {"op4_bpe_round_trip": op4_bpe_round_trip}
ORACLES: dict[str, str] = {}
