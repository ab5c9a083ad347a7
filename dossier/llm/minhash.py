"""MinHash near-dedup with tensored banding.

Two small collections of half keys are computed, HALVES each, of WIDTH minhashes; every pair of a half key from the one and
one from the other is the key of a table. HALVES * HALVES tables of 2 * WIDTH minhashes thus cost 2 * HALVES * WIDTH
minhashes instead of 2 * HALVES * HALVES * WIDTH. At a similarity s two documents meet in some table with probability
(1 - (1 - s^WIDTH)^HALVES)^2: 0.9993 at 0.8 and 1 - 1e-8 at 0.9 with the defaults.

One pass over the texts makes a signature of each distinct shingle set: its half keys and a parity bitmap of its shingles.
Signatures are written in packs; no text is shuffled. A pack sends only the sorted leading bits of its table keys to
buckets, so keys that nobody else has go no further. Documents with equal shingle sets are one class and take part once.

Links are confirmed on full sets, which are made anew from just the texts that a pair names. In a first round each class
meets the most connected class of its tables, in a second one a class drawn at random for each table that still holds
different components; either way the one it shares most tables with. Last, in each table that still holds different
components, classes outside its largest component meet all those of other components, each pair in the first table that
both share, so that no candidate pair goes untested unless both ends are joined already. Before texts are read again,
pairs that cannot be alike enough are dropped: two sets differ in at least as many shingles as their bitmaps do in bits.
That bound is exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import components, spread
from .shelves import expand, squeeze
from .wordhash import SPACE, encode, member, mix, pack_sorted, run_hashes, run_starts, unpack_sorted, words

SHINGLE, PERCENT = 5, 80
HALVES, WIDTH = 12, 3
#: 64-bit words of a set's parity bitmap.
SKETCH = 8
#: Bytes of text, and documents, that one pack of signatures covers at most.
PACK_BYTES, PACK_DOCS = 32 << 20, 4096
#: Bytes of text that are made into sets at once.
STEP = 1 << 20
#: Table keys a bucket gets, about, and bits of a key beyond those that number all keys: so few keys are shared by chance.
BUCKET_KEYS, SPARE_BITS = 1 << 20, 18
#: Shingles that are compared with one set in one place.
LOAD = 1 << 16
#: Ids of texts to read again up to which their list is broadcast; a longer list is joined by a shuffle.
BROADCAST_IDS = 200_000
_RNG = np.random.Generator(np.random.PCG64(77))
_TIMES = _RNG.integers(1, 2**63, 512, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts, ascending inside each, and where each text's begin."""
    hashes, first = words(texts, SPACE, True)
    n_words = np.diff(first)
    runs = run_hashes(hashes, width)
    at = np.flatnonzero(run_starts(first, width))
    owner = np.repeat(np.arange(len(texts)), n_words)[at]
    value = runs[at]
    short = np.flatnonzero((n_words > 0) & (n_words < width))
    if len(short):  # the whole sequence is the one shingle
        own = np.array([mix(run_hashes(hashes[first[i] : first[i + 1]], int(n_words[i])) ^ np.uint64(n_words[i]))[0] for i in short], np.uint64)
        owner, value = np.concatenate([owner, short]), np.concatenate([value, own])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[new], value[new]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def set_hashes(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One number for each set, the same for equal sets."""
    total = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(mix(value), out=total[1:])
    return mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64)


def half_keys(value: np.ndarray, first: np.ndarray, halves: int, width: int) -> np.ndarray:
    """A row of 2 * halves half keys for each set; none may be empty."""
    at, ends = first[:-1], first[1:]
    half = np.zeros((2 * halves, len(at)), np.uint64)
    i = 0
    while i < len(at):  # as many sets at once as the processor's cache holds
        j = max(i + 1, int(np.searchsorted(ends, at[i] + 65536, "right")))
        part, starts = value[at[i] : ends[j - 1]], at[i:j] - at[i]
        for k in range(2 * halves * width):
            row = half[k // width]
            row[i:j] = mix((row[i:j] ^ np.minimum.reduceat(part * _TIMES[k], starts)) * _TIMES[256 + k % 256] + np.uint64(k))
        i = j
    return np.ascontiguousarray(half.T)


def table_bits(halves: int) -> int:
    return common.bits_for(halves * halves)


def table_keys(half: np.ndarray) -> np.ndarray:
    """A row of halves * halves table keys for each row of half keys; the last bits of a key are its table's number."""
    halves = half.shape[1] // 2
    a, b, low = half[:, :halves], half[:, halves:], np.uint64((1 << table_bits(halves)) - 1)
    tables = np.arange(halves * halves, dtype=np.uint64).reshape(1, halves, halves)
    keys = mix(a[:, :, None] + b[:, None, :] * np.uint64(0x9E3779B97F4A7C15) + tables)
    return ((keys & ~low) | tables).reshape(len(half), halves * halves)


def sketch(value: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles at each bit; the bit is taken from the shingle's hash."""
    odd = np.bincount((mix(value) % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


class Pack:
    """Signatures of a run of documents: of each document its set's size and hash, of each class the smallest id, half keys and bitmap."""

    def __init__(self, shingle: int, halves: int, width: int, hashed: bool):
        self.shingle, self.halves, self.width, self.hashed = shingle, halves, width, hashed
        self.ids: list[int | None] = []
        self.size, self.hash, self.half, self.bits, self.n, self.md5 = [], [], [], [], [], []
        self.least: dict[int, int] = {}

    def add(self, ids: list[int | None], texts: list[str | None]) -> None:
        value, first = shingle_sets(texts, self.shingle)
        size, hashes = np.diff(first), set_hashes(value, first)
        new: list[int] = []
        for i, (doc_id, n, h) in enumerate(zip(ids, size.tolist(), hashes.tolist(), strict=True)):
            if doc_id is not None and n:
                if h not in self.least:
                    new.append(i)
                self.least[h] = min(doc_id, self.least.get(h, doc_id))
        if new:
            sets = [value[first[i] : first[i + 1]] for i in new]
            at = np.zeros(len(new) + 1, np.int64)
            np.cumsum(size[new], out=at[1:])
            self.half.append(half_keys(np.concatenate(sets), at, self.halves, self.width))
            self.bits += [sketch(s) for s in sets]
            self.n += size[new].tolist()
        self.ids += ids
        self.size.append(size)
        self.hash.append(hashes)
        if self.hashed:
            self.md5 += [b"" if t is None else hashlib.md5(encode(t)).digest() for t in texts]

    def row(self) -> tuple:
        known = np.array([0 if i is None else i for i in self.ids], np.int64)
        nulls = np.array([i is None for i in self.ids], np.uint8)
        return (
            len(self.ids), squeeze(known.tobytes() + nulls.tobytes()), squeeze(np.concatenate(self.size).astype(np.int64).tobytes()), np.concatenate(self.hash).tobytes(),
            np.array([bool(m) for m in self.md5], np.uint8).tobytes() + b"".join(self.md5) if self.hashed else b"",
            np.array([*self.least.keys()], np.int64).tobytes(), np.array([*self.least.values()], np.int64).tobytes(), squeeze(np.array(self.n, np.int64).tobytes()),
            b"".join(h.tobytes() for h in self.half), b"".join(b.tobytes() for b in self.bits),
        )


_PACKED = "n_docs long, ids binary, sizes binary, hashes binary, md5s binary, class_hash binary, class_id binary, class_n binary, half binary, bits binary"


def _packs(docs: DataFrame, shingle: int, halves: int, width: int, pack_bytes: int, hashed: bool) -> DataFrame:
    """(shelf, ...) as Pack.row() gives them; written, so that numbers of packs stay the same whatever is computed again."""
    names = [c.split()[0] for c in _PACKED.split(", ")]

    def rows(batches):
        pack, size, ids, texts, step = Pack(shingle, halves, width, hashed), 0, [], [], 0
        for pdf in batches:
            for i, t in zip(pdf["doc_id"].tolist(), pdf["text"].tolist(), strict=True):
                ids.append(None if i is None or i != i else int(i))
                texts.append(t)
                step += len(t) if t else 1
                if step >= min(STEP, pack_bytes):
                    pack.add(ids, texts)
                    size, step, ids, texts = size + step, 0, [], []
                    if size >= pack_bytes or len(pack.ids) >= PACK_DOCS:
                        yield pd.DataFrame([pack.row()], columns=names)
                        pack, size = Pack(shingle, halves, width, hashed), 0
        if ids:
            pack.add(ids, texts)
        if pack.ids:
            yield pd.DataFrame([pack.row()], columns=names)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return common.checkpointed(slim.mapInPandas(rows, _PACKED).withColumn("shelf", F.monotonically_increasing_id()))


def _each(pdf: pd.DataFrame, halves: int):
    """(class hashes, class ids, sizes, half keys, bitmaps) of the packs of a frame."""
    for h, i, n, half, bits in zip(pdf["class_hash"], pdf["class_id"], pdf["class_n"], pdf["half"], pdf["bits"], strict=True):
        yield np.frombuffer(h, np.int64), np.frombuffer(i, np.int64), np.frombuffer(expand(n), np.int64), np.frombuffer(half, np.uint64).reshape(-1, 2 * halves), np.frombuffer(bits, np.int64).reshape(-1, SKETCH)


def _documents(packs: DataFrame, hashed: bool) -> DataFrame:
    """(doc_id, n_shingles, h1) of every document, and text_md5 if hashed."""

    def rows(batches):
        for pdf in batches:
            for n, ids, sizes, hashes, md5s in zip(pdf["n_docs"].tolist(), pdf["ids"], pdf["sizes"], pdf["hashes"], pdf["md5s"], strict=True):
                raw = expand(ids)
                known, nulls = np.frombuffer(raw[: 8 * n], np.int64), np.frombuffer(raw[8 * n :], np.uint8)
                out = pd.DataFrame({"doc_id": pd.array(known, "Int64"), "n_shingles": np.frombuffer(expand(sizes), np.int64), "h1": np.frombuffer(hashes, np.int64)})
                out.loc[nulls == 1, "doc_id"] = pd.NA
                if hashed:
                    at, own = n, []
                    for there in np.frombuffer(md5s[:n], np.uint8).tolist():
                        own.append(md5s[at : at + 16].hex() if there else None)
                        at += 16 * there
                    out["text_md5"] = own
                yield out

    return packs.select("n_docs", "ids", "sizes", "hashes", "md5s").mapInPandas(rows, "doc_id long, n_shingles long, h1 long" + (", text_md5 string" if hashed else ""))


def _split(codes: np.ndarray, top: int, bits: int):
    """(bucket, codes) of ascending codes of `top` bits, by their first `bits`."""
    if not len(codes):
        return
    bucket = (codes >> np.uint64(top - bits)).astype(np.int64) if bits else np.zeros(len(codes), np.int64)
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(codes)], strict=True):
        yield int(bucket[a]), codes[a:b]


def _shared_codes(packs: DataFrame, halves: int, top: int, bits: int) -> DataFrame:
    """(shelf, bucket, codes): the leading bits of those table keys of a pack that two of its classes or another pack have."""

    def send(batches):
        for pdf in batches:
            for shelf, (_, _, _, half, _) in zip(pdf["shelf"].tolist(), _each(pdf, halves), strict=True):
                codes, n = np.unique(table_keys(half) >> np.uint64(64 - top), return_counts=True)
                again = dict(_split(codes[n > 1], top, bits))
                none = np.zeros(0, np.uint64)
                rows = [(shelf, b, squeeze(pack_sorted(c)), squeeze(pack_sorted(again.get(b, none)))) for b, c in _split(codes, top, bits)]
                yield pd.DataFrame(rows, columns=["shelf", "bucket", "codes", "again"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = [unpack_sorted(expand(x)) for x in pdf["codes"]]
        distinct, n = np.unique(np.concatenate(lists), return_counts=True)
        shared = np.unique(np.concatenate([distinct[n > 1], *(unpack_sorted(expand(x)) for x in pdf["again"])]))
        rows = [(shelf, bucket, squeeze(pack_sorted(own))) for shelf, bucket, c in zip(pdf["shelf"].tolist(), pdf["bucket"].tolist(), lists, strict=True) if len(own := c[member(c, shared)])]
        return pd.DataFrame(rows, columns=["shelf", "bucket", "codes"])

    sent = packs.select("shelf", "class_hash", "class_id", "class_n", "half", "bits").mapInPandas(send, "shelf long, bucket int, codes binary, again binary")
    return sent.groupBy("bucket").applyInPandas(answer, "shelf long, bucket int, codes binary")


def _leads(packs: DataFrame, shared: DataFrame, halves: int, top: int) -> DataFrame:
    """(node, doc_id, n, keys, half, bits) of the classes of each pack that share a key: half holds 32 bits of each half key."""

    def last(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            raise RuntimeError("an answer came back for a pack that isn't there")
        known = np.sort(np.concatenate([np.zeros(0, np.uint64), *(unpack_sorted(expand(x)) for x in right["codes"])]))
        rows: list[tuple] = []
        for h, ids, n, half, bits in _each(left, halves):
            for i in range(0, len(h), 512):
                table = table_keys(half[i : i + 512])
                hit = member((table >> np.uint64(64 - top)).ravel(), known).reshape(table.shape)
                short = (half[i : i + 512] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                rows += [(int(h[i + k]), int(ids[i + k]), int(n[i + k]), np.unique(table[k][hit[k]]).view(np.int64), short[k], bits[i + k]) for k in np.flatnonzero(hit.any(1)).tolist()]
        return pd.DataFrame(rows, columns=["node", "doc_id", "n", "keys", "half", "bits"])

    slim = packs.select("shelf", "class_hash", "class_id", "class_n", "half", "bits")
    return slim.groupBy("shelf").cogroup(shared.groupBy("shelf")).applyInPandas(last, "node long, doc_id long, n long, keys array<long>, half array<int>, bits array<long>")


def _alike_sizes(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _alike_sketches(a: Column, b: Column, sizes: Column, percent: int) -> Column:
    """False only for sets that differ in more shingles than two sets of that size together may: (100 - percent) / (100 + percent) of it."""
    differ = sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(1, SKETCH)), F.bit_count(a[0].bitwiseXOR(b[0])))
    return differ * (100 + percent) <= sizes * (100 - percent)


def _first_shared(a: Column, b: Column, key: Column, halves: int) -> Column:
    """True in the table of the first half keys that both have, of either collection: a pair meets in no other one."""
    table = key.bitwiseAND(F.lit((1 << table_bits(halves)) - 1))

    def first(k: int) -> Column:
        return F.coalesce(*(F.when(a[k + i] == b[k + i], F.lit(i)) for i in range(halves)))

    return (first(0) == F.floor(table / halves)) & (first(halves) == table % halves)


def _confirmed(docs: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(p, q) of those rows of pairs (a, doc_a, p, b, doc_b, n_b, q) where the full sets of a and b are alike enough.

    Sets are made from the texts of the documents that pairs name, and each goes where it is compared; a is compared in as
    many places as its partners' shingles fill.
    """
    pairs = common.checkpointed(pairs)
    places = common.checkpointed(pairs.groupBy("a").agg(F.ceil(F.sum("n_b") / LOAD).cast("int").alias("places"), F.min("doc_a").alias("doc_id"), F.min("p").alias("component")))
    partners = pairs.join(places.select("a", "places"), "a").select(F.col("doc_b").alias("doc_id"), "a", F.pmod(F.xxhash64("b"), F.col("places")).cast("int").alias("place"), F.lit(0).alias("is_a"), F.col("b").alias("node"), F.col("q").alias("component"))
    own = places.select("doc_id", "a", F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("place"), F.lit(1).alias("is_a"), F.col("a").alias("node"), "component")
    wanted = common.checkpointed(partners.unionByName(own))
    ids = wanted.select("doc_id").distinct()

    def sets(batches):
        for batch in (part for whole in batches for part in common.slices(whole)):
            value, first = shingle_sets(batch.column("text").to_pylist(), shingle)
            data = [pack_sorted(value[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(set_hashes(value, first)), pa.array(data, pa.binary())], ["doc_id", "node", "shingles"])

    def verify(batches):
        at, left, p = None, None, 0
        for pdf in batches:
            links: list[tuple[int, int]] = []
            for a, place, is_a, component, data in zip(pdf["a"].tolist(), pdf["place"].tolist(), pdf["is_a"].tolist(), pdf["component"].tolist(), pdf["shingles"], strict=True):
                if is_a:
                    at, left, p = (a, place), unpack_sorted(data), component
                    continue
                if (a, place) != at:
                    raise RuntimeError("a text that was there in the first pass isn't there any more")
                right = unpack_sorted(data)
                both = int(member(right, left).sum())
                if 100 * both >= percent * (len(left) + len(right) - both):
                    links.append((p, component))
            yield pd.DataFrame(links, columns=["p", "q"], dtype="int64")

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = texts.join(F.broadcast(ids) if wanted.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")
    made = named.mapInArrow(sets, "doc_id long, node long, shingles binary").groupBy("doc_id", "node").agg(F.first("shingles").alias("shingles"))  # repeated rows count once
    dealt = made.join(wanted, ["doc_id", "node"]).select("a", "place", "is_a", "component", "shingles")
    return dealt.repartition("a", "place").sortWithinPartitions("a", "place", F.desc("is_a")).mapInPandas(verify, "p long, q long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, halves: int = HALVES, width: int = WIDTH, shelf_bytes: int = PACK_BYTES, hashed: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row; if hashed, text_md5 as well, which tells rows of one id apart.

    Null and blank texts have no shingles and link with nothing; a text of fewer words than a shingle has is one shingle
    by itself. Rows of one id are one document for its links: they get the same component only if their sets link. Rows
    without an id link with nothing and are kept under a null component. An empty table gives no rows; other columns
    aren't read. docs is read twice or more and has to hold the same rows each time; if it doesn't, an error says so.
    """
    n_keys = max(1, docs.count()) * halves * halves
    bits, top = common.bits_for(common.ceil_div(n_keys, BUCKET_KEYS)), min(64 - table_bits(halves), SPARE_BITS + common.bits_for(n_keys))
    packs = _packs(docs, shingle, halves, width, shelf_bytes, hashed)
    documents = _documents(packs, hashed)

    # a class is known by its set's hash; rows of equal sets are equal for all that follows
    classes = common.checkpointed(documents.where("n_shingles > 0 and doc_id is not null").groupBy("h1").agg(F.min("doc_id").alias("rep")))
    leads = _leads(packs, _shared_codes(packs, halves, top, bits), halves, top).join(classes, F.col("node") == F.col("h1")).where(F.col("doc_id") == F.col("rep"))
    leads = common.checkpointed(leads.select("node", "doc_id", "n", "keys", "half", "bits").dropDuplicates(["node"]))
    common.release(docs.sparkSession)
    labels = leads.select("node", F.col("node").alias("component"))

    def side(name: str, *more: str) -> DataFrame:
        return leads.select(F.col("node").alias(name), F.col("doc_id").alias(f"doc_{name}"), F.col("n").alias(f"n_{name}"), *(F.col(c).alias(f"{c}_{name}") for c in more))

    def rows() -> DataFrame:
        """(key, node, n, m, component) of every table key of every class; m is how many keys the class has."""
        return leads.select("node", "n", "keys").join(labels, "node").select(F.explode("keys").alias("key"), "node", "n", F.size("keys").alias("m"), "component")

    def relabelled(links: DataFrame) -> DataFrame:
        joined = components(links, "p", "q", least=False).select(F.col("id").alias("component"), F.col("component").alias("to"))
        out = common.checkpointed(labels.join(joined, "component", "left").select("node", F.coalesce("to", "component").alias("component")))
        common.release(docs.sparkSession)
        return out

    for rank in (-F.col("m"), F.xxhash64("node", "key")):
        met = rows().groupBy("key").agg(F.min(F.struct(rank.cast("long").alias("rank"), "node", "n", "component")).alias("c"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        centres = common.checkpointed(met.where("lo <> hi").select("key", F.col("c.node").alias("a"), F.col("c.n").alias("size_a"), F.col("c.component").alias("p")))
        starred = rows().join(centres, "key").where((F.col("p") != F.col("component")) & _alike_sizes(F.col("size_a"), F.col("n"), percent))
        pairs = starred.groupBy("a", F.col("node").alias("b"), "p", F.col("component").alias("q")).agg(F.count("*").alias("tables"))
        pairs = pairs.join(side("a", "bits"), "a").join(side("b", "bits"), "b").where(_alike_sketches(F.col("bits_a"), F.col("bits_b"), F.col("n_a") + F.col("n_b"), percent))
        best = pairs.groupBy("b").agg(F.max_by(F.struct("a", "doc_a", "p", "doc_b", "n_b", "q"), F.struct("tables", "a")).alias("s")).select("b", "s.*")
        labels = relabelled(_confirmed(docs, best, shingle, percent))

    # what both rounds left open: tables that hold more than one component
    sized = rows().groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed = sized.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("n_components")).where("n_components > 1")
    open_rows = common.checkpointed(rows().join(common.checkpointed(mixed.select("key", "main")), "key").select("key", F.col("node").alias("b"), F.col("component").alias("q"), "main"))
    both = open_rows.join(side("b", "half", "bits"), "b")
    stray = open_rows.where("q <> main").select("key", F.col("b").alias("a"), F.col("q").alias("p")).join(side("a", "half", "bits"), "a")
    across = both.join(stray, "key").where(
        (F.col("p") != F.col("q"))
        & ((F.col("q") == F.col("main")) | (F.col("a") < F.col("b")))
        & _alike_sizes(F.col("n_a"), F.col("n_b"), percent)
        & _first_shared(F.col("half_a"), F.col("half_b"), F.col("key"), halves)
        & _alike_sketches(F.col("bits_a"), F.col("bits_b"), F.col("n_a") + F.col("n_b"), percent)
    )
    labels = relabelled(_confirmed(docs, across.select("a", "doc_a", "p", "b", "doc_b", "n_b", "q"), shingle, percent))

    first = labels.join(classes, F.col("node") == F.col("h1")).select("h1", "rep", "component")
    first = spread(first, first.groupBy("component").agg(F.min("rep").alias("of_class")), "component", "h1").select("h1", "of_class")
    of_class = classes.join(first, "h1", "left").select("h1", F.coalesce("of_class", "rep").alias("of_class"))
    out = documents.join(common.checkpointed(of_class), "h1", "left")
    linked = F.when(F.col("n_shingles") > 0, F.col("of_class"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(linked, "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"), *(["text_md5"] if hashed else []))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"), shingle=2)


QUERIES = {"op5_minhash_near_dedup": op5_minhash_near_dedup}
ORACLES: dict[str, str] = {}
