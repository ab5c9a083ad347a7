"""Embedding near-dedup: an exact range join by angle, with pivots.

Unit vectors are compared by the angle between them, which is a metric. Pivots come from a bounded sample: centres of its
densest neighbourhoods, at least the join's radius apart. Each vector is at home in the cell of its nearest pivot. Vectors
in the core of a cell (within half the radius of the pivot) all link, so these pairs are counted and not compared. A hot
group of copies is mostly such a core.

Cells are cut into packs, a row of bytes for some thousand vectors, which are written once and then met pack by pack in a
Cartesian product, so a vector is never copied for each pack that it meets: a task holds two packs, whatever the table's
size. A pack is a ball: by the triangle inequality two packs are left out if their balls are farther apart than the
radius, and of the others only the vectors within the radius of the other ball are compared. Of a pair the leading
coordinates and the lengths of what remains are multiplied first: by Cauchy and Schwarz that product is at least the
cosine. A pair of packs keeps counts of links and a spanning forest of them, never the pairs. In data without any
low-dimensional structure the triangle inequality excludes little, and the packs then make up the whole comparison in
blocks, whose time grows with the square of the rows.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import components

COSINE = 0.9
#: Bounds of the sample that pivots come from, and of the pivots.
SAMPLE, PIVOTS = 2048, 512
#: Vectors in a pack: a table has about PACKS packs, of TILE vectors at least; more only once a pack has PACK_BYTES.
TILE, PACKS, PACK_BYTES = 4096, 32, 4 << 20
#: Pack files at most, when there are more packs a file has several. Either side of the product has at most SIDE partitions,
#: or more once a partition has SIDE_PACKS packs, since the product of both numbers is that of its tasks.
FILES, SIDE, SIDE_PACKS = 512, 128, 8
#: A core of less than a pack over CORE is compared like the rest of its cell.
CORE = 8
#: Rows and columns that are multiplied at once, and links that are held before they are merged.
ROWS, COLUMNS, HELD = 256, 512, 1 << 18
_SLACK = 1e-6


def unit(rows: list | np.ndarray) -> np.ndarray:
    x = np.array(rows, np.float64)
    x /= np.maximum(x.max(axis=1, keepdims=True), -x.min(axis=1, keepdims=True))
    x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return x


def usable(vectors: DataFrame, embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): the rows with vectors that can be compared. v is of floats if the table's are, otherwise of doubles."""
    floats = vectors.schema[embedding].dataType.simpleString() == "array<float>"
    v = F.col(embedding) if floats else F.transform(embedding, lambda x: x.cast("double"))
    fine = vectors.where(F.col("vec_id").isNotNull() & F.col(embedding).isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return fine.where(~F.coalesce(bad, F.lit(False)) & F.exists("v", lambda x: x != 0))


def one_each(fine: DataFrame) -> DataFrame:
    """Of rows with the same id the least vector stands for all."""
    return fine.groupBy("vec_id").agg(F.min("v").alias("v"))


def choose_pivots(sample: np.ndarray, n: int, radius: float) -> np.ndarray:
    """At most n centres of dense places of the sample, farther than radius from each other."""
    close = sample @ sample.T >= np.cos(radius / 2)
    chosen: list[np.ndarray] = []
    for i in np.argsort(-close.sum(1), kind="stable"):
        centre = sample[close[i]].sum(0)
        centre /= np.linalg.norm(centre)
        if all(centre @ p < np.cos(radius) for p in chosen):
            chosen.append(centre)
        if len(chosen) == n:
            break
    return np.array(chosen)


def merge(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels of the components once the links (u, v) have been added; a label is its component's least place."""
    while len(u):
        a, b = label[u], label[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
    return label


def leading(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Coordinates along the axes and the length of what remains: the product of two such rows is at least that of the vectors."""
    y = x @ axes
    return np.concatenate([y, np.sqrt(np.maximum(0, 1 - (y * y).sum(1)))[:, None]], 1)


def tile_links(res: np.ndarray, vis: np.ndarray | None, threshold: float, axes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Number of links and component label of each row of res (then vis); without vis the pairs inside res.

    Products in single precision only choose; what is within their error of the threshold is computed in double.
    """
    other = res if vis is None else vis
    shift = 0 if vis is None else len(res)
    n = np.zeros(len(res) + (0 if vis is None else len(vis)), np.int64)
    label = np.arange(len(n))
    error = 1e-5 + 2e-7 * res.shape[1]
    low, high = np.float32(threshold - error), np.float32(threshold + error)
    quick, quick_other = res.astype(np.float32), other.astype(np.float32)
    if axes is not None:
        lead = leading(res, axes).astype(np.float32)
        lead_other = lead if vis is None else leading(other, axes).astype(np.float32)
    product, near = np.empty(ROWS * COLUMNS, np.float32), np.zeros(ROWS * COLUMNS, bool)
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def settle() -> None:
        nonlocal label
        if held:
            p, q = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]) + shift
            held.clear()
            n[:] += np.bincount(p, minlength=len(n)) + np.bincount(q, minlength=len(n))
            label = merge(label, p, q)

    def likely(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the block of x by y whose product isn't too low, and the products; eight places are looked at at once, as few are near."""
        size = len(x) * len(y)
        block = product[:size]
        np.matmul(x, y.T, out=block.reshape(len(x), len(y)))
        np.greater_equal(block, low, out=near[:size])
        near[size : size + 8] = False
        some = np.flatnonzero(near[: common.ceil_div(size, 8) * 8].view(np.uint64))
        k, place = np.nonzero(near.reshape(-1, 8)[some])
        at = some[k] * 8 + place
        return at, block[at]

    def links(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        to_i, to_j = min(i + ROWS, len(res)), min(j + COLUMNS, len(other))
        width = to_j - j
        sure = None
        if axes is not None:
            at, _ = likely(lead[i:to_i], lead_other[j:to_j])
        if axes is None or len(at) * 64 > (to_i - i) * width:  # many are near, so whole products cost less than pairs one by one
            at, cosine = likely(quick[i:to_i], quick_other[j:to_j])
            sure = cosine >= high
        p, q = at // width + i, at % width + j
        keep = np.zeros(len(at), bool) if sure is None else sure
        close = np.flatnonzero(~keep)
        for k in range(0, len(close), 1 << 14):
            c = close[k : k + (1 << 14)]
            keep[c] = np.einsum("ij,ij->i", res[p[c]], other[q[c]]) >= threshold
        return p[keep], q[keep]

    for i in range(0, len(res), ROWS):
        for j in range(0 if vis is not None else i // COLUMNS * COLUMNS, len(other), COLUMNS):
            p, q = links(i, j)
            if vis is None:
                p, q = p[p < q], q[p < q]
            if len(p):
                held.append((p, q))
                if sum(len(h[0]) for h in held) > HELD:
                    settle()
    settle()
    return n, label


def by_length(batch: pa.RecordBatch):
    """(d, places, vectors) for each length of the vectors in column v."""
    column = batch.column(batch.schema.get_field_index("v"))
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == d)
        yield d, at, column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _cells(fine: DataFrame, radius: float, tile: int | None) -> tuple[dict, dict, dict]:
    """By vector length: pivots, leading axes (only where there is more than one pack) and how many vectors a pack has."""
    totals = {r["d"]: r["n"] for r in fine.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()}  # a row for each length
    width = 4 if fine.schema["v"].dataType.simpleString() == "array<float>" else 8
    full = {d: max(1, min(tile or max(TILE, n // PACKS), PACK_BYTES // (width * d))) for d, n in totals.items()}
    share = SAMPLE / max(1, sum(totals.values()))
    picked: dict[int, list] = {}
    for r in sorted(one_each(fine.where(common.sample_share(F.lit(min(1.0, share)), "vec_id"))).collect())[: 2 * SAMPLE]:
        picked.setdefault(len(r["v"]), []).append(r["v"])
    pivots, axes = {}, {}
    for d, rows in picked.items():
        if totals[d] > full[d]:
            sample = unit(rows)
            pivots[d] = choose_pivots(sample, min(PIVOTS, max(1, totals[d] // full[d])), radius)
            if d >= 32:
                axes[d] = np.linalg.eigh(sample.T @ sample)[1][:, 1 - d // 2 :]
    return pivots, axes, full


def _packed(fine: DataFrame, radius: float, tile: int | None) -> tuple[DataFrame, dict, int]:
    """Packs (pack, d, cell, core, n, least, centre, spread, ids, vectors), written, the leading axes by length and how many packs there may be."""
    pivots, axes, full = _cells(fine, radius, tile)

    def place(d: int, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Home cell and whether in its core."""
        if d not in pivots:
            return np.zeros(len(v), np.int64), np.zeros(len(v), bool)
        c = unit(v) @ pivots[d].T
        return c.argmax(1), c.max(1) >= np.cos(radius / 2 - _SLACK)

    def count(batches):
        for batch in batches:
            for d, _, v in by_length(batch):
                home, core = place(d, v)
                key, n = np.unique(home * 2 + core, return_counts=True)
                yield pa.RecordBatch.from_pydict({"d": pa.array([d] * len(key), pa.int32()), "kind": pa.array(key, pa.int64()), "n": pa.array(n, pa.int64())})

    rows = fine.select("v").mapInArrow(count, "d int, kind long, n long").groupBy("d", "kind").agg(F.sum("n").alias("n")).collect()  # a row for each pivot, or length
    met = {(r["d"], r["kind"]): r["n"] for r in rows}
    sizes, goes = {}, {}
    for d in sorted(full):
        for kind in range(0, 2 * len(pivots.get(d, [0])), 2):
            rest, core = met.get((d, kind), 0), met.get((d, kind + 1), 0)
            goes[d, kind], goes[d, kind + 1] = kind, kind + (core * CORE >= full[d])
            for k in {goes[d, kind], goes[d, kind + 1]}:
                sizes[d, k] = max(1, round((core if k > kind else rest if goes[d, kind + 1] > kind else rest + core) / full[d]))
    first = dict(zip(sizes, accumulate(sizes.values(), initial=0), strict=False))
    names = {k: (d, kind // 2, kind % 2 == 1) for (d, kind), n in sizes.items() for k in range(first[d, kind], first[d, kind] + n)}

    def deal(batches):
        for batch in batches:
            salt = pd.util.hash_array(batch.column(0).to_numpy(zero_copy_only=False))
            pack = np.zeros(batch.num_rows, np.int64)
            for d, at, v in by_length(batch):
                home, core = place(d, v)
                kind = [(d, goes[d, k]) for k in (home * 2 + core).tolist()]
                pack[at] = np.array([first[k] for k in kind]) + (salt[at] % np.array([sizes[k] for k in kind], np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pack), *batch.columns], ["pack", "vec_id", "v"])

    def pack(key, group):
        d, cell, core = names[key[0].as_py()]
        ids = group.column("vec_id").to_numpy()
        v = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in group.column("v").chunks]).reshape(-1, d)
        x = unit(v)
        centre = x.sum(0)
        length = np.linalg.norm(centre)
        centre = centre / length if length > _SLACK else x[0]
        spread = float(np.arccos(np.clip((x @ centre).min(), -1, 1)))
        row = {"pack": key[0].as_py(), "d": d, "cell": cell, "core": core, "n": len(ids), "least": int(ids.min()), "centre": centre.tolist(), "spread": spread, "ids": ids.tobytes(), "vectors": v.tobytes()}
        return pa.Table.from_pylist([row], schema=_PACK_ARROW)

    dealt = one_each(fine).mapInArrow(deal, fine.schema.simpleString().replace("struct<", "struct<pack:bigint,"))
    packs = dealt.groupBy("pack").applyInArrow(pack, _PACK)
    return common.checkpointed(packs, max(1, len(names) // FILES)), axes, len(names)


_PACK = "pack long, d int, cell int, core boolean, n long, least long, centre array<double>, spread double, ids binary, vectors binary"
_PACK_ARROW = pa.schema([("pack", pa.int64()), ("d", pa.int32()), ("cell", pa.int32()), ("core", pa.bool_()), ("n", pa.int64()), ("least", pa.int64()), ("centre", pa.list_(pa.float64())), ("spread", pa.float64()), ("ids", pa.binary()), ("vectors", pa.binary())])
_FOUND = "vec_id long, n long, to long"


def _links_of(ids: np.ndarray, n: np.ndarray, to: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(to, pa.int64())], ["vec_id", "n", "to"])


def _between(a: Column, b: Column) -> Column:
    """Angle between two centres."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.acos(F.greatest(F.least(dot, F.lit(1.0)), F.lit(-1.0)))


def _found(fine: DataFrame, threshold: float, tile: int | None) -> DataFrame:
    """(vec_id, n, to): numbers of links and spanning forests, by pairs of packs."""
    radius = float(np.arccos(threshold))
    packs, axes, n_packs = _packed(fine, radius, tile)
    double = fine.schema["v"].dataType.simpleString() != "array<float>"

    def compare(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                r = {name: column[k] for name, column in zip(batch.schema.names, batch.columns, strict=True)}
                d, ids, x = r["d"].as_py(), [], []
                for side, of in ("ab", "ba"):
                    v = np.frombuffer(r[f"{side}_vectors"].as_buffer(), np.float64 if double else np.float32).reshape(-1, d)
                    u = unit(v)
                    near = u @ r[f"{of}_centre"].values.to_numpy() >= np.cos(min(np.pi, r[f"{of}_spread"].as_py() + radius + _SLACK)) - _SLACK
                    ids.append(np.frombuffer(r[f"{side}_ids"].as_buffer(), np.int64)[near])
                    x.append(u if near.all() else u[near])
                    if r["inside"].as_py():
                        break
                if r["inside"].as_py():
                    n, label = tile_links(x[0], None, threshold, axes.get(d))
                elif not (len(x[0]) and len(x[1])):
                    continue
                else:
                    n, label = tile_links(x[0], x[1], threshold, axes.get(d))
                at = np.concatenate(ids)
                linked = n > 0
                yield _links_of(at[linked], n[linked], at[label[linked]])

    cores = {(r["d"], r["cell"]): (r["n"], r["least"]) for r in packs.where("core").groupBy("d", "cell").agg(F.sum("n").alias("n"), F.min("least").alias("least")).collect()}  # a row for each pivot at most

    def inside_core(batches):
        for batch in batches:
            for r in batch.to_pylist():
                n, least = cores[r["d"], r["cell"]]
                if n > 1:
                    ids = np.frombuffer(r["ids"], np.int64)
                    yield _links_of(ids, np.full(len(ids), n - 1), np.full(len(ids), least))

    columns = ("pack", "d", "cell", "core", "centre", "spread", "ids", "vectors")
    parts = max(SIDE, n_packs // SIDE_PACKS)
    a, b = (packs.select(*(F.col(c).alias(f"{side}_{c}") for c in columns)).coalesce(parts) for side in "ab")
    one_core = F.col("a_core") & F.col("b_core") & (F.col("a_cell") == F.col("b_cell"))
    reach = _between(F.col("a_centre"), F.col("b_centre")) <= F.col("a_spread") + F.col("b_spread") + F.lit(radius + 4 * _SLACK)
    # each pair of packs once, and as often with the one as with the other in front
    once = F.when(F.col("a_pack") == F.col("b_pack"), True).otherwise((F.col("a_pack") < F.col("b_pack")) == ((F.col("a_pack") + F.col("b_pack")) % 2 == 0))
    met = a.hint("shuffle_replicate_nl").join(b, (F.col("a_d") == F.col("b_d")) & once & ~one_core & reach)
    met = met.select(F.col("a_d").alias("d"), (F.col("a_pack") == F.col("b_pack")).alias("inside"), *(f"{side}_{c}" for side in "ab" for c in ("centre", "spread", "ids", "vectors")))
    found = met.mapInArrow(compare, _FOUND)
    with common.setting(fine.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", "4m"):  # a pair or two of packs at once, not what fills a batch
        return common.checkpointed(found.unionByName(packs.where("core").select("d", "cell", "ids").mapInArrow(inside_core, _FOUND)))


def near_vectors(vectors: DataFrame, threshold: float = COSINE, tile: int | None = None, embedding: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Null, zero and non-finite vectors link with nothing; rows without an id too, and have a null component and are kept.
    Rows with the same id are one vector. Vectors are compared with those of the same length. Ties at the threshold link;
    the threshold is above 0 and at most 1. An empty table gives no rows; other columns aren't read. `tile` is the number
    of vectors in a pack, by itself it follows the table's size.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the triangle inequality bounds angles below a right one, so the threshold has to be above 0")
    found = _found(usable(vectors, embedding), threshold, tile)
    n_links = found.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    joined = components(found.select(F.col("vec_id").alias("a"), F.col("to").alias("b"))).select(F.col("id").alias("vec_id"), "component")
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(n_links, "vec_id", "left").join(joined, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(common.table(spark, sf_dir, "embeddings"))


QUERIES = {"op6_embedding_near_dedup": op6_embedding_near_dedup}
ORACLES = {
    "op6_embedding_near_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, c.component_id, c.component_id = e.vec_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id"""
}
