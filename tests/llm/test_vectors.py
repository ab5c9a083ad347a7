import numpy as np
import pytest

from dossier.llm import metric_join, topk_bsi
from dossier.llm.components import components

from .brute import Union


def table(spark, x):
    return spark.createDataFrame([(i, None if v is None else [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(3)


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((160, 16))
    centre = rng.standard_normal(16)
    tight = centre + 0.05 * rng.standard_normal((50, 16))
    loose = centre + 0.35 * rng.standard_normal((40, 16))
    return np.concatenate([x, tight, loose, 3 * tight[:5]]).astype(np.float32)


@pytest.mark.parametrize("tile", [24, 100, 8192])
def test_links_and_components(spark, points, tile):
    x = points.astype(float)
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = n @ n.T >= 0.9
    np.fill_diagonal(near, False)
    u = Union(range(len(x)))
    for a, b in zip(*np.nonzero(near), strict=True):
        u.join(int(a), int(b))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in metric_join.near_vectors(table(spark, points), tile=tile).collect()}
    assert got == {i: (int(near[i].sum()), u.find(i), u.find(i) == i) for i in range(len(x))}
    assert near.sum() > 1000


def stages(spark):
    """Shuffled rows by stage, of the latest stages."""
    gateway = spark.sparkContext._gateway
    none = gateway.jvm.java.util.ArrayList()
    found = spark.sparkContext._jsc.sc().statusStore().stageList(none, False, False, gateway.new_array(gateway.jvm.double, 0), none)
    return {(s := found.apply(k)).stageId(): s.shuffleWriteRecords() for k in range(found.size())}


def test_no_vector_is_copied_for_each_tile(spark):
    df = table(spark, np.random.default_rng(9).standard_normal((1500, 24)))
    before = max(stages(spark), default=-1)
    assert len(metric_join.near_vectors(df, tile=24).collect()) == 1500
    assert 1500 <= sum(n for k, n in stages(spark).items() if k > before) < 12 * 1500  # 86,629 when each of 62 tiles had copies


@pytest.mark.parametrize("kind", ["float", "double"])
def test_long_vectors_near_the_threshold_and_of_two_lengths(spark, kind):
    rng = np.random.default_rng(11)
    x = rng.standard_normal((700, 64))
    dense = rng.standard_normal(64) + 0.2 * rng.standard_normal((300, 64))  # about as many pairs on either side of 0.9 as make a block dense
    u = x[:200] / np.linalg.norm(x[:200], axis=1, keepdims=True)
    v = rng.standard_normal((200, 64))
    v -= (v * u).sum(1, keepdims=True) * u
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    c = 0.9 + np.linspace(-1e-4, 1e-4, 200)[:, None]
    sets = [np.concatenate([x, dense, 0.3 * dense + 0.7 * dense[0], c * u + np.sqrt(1 - c * c) * v]), rng.standard_normal((40, 3)) + [2, 0, 0]]
    if kind == "float":
        sets = [y.astype(np.float32).astype(float) for y in sets]
    want, first = {}, 0
    for y in sets:
        n = y / np.linalg.norm(y, axis=1, keepdims=True)
        near = n @ n.T >= 0.9
        np.fill_diagonal(near, False)
        u = Union(range(len(y)))
        for a, b in zip(*np.nonzero(near), strict=True):
            u.join(int(a), int(b))
        want |= {first + i: (int(near[i].sum()), first + u.find(i)) for i in range(len(y))}
        first += len(y)
    df = spark.createDataFrame(list(enumerate(r.tolist() for y in sets for r in y)), f"vec_id long, embedding array<{kind}>").repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in metric_join.near_vectors(df, tile=150).collect()}
    assert got == want


def test_vectors_that_cannot_be_compared(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 4.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [1.0, None]), (None, [1.0, 2.0]), (6, [2.0, 4.0]), (6, [2.0, 4.0]), (7, []), (8, [1.0, 2.0, 3.0])], "vec_id long, embedding array<float>")
    got = [(r["vec_id"], r["n_links"], r["component_id"]) for r in metric_join.near_vectors(df).collect()]
    assert sorted(g for g in got if g[0] in (0, 1, 6)) == [(0, 2, 0), (1, 2, 0), (6, 2, 0), (6, 2, 0)]
    assert all(g[1] == 0 and g[2] == g[0] for g in got if g[0] not in (0, 1, 6)) and len(got) == 11
    assert metric_join.near_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize(("block", "slices"), [(50, 3), (32768, 6), (70, 12)])
def test_top_k(spark, points, block, slices):
    rows = topk_bsi.quantised(table(spark, points))
    got = sorted(tuple(r) for r in topk_bsi.top_k(rows, rows.where("vec_id % 10 = 0"), block=block, chunk=7, slices=slices).collect())
    q, want = np.floor(points.astype(float) * 256).astype(np.int64), []
    for i in range(0, len(q), 10):
        score = q @ q[i]
        best = [k for k in np.lexsort((np.arange(len(q)), -score)) if k != i][:5]
        want += [(i, j + 1, int(k), int(score[k])) for j, k in enumerate(best)]
    assert got == want


def test_top_k_ties_and_few_rows(spark):
    rows = topk_bsi.quantised(table(spark, [[1, 1], [1, 1], None, [1, 1], [float("inf"), 0], [-1, 0.5]]))
    got = sorted(tuple(r) for r in topk_bsi.top_k(rows, rows.where("vec_id in (0, 5)")).collect())
    assert got == [(0, 1, 1, 131072), (0, 2, 3, 131072), (0, 3, 5, -32768), (5, 1, 0, -32768), (5, 2, 1, -32768), (5, 3, 3, -32768)]
    assert topk_bsi.top_k(rows.limit(0), rows).collect() == [] == topk_bsi.top_k(rows, rows.limit(0)).collect()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40, 90)] + [(7, i) for i in range(200, 260)] + [(5, 5), (None, 3), (300, 299), (298, 299)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 40 for i in range(40, 91)} | {i: 7 for i in [7, *range(200, 260)]} | {298: 298, 299: 298, 300: 298}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
