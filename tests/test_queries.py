"""Every registered query of the library against its SQL in another engine, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from dossier import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def other():
    d = duckdb.connect()
    d.execute("set timezone='UTC'")
    for t in TABLES:
        d.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return d


def plain(df: pd.DataFrame) -> list[tuple]:
    def one(v):
        return "~" if v is None or (isinstance(v, float) and v != v) else repr(round(v, 9)) if isinstance(v, float) else str(v)

    df = df[sorted(df.columns)]
    return sorted(tuple(one(v) for v in row) for row in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, other, name):
    got, want = registry.QUERIES[name](spark, DATA).toPandas(), other.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_byte_chunks_of_documents(spark):
    rows = registry.QUERIES["doc_byte_chunks"](spark, DATA).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    want = []
    for i, text in texts.items():
        sizes, at = [], None
        for line in filter(None, text.split("\n")):
            n = len(line.encode())
            if at is not None and at + 1 + n <= 1200:
                at += 1 + n
            else:
                sizes += [at] if at is not None else []
                at = n
        want += [(i, k, n) for k, n in enumerate(sizes + ([at] if at is not None else []))]
    assert sorted(map(tuple, rows)) == sorted(want)


def test_joint_quota_of_events(spark):
    used, users, kinds, taken = {}, {}, {}, 0
    rows = sorted(registry.QUERIES["event_joint_quota"](spark, DATA).collect(), key=lambda r: r["ord"])
    for r in rows:
        why = "total" if taken >= 100 else "user_id-capacity" if users.get(r["user_id"], 0) >= 2 else "event_type-capacity" if kinds.get(r["event_type"], 0) >= 40 else None
        assert r["reason"] == why
        if why is None:
            taken += 1
            users[r["user_id"]], kinds[r["event_type"]] = users.get(r["user_id"], 0) + 1, kinds.get(r["event_type"], 0) + 1
    assert taken and used == {}


def test_joint_quota_has_a_reason_for_every_event(spark, tmp_path):
    """One user's events fill the first thousands; all rows have a reason, and the quotas are filled by later ones."""
    kinds = ["view", "click", "purchase", "signup"]
    spark.range(6000).selectExpr("id as event_id", "if(id < 5000, 1, id) as user_id", f"array({', '.join(map(repr, kinds))})[id % 4] as event_type").write.parquet(str(tmp_path / "events.parquet"))
    got = {r["ord"]: r["reason"] for r in registry.QUERIES["event_joint_quota"](spark, str(tmp_path)).collect()}
    taken = [0, 1, *range(5000, 5098)]
    assert sorted(got) == list(range(6000))
    assert [i for i in sorted(got) if got[i] is None] == taken
    assert {got[i] for i in range(2, 5000)} == {"user_id-capacity"} and {got[i] for i in range(5098, 6000)} == {"total"}


def test_every_order_and_whole_texts(spark):
    assert registry.QUERIES["scored_orders"](spark, DATA).count() == spark.read.parquet(f"{DATA}/orders.parquet").count()
    turns = spark.read.parquet(f"{DATA}/conversations.parquet").collect()
    first = {}
    for r in sorted(turns, key=lambda r: r["turn"]):
        first.setdefault(f"{r['conv_id']}/{r['role']}", r["text"])
    got = {r["key"]: r["first_said"] for r in registry.QUERIES["turn_text_lookups"](spark, DATA).collect()}
    assert got == first and any(len(t or "") > 40 for t in got.values())


def test_supplier_events_where_a_key_is_a_portals_name(spark, tmp_path):
    """Suppliers 163 and 1163 have papers of their own, so their events have two sources, as the SQL says."""
    spark.sql("select id as s_suppkey, concat('Supplier', id) as s_name, 1 as s_nationkey, 0.0d as s_acctbal from values (162L), (163L), (1163L) as t(id)").write.parquet(str(tmp_path / "supplier.parquet"))
    d = duckdb.connect()
    d.execute(f"create view supplier as select * from '{tmp_path}/supplier.parquet/*.parquet'")
    got, want = registry.QUERIES["supplier_events"](spark, str(tmp_path)).toPandas(), d.execute(registry.ORACLES["supplier_events"]).df()
    assert plain(got) == plain(want) and len(got) == 3


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
