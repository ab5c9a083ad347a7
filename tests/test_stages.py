"""Runs that are killed and started again, the ledger of deliveries, and the stateful stream."""

import pytest
from pyspark.sql import functions as F

from dossier.operators import stages
from dossier.queries import runs
from dossier.streaming import seen


class Killed(Exception):
    pass


@pytest.fixture
def stateful(spark):
    for k, v in seen.SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k in seen.SETTINGS:
        spark.conf.unset(k)


def items(spark, *urls):
    return spark.createDataFrame(list(enumerate(urls)), "ord long, url string")


def test_stage_is_made_once_and_a_killed_attempt_is_not_read(spark, tmp_path):
    run, made = stages.Stages(spark, str(tmp_path / "run")), []

    def make():
        made.append(1)
        return spark.range(3)

    spark.range(99).write.parquet(str(tmp_path / "run/tables/a/000001"))  # written, never committed
    assert run.read("a") is None and not run.has("a")
    assert run.stage("a", make).count() == 3 and run.stage("a", make).count() == 3 and len(made) == 1
    assert run.commits() == {"a": "000002"}
    assert run.stage("b", lambda: spark.range(0)).count() == 0 and run.has("b")
    assert run.read("a", "b", "never").count() == 3
    assert run.sweep() == 1 and run.sweep() == 0 and run.read("a").count() == 3
    with pytest.raises(ValueError):
        run.stage("a/b", make)


def test_failed_stage_leaves_no_commit(spark, tmp_path):
    run = stages.Stages(spark, str(tmp_path / "run"))

    def broken():
        raise Killed

    with pytest.raises(Killed):
        run.stage("a", broken)
    assert not run.has("a") and run.stage("a", lambda: spark.range(2)).count() == 2


def test_delivery_after_each_kind_of_loss(spark, tmp_path):
    ledger, got, fail = stages.Stages(spark, str(tmp_path / "ledger")), {}, []

    def send(outbox):
        rows = outbox.collect()
        if fail and fail[0] == "refuse":
            fail.clear()
            return False
        for r in rows:
            got.setdefault(r["delivery_id"], []).append(r["url"])
        if fail:
            fail.clear()
            raise Killed
        return True

    def go(batch, day, *urls):
        run = stages.Stages(spark, str(tmp_path / batch))
        return stages.deliver(run, ledger, batch, lambda: items(spark, *urls), F.lit(day), send)

    a, b, c = "http://x.cn/a", "http://x.cn/b", "http://x.cn/c"
    fail.append("refuse")
    assert go("r0", "2026-01-01", a, a + "#again", None, "") == "failed" and not got and not ledger.has("r0")
    assert go("r0", "2026-01-01", a) == "done" and list(got.values()) == [[a]]
    assert go("r0", "2026-01-01", a, c) == "done" and len(got) == 1  # a batch in the ledger is closed
    assert go("r1", "2026-01-10", a) == "skipped" and not ledger.has("r1")
    fail.append("kill")
    with pytest.raises(Killed):
        go("r2", "2026-01-11", a, b)
    assert go("r2", "2026-01-11", a, b, c) == "done"  # the same rows under the same id, though the input has grown
    assert [u for k, u in got.items() if k.startswith("r2/")] == [[b, b]]
    assert go("r3", "2026-01-31", a, b) == "done"  # exactly 30 days after the first: delivered again
    assert [u for k, u in got.items() if k.startswith("r3/")] == [[a]]


def test_last_run_is_patched_field_by_field(spark):
    df = spark.createDataFrame([("x", None, 1), (None, "ok", 3), ("y", "bad", 2)], "run string, status string, at long")
    assert stages.last_run(df).collect() == [("y", "ok", 3)]
    assert stages.last_run(df.limit(0)).collect() == [(None, None, None)]


def test_runs_meet_repeats_expiry_and_the_lost_batch(spark):
    rows = runs.page_delivery_runs(spark, "/root/testdata/sf0.001").collect()
    by = [{r["key"] for r in rows if r["run"] == i} for i in range(4)]
    assert all(by) and not by[0] & by[1] and not by[1] & by[2] and not by[2] & by[3]
    assert by[0] & by[2] and by[1] & by[3] and all(r["page_id"] % 5 != 3 for r in rows if r["run"] == 2)


def test_runs_over_no_pages(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(0).write.parquet(str(tmp_path / "pages.parquet"))
    assert runs.page_delivery_runs(spark, str(tmp_path)).collect() == []


def test_stream_delivers_once_in_a_window_and_after_a_restart(stateful, tmp_path):
    src, out, ckpt = (str(tmp_path / d) for d in ("src", "out", "ckpt"))

    def add(*rows):
        stateful.createDataFrame(list(rows), "url string, at string").selectExpr("url", "cast(at as timestamp) as at").coalesce(1).write.mode("append").parquet(src)

    def go():
        stream = stateful.readStream.schema("url string, at timestamp").option("maxFilesPerTrigger", 1).parquet(src)
        q = seen.delivered_stream(stream, "url", "at").writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start(out)
        assert q.awaitTermination(120)
        return sorted((r["url"], str(r["at"])[:10]) for r in stateful.read.parquet(out).collect())

    a, b = "http://x.cn/a", "http://x.cn/b"
    add((a, "2026-01-01"), (a + "#x", "2026-01-02"), (None, "2026-01-01"), (b, None), ("", "2026-01-01"))
    assert go() == [(a, "2026-01-01")]
    add((a, "2026-01-20"), (b, "2026-01-20"))
    assert go() == [(a, "2026-01-01"), (b, "2026-01-20")]
    add((a, "2026-01-31"), (b, "2026-01-31"))
    assert go() == [(a, "2026-01-01"), (a, "2026-01-31"), (b, "2026-01-20")]


def test_stream_forgets_after_its_time_to_live(stateful, tmp_path):
    src, out, ckpt = (str(tmp_path / d) for d in ("src", "out", "ckpt"))
    for _ in range(2):
        stateful.createDataFrame([("http://x.cn/a", "2026-01-01")], "url string, at string").selectExpr("url", "cast(at as timestamp) as at").write.mode("append").parquet(src)
        stream = stateful.readStream.schema("url string, at timestamp").parquet(src)
        q = seen.delivered_stream(stream, "url", "at", ttl_ms=1).writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start(out)
        assert q.awaitTermination(120)
    assert stateful.read.parquet(out).count() == 2
