"""Deliveries of many portfolios and ladders of attempts against plain loops."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from dossier.operators import delivery, ladder
from dossier.queries import deliveries

SCHEMA = "portfolio string, module string, key string, ord long, score long, strict boolean, fallback boolean, home boolean, graded boolean, _rank string, place string"
MODULES = ("a", "b", "c")


def first_of_key(rows):
    seen, out = set(), []
    for r in rows:
        if r["key"] not in seen:
            seen.add(r["key"])
            out.append(r)
    return out


def best(r):
    return (-r["score"], r["ord"])


def chosen_by_loop(rows, t):
    rows = first_of_key(sorted((r for r in rows if r["strict"] and r["graded"]), key=lambda r: r["ord"]))
    rows.sort(key=best)
    out, count = [], defaultdict(int)

    def take(r):
        if len(out) < t.target and r not in out and count[r["module"]] < t.cap:
            out.append(r)
            count[r["module"]] += 1

    for i in range(t.floor):
        lead = [own[i] for m in t.modules if len(own := [r for r in rows if r["module"] == m]) > i]
        for r in sorted(lead, key=best):
            take(r)
    for r in rows:
        take(r)
    return out


def delivered_by_loop(rows, t):
    strict = sorted(first_of_key(sorted((r for r in rows if r["strict"]), key=lambda r: r["ord"])), key=best)
    out = sorted((own[0] for m in t.modules if (own := [r for r in strict if r["module"] == m])), key=best)[: t.target]
    for r in strict:
        if len(out) < t.target and r not in out:
            out.append(r)
    stand_ins = first_of_key(sorted((r for r in rows if r["fallback"]), key=best))
    if not out:
        return [(r, "fallback") for r in stand_ins[: t.target]]
    need = min(t.home, t.target, sum(1 for r in rows if r["home"] and r["graded"])) if out else 0
    used, have = {r["key"] for r in out}, sum(1 for r in out if r["home"])
    more = [r for r in stand_ins if r["home"] and r["key"] not in used][: max(0, need - have)]
    return sorted([(r, "strict") for r in out] + [(r, "home") for r in more], key=lambda x: best(x[0]))


def fixture(spark, rng):
    rows = []
    for p in [None, "", *(f"p{i}" for i in range(40))]:
        for o in range(rng.choice([1, 3, 9, 30])):
            flags = [rng.choice([True, True, False, None]) if rng.random() < 0.9 else None for _ in range(4)]
            if p in ("p1", "p2"):
                flags[0] = False
            rows.append((p, rng.choice(["a", "a", "b", "c", "z", None]), rng.choice([None, "", *"klmnopqrstuv"]), o, rng.randrange(6), *flags, "x", "y"))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    by = defaultdict(list)
    for r in df.collect():
        by[r["portfolio"]].append(r.asDict())
    return df, by


def test_deliveries_follow_the_loops(spark):
    for seed, t in ((1, delivery.Terms(MODULES, target=5, fewest=3, most=6, floor=1, cap=2, home=2, graded=2)), (2, delivery.Terms(MODULES, target=2, fewest=1, most=3, floor=2, cap=3, home=3, graded=1))):
        df, by = fixture(spark, random.Random(seed))
        # the columns _rank and place of the caller's are no part of the rows' contract
        df = df.drop("_rank", "place")
        got, sent = defaultdict(dict), defaultdict(dict)
        for r in delivery.chosen(df, t, F.desc("score")).collect():
            got[r["portfolio"]][r["place"]] = r["ord"]
        taken = delivery.delivered(df, t, F.desc("score"))
        for r in taken.collect():
            sent[r["portfolio"]][r["place"]] = (r["ord"], r["how"])
        hows = set()
        for p, rows in by.items():
            assert [got[p][i + 1] for i in range(len(got[p]))] == [r["ord"] for r in chosen_by_loop(rows, t)], p
            want = [(r["ord"], how) for r, how in delivered_by_loop(rows, t)]
            assert [sent[p][i + 1] for i in range(len(sent[p]))] == want, p
            hows |= {how for _, how in want}
        assert hows == {"strict", "home", "fallback"}
        audit = {r["portfolio"]: r for r in delivery.audit(df, taken, t).collect()}
        assert set(audit) == set(by)
        for p, a in audit.items():
            out = [r for r, _ in delivered_by_loop(by[p], t)]
            assert (a["rows"], a["taken"], a["taken_home"]) == (len(by[p]), len(out), sum(1 for r in out if r["home"]))
            assert a["missing"] == [m for m in MODULES if m not in {r["module"] for r in out}]
            assert set(a["out_of_pool"]) <= set(a["underfilled"]) and (a["status"] == "whole") == (not a["codes"])


def test_an_empty_table_of_rows(spark):
    t = delivery.Terms(MODULES)
    df = spark.createDataFrame([], SCHEMA).drop("_rank", "place")
    assert delivery.chosen(df, t, F.desc("score")).isEmpty()
    assert delivery.audit(df, delivery.delivered(df, t, F.desc("score")), t).isEmpty()


def test_every_code_and_state_occurs_over_the_tables(spark):
    rows = deliveries.customer_delivery_audit(spark, "/root/testdata/sf0.01").collect()
    codes = {c for r in rows for c in r["codes"].split(",") if c}
    assert codes == {"no-items", "no-home", "few-home", "few-graded", "item-count", "missing-module", "underfilled-module"}
    assert {r["status"] for r in rows} == {"whole", "partial", "refused"}
    assert any(r["out_of_pool"] and r["out_of_pool"] != r["underfilled"] for r in rows)
    pages = deliveries.page_recovery(spark, "/root/testdata/sf0.01").collect()
    assert {(r["recovery_status"], r["recovery_method"]) for r in pages} == {("ok", "direct"), ("recovered", "retry"), ("recovered", "browser"), ("recovered", "alternate"), ("failed", "")}


FAILS = {"soft": (503, "http", ""), "hard": (404, "http", ""), "login": (401, "http", ""), "captcha": (0, "captcha", ""), "blank": (200, "http", ""), "late": (None, "timeout", "timed out"), "none": (None, None, None)}


def ladder_by_loop(plan, others, tries, browser):
    """(status, method, log of methods, wait) of a plan: what each attempt brings, "ok" or a key of FAILS."""
    log, wait = [], 0
    direct = None
    for i in range(max(1, tries)):
        log.append("direct" if i == 0 else "retry")
        direct = plan[len(log) - 1]
        if direct == "ok":
            return ("ok" if i == 0 else "recovered"), log[-1], log, wait
        if direct not in ("soft", "late", "none") or i >= tries - 1:
            break
        wait += (10, 20)[min(i, 1)]
    steps = (["browser"] if browser and direct not in ("login", "captcha") else []) + ["alternate"] * len(others or [])
    for m in steps:
        log.append(m)
        if plan[len(log) - 1] == "ok":
            return "recovered", m, log, wait
    return "failed", "", log, wait


def test_ladders_follow_the_loop(spark):
    rng = random.Random(3)
    kinds = ["ok", *FAILS]
    rows = [(i, f"http://h/{i}", rng.choice([None, [], ["u"], ["u", "v", "w"]]), [rng.choice(kinds[rng.random() > 0.4 :]) for _ in range(9)], "kept") for i in range(250)]
    df = spark.createDataFrame(rows, "id long, url string, alternate_urls array<string>, plan array<string>, note string").repartition(3)
    fails = F.create_map(*(F.lit(x) for k, (s, kind, e) in FAILS.items() for x in (k, f"{'' if s is None else s}|{kind or ''}|{e or ''}")))

    def attempt(d):
        what = F.get("plan", F.col("attempt_number") - 1)
        part = F.split(F.coalesce(fails[what], F.lit("200|http|")), r"\|")
        ok = (what == "ok") | (what == "blank")
        return d.withColumns({"ok": ok, "status": F.nullif(part[0], F.lit("")).cast("int"), "kind": F.nullif(part[1], F.lit("")), "error": F.nullif(part[2], F.lit("")), "html": F.when(what == "ok", F.col("attempt_url")).when(what == "blank", " \n"), "final_url": F.lit(None).cast("string"), "duration_ms": F.lit(-5)})

    for tries, browser in ((3, True), (1, False)):
        out = {r["id"]: r for r in ladder.recovered(df, attempt, tries, (10, 20), browser, F.lit(0)).collect()}
        assert set(out) == set(range(250))
        for i, url, others, plan, _ in rows:
            r = out[i]
            status, method, log, wait = ladder_by_loop(plan, others, tries, browser)
            assert (r["recovery_status"], r["recovery_method"], [a["method"] for a in r["attempts"]], r["waited_ms"], r["note"]) == (status, method, log, wait, "kept"), (plan, others)
            assert all(a["duration_ms"] == 0 for a in r["attempts"]) and (r["final_error"] == "") == (status != "failed")
            used = (others or [])[log.count("alternate") - 1] if method == "alternate" else url
            assert (r["html"], r["final_url"]) == ((used, url) if status != "failed" else ("", ""))
    assert ladder.recovered(df.where("false"), attempt).isEmpty()
