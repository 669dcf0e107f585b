"""Control plane: fetch rounds, ledgers, life cycles, queues, constraints, decisions, objects and sweeps on small cases."""

import datetime as dt
import glob
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import catalogue, constraints, decisions, incremental, lifecycle, queue, sweep
from tidemark.operators.constraints import Check, Reference, Unique
from tidemark.sources import ledger, objects

D = lambda i: dt.date(2026, 1, 1) + dt.timedelta(i)
LOG = "code string, day date, close double, version int, full boolean"


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# Fetch rounds


def fetch(spark, log, source, keys, version=1, required=3, run=D(5)):
    held = spark.createDataFrame(log, LOG)
    offered = spark.createDataFrame(source, "code string, day date, close double, ord int")
    names = spark.createDataFrame([(k,) for k in keys], "code string")
    rows, man = incremental.fetch_round(held, offered, names, "code", "day", "ord", required, str(run), ["close"], version)
    return held, rows, man


def test_a_round_takes_later_rows_whole_histories_or_nothing(spark):
    log = [("late", D(i), 1.0, 0, True) for i in range(4)] + [("full", D(5), 1.0, 0, True)] + [("ok", D(i), 1.0, 0, True) for i in range(2, 6)] + [("void", D(i), None, 0, True) for i in range(6)]
    source = [("late", D(2), 9.0, 1), ("late", D(4), 2.0, 1), ("late", D(5), 2.0, 1), ("late", D(5), 3.0, 2), ("late", D(6), 4.0, 1)]
    source += [("full", D(i), 5.0, 1) for i in range(6)] + [("ok", D(0), 7.0, 1)] + [("void", D(i), 5.0, 1) for i in range(6)]
    held, rows, man = fetch(spark, log, source, ["late", "full", "ok", "void", "gone"])
    assert rows_of(rows, "code", "day", "close", "full") == sorted([("late", D(4), 2.0, False), ("late", D(5), 3.0, False), *(("full", D(i), 5.0, True) for i in range(6)), *(("void", D(i), 5.0, True) for i in range(6))], key=repr)
    assert rows_of(man, "code", "fetched_bars", "status", "error", "newly_fetched_days") == [
        ("full", 6, "ok", None, 6), ("gone", 0, "failed", "fetch_failed", 0), ("late", 6, "ok", None, 2), ("ok", 4, "ok", None, 0), ("void", 6, "ok", "schema_mismatch_missing_ohlcv:close", 6),
    ]
    now = incremental.in_force(held.unionByName(rows), "code", "day")
    assert [r for r in rows_of(now, "code", "day", "close") if r[0] == "late"] == [("late", D(i), c) for i, c in enumerate((1.0, 1.0, 1.0, 1.0, 2.0, 3.0))]
    again = [tuple(r) for r in held.unionByName(rows).collect()]
    _, more, man2 = fetch(spark, again, source, ["late", "full", "ok", "void"], 2)
    assert more.count() == 0 and {r["newly_fetched_days"] for r in man2.collect()} == {0}


def test_stale_keys_are_left_out_up_to_a_number(spark):
    man = spark.createDataFrame([(f"k{i} ", "stale") for i in range(10)] + [("fine", "ok")], "code string, status string")
    with pytest.raises(incremental.StaleDataError):
        incremental.stale_exclusions(man, "code", "2026-01-06")
    out = incremental.stale_exclusions(man.where("code <> 'k9 '"), "code", "2026-01-06")
    rows = spark.createDataFrame([("k1",), ("fine",), ("k9",)], "code string")
    assert rows_of(incremental.without_stale(rows, out, "code", "2026-01-06"), "code") == [("fine",), ("k9",)]
    assert incremental.without_stale(rows, out, "code", "2026-01-07").count() == 3


# Resumable batches


def doubled(rows):
    return rows.select("_chunk", "k", (F.col("v") * 2).alias("v"))


def test_a_broken_run_taken_up_again_equals_a_whole_one(spark, tmp_path):
    rows = spark.createDataFrame([(i % 20, i) for i in range(100)] + [(None, 1)], "k long, v long")
    name = ledger.run_fingerprint(rows, "k", "p")
    assert name == ledger.run_fingerprint(rows.orderBy(F.desc("v")), "k", "p") != ledger.run_fingerprint(rows, "k", "q")
    chunk = F.pmod("k", F.lit(6)).cast("long")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    assert ledger.run_chunks(rows, "k", chunk, doubled, a, name, wave_chunks=2, waves=1) == 4

    def breaks(part):
        doubled(part).write.partitionBy("_chunk").parquet(f"{a}/data/lost")  # a wave that never reached the ledger
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        ledger.run_chunks(rows, "k", chunk, breaks, a, name)
    seen = []
    work = lambda part: seen.extend(r[0] for r in part.select("_chunk").distinct().collect()) or doubled(part)
    assert ledger.run_chunks(rows, "k", chunk, work, a, name) == 0 and sorted(seen) == [2, 3, 4, 5]
    assert ledger.run_chunks(rows, "k", chunk, doubled, b, name) == 0
    assert rows_of(ledger.finished_rows(spark, a, name), "k", "v") == rows_of(ledger.finished_rows(spark, b, name), "k", "v")
    assert ledger.finished_rows(spark, a, name).count() == 100
    with pytest.raises(ValueError):
        ledger.finished_rows(spark, a, "other")


# Life cycle


def test_steps_are_judged_in_order_and_one_version_is_active(spark):
    steps = [
        ("insert", "a", None, "shadow", "insert_must_be_draft"), ("insert", "a", None, "draft", None), ("insert", "a", None, "draft", "exists"), ("member", "b", None, None, "unknown_version"), ("member", "a", None, None, None),
        ("activate", "a", None, None, "not_activatable"), ("move", "a", "draft", "active", "move_not_allowed"), ("move", "a", "shadow", "draft", "move_denied"), ("move", "a", "draft", "shadow", None), ("member", "a", None, None, "members_need_draft"),
        ("activate", "a", "z", None, "pointer_conflict"), ("activate", "a", None, None, None), ("activate", "a", "a", None, None), ("insert", "b", None, "draft", None), ("move", "b", "draft", "retired", None), ("activate", "b", "a", None, None), ("drop", "b", None, None, "unknown_step"),
    ]
    log = spark.createDataFrame([("p", i, *s[:4]) for i, s in enumerate(steps)] + [(None, 0, "activate", "a", None, None)], "pointer string, seq long, op string, version string, before string, after string")
    got = lifecycle.replay(log.repartition(4), "pointer", ["seq"])
    one = [r for r in got.orderBy("seq").collect() if r["pointer"] == "p"]
    assert [r["reason"] for r in one] == [s[4] for s in steps] and one[-1]["active"] == "b"
    assert rows_of(lifecycle.active_versions(got, "pointer"), "pointer", "active", "n_accepted", "n_rejected") == [("p", "b", 8, 9), (None, None, 0, 1)]


# Queues


def test_tokens_fence_and_claims_run_out(spark):
    calls = [(1, "claim", None, 60), (50, "heartbeat", 1, 100), (60, "dispatch", 1, 0), (151, "finish", 1, 0), (152, "claim", None, 60), (153, "fail", 1, 60), (154, "fail", 2, 0), (155, "claim", None, 60), (214, "claim", None, 60), (215, "finish", 3, 0), (300, "heartbeat", 3, 60), (301, "fail", 3, 60), (400, "claim", None, 60)]
    log = spark.createDataFrame([(7, i, at, op, t, s) for i, (at, op, t, s) in enumerate(calls)] + [(8, 99, 10, "claim", None, 60)], "entry long, seq long, at long, op string, token long, seconds long")
    got = queue.replay(log.repartition(3), "entry", 1000).orderBy("entry", "at", F.desc_nulls_first("seq")).collect()
    want = [(1, "claim", None), (50, "heartbeat", None), (60, "dispatch", None), (150, "reclaim", None), (151, "finish", "bad_status"), (152, "claim", None), (153, "fail", "fencing_mismatch"), (154, "fail", None), (155, "claim", "not_eligible"), (214, "claim", None), (215, "finish", None), (300, "heartbeat", "bad_status"), (301, "fail", None), (400, "claim", "not_eligible")]
    assert [(r["at"], r["op"], r["reason"]) for r in got if r["entry"] == 7] == want  # after three attempts the budget is spent
    assert [(r["at"], r["op"]) for r in got if r["entry"] == 8] == [(10, "claim"), (70, "reclaim")]


# Constraints


def test_catalogue_of_constraints(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", None), (2, None, -1), (2, None, 3), (3, "b", 4)], "id int, s string, n int")
    good = spark.createDataFrame([(1,), (2,)], "x int")
    got = constraints.violations(df, [Check("positive", "n > 0"), Check("fine", "id > 0"), Unique("pair", ("id", "s")), Unique("small", ("id",), "n < 4"), Reference("known", ("id",), good, ("x",))])
    assert rows_of(got, "rule", "kind", "n_rows", "n_keys") == [("known", "reference", 1, 1), ("pair", "unique", 2, 1), ("positive", "check", 1, None), ("small", "unique", 2, 1)]
    seen, counts = constraints.observed(df, [Check("positive", "n > 0")])
    assert seen.count() == 5 and counts.get == {"positive": 1}
    assert rows_of(constraints.broken_rules(df, [Check("positive", "n > 0"), Check("s", "s <> 'b'")]).withColumn("b", F.array_join("broken", ",")), "id", "b") == [(2, "positive"), (3, "s")]
    assert constraints.violations(df.limit(0), [Check("positive", "n > 0"), Unique("pair", ("id", "s"))]).count() == 0


# Decisions


def test_the_most_specific_rule_decides(spark):
    rules = decisions.rule_table(spark, ["a", "b"], "out", [("*", "*", "any"), ("x", "*", "x any"), ("*", "y", "any y"), ("x", "*", "x again"), ("x", "y", "both")])
    rows = spark.createDataFrame([(" X ", "y"), ("x", "z"), ("w", "Y"), ("x", None), (None, None)], "a string, b string")
    got = decisions.decide(rows, rules, ["a", "b"], "out")
    assert rows_of(got, "a", "b", "out", "rule") == sorted([(" X ", "y", "both", 4), ("x", "z", "x any", 1), ("w", "Y", "any y", 2), ("x", None, "x any", 1), (None, None, "any", 0)], key=repr)
    few = rules.where("rule = 4")
    assert [r["out"] for r in decisions.decide(rows, few, ["a", "b"], "out", strict=False).collect()].count(None) == 4
    with pytest.raises(Exception, match="no rule fits"):
        decisions.decide(rows, few, ["a", "b"], "out").collect()


# Objects


def test_objects_are_the_same_bytes_and_all_or_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(f"s/k{i}.json.gz", f"body {i} é" * 50) for i in range(20)], "key string, body string").repartition(4)
    a, b = tmp_path / "a", tmp_path / "b"
    objects.write_objects(rows, f"file://{a}")
    objects.write_objects(rows.repartition(2), str(b))
    files = lambda d: {os.path.relpath(p, d): open(p, "rb").read() for p in glob.glob(f"{d}/**", recursive=True) if os.path.isfile(p)}
    assert files(a) == files(b) and len(files(a)) == 21 and gzip.decompress(files(a)["s/k3.json.gz"]).decode() == "body 3 é" * 50
    assert objects.manifest_faults(objects.scan_objects(spark, str(a)), objects.read_manifest(spark, str(a))).count() == 0
    for bad in (spark.createDataFrame([("s/new", "x"), ("s/big", json.dumps(list(range(9000))))], rows.schema).repartition(2), rows.unionByName(rows).limit(40)):
        with pytest.raises(Exception, match="at most|twice"):
            objects.write_objects(bad, str(a), most_bytes=5000)
        assert files(a) == files(b) and not glob.glob(f"{a}/.staging*")
    with pytest.raises(Exception, match="other contents"):
        objects.write_objects(spark.createDataFrame([("s/k1.json.gz", "changed")], rows.schema), str(a), create_only=True)
    objects.write_objects(rows, str(a), create_only=True)
    assert files(a) == files(b)


def test_a_pointer_moves_to_what_the_manifest_holds(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{i}", "x" * i) for i in range(5)], "key string, body string")
    folder, pointer = str(tmp_path / "new"), str(tmp_path / "latest")
    objects.write_objects(rows, folder)
    assert objects.publish_verified(spark, folder, pointer) and open(pointer).read() == folder
    with open(f"{folder}/k1", "ab") as f:
        f.write(b"!")
    os.remove(f"{folder}/k2")
    with open(f"{folder}/k9", "w") as f:
        f.write("x")
    assert rows_of(objects.manifest_faults(objects.scan_objects(spark, folder), objects.read_manifest(spark, folder)), "key", "fault") == [("k1", "changed"), ("k2", "missing"), ("k9", "extra")]
    os.remove(pointer)
    assert not objects.publish_verified(spark, folder, pointer) and not os.path.exists(pointer)


# Sweep


@pytest.mark.parametrize("limit", [1, 4, 7, 100])
def test_runs_of_a_sweep_reach_every_orphan_once(spark, limit):
    things = spark.createDataFrame([(f"k{i:02}", dt.datetime(2026, 1, 1 + i % 3)) for i in range(20)] + [(None, dt.datetime(2026, 1, 1))], "key string, created_at timestamp")
    live = spark.createDataFrame([("k03",), ("k04",), (None,)], "key string")
    found = sweep.orphans(things, live, "key", "2026-01-03")
    after, got = None, []
    for _ in range(30):
        pages, after = sweep.sweep(found, "key", limit, 2, after)
        got += [r[0] for p in pages for r in p.plan.collect()]
        if after is None:
            break
    assert got == sorted(got) == [f"k{i:02}" for i in range(20) if i % 3 < 2 and i not in (3, 4)]


# Catalogue


def test_a_table_must_hold_to_its_catalogue(spark):
    df = spark.createDataFrame([("7", 1.00000000004, float("nan"), "é", "tr")], "code string, a double, b double, s string, t string")
    table = spark.createDataFrame([("b", "float", 2), ("a", "float", 1), ("s", "string", 3), ("t", "bool", 4)], "metric_key string, value_type string, position int")
    r = catalogue.snapshot(df, table).first()
    assert r["instrument_code"] == "0007" and r["a"] == 1.0 and r["b"] is None and r["s"] == "é" and r["t"] is None
    assert r["_flags"]["missing_metrics"] == ["t"] and r["_flags"]["non_finite_metrics"] == ["b"]
    for bad in ([{"metric_key": "none", "value_type": "int"}], [{"metric_key": "a", "value_type": "date"}], [{"metric_key": "a", "value_type": "int"}] * 2):
        with pytest.raises(catalogue.CatalogueError):
            catalogue.snapshot(df, bad)
