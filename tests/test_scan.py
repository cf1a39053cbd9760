"""Order within groups of any size: against plain Python, with blocks so small that a group has many."""

import random

import pytest
from pyspark.sql import functions as F

from labelloom.operators import runs
from labelloom.plans import scan

LOW = float("-inf")


def plain_stop(metrics, patience, delta):
    best, bad = LOW, 0
    for i, m in enumerate(metrics):
        m = LOW if m is None else m
        if m > best + delta:
            best, bad = m, 0
        else:
            bad += 1
            if bad >= patience:
                return i + 1
    return None


@pytest.fixture
def tiny(monkeypatch):
    monkeypatch.setattr(scan, "BLOCK", 5)


def test_places_by_group_and_in_one_table(spark, monkeypatch):
    rows = [(g, i) for g, n in ((1, 6), (2, 3), (None, 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "g int, i int").repartition(4)
    by_group, span = scan.placed(df, ["g"], "i", name="at")
    assert span == 6 and {(r.g, r.i): r.at for r in by_group.collect()} == {r: r[1] for r in rows}
    monkeypatch.setattr(scan, "BLOCK", 5)
    whole, span = scan.placed(df, ["g"], "i", name="at")
    got = {(r.g, r.i): r.at - r.f for r in scan.with_first(whole, ["g"], "at", "f", span).collect()}
    assert span == len(rows) and got == {r: r[1] for r in rows}


def placed(spark, sizes):
    rng, rows, at = random.Random(1), [], 0
    for g, n in sizes:
        for _ in range(n):
            rows.append((g, at, rng.randrange(50)))
            at += 1
    return rows, spark.createDataFrame(rows, "g int, at bigint, v int").repartition(7)


def test_running_aggregates_over_blocks(spark, tiny):
    rows, df = placed(spark, [(1, 200), (2, 1), (None, 33), (3, 7)])
    for kind, total in (("max", max), ("sum", sum)):
        got = {r.at: r.x for r in scan.before(df, ["g"], "at", "v", kind, "x", len(rows)).collect()}
        for g, at, _ in rows:
            ahead = [v for h, b, v in rows if h == g and b < at]
            assert (got[at] or 0) == (total(ahead) if ahead else 0)
    assert {r.at: r.f for r in scan.with_first(df, ["g"], "at", "f", len(rows)).collect()} == {at: min(b for h, b, _ in rows if h == g) for g, at, _ in rows}


def test_no_task_gets_a_whole_group(spark, tiny):
    """A group with a third of all rows: no key that is sorted or joined has more than BLOCK of them."""
    rows, df = placed(spark, [(1, 100), *[(i, 2) for i in range(2, 102)]])
    keys = scan.blocked(df, ["g"], "at").groupBy("_g", "_block").count()
    assert keys.agg(F.max("count")).first()[0] <= scan.BLOCK and keys.where("_g.g = 1").count() >= 20
    for x in (scan.before(df, ["g"], "at", "v", "max", "x", len(rows)), scan.with_first(df, ["g"], "at", "f", len(rows))):
        plan = x._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window" in line]
        assert all("_block" in w for w in windows[-1:])


def test_hot_groups_are_joined_by_broadcast(spark):
    rows = spark.createDataFrame([(k, i) for k, n in ((1, 60), (2, 20), (3, 1), (None, 4)) for i in range(n)], "k int, i int")
    groups = rows.where("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("top"))
    got = scan.left_join_by_group(rows, groups.where("n > 1"), "k", "n", F.col("i"), most=3)
    assert sorted(map(str, got.collect())) == sorted(str(spark.createDataFrame([(k, i, n, t)], got.schema).first()) for k, i, n, t in [(1, i, 60, 59) for i in range(60)] + [(2, i, 20, 19) for i in range(20)] + [(3, 0, None, None)] + [(None, i, None, None) for i in range(4)])


@pytest.mark.parametrize("patience, delta, block", [(1, 0.0, 5), (2, 0.0, 1 << 16), (2, 0.05, 5), (3, 0.1, 1 << 16), (5, 0.3, 5), (2, -0.05, 5), (0, 0.1, 5)])
def test_early_stop_against_a_fold(spark, monkeypatch, patience, delta, block):
    monkeypatch.setattr(scan, "BLOCK", block)
    rng = random.Random(int(patience * 100 + delta * 1000))
    metrics = {0: [], 1: [0.50, 0.62, 0.64, 0.64, 0.63, 0.62], 2: [None, None, 0.1], 3: [i / 100 for i in range(60)], 4: [0.3, float("nan"), 0.5, LOW]}
    metrics |= {k: [rng.choice([None, rng.random(), rng.random(), k / 40]) for _ in range(rng.randrange(1, 40))] for k in range(5, 20)}
    metrics |= {k: [min(1.0, 0.01 * i + rng.random() * 0.04) for i in range(120)] for k in (20, 21)}
    rows = [(k, i + 1, m, "x") for k, ms in metrics.items() for i, m in enumerate(ms)]
    epochs = spark.createDataFrame(rows, "run_id int, epoch int, val_f1 double, note string").repartition(6)
    clean = {k: [LOW if m != m else m for m in ms] for k, ms in metrics.items()}
    want = {k: plain_stop(ms, patience, delta) for k, ms in clean.items() if ms}
    assert {r.run_id: r.stop_epoch for r in runs.early_stop(epochs, patience, delta).collect()} == want
    ran = runs.effective_epochs(epochs, patience, delta)
    assert ran.columns == epochs.columns
    assert sorted((r.run_id, r.epoch) for r in ran.collect()) == sorted((k, e) for k, e, _, _ in rows if want[k] is None or e <= want[k])


def test_checkpoints_of_a_long_run(spark, tiny):
    rng = random.Random(3)
    ms = [rng.choice([None, round(rng.random(), 4)]) for _ in range(90)]
    plan = runs.checkpoint_plan(spark.createDataFrame([(1, i, m) for i, m in enumerate(ms)], "run_id int, epoch int, val_f1 double"), save_last=False)
    want = [i for i, m in enumerate(ms) if m is not None and m > max([LOW, *[x for x in ms[:i] if x is not None]])]
    assert sorted(r.epoch for r in plan.collect()) == want
