"""The stored sketch table and the one-pass frequent items."""

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkwright.operators.sketches import SketchTable, daily_sketches, uniques_since
from sparkwright.operators.stats import frequent_items, heavy_hitters


def visits(spark, days, users):
    rows = [(dt.datetime(2024, 1, d, h), u) for d in days for h in (0, 23) for u in users]
    return spark.createDataFrame(rows + [(None, 1), (dt.datetime(2024, 1, days[0]), None)],
                                 "ts timestamp, u long")


def times(path):
    return {d: os.path.getmtime(d) for d, _, files in os.walk(f"{path}/data")
            if "bucket=" in d}


def test_loads_touch_their_own_days(spark, scratch):
    store = SketchTable(scratch)
    assert store.read(spark).count() == 0
    a, b = visits(spark, [1, 2, 3], range(500)), visits(spark, [3, 4], range(400, 900))
    store.load(a, "ts", "u", 0)
    first = times(scratch)
    store.load(b, "ts", "u", 1)
    second = times(scratch)
    kept = [d for d in first if d in second]
    assert len(first) == 3 and len(second) == 4
    assert len(kept) == 2 and all(first[d] == second[d] for d in kept)  # days 1 and 2
    store.load(b, "ts", "u", 1)  # a repeated load
    assert times(scratch) == second
    both = daily_sketches(a.unionByName(b), "ts", "u").filter("visit_date IS NOT NULL")
    per_day = lambda t: {r.visit_date: r.n for r in t.select(
        "visit_date", F.hll_sketch_estimate("hll").alias("n")).collect()}
    got, want = per_day(store.read(spark)), per_day(both)
    assert got.keys() == want.keys()
    for day, exact in zip(sorted(got), (500, 500, 900, 500)):
        assert abs(got[day] - exact) <= 0.03 * exact
    for as_of in ("2024-01-02", "2024-01-04", "2024-01-10"):
        stored, direct = (uniques_since(t, as_of).first().uniques for t in (store.read(spark), both))
        assert abs(stored - direct) <= 0.03 * direct and abs(stored - 900) <= 27


def test_reads_no_events(spark, scratch):
    store = SketchTable(scratch)
    store.load(visits(spark, [5], range(10)), "ts", "u", 0)
    plan = uniques_since(store.read(spark), "2024-01-06")._jdf.queryExecution().optimizedPlan().toString()
    assert "visit_date" in plan and "ts#" not in plan


def rows(spark, values, parts):
    return spark.createDataFrame([(v,) for v in values], "v string").repartition(parts)


@pytest.mark.parametrize("support, parts", [(0.05, 1), (0.05, 7), (0.3, 3), (1.0, 2)])
def test_heavy_hitters_bounds(spark, support, parts):
    rng = random.Random(parts)
    values = ([None] * 300 + ["a"] * 1000 + ["b"] * 400 + ["c"] * 251 + ["d"] * 249
              + [f"x{rng.randrange(10 ** 6)}" for _ in range(2800)])
    rng.shuffle(values)
    exact, n = Counter(values), len(values)
    got = {r.v: (r.lower, r.upper) for r in heavy_hitters(rows(spark, values, parts), "v", support).collect()}
    assert {v for v, c in exact.items() if c >= support * n} <= got.keys()
    for v, (lower, upper) in got.items():
        assert lower <= exact[v] <= upper <= lower + support * n / 4
        assert exact[v] >= 0.75 * support * n
    assert {r.v for r in frequent_items(rows(spark, values, parts), "v", support).collect()} <= got.keys()


def test_heavy_hitters_of_few_batches_are_pruned(spark):
    """Batches smaller than the counters, then an adversary who spreads a value thin."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        values = [w for i in range(1000) for w in ("hot", f"a{i}", f"b{i}")]
        df = spark.createDataFrame([(v,) for v in values], "v string").coalesce(1)
        (r,) = heavy_hitters(df, "v", 0.25).collect()
        assert r.v == "hot" and r.lower <= 1000 <= r.upper and r.lower < 1000
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def test_heavy_hitters_of_nothing_and_of_other_types(spark):
    assert heavy_hitters(rows(spark, [], 2), "v", 0.1).count() == 0
    d = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(d, 1.5)] * 3 + [(None, None)], "d date, x double")
    assert [tuple(r) for r in heavy_hitters(df, "d", 0.5).collect()] == [(d, 3, 3)]
    assert [tuple(r) for r in heavy_hitters(df, "x", 0.5).collect()] == [(1.5, 3, 3)]
    with pytest.raises(ValueError):
        heavy_hitters(df, "x", 0)
