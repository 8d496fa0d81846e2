"""Properties: hot keys are split, never truncated; sized broadcast; stats."""

import pytest
from pyspark.sql import functions as F

from sparkwright.operators.collect import collect_counts, collect_lists, paged_counts
from sparkwright.operators.joins import broadcast_if_small, fits, sized_join
from sparkwright.operators.pairs import cogroup, cogroup_counts
from sparkwright.operators.stats import crosstab, describe_typed, frequent_items
from sparkwright.plans.text_jobs import posting_maps


def _lists(rows, key):
    return sorted((v for r in rows if r.k == key for v in r.vs), key=lambda v: (v is not None, v))


def test_hot_keys_and_hot_values_are_paged_and_nothing_is_lost(spark):
    hot = spark.range(0, 5000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    null = spark.range(0, 5000).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("v"))
    same = spark.range(0, 7001).select(F.lit("same").alias("k"), F.when(F.col("id") < 7000, 3).alias("v"))
    cold = spark.createDataFrame([("x", None), ("x", 1), ("x", 1), ("y", None)], "k string, v long")
    df = hot.unionByName(null).unionByName(same).unionByName(cold)
    rows = collect_lists(df, "k", F.col("v"), "vs", page=600).collect()
    for key, n in (("hot", 5000), (None, 5000), ("same", 7001)):
        own = sorted((r for r in rows if r.k == key), key=lambda r: r.page)
        assert [r.page for r in own] == list(range(-(-n // 600)))
        assert [len(r.vs) for r in own] == [600] * (n // 600) + [n % 600]
    assert _lists(rows, "hot") == _lists(rows, None) == list(range(5000))
    assert _lists(rows, "same") == [None] + [3] * 7000
    assert _lists(rows, "x") == [None, 1, 1] and _lists(rows, "y") == [None]
    assert collect_lists(df.limit(0), "k", F.col("v"), "vs").count() == 0


def test_a_hot_value_is_one_row_before_it_is_dealt_out(spark):
    """No window or join sees the repeats of a value."""
    df = spark.range(0, 9000).select(F.lit("h").alias("k"), F.lit(1).alias("v"))
    counts = collect_counts(df, "k", F.col("v"), "v")
    dealt = paged_counts(counts, "k", "v", 4000, F.col("v"))
    assert sorted(map(tuple, dealt.collect())) == [("h", 0, 1, 4000), ("h", 1, 1, 4000), ("h", 2, 1, 1000)]


@pytest.mark.parametrize("page", [1, 7, 100])
def test_pages_follow_the_order_of_hashes(spark, page):
    import hashlib
    rows = [(k, v) for k in ("a", "b", None) for v in [*range(40), 5, 5, None, None]]
    df = spark.createDataFrame(rows, "k string, v long").repartition(5)
    order = sorted([*range(40), 5, 5, None, None], key=lambda v: hashlib.md5(
        ("" if v is None else str(v)).encode()).hexdigest()[:8])
    got = {(r.k, r.page): r.vs for r in collect_lists(df, "k", F.col("v"), "vs", page=page).collect()}
    assert got == {(k, p): sorted(order[p * page:(p + 1) * page], key=lambda v: (v is not None, v))
                   for k in ("a", "b", None) for p in range(-(-len(order) // page))}


def test_counts_are_the_form_without_lists(spark):
    dup = spark.range(0, 2510).select(
        F.lit("h").alias("k"), F.when(F.col("id") < 2500, 7).alias("v"))
    got = {(r.k, r.v): r.n for r in collect_counts(dup, "k", F.col("v"), "v").collect()}
    assert got == {("h", 7): 2500, ("h", None): 10}


def test_cogroup_keeps_nulls_and_null_keys(spark):
    a = spark.createDataFrame([("x", None), ("x", 1), (None, 2), ("y", None)], "k string, v long")
    b = spark.createDataFrame([("x", 5), (None, None), ("z", 6)], "k string, v long")
    got = {r.k: (r.l, r.r) for r in cogroup([a, b], names=["l", "r"]).collect()}
    assert got == {"x": ([None, 1], [5]), None: ([2], [None]), "y": ([None], []), "z": ([], [6])}
    spread = cogroup([a, b], names=["l", "r"], page=1).collect()
    for k, (left, right) in got.items():
        order = lambda v: (v is not None, v)
        assert sorted((x for r in spread if r.k == k for x in r.l), key=order) == left
        assert sorted((x for r in spread if r.k == k for x in r.r), key=order) == right
    counts = {(r.k, r.side, r.v): r.n for r in cogroup_counts([a, b], names=["l", "r"]).collect()}
    assert counts[None, "r", None] == 1 and len(counts) == 7


def test_posting_maps(spark):
    idx = spark.createDataFrame([("w", "f1", 2), ("w", "f2", 1), ("z", "f1", 5)],
                                "word string, file string, cnt long")
    got = {}
    for r in posting_maps(idx, page=1).collect():
        assert len(r.postings) == 1
        got.setdefault(r.word, {}).update(r.postings)
    assert got == {"w": {"f1": 2, "f2": 1}, "z": {"f1": 5}}


def test_sized_broadcast(spark):
    small = spark.range(10)
    assert fits(small, 10) and not fits(small, 9)
    # bytes are bounded too: 10 rows of 1,000-char strings exceed 5,000 bytes
    wide = small.select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert fits(wide, 10, 20_000) and not fits(wide, 10, 5_000)
    plan_small = spark.range(1000).join(broadcast_if_small(small, 100), "id")
    plan_big = spark.range(1000).join(broadcast_if_small(spark.range(500), 100), "id")
    assert plan_small.count() == 10 and plan_big.count() == 500
    assert "broadcast" in plan_small._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in plan_big._jdf.queryExecution().analyzed().toString().lower()


def test_sized_join_measures_only_between_the_bounds(spark, monkeypatch):
    measured = []

    def counted(df, *bounds):
        measured.append(df)
        return fits(df, *bounds)

    monkeypatch.setattr("sparkwright.operators.joins.fits", counted)
    big, small = spark.range(1000), spark.range(500)
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()
    # 500 longs are 4,000 bytes: under Spark's threshold, then over the bound
    under, over = sized_join(big, small, "id"), sized_join(big, small, "id", max_bytes=3_000)
    assert not measured and not hinted(under) and not hinted(over)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        between = sized_join(big, small, "id")
        rows = sized_join(big, small, "id", max_rows=499)
        assert len(measured) == 2 and hinted(between) and not hinted(rows)
        assert [df.count() for df in (under, over, between, rows)] == [500] * 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_describe_and_crosstab(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (None, "b")], "x int, s string")
    d = {r.column: r for r in describe_typed(df, ["x"]).collect()}
    assert d["x"]["count"] == 3 and d["x"].mean == 2.0 and d["x"].stddev == 1.0
    ct = {r["x_s"]: (r.a, r.b) for r in crosstab(df.fillna(0), "x", "s", ["a", "b"]).collect()}
    assert ct == {"1": (1, 0), "2": (1, 0), "3": (0, 1), "0": (0, 1)}
    rows = spark.createDataFrame([(1, "a"), (1, "z"), (None, "a"), (None, None)], "x int, s string")
    free = {r["x_s"]: (r.a, r.z, r["null"]) for r in crosstab(rows, "x", "s").collect()}
    assert free == {"1": (1, 1, 0), "null": (1, 0, 1)}
    with pytest.raises(Exception, match="not listed"):
        crosstab(rows, "x", "s", ["a", "z"]).collect()
    assert crosstab(rows, "x", "s", ["a", "z", None]).count() == 2
    fi = {r.s for r in frequent_items(df, "s", 0.5).collect()}
    assert fi == {"a", "b"}
