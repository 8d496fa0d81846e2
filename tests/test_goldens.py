"""Literal goldens from the reference's code and comments."""

from pyspark.sql import functions as F

from sparkwright.operators.aggregates import global_stats
from sparkwright.operators.cells import put, scan, to_cells, wide_view
from sparkwright.operators.pairs import cogroup, pair_join
from sparkwright.operators.sketches import estimate

RDD1 = [("anna", 1), ("bert", 2), ("carl", 3), ("carl", 2)]
RDD2 = [("anna", 33), ("anna", 44), ("bert", 11), ("carl", 22)]


def test_pair_join_golden(spark):
    left = spark.createDataFrame(RDD1, "k string, v int")
    right = spark.createDataFrame(RDD2, "k string, w int")
    got = sorted(tuple(r) for r in pair_join(left, right).collect())
    assert got == sorted([("carl", 3, 22), ("carl", 2, 22), ("bert", 2, 11),
                          ("anna", 1, 33), ("anna", 1, 44)])


def test_cogroup_golden(spark):
    left = spark.createDataFrame(RDD1, "k string, v int")
    right = spark.createDataFrame(RDD2, "k string, v int")
    got = {r.k: (r.l, r.r) for r in cogroup([left, right], names=["l", "r"]).collect()}
    assert got == {"carl": ([2, 3], [22]), "bert": ([2], [11]),
                   "anna": ([1], [33, 44])}


def test_cogroup_flatten_equals_join(spark):
    left = spark.createDataFrame(RDD1, "k string, v int")
    right = spark.createDataFrame(RDD2, "k string, w int")
    cg = cogroup([left, right.withColumnRenamed("w", "v")], names=["l", "r"])
    flat = cg.select("k", F.explode("l").alias("v"), "r").select(
        "k", "v", F.explode("r").alias("w"))
    assert sorted(map(tuple, flat.collect())) == sorted(
        map(tuple, pair_join(left, right).collect()))


def test_three_way_cogroup_golden(spark):
    l1 = spark.createDataFrame([(1, "www"), (2, "bbs")], "k int, v string")
    l2 = spark.createDataFrame([(1, "cnblog"), (2, "cnblog"), (3, "very")], "k int, v string")
    l3 = spark.createDataFrame([(1, "com"), (2, "com"), (3, "good")], "k int, v string")
    got = {r.k: (r.a, r.b, r.c) for r in cogroup([l1, l2, l3], names=["a", "b", "c"]).collect()}
    assert got == {1: (["www"], ["cnblog"], ["com"]), 2: (["bbs"], ["cnblog"], ["com"]),
                   3: ([], ["very"], ["good"])}


def test_int_aggregates_golden(spark):
    df = spark.createDataFrame([(x,) for x in [5, 9, 4, 6, 8, 8, 7, 6]], "x int")
    r = global_stats(df, "x").first()
    assert (r.max_v, r.min_v, r.mean_v, r.sum_v, r.count_v) == (9, 4, 6.625, 53, 8)
    assert df.distinct().count() == 6
    empty = global_stats(df.filter("x > 100"), "x").first()
    assert empty.max_v is None and empty.sum_v is None and empty.count_v == 0


def test_udf_filter_golden(spark):
    from sparkwright.functions.udfs import gt_five, register_all
    register_all(spark)
    spark.range(1, 10).createOrReplaceTempView("sw_range")
    ids = [r.id for r in spark.sql("SELECT id FROM sw_range WHERE one_arg_filter(id)").collect()]
    assert sorted(ids) == [6, 7, 8, 9]
    assert spark.range(1, 10).where(gt_five("id")).count() == 4


def test_sketch_cardinality_golden(spark):
    df = spark.createDataFrame([(x,) for x in [1, 2, 3, 4, 1, 2, 3, 4, 5]], "x long")
    assert estimate(df, "x").first().estimate == 5


STUDENTS = [
    ("Tom", "20210000000001", "1", "75", "82"),
    ("Jerry", "20210000000002", "1", "85", "67"),
    ("Jack", "20210000000003", "2", "80", "80"),
    ("Rose", "20210000000004", "2", "60", "61"),
]


def test_wide_column_golden(spark):
    df = spark.createDataFrame(STUDENTS, "name string, sid string, cls string, u string, p string")
    fams = {"info": {"student_id": "sid", "class": "cls"},
            "score": {"understanding": "u", "programming": "p"}}
    cells = to_cells(df, "name", fams)
    extra = spark.createDataFrame([("dora", "info", "student_id", 2, "20210000000005")],
                                  "row_key string, family string, qualifier string, ts long, value string")
    merged = scan(put(cells, extra))
    assert merged.count() == 17
    keys = [r.row_key for r in merged.select("row_key").collect()]
    assert keys == sorted(keys)
    wide = {r.row_key: r for r in wide_view(merged, ["student_id", "class", "understanding",
                                                      "programming"]).collect()}
    assert wide["Tom"].programming == "82" and wide["dora"].understanding is None
    # newer version wins
    newer = spark.createDataFrame([("Tom", "score", "programming", 5, "90")],
                                  "row_key string, family string, qualifier string, ts long, value string")
    tom = {r.qualifier: r.value for r in put(merged, newer).filter("row_key = 'Tom'").collect()}
    assert tom["programming"] == "90" and tom["understanding"] == "75"
    # the wide view of unresolved cells also shows the latest version
    unresolved = merged.unionByName(newer)
    assert {r.row_key: r.programming for r in wide_view(unresolved, ["programming"])
            .collect()}["Tom"] == "90"
