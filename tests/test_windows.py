import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from reelhouse.operators.windows import dense_row_id, find_hot_keys, lag_delta, top_k_per_group


def _rows(n=3000, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.4 else (None if rnd.random() < 0.02 else f"k{rnd.randint(0, 30)}")
        t = rnd.choice([None, rnd.randint(0, 50)])
        out.append((i, k, t, float(rnd.randint(0, 1000))))
    return out


def test_dense_row_id_equals_window(spark):
    df = spark.createDataFrame(_rows(), "id int, k string, t int, v double")
    order = ["k", "t", "id"]
    got = dense_row_id(df.repartition(7), order, name="rid", partitions=5)
    w = Window.orderBy(*[F.col(c).asc_nulls_last() for c in order])
    want = df.withColumn("rid", F.row_number().over(w))
    assert sorted(got.select("id", "rid").collect()) == sorted(want.select("id", "rid").collect())
    ids = [r.rid for r in got.select("rid").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_dense_row_id_plan_has_no_single_partition(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    out = dense_row_id(df, ["k", "id"], name="rid")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_lag_hot_path_equals_window(spark):
    df = spark.createDataFrame(_rows(), "id int, k string, t int, v double")
    cols = {"v": "dv"}
    order = ["t", "id"]
    plain = lag_delta(df, ["k"], order, cols)
    hot = find_hot_keys(df, ["k"], share=0.1, sample_fraction=0.5, min_rows=10)
    assert hot is not None and {r.k for r in hot.collect()} == {"hot"}
    split = lag_delta(df, ["k"], order, cols, hot_keys=hot)
    a = sorted(plain.select("id", "dv").collect(), key=lambda r: r.id)
    b = sorted(split.select("id", "dv").collect(), key=lambda r: r.id)
    assert a == b
    assert sum(1 for r in a if r.dv is not None) > 0


def test_find_hot_keys_none_on_uniform(spark):
    df = spark.range(5000).withColumn("k", F.col("id") % 1000)
    assert find_hot_keys(df, ["k"]) is None


def test_top_k_per_group(spark):
    df = spark.createDataFrame([("a", 3, 1), ("a", 5, 2), ("a", 5, 3), ("b", 1, 4)], "g string, v int, id int")
    out = top_k_per_group(df, ["g"], [F.col("v").desc(), F.col("id").asc()], 2)
    got = sorted((r.g, r.rank, r.id) for r in out.collect())
    assert got == [("a", 1, 2), ("a", 2, 3), ("b", 1, 4)]


def test_dense_row_id_spreads_a_group_of_copies(spark):
    # 3,000 identical rows (a third of the input) plus 6,000 distinct ones
    copies = spark.range(3000).select(F.lit(7).cast("bigint").alias("k"))
    rest = spark.range(6000).select((F.col("id") + 100).alias("k"))
    df = copies.unionByName(rest)
    out = dense_row_id(df, ["k"], name="rid", partitions=6)
    per_part = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(per_part) < 3000  # the copies did not stay together in one range
    ids = sorted(r.rid for r in out.collect())
    assert ids == list(range(1, 9001))
    assert {r.rid for r in out.filter("k = 7").collect()} == set(range(1, 3001))


def test_find_hot_keys_two_columns_and_null_key(spark):
    # ("x", NULL) holds 40% of the rows; the grand total and the ("x") subtotal
    # of the rollup must not be mistaken for keys
    hot = spark.range(4000).select(F.lit("x").alias("a"), F.lit(None).cast("int").alias("b"))
    rest = spark.range(6000).select(F.lit("x").alias("a"), (F.col("id") % 600).cast("int").alias("b"))
    df = hot.unionByName(rest)
    found = find_hot_keys(df, ["a", "b"], share=0.1, sample_fraction=0.5, min_rows=100)
    assert found is not None and [tuple(r) for r in found.collect()] == [("x", None)]
    assert found.schema == df.select("a", "b").schema


def test_reduce_then_left_join_equals_left_join(spark):
    from reelhouse.operators.joins import reduce_then_left_join

    keys = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    big = spark.range(300).select(
        F.when(F.col("id") < 200, F.lit("a")).when(F.col("id") < 210, F.lit("b"))
        .when(F.col("id") < 220, F.lit(None)).otherwise(F.concat(F.lit("z"), F.col("id").cast("string")))
        .alias("n"), F.col("id").alias("v"))
    want = sorted(keys.join(big, keys.k == big.n, "left").collect(), key=str)
    for cap in (1000, 1):  # broadcast branch, then shuffle branch
        got = reduce_then_left_join(keys, big, "k", "n", max_broadcast_rows=cap)
        assert got.columns == ["k", "n", "v"]
        assert sorted(got.collect(), key=str) == want


def test_top_n_equals_order_limit_and_merges_in_two_levels(spark):
    from reelhouse.operators.windows import top_n

    df = spark.createDataFrame(_rows(), "id int, k string, t int, v double").repartition(12)
    order = [F.col("v").desc(), F.col("id").asc()]
    got = top_n(df, order, 25, fan_in=3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert got.collect() == df.orderBy(*order).limit(25).collect()


def test_dense_row_id_many_ranges(spark):
    # many ranges: offsets travel as a broadcast (partition, offset) frame
    df = spark.range(20000).select(((F.col("id") * 7919) % 20000).alias("k"))
    out = dense_row_id(df, ["k"], name="rid", partitions=400)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert out.filter(F.col("rid") != F.col("k") + 1).count() == 0


def test_fits_all_in_one_job(spark):
    from reelhouse.operators.joins import fits, fits_all

    frames = {"a": spark.range(5), "b": spark.range(50), "c": spark.range(0)}
    got = fits_all(frames, 10)
    assert got == {"a": True, "b": False, "c": True}
    assert got == {k: fits(v, 10) for k, v in frames.items()}


def test_find_hot_keys_on_empty_input(spark):
    empty = spark.range(0).select(F.col("id").cast("string").alias("k"))
    assert find_hot_keys(empty, ["k"], share=0.1, sample_fraction=1.0, min_rows=1) is None


def test_lag_spread_carries_one_row_over_each_cut(spark):
    from reelhouse.operators.windows import lag_spread, lag_window

    rows = [(i % 5 if i % 3 else 7, None if i % 11 == 0 else i % 40, i % 2, float(i * i % 97), i) for i in range(4000)]
    rows += [(9, 1, 1, float(i), 5000 + i) for i in range(500)] + [(None, 3, 0, 1.0, 9000), (None, 1, 1, 2.0, 9001)]
    df = spark.createDataFrame(rows, "k int, t int, u int, v double, id int").repartition(6)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # many segments
    try:
        got = lag_spread(df, ["k"], ["t", "u", "id"], {"v": "dv", "id": "di"})
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan
        want = lag_window(df, ["k"], ["t", "u", "id"], {"v": "dv", "id": "di"})
        assert got.columns == want.columns
        key = lambda r: r.id
        assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_row_ids_come_from_the_written_files(spark):
    from reelhouse.operators.windows import file_row_id

    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("a"), (F.col("id") % 3).alias("b"))
    out = file_row_id(df.repartition(9), ["b", "a"], name="rid", partitions=6)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "") and plan.count("FileScan parquet") == 1
    rows = sorted(out.collect(), key=lambda r: r.rid)
    assert [(r.b, r.a) for r in rows] == sorted((r.b, r.a) for r in rows) and [r.rid for r in rows] == list(range(1, 5001))
    assert file_row_id(df.limit(0), ["a"], name="rid").count() == 0
    five = file_row_id(df, ["a", "b"], name="rid", start=5).agg(F.min("rid"), F.max("rid")).first()
    assert tuple(five) == (5, 5004)
    copies = spark.range(3000).select(F.lit(7).cast("bigint").alias("k")).unionByName(spark.range(6000).select((F.col("id") + 100).alias("k")))
    out = file_row_id(copies, ["k"], name="rid", partitions=6)
    assert {r.rid for r in out.filter("k = 7").collect()} == set(range(1, 3001)) and len(out.inputFiles()) == 6
