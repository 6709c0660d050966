"""Fused quality rules: the single rules' numbers from one scan of each table."""

import random
import tempfile

import pytest

from reelhouse.operators import quality


def rows(seed, n=300):
    r = random.Random(seed)
    pick = lambda k: r.choice([None, *range(k)])
    return [(pick(400), pick(3), r.choice([None, "a", "b", str(r.randrange(500))]), pick(50)) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_table_rules_equal_the_single_rules(spark, seed):
    df = spark.createDataFrame(rows(seed), "a int, b int, c string, d bigint")
    for nulls, uniques in ((["a", "c"], ["a", "b", "c", "d"]), ([], ["c"]), (["b"], []), (["d", "a"], ["d"])):
        got = {tuple(r) for r in quality.table_rules(df, "t", nulls, uniques).collect()}
        frames = [quality.not_null(df, nulls, "t")] if nulls else []
        want = {tuple(r) for f in frames + [quality.unique(df, c, "t") for c in uniques] for r in f.collect()}
        assert got == want and len(got) == len(nulls) + len(uniques)
    empty = quality.table_rules(df.limit(0), "t", ["a"], ["a", "b"]).collect()
    assert len(empty) == 3 and all(r.failures == 0 for r in empty)


def test_reference_rules_equal_the_single_rules(spark):
    child = spark.createDataFrame(rows(3), "a int, b int, c string, d bigint")
    p1 = spark.createDataFrame([(i % 40,) for i in range(200)] + [(None,)], "k bigint")
    p2 = spark.createDataFrame([("a",), ("a",), ("7",)], "name string")
    refs = [("a", "p1", "k", p1), ("c", "p2", "name", p2), ("d", "p1", "k", p1), ("b", "none", "k", p1.limit(0))]
    got = {tuple(r) for r in quality.reference_rules(child, "t", refs).collect()}
    assert got == {tuple(quality.foreign_key(child, c, p, pc, "t", pt).first()) for c, pt, pc, p in refs}
    assert all(f > 0 for *_, f in got)


def test_one_scan_of_each_table(spark):
    d = tempfile.mkdtemp(prefix="reelhouse-quality-", dir="/tmp")
    spark.createDataFrame(rows(4), "a int, b int, c string, d bigint").write.parquet(f"{d}/child_t")
    spark.range(50).write.parquet(f"{d}/parent_t")
    child, parent = spark.read.parquet(f"{d}/child_t"), spark.read.parquet(f"{d}/parent_t")
    tests = {"c": {"not_null": ["a", "b"], "unique": ["a", "c", "d"]}}
    plan = quality.suite({"c": child}, tests)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("child_t") == 1
    refs = [("c", "a", "p", "id"), ("c", "b", "p", "id"), ("c", "d", "p", "id")]
    plan = quality.suite({"c": child, "p": parent}, {}, refs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("child_t") == 1
