import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reelhouse.operators.heavy import any_heavy


@pytest.mark.parametrize("seed,cap", [(1, 10**6), (2, 0)])
def test_majority_equals_counting(spark, seed, cap):
    r = random.Random(seed)
    rows = []
    for g in [None, *range(60)]:
        n, share = r.randint(1, 40), r.choice([0.2, 0.5, 0.55, 0.9, 1.0])
        top = r.choice([None, "top", "x" * 300, ""])
        rows += [(g, r.choice("abc"), top if r.random() < share else f"v{r.randrange(9)}") for _ in range(n)]
    rows += [(900, "a", "p"), (900, "a", "q"), (901, "b", None), (901, "b", None), (901, "b", "z")]  # a tie; a majority of NULLs
    df = spark.createDataFrame(rows, "g int, k string, v string").repartition(5)
    for keys in (["g"], ["g", "k"], ["k"]):
        at = [("g", "k", "v").index(c) for c in keys]
        counts, total = Counter(), Counter()
        for row in rows:
            key = tuple(row[i] for i in at)
            total[key] += 1
            counts[key, row[2]] += row[2] is not None
        want = {k: next((v for (kk, v), c in counts.items() if kk == k and 2 * c > n), None) for k, n in total.items()}
        got = any_heavy(df, keys, "v", max_broadcast_rows=cap).collect()
        assert len(got) == len(want)
        assert {tuple(x[c] for c in keys): (x.heavy, x["rows"]) for x in got} == {k: (v, total[k]) for k, v in want.items()}


def test_one_row_per_group_and_task_crosses_the_exchange(spark):
    df = spark.range(20_000).select(F.lit(1).alias("g"), F.when(F.col("id") % 5 < 3, F.lit(-7)).otherwise(F.col("id")).alias("v"))
    assert [tuple(x) for x in any_heavy(df, ["g"], "v").collect()] == [(1, -7, 20_000)]
    assert any_heavy(df.limit(0), ["g"], "v").count() == 0


def test_values_that_share_a_hash_are_counted_apart(spark):
    rows = spark.range(300_000).select((F.col("id") % 3).alias("g"), "id")  # more values than hashes in each group
    df = rows.select("g", F.when((F.col("g") == 1) & (F.col("id") % 2 == 0), F.lit(-1)).otherwise(F.col("id")).alias("v"))
    df = df.unionByName(spark.range(1).select(F.lit(1).alias("g"), F.lit(-1).alias("v")))
    assert sorted(tuple(x) for x in any_heavy(df, ["g"], "v").collect()) == [(0, None, 100_000), (1, -1, 100_001), (2, None, 100_000)]


def test_summary_of_many_small_groups_is_narrow(spark):
    df = spark.range(100).select(F.col("id").alias("g"), (F.col("id") % 7).alias("v"))
    fields = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = any_heavy(df, ["g"], "v", max_broadcast_rows=0)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", fields)
    assert 0 < max(line.count("sum(") for line in plan.splitlines()) <= 32  # with 64 counters 64 and more
