"""Plan-shape checks: the scale properties the design relies on."""

import contextlib
import io
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from reelhouse.functions.exprs import first_item
from reelhouse.operators.windows import lag_delta
from reelhouse.plans import fact as FM
from reelhouse.plans import reports as R
from reelhouse.plans.registry import Warehouse
from reelhouse.plans.views import view_full
from reelhouse.sources import sinks


def _plan(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def gold(spark, sf_small):
    w = Warehouse(spark, sf_small)
    root = tempfile.mkdtemp(prefix="reelhouse-plans-", dir="/tmp")
    names = ["dim_movie", "dim_genre", "dim_director", "dim_production", "dim_date", "fact"]
    for n in names:
        sinks.overwrite(getattr(w, n), f"{root}/{n}")
    sinks.overwrite(w.bronze.tmdb_raw, f"{root}/films")
    sinks.overwrite(w.bronze.crew, f"{root}/crew")
    return {n: spark.read.parquet(f"{root}/{n}") for n in names + ["films", "crew"]}


def test_year_filter_reaches_parquet(gold):
    df = R.top_films(gold["fact"], gold["dim_movie"], gold["dim_genre"], 2000)
    plan = _plan(df)
    assert "GreaterThanOrEqual(release_date,2000-01-01)" in plan
    assert "LessThan(release_date,2001-01-01)" in plan
    assert "WindowGroupLimit" in plan  # partial top-k before the shuffle


def test_reports_prune_columns_and_preaggregate(gold):
    df = R.genre_rating(gold["fact"], gold["dim_genre"])
    plan = _plan(df)
    schemas = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema") and "vote_avg" in ln]
    fields = {f.split(":")[0] for f in schemas[0][len("ReadSchema: struct<"):-1].split(",")}
    assert fields <= {"movie_id", "genre_id", "vote_avg"}
    # the fact side is aggregated by key before it meets the dimension
    assert plan.count("HashAggregate") >= 4


def test_fact_lag_reuses_join_partitioning(spark, gold):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # behave like large tables
    try:
        t = FM._film_measures(gold["films"])
        d = gold["crew"].select("tconst", F.nullif(first_item("directors"), F.lit("")).alias("director_id"))
        t = t.join(d, t["imdb_id"] == d["tconst"], "left").drop("tconst")
        m = lag_delta(t, ["imdb_id"], FM.LAG_ORDER, FM.CHANGES)
        full = _plan(m)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert "SortMergeJoin" in full and "Window" in full
    # two exchanges for the join, none extra for the window
    assert full.count("Arguments: hashpartitioning(") == 2
    films_scan = [ln for ln in full.splitlines() if ln.startswith("ReadSchema") and "imdb_id" in ln][0]
    assert "runtime" not in films_scan and "original_language" not in films_scan


def test_view_holds_no_join_hints(spark, gold):
    """A view is defined once and read later: the sizes of the read decide its joins."""
    args = [gold[k] for k in ("fact", "dim_movie", "dim_date", "dim_director", "dim_genre", "dim_production")]
    assert _plan(view_full(*args), "simple").count("BroadcastHashJoin") == 5
    assert "ResolvedHint" not in view_full(*args)._jdf.queryExecution().analyzed().toString()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(view_full(*args), "simple")
        assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)



def test_fact_plan_has_no_single_partition_window(gold):
    fact = FM.fact_movie_performance(gold["films"], gold["crew"])
    assert "SinglePartition" not in _plan(fact)


def test_partitioned_reads_are_pruned(spark, sf_small):
    from reelhouse.plans.registry import QUERIES

    w = Warehouse(spark, sf_small)
    by_year = _plan(QUERIES["q_films_year_partition"](w))
    assert re.search(r"PartitionFilters: \[isnotnull\(release_year#\d+\), \(release_year#\d+ = 2000\)\]", by_year)
    latest = _plan(QUERIES["q_latest_run"](w))
    # only the latest run's folder is listed for the scan
    assert re.search(r"PartitionFilters: \[isnotnull\(run_date#\d+\), \(run_date#\d+ = 2024-01-01\)\]", latest)
