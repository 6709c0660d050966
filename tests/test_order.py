"""Row order of the reports, and of the rows inside stored gold files."""

import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.oracle import oracle_queries
from reelhouse.plans import dims as D
from reelhouse.plans.daily import GOLD_ORDER
from reelhouse.plans.registry import Warehouse, registered
from reelhouse.sources import sinks
from tools.oracle_check import TABLES, norm

#: report -> its order as SQL over its result columns (None: the SQL is ordered itself)
ORDERS = {
    "q_r1_genre_rating": "avg_rating DESC NULLS LAST, genre_name NULLS LAST",
    "q_r2_directors": None,
    "q_r3_by_year": "release_year NULLS LAST",
    "q_r4_mode": None,
    "q_r5_runtime_bucket": "avg_revenue NULLS LAST, runtime_bucket NULLS LAST",
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_reports_come_in_their_order(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    sql = oracle_queries()[name]
    if ORDERS[name]:
        sql = f"SELECT * FROM ({sql}) x ORDER BY {ORDERS[name]}"
    res = con.execute(sql)
    columns = [d[0] for d in res.description]
    want = [[norm(v, 9) for v in r] for r in res.fetchall()]
    got = [[norm(r[c], 9) for c in columns] for r in registered()[name](spark, sf_small).collect()]
    assert got == want and len(got) >= 1


def test_rows_inside_gold_files_are_in_key_order(spark, sf_small):
    w = Warehouse(spark, sf_small)
    root = tempfile.mkdtemp(prefix="reelhouse-order-", dir="/tmp")
    for name, df in (("dim_movie", w.dim_movie), ("dim_date", D.dim_date(w.bronze.tmdb_raw)), ("fact_movie_performance", w.fact)):
        sinks.overwrite(df, f"{root}/{name}", sort_by=GOLD_ORDER[name])
        assert set(GOLD_ORDER[name]) <= set(schemas.GOLD[name].fieldNames())
        rows = spark.read.parquet(f"{root}/{name}").select(
            F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"), *GOLD_ORDER[name]).collect()
        keys = {}
        for r in sorted(rows, key=lambda r: (r.file, r["at"])):
            keys.setdefault(r.file, []).append(tuple((r[c] is None, r[c]) for c in GOLD_ORDER[name]))
        assert len(rows) > 50 and all(k == sorted(k) for k in keys.values())


def test_today_is_the_default_validity_start(spark, sf_small):
    row = D.dim_production(Warehouse(spark, sf_small).bronze.tmdb_raw).select("valid_from", F.current_date().alias("today")).first()
    assert row.valid_from == row.today
