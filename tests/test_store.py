"""Catalog tables, stored views and released layers of the daily run."""

import tempfile

import pytest
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.operators import quality
from reelhouse.operators.clean import REJECT_REASONS, film_rules, filter_films, reject_reason
from reelhouse.plans import daily
from reelhouse.plans.bronze import films_filtered
from reelhouse.plans.views import view_full, view_limited, view_sql
from reelhouse.sources import sinks
from reelhouse.sources.adapter import LINE_BREAKS, RawInputs
from reelhouse.sources.releases import Releases


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_a_killed_replacement_leaves_the_old_table(spark):
    name = "store_test.t"
    sinks.replace_table(spark, spark.range(4), name, comment="four")
    boom = F.raise_error(F.lit("executor lost")).cast("long")
    with pytest.raises(Exception, match="executor lost"):
        sinks.replace_table(spark, spark.range(500).select(F.when(F.col("id") == 499, boom).otherwise(F.col("id")).alias("id")), name)
    assert ids(spark.table(name)) == [0, 1, 2, 3]
    # rows computed from the table that they replace; the same columns keep the catalog entry
    assert ids(sinks.replace_table(spark, spark.table(name).select((F.col("id") * 2).alias("id")), name)) == [0, 2, 4, 6]
    info = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Comment'").collect()
    assert info[0].data_type == "four"
    other = sinks.replace_table(spark, spark.range(2).select("id", F.lit("x").alias("v")), name, partition_by=["v"])
    assert other.columns == ["id", "v"] and ids(spark.newSession().table(name)) == [0, 1]
    assert sinks.replace_table(spark, spark.range(0), name).count() == 0


def test_descriptions_reach_the_catalog(spark):
    df = quality.describe(spark.range(1).select("id", F.lit("x").alias("v")), {"id": "it's a key"})
    for _ in range(2):
        sinks.replace_table(spark, df, "store_test.described", comment="Table's text")
        assert {c.name: c.description for c in spark.catalog.listColumns("store_test.described")} == {"id": "it's a key", "v": None}
    df = quality.describe(df, {"v": "a value"})
    sinks.replace_table(spark, df, "store_test.described")
    assert {c.name: c.description for c in spark.catalog.listColumns("store_test.described")}["v"] == "a value"


def test_reject_reasons_split_the_rows(spark, sf_small):
    src = RawInputs(spark, sf_small).films_src
    why = src.select(reject_reason(src).alias("why"))
    counts = {r["why"]: r["count"] for r in why.groupBy("why").count().collect()}
    assert counts[None] == filter_films(src).count() and set(counts) <= {None, *REJECT_REASONS} and len(counts) >= 6
    assert len(film_rules(src)) == len(REJECT_REASONS)
    assert {r.why for r in src.select("status").select(reject_reason(src.select("status")).alias("why")).distinct().collect()} == {"no id"}


@pytest.fixture(scope="module")
def inputs(spark, sf_small):
    root = tempfile.mkdtemp(prefix="reelhouse-store-", dir="/tmp")
    raw = RawInputs(spark, sf_small)
    sinks.write_csv(raw.films_src.withColumns({c: F.expr(x) for c, x in LINE_BREAKS.items()}), f"{root}/movies")
    sinks.write_tsv_gz(raw.crew_src.select("tconst", "directors"), f"{root}/title.crew.tsv.gz")
    sinks.write_tsv_gz(raw.names_src.select("nconst", "primaryName", "primaryProfession"), f"{root}/name.basics.tsv.gz")
    return root, films_filtered(raw.films_src).count(), raw.films_src.count()


def test_daily_run_in_releases_with_stored_views(spark, inputs, monkeypatch):
    root, films, every = inputs
    run = lambda **a: daily.run_daily(spark, f"{root}/movies", f"{root}/title.crew.tsv.gz", f"{root}/name.basics.tsv.gz", f"{root}/wh",
                                      as_of="2024-01-01", releases=True, database="store_daily", **a)
    out = run(run_date="2024-01-01")
    # films with line breaks in their titles are all there, rejects are counted on the way
    assert out["rows"]["fact_movie_performance"] == out["tmdb_loaded"] == films
    assert out["tmdb_read"] == every and sum(out["rejected"].values()) == every - films
    gold = Releases(spark, f"{root}/wh/gold")
    assert set(gold.manifest().tables) == set(schemas.GOLD) and gold.manifest().number == 1
    assert all(gold.table(n).schema == s for n, s in schemas.GOLD.items())
    assert Releases(spark, f"{root}/wh/bronze").table("tmdb_raw").count() == films

    # another session reads the views and the descriptions
    other = spark.newSession()
    star = [gold.table(n) for n in ("fact_movie_performance", "dim_movie", "dim_date", "dim_director", "dim_genre", "dim_production")]
    for name, view in (("analytical_view_full", view_full), ("analytical_view_limited", view_limited)):
        stored, direct = other.table(f"store_daily.{name}"), view(*star)
        assert stored.columns == direct.columns and [f.dataType for f in stored.schema] == [f.dataType for f in direct.schema]
        assert stored.exceptAll(direct).count() == direct.exceptAll(stored).count() == 0 < direct.count()
    notes = {c.name: c.description for c in other.catalog.listColumns("store_daily.dim_genre")}
    assert notes == schemas.COLUMN_COMMENTS["dim_genre"]

    # a run whose rules fail publishes no gold table
    monkeypatch.setitem(quality.GOLD_TESTS, "dim_movie", {"not_null": ["movie_id"], "unique": ["movie_id", "language"]})
    with pytest.raises(quality.QualityError, match="dim_movie.language unique"):
        run(run_date="2024-01-02")
    assert gold.manifest().number == 1 and gold.table("dim_movie").count() > 0


def test_view_sql_names_every_relation():
    text = view_sql("analytical_view_limited", {t: f"g.{t}" for t in schemas.GOLD})
    assert all(f"g.{t}" in text for t in schemas.GOLD)
