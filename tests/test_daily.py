"""End to end: raw CSV + gzip TSV files derived from the test tables -> daily run."""

import os
import tempfile

from reelhouse import schemas
from reelhouse.plans.bronze import films_filtered
from reelhouse.plans.daily import run_daily
from reelhouse.sources.adapter import RawInputs
from reelhouse.sources.sinks import write_tsv_gz


def test_run_daily_end_to_end(spark, sf_small):
    root = tempfile.mkdtemp(prefix="reelhouse-daily-", dir="/tmp")
    raw = RawInputs(spark, sf_small)
    raw.films_src.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{root}/in/movies")
    write_tsv_gz(raw.crew_src.select("tconst", "directors"), f"{root}/in/title.crew.tsv.gz")
    write_tsv_gz(raw.names_src.select("nconst", "primaryName", "primaryProfession"), f"{root}/in/name.basics.tsv.gz")
    out = run_daily(spark, f"{root}/in/movies", f"{root}/in/title.crew.tsv.gz", f"{root}/in/name.basics.tsv.gz",
                    f"{root}/wh", run_date="2024-01-01", as_of="2024-01-01", raw_partitions=4)
    rows = out["rows"]
    films = films_filtered(raw.films_src).count()
    assert films > 100 and rows["tmdb_raw"] == films == out["tmdb_loaded"]
    assert rows["imdb_title_crew_raw"] == 1500 and rows["imdb_name_basics_raw"] == 150
    assert rows["fact_movie_performance"] == films
    assert all(r["failures"] == 0 for r in out["quality"])
    fact = spark.read.parquet(f"{root}/wh/gold/fact_movie_performance")
    assert sorted(r.fact_id for r in fact.select("fact_id").collect()) == list(range(1, films + 1))
    assert os.path.isdir(f"{root}/wh/raw/tmdb/run_date=2024-01-01")
    assert {r["rule"] for r in out["quality"]} >= {"references dim_date.date_id", "references dim_director.director_id"}
    assert spark.read.parquet(f"{root}/wh/lakehouse/tmdb_bronze").schema == schemas.TMDB_SNAPSHOT
    for name, schema in schemas.GOLD.items():
        assert spark.read.parquet(f"{root}/wh/gold/{name}").schema == schema
