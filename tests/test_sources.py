import datetime as dt
import gzip
import os
import tempfile

from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.operators.clean import enforce
from reelhouse.plans import bronze as B
from reelhouse.sources import files, sinks

CSV = (
    'imdb_id,title,release_date,budget,revenue,vote_average,vote_count,runtime,genres,status,extra\n'
    'tt1,"He said ""hi"", ok",2001-02-03,100,2000,7.5,10,95,"Drama, Comedy",Released,x\n'
    'tt2,"Two\nlines",2002-01-01,5,6,6.1,3,120,Horror,RELEASED,y\n'
    'tt3,Old film,1999-05-05,1,1,8,100,100,Drama,Released,z\n'
    'tt4,Bad date,not a date,1,1,8,100,100,Drama,Released,z\n'
    'tt5,Short,2005-01-01,1,1,8,100,30,Drama,Released,z\n'
    'tt6,Rumored,2005-01-01,1,1,8,100,100,Drama,Rumored,z\n'
    ',No id,2005-01-01,1,1,8,100,100,Drama,Released,z\n'
    'tt7,Bad number,2005-01-01,abc,1,8,100,100,,released,z\n'
    'tt8,No votes,2005-01-01,1,1,8,,100,Drama,Released,z\n'
    'tt9," Padded title ",2003-01-01,1,1,7,5,100,Drama,Released,z\n'
)


def _tmp():
    return tempfile.mkdtemp(prefix="reelhouse-test-", dir="/tmp")


def test_csv_reader_filter_and_bronze(spark):
    d = _tmp()
    p = os.path.join(d, "movies.csv")
    with open(p, "w") as fh:
        fh.write(CSV)
    raw = files.read_films_csv(spark, p, columns=schemas.RAW_FILM_COLUMNS, multi_line=True)
    assert "extra" not in raw.columns and "production_companies" not in raw.columns
    rows = {r.imdb_id: r for r in raw.collect()}
    assert rows["tt1"].title == 'He said "hi", ok' and rows["tt2"].title == "Two\nlines"
    kept = B.films_filtered(raw)
    assert sorted(r.imdb_id for r in kept.collect()) == ["tt1", "tt2", "tt7", "tt9"]
    bronze = B.tmdb_raw(kept).collect()
    by = {r.imdb_id: r for r in bronze}
    assert by["tt7"].budget is None and by["tt7"].genres == "" and by["tt7"].production_companies == ""
    assert by["tt1"].release_date == dt.date(2001, 2, 3) and by["tt1"].vote_count == 10


def test_tsv_gzip_reader_and_bronze(spark):
    d = _tmp()
    p = os.path.join(d, "title.basics.tsv.gz")
    with gzip.open(p, "wt") as fh:
        fh.write("tconst\tprimaryTitle\tstartYear\truntimeMinutes\tgenres\n")
        fh.write('tt1\t"Quoted start\t1994\t\\N\tDrama\n')
        fh.write("tt2\tNull\t\\N\t90\tDrama\n")
        fh.write("\\N\tNo id\t2000\t90\tDrama\n")
    raw = files.read_tsv(spark, p, ["tconst", "primaryTitle", "startYear", "runtimeMinutes"])
    assert raw.columns == ["tconst", "primaryTitle", "startYear", "runtimeMinutes"]
    out = {r.tconst: r for r in B.title_basics_raw(raw).collect()}
    assert set(out) == {"tt1", "tt2"}
    assert out["tt1"].primaryTitle == '"Quoted start' and out["tt1"].runtimeMinutes == -1
    assert out["tt2"].primaryTitle == "Null" and out["tt2"].startYear == -1


def test_crew_and_names_bronze(spark):
    crew = spark.createDataFrame([("tt1", None), ("tt2", "nm1"), ("tt3", "nm1,nm2"), (None, "nm3")],
                                 "tconst string, directors string")
    out = sorted(tuple(r) for r in B.title_crew_raw(crew).collect())
    assert out == [("tt1", ""), ("tt2", "nm1"), ("tt3", "nm1,nm2")]
    names = spark.createDataFrame([("nm1", None, "director"), ("nm2", "Cher", None), (None, "X", "y")],
                                  "nconst string, primaryName string, primaryProfession string")
    out = sorted(tuple(r) for r in B.name_basics_raw(names).collect())
    assert out == [("nm1", "", "director"), ("nm2", "Cher", "")]


def test_overwrite_layouts_and_runs(spark):
    d = _tmp()
    df = spark.range(100).select(F.col("id"), (F.col("id") % 3).alias("y"))
    sinks.overwrite(df, f"{d}/t", sort_by=["id"], partition_by=["y"], max_rows_per_file=10)
    back = spark.read.parquet(f"{d}/t")
    assert back.count() == 100
    assert len(back.inputFiles()) >= 10
    sinks.overwrite(df.limit(5), f"{d}/t")  # idempotent full refresh
    assert spark.read.parquet(f"{d}/t").count() == 5
    sinks.write_run(df.filter("id < 10"), f"{d}/runs", "2024-01-01")
    sinks.write_run(df.filter("id < 20"), f"{d}/runs", "2024-01-02")
    sinks.write_run(df.filter("id < 30"), f"{d}/runs", "2024-01-02")  # rerun of a day replaces it
    assert sinks.list_runs(spark, f"{d}/runs") == ["2024-01-01", "2024-01-02"]
    assert sinks.read_latest(spark, f"{d}/runs").count() == 30


def test_append_new_columns_and_enforce(spark):
    old = spark.createDataFrame([(1, "a")], "id bigint, v string")
    new = spark.createDataFrame([(2, "b", 3.5)], "id int, v string, w double")
    out = sinks.append_new_columns(old, new)
    assert out.columns == ["id", "v", "w"] and out.schema["id"].dataType.simpleString() == "bigint"
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", None), (2, "b", 3.5)]
    e = enforce(spark.createDataFrame([("tt1",)], "tconst string"), schemas.TITLE_CREW_RAW)
    assert e.columns == ["tconst", "directors"] and e.first().directors is None


def test_snapshot_and_sample(spark):
    raw = spark.createDataFrame(
        [("tt2", "B", "6.5", "10", "2001-01-01", "5"), ("tt1", "A", "7", "2.5", "2002-02-02", "7"),
         ("tt3", "C", "5", "3", "bad", "1"), ("tt4", None, "5", "3", "2001-01-01", "1")],
        "imdb_id string, title string, vote_average string, vote_count string, release_date string, revenue string")
    snap = B.films_snapshot(raw, n=3).collect()
    assert [r.imdb_id for r in snap] == ["tt1", "tt2", "tt3"]
    by = {r.imdb_id: r for r in snap}
    assert by["tt1"].vote_count is None and by["tt2"].vote_count == 10
    assert by["tt3"].release_date is None and by["tt2"].release_date == dt.datetime(2001, 1, 1)
    assert files.sample_first(raw, 2).count() == 2


def test_namespace_and_table(spark):
    sinks.create_namespace(spark, "bronze_test")
    t = sinks.replace_table(spark, spark.range(3), "bronze_test.t")
    assert t.count() == 3
    t2 = sinks.replace_table(spark, spark.range(5), "bronze_test.t")
    assert t2.count() == 5


def test_csv_rewrite_roundtrip_and_catalog(spark):
    d = _tmp()
    p = os.path.join(d, "movies.csv")
    with open(p, "w") as fh:
        fh.write(CSV)
    raw = files.read_films_csv(spark, p, columns=schemas.RAW_FILM_COLUMNS, multi_line=True)
    kept = B.films_filtered(raw)
    sinks.write_csv(kept, f"{d}/filtered")  # new path, never over the input
    again = files.read_films_csv(spark, f"{d}/filtered", columns=schemas.RAW_FILM_COLUMNS, multi_line=True)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, kept.collect()))
    assert {r.title for r in again.collect()} >= {" Padded title ", "Two\nlines"}
    from reelhouse.sources.catalog import Catalog

    cat = Catalog(spark, d)
    sinks.overwrite(B.tmdb_raw(kept), cat.path("bronze", "tmdb_raw"), sort_by=["imdb_id"], cluster=True)
    t = cat.source("bronze", "tmdb_raw")
    assert t.schema == schemas.TMDB_RAW and t.count() == 4


def test_snapshot_write_read_narrow_schema(spark):
    d = _tmp()
    raw = spark.createDataFrame([("tt1", "A", "7", "2", "2002-02-02 10:11:12.123456", "7")],
                                "imdb_id string, title string, vote_average string, vote_count string, "
                                "release_date string, revenue string")
    snap = B.films_snapshot(raw, n=10)
    back = sinks.write_snapshot(snap, f"{d}/snap", schemas.TMDB_SNAPSHOT)
    r = back.first()
    assert r.release_date == dt.datetime(2002, 2, 2, 10, 11, 12, 123456) and r.vote_count == 2
    narrow = files.read_snapshot(spark, f"{d}/snap", schemas.TMDB_SNAPSHOT)
    assert narrow.schema == schemas.TMDB_SNAPSHOT


def test_table_comment(spark):
    sinks.create_namespace(spark, "gold_test")
    sinks.replace_table(spark, spark.range(2), "gold_test.c")
    sinks.comment_table(spark, "gold_test.c", "Movie's fact table")
    info = spark.sql("DESCRIBE TABLE EXTENDED gold_test.c").filter("col_name = 'Comment'").collect()
    assert info[0].data_type == "Movie's fact table"


def test_tsv_gz_writer_round_trip_through_bronze(spark):
    rows = [("tt1", '"q'), ("tt2", "Null"), ("tt3", None), ("tt4", ""), ("tt5", "a, b"), ("tt6", " pad ")]
    df = spark.createDataFrame(rows, "tconst string, directors string")
    d = _tmp()
    sinks.write_tsv_gz(df, f"{d}/title.crew.tsv.gz")
    back = files.read_tsv(spark, f"{d}/title.crew.tsv.gz", ["tconst", "directors"])
    # quotes and 'Null' stay text, \N is NULL; an empty field also reads as NULL,
    # and bronze stores both as '' (the dump format itself never has empty fields)
    got = {r.tconst: r.directors for r in B.title_crew_raw(back).collect()}
    assert got == {"tt1": '"q', "tt2": "Null", "tt3": "", "tt4": "", "tt5": "a, b", "tt6": " pad "}


def test_nan_text_is_missing(spark):
    rows = [(f"tt{i}", "T", "2001-01-01", "released", r, v, "5", "NaN")
            for i, (r, v) in enumerate([("90", "7.5"), ("nan", "7.5"), ("90", "NaN"), ("NaN", "NaN")])]
    raw = spark.createDataFrame(rows, "imdb_id string, title string, release_date string, status string, runtime string, "
                                      "vote_average string, vote_count string, revenue string")
    kept = B.tmdb_raw(B.films_filtered(raw)).collect()
    assert [(r.imdb_id, r.vote_average, r.revenue) for r in kept] == [("tt0", 7.5, None)]
    assert [r.vote_average for r in B.tmdb_raw(raw).orderBy("imdb_id").collect()] == [7.5, 7.5, None, None]


def test_large_csv_is_split(spark):
    d = _tmp()
    with open(f"{d}/movies.csv", "w") as fh:
        fh.write("imdb_id,title\n" + "".join(f"tt{i},A title of some length {i}\n" for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = files.read_films_csv(spark, f"{d}/movies.csv")
        assert df.rdd.getNumPartitions() > 4 and df.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
