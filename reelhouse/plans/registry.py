"""Registered queries: one callable per operator / model / report.

Each callable takes ``(spark, sf_dir)``, derives the raw inputs from the test
tables of ``sf_dir`` (whole tables, see ``sources.adapter``), and returns a
lazy DataFrame.  Column names and types match the SQL of ``reelhouse.oracle``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse import oracle
from reelhouse.functions.exprs import bucketize, popularity, surrogate_key
from reelhouse.operators import quality
from reelhouse.operators.clean import reject_reason
from reelhouse.operators.heavy import any_heavy
from reelhouse.operators.policy import REFERENCE_POLICY, project_for_role
from reelhouse.operators.windows import file_row_id, find_hot_keys, lag_delta, lag_spread
from reelhouse.plans import bronze as B
from reelhouse.plans import dims as D
from reelhouse.plans import reports as R
from reelhouse.plans.daily import Bronze, build_bronze
from reelhouse.plans.fact import fact_literal, fact_movie_performance
from reelhouse.plans.views import view_full, view_limited, view_sql
from reelhouse import schemas
from reelhouse.session import ensure_checkpoint_dir
from reelhouse.sources.adapter import LINE_BREAKS, RawInputs, read_testdata
from reelhouse.sources import sinks
from reelhouse.sources.catalog import Catalog
from reelhouse.sources.files import read_films_csv, read_snapshot, read_tsv, sample_first
from reelhouse.sources.releases import Releases

AS_OF = _dt.date.fromisoformat(oracle.AS_OF)
ROUND6 = ("movie_popularity", "popularity_change")


class Warehouse:
    """Lazily built layers for one test-data folder (each built at most once)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.raw = RawInputs(spark, sf_dir)

    @cached_property
    def bronze(self) -> Bronze:
        return build_bronze(self.raw.films_src, self.raw.crew_src, self.raw.names_src)

    @cached_property
    def dim_movie(self):
        return D.dim_movie(self.bronze.tmdb_raw)

    @cached_property
    def dim_genre(self):
        return D.dim_genre(self.bronze.tmdb_raw)

    @cached_property
    def dim_production(self):
        return D.dim_production(self.bronze.tmdb_raw, AS_OF)

    @cached_property
    def dim_director(self):
        return D.dim_director(self.bronze.crew, self.bronze.names, AS_OF)

    @cached_property
    def dim_date(self):
        return D.dim_date(self.bronze.tmdb_raw)

    @cached_property
    def fact(self):
        return fact_movie_performance(self.bronze.tmdb_raw, self.bronze.crew)

    def star(self):
        return (self.fact, self.dim_movie, self.dim_date, self.dim_director, self.dim_genre, self.dim_production)


def _round(df: DataFrame, cols=ROUND6, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols if c in df.columns})


def _order_dates(spark, sf_dir):
    return read_testdata(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("full_date")).distinct()


SLICE_GENRES = oracle.SLICE_GENRES


def _queries() -> dict[str, Callable[[Warehouse], DataFrame]]:
    q: dict[str, Callable[[Warehouse], DataFrame]] = {}
    q["q_tmdb_filter"] = lambda w: B.films_filtered(w.raw.films_src)
    q["q_fill_bronze"] = lambda w: w.bronze.tmdb_raw
    q["q_crew_bronze"] = lambda w: w.bronze.crew
    q["q_names_bronze"] = lambda w: w.bronze.names
    q["q_dim_movie"] = lambda w: w.dim_movie
    q["q_dim_genre"] = lambda w: w.dim_genre
    q["q_dim_director"] = lambda w: w.dim_director
    q["q_dim_production"] = lambda w: w.dim_production
    q["q_dim_date"] = lambda w: w.dim_date
    q["q_dim_date_literal"] = lambda w: D.dim_date(w.bronze.tmdb_raw, weekday_by_name=True)
    q["q_calendar_orders"] = lambda w: D.calendar(_order_dates(w.spark, w.sf_dir))
    q["q_holidays_strict"] = lambda w: D.calendar(_order_dates(w.spark, w.sf_dir), strict_thanksgiving=True)
    q["q_surrogate_key"] = lambda w: read_testdata(w.spark, w.sf_dir, "customer").select(
        "c_custkey", "c_name", surrogate_key("c_name", "md5_60").alias("name_key"))
    q["q_popularity"] = lambda w: w.bronze.tmdb_raw.select(
        "imdb_id", "vote_count", F.round(popularity("vote_average", "vote_count"), 6).alias("movie_popularity"))
    q["q_bucketize_runtime"] = lambda w: w.bronze.tmdb_raw.select(
        "imdb_id", "runtime",
        bucketize("runtime", R.RUNTIME_EDGES, R.RUNTIME_LABELS, R.RUNTIME_ELSE).alias("runtime_bucket"))
    q["q_fact_direct"] = lambda w: _round(w.fact)
    q["q_fact_join_keys"] = lambda w: _round(fact_movie_performance(
        w.bronze.tmdb_raw, w.bronze.crew, key_mode="join",
        dim_genre=w.dim_genre, dim_production=w.dim_production, dim_date=w.dim_date))
    q["q_fact_literal"] = lambda w: _round(fact_literal(
        w.bronze.tmdb_raw, w.bronze.crew, w.dim_genre, w.dim_production, w.dim_date))
    q["q_row_number"] = lambda w: file_row_id(
        read_testdata(w.spark, w.sf_dir, "lineitem").select("l_orderkey", "l_linenumber"),
        ["l_orderkey", "l_linenumber"], name="row_id")
    q["q_lag_by_director_year"] = _lag_by_director
    q["q_view_full"] = lambda w: _round(view_full(*w.star()))
    q["q_view_limited"] = lambda w: _round(view_limited(*w.star()))
    q["q_role_projection"] = lambda w: _round(
        project_for_role(w.fact, "fact_movie_performance", "analyst_limited", REFERENCE_POLICY))
    q["q_r1_genre_rating"] = lambda w: R.genre_rating(w.fact, w.dim_genre)
    q["q_r2_directors"] = lambda w: R.directors(w.fact, w.dim_director, min_rating=oracle.DIRECTOR_MIN_RATING)
    q["q_r3_by_year"] = lambda w: R.by_release_year(w.fact, w.dim_movie)
    q["q_r4_top_films"] = lambda w: R.top_films(w.fact, w.dim_movie, w.dim_genre, oracle.TOP_YEAR, 10)
    q["q_r4_mode"] = lambda w: R.top_genres_by_peak(w.fact, w.dim_movie, w.dim_genre, oracle.TOP_YEAR, 10)
    q["q_r5_runtime_bucket"] = lambda w: R.runtime_buckets(w.fact, w.dim_movie)
    q["q_slice_genre"] = lambda w: R.slice_report(_round(view_full(*w.star())), {"genre_name": SLICE_GENRES})
    q["q_quality_suite"] = lambda w: quality.suite({
        "dim_movie": w.dim_movie, "dim_genre": w.dim_genre, "dim_date": w.dim_date,
        "dim_production": w.dim_production, "fact_movie_performance": w.fact})
    q["q_fk_orphans"] = _fk_orphans
    q["q_snapshot"] = lambda w: B.films_snapshot(B.films_filtered(w.raw.films_src))
    q["q_sample_first"] = lambda w: sample_first(
        w.raw.films_src.select("imdb_id", "title", "revenue"), 5000, ["imdb_id", "title", "revenue"])
    q["q_bronze_from_csv"] = _bronze_from_csv
    q["q_crew_from_tsv_gz"] = _crew_from_tsv_gz
    q["q_title_basics_bronze"] = lambda w: B.title_basics_raw(w.raw.basics_src)
    q["q_snapshot_scan"] = _snapshot_scan
    q["q_films_year_partition"] = _films_year_partition
    q["q_latest_run"] = _latest_run
    q["q_clustered_bronze"] = _clustered_bronze
    q["q_append_columns"] = lambda w: sinks.append_new_columns(
        w.bronze.tmdb_raw, B.films_filtered(w.raw.films_src))
    q["q_load_counts"] = lambda w: quality.row_counts({
        "tmdb_filtered": B.films_filtered(w.raw.films_src), "tmdb_raw": w.bronze.tmdb_raw,
        "imdb_title_crew_raw": w.bronze.crew, "imdb_name_basics_raw": w.bronze.names,
        "imdb_title_basics_raw": B.title_basics_raw(w.raw.basics_src)})
    q["q_view_by_name"] = _view_by_name
    q["q_csv_line_breaks"] = _csv_line_breaks
    q["q_rejects"] = lambda w: w.raw.films_src.select("imdb_id", "title", reject_reason(w.raw.films_src).alias("reason")).filter(
        F.col("reason").isNotNull())
    q["q_replace_table"] = _replace_table
    q["q_release_switch"] = _release_switch
    q["q_append_stored"] = _append_stored
    q["q_view_stored"] = _view_stored
    q["q_describe"] = _describe
    q["q_ref_scan"] = _ref_scan
    q["q_lag_segments"] = _lag_segments
    q["q_any_heavy"] = lambda w: any_heavy(
        read_testdata(w.spark, w.sf_dir, "lineitem").withColumn("flags", F.concat("l_returnflag", "l_linestatus")), ["l_orderkey"], "flags")
    return q


def _scratch(spark: SparkSession) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/reelhouse-io-{uuid.uuid4().hex[:12]}"


def _bronze_from_csv(w: Warehouse) -> DataFrame:
    """Raw film rows written as a CSV file, read back by the CSV reader, loaded to bronze."""
    path = f"{_scratch(w.spark)}/movies"
    sinks.write_csv(w.raw.films_src, path)
    raw = read_films_csv(w.spark, path, columns=schemas.RAW_FILM_COLUMNS)
    return B.tmdb_raw(B.films_filtered(raw))


def _csv_line_breaks(w: Warehouse) -> DataFrame:
    """Film rows whose titles and companies hold quoted line breaks, written as CSV, read back in splits, loaded to bronze."""
    path = f"{_scratch(w.spark)}/movies"
    broken = w.raw.films_src.withColumns({c: F.expr(x) for c, x in LINE_BREAKS.items()})
    sinks.write_csv(broken, path)
    return B.tmdb_raw(B.films_filtered(read_films_csv(w.spark, path, columns=schemas.RAW_FILM_COLUMNS)))


def _replace_table(w: Warehouse) -> DataFrame:
    """The film table stored in the catalog, then replaced by rows computed from itself."""
    name = f"default.films_{uuid.uuid4().hex[:12]}"
    sinks.replace_table(w.spark, w.bronze.tmdb_raw, name)
    old = w.spark.table(name)
    return sinks.replace_table(w.spark, old.withColumn("revenue", F.col("revenue") - F.col("budget")), name, sort_by=["imdb_id"])


def _release_switch(w: Warehouse) -> DataFrame:
    """Films and crew released together, then both replaced by one switch; rows of both versions, marked."""
    layer = Releases(w.spark, _scratch(w.spark))
    layer.publish(layer.stage("films", B.films_filtered(w.raw.films_src)), layer.stage("crew", w.raw.crew_src))
    layer.publish(layer.stage("films", w.bronze.tmdb_raw.filter("vote_count > 3"), sort_by=["imdb_id"]),
                  layer.stage("crew", w.bronze.crew.filter("directors <> ''")))
    rows = [layer.table(t, n).select(F.lit(t).alias("tbl"), F.lit(n).alias("version"), F.col(k).alias("id"))
            for n in (1, 2) for t, k in (("films", "imdb_id"), ("crew", "tconst"))]
    return reduce(DataFrame.union, rows)


def _append_stored(w: Warehouse) -> DataFrame:
    """Bronze films stored, then the raw rows with one column more appended to the stored table, read as one."""
    layer = Releases(w.spark, _scratch(w.spark))
    layer.replace("films", w.bronze.tmdb_raw, sort_by=["imdb_id"])
    return layer.append("films", B.films_filtered(w.raw.films_src))


def _view_stored(w: Warehouse) -> DataFrame:
    """Gold tables written once, the limited view stored as SQL text over them and read by name in another session."""
    root = _scratch(w.spark)
    tables = dict(zip(("fact_movie_performance", "dim_movie", "dim_date", "dim_director", "dim_genre", "dim_production"), w.star()))
    for name, df in tables.items():
        sinks.overwrite(df, f"{root}/{name}")
    name = f"default.limited_{uuid.uuid4().hex[:12]}"
    sinks.create_view(w.spark, name, view_sql("analytical_view_limited", {t: f"parquet.`{root}/{t}`" for t in tables}))
    return _round(w.spark.newSession().table(name))


def _describe(w: Warehouse) -> DataFrame:
    """Column descriptions read back from the catalog, with the number of filled values of each described column."""
    frames = []
    for table in ("dim_movie", "dim_genre", "dim_date", "dim_production"):
        name = f"default.{table}_{uuid.uuid4().hex[:12]}"
        described = quality.describe(getattr(w, table), schemas.COLUMN_COMMENTS[table])
        df = sinks.replace_table(w.spark, described, name, comment=schemas.TABLE_COMMENTS[table])
        stored = {c.name: c.description for c in w.spark.catalog.listColumns(name) if c.description}
        counts = df.agg(*[F.count(c).alias(c) for c in stored])
        frames.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(table).alias("tbl"), F.lit(c).alias("column_name"), F.lit(text).alias("description"), F.col(c).alias("filled"))
            for c, text in stored.items()]))))
    return reduce(DataFrame.union, frames)


def _ref_scan(w: Warehouse) -> DataFrame:
    """Directors built from stored bronze tables by name, stored as a model and read by ``ref``."""
    cat = Catalog(w.spark, _scratch(w.spark))
    sinks.overwrite(w.bronze.crew, cat.path("bronze", "imdb_title_crew_raw"))
    sinks.overwrite(w.bronze.names, cat.path("bronze", "imdb_name_basics_raw"))
    crew, names = (cat.source("bronze", t) for t in ("imdb_title_crew_raw", "imdb_name_basics_raw"))
    sinks.overwrite(D.dim_director(crew, names, AS_OF), cat.path("gold", "dim_director"), sort_by=["director_id"])
    return cat.ref("dim_director")


def _lag_segments(w: Warehouse) -> DataFrame:
    """Quantity and price change between consecutive lines of a supplier, by segments of every group."""
    lines = read_testdata(w.spark, w.sf_dir, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("quantity"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"))
    return lag_spread(lines, ["l_suppkey"], ["l_orderkey", "l_linenumber", "quantity", "cents"], {"quantity": "quantity_change", "cents": "cents_change"})


def _crew_from_tsv_gz(w: Warehouse) -> DataFrame:
    """Crew rows written as gzip TSV (\\N for NULL), read back by the TSV reader, loaded to bronze."""
    path = f"{_scratch(w.spark)}/title.crew"
    sinks.write_tsv_gz(w.raw.crew_src, path)
    return B.title_crew_raw(read_tsv(w.spark, path, ["tconst", "directors"]))


def _snapshot_scan(w: Warehouse) -> DataFrame:
    """Snapshot written as a Parquet folder, then scanned as a table with the declared schema."""
    path = f"{_scratch(w.spark)}/tmdb_bronze"
    sinks.write_snapshot(B.films_snapshot(B.films_filtered(w.raw.films_src)), path, schemas.TMDB_SNAPSHOT)
    return read_snapshot(w.spark, path, schemas.TMDB_SNAPSHOT)


def _films_year_partition(w: Warehouse) -> DataFrame:
    """Bronze films written with one folder per release year; one year read back (partition pruning)."""
    path = f"{_scratch(w.spark)}/tmdb_by_year"
    films = w.bronze.tmdb_raw.withColumn("release_year", F.year("release_date"))
    sinks.overwrite(films, path, sort_by=["imdb_id"], partition_by=["release_year"])
    return w.spark.read.parquet(path).filter(F.col("release_year") == oracle.TOP_YEAR)


def _latest_run(w: Warehouse) -> DataFrame:
    """Two runs of the raw film file by run date; the latest one is read back."""
    root = f"{_scratch(w.spark)}/raw_tmdb"
    sinks.write_run(w.raw.films_src, root, "2023-12-31")
    sinks.write_run(B.films_filtered(w.raw.films_src), root, oracle.AS_OF)
    return sinks.read_latest(w.spark, root)


def _clustered_bronze(w: Warehouse) -> DataFrame:
    """Bronze films range-clustered on imdb_id in capped files, read back by name."""
    cat = Catalog(w.spark, _scratch(w.spark))
    sinks.overwrite(w.bronze.tmdb_raw, cat.path("bronze", "tmdb_raw"), sort_by=["imdb_id"], cluster=True,
                    max_rows_per_file=500)
    return cat.source("bronze", "tmdb_raw")


def _view_by_name(w: Warehouse) -> DataFrame:
    """The full view published under its name and queried through the catalog."""
    sinks.publish_view(view_full(*w.star()), "analytical_view_full")
    return _round(w.spark.table("analytical_view_full"))


def _lag_by_director(w: Warehouse) -> DataFrame:
    """Revenue change between consecutive films of the same director."""
    from reelhouse.functions.exprs import first_item

    t = w.bronze.tmdb_raw.select("imdb_id", F.year("release_date").alias("release_year"), "release_date", "revenue")
    c = w.bronze.crew.select("tconst", F.nullif(first_item("directors"), F.lit("")).alias("director_id"))
    rows = t.join(c, t["imdb_id"] == c["tconst"], "inner").drop("tconst").filter(F.col("director_id").isNotNull())
    # heavy directors found on the crew column alone (the hot list only routes
    # rows, so an estimate suffices), not by computing the join twice
    hot = find_hot_keys(c.filter(F.col("director_id").isNotNull()), ["director_id"])
    out = lag_delta(rows, ["director_id"], ["release_year", "release_date", "imdb_id", "revenue"],
                    {"revenue": "revenue_growth"}, hot_keys=hot)
    return out.select("director_id", "imdb_id", "release_year", "revenue", "revenue_growth")


def _fk_orphans(w: Warehouse) -> DataFrame:
    tables = {
        "fact_movie_performance": w.fact, "dim_movie": w.dim_movie, "dim_date": w.dim_date,
        "dim_genre": w.dim_genre, "dim_production": w.dim_production, "dim_director": w.dim_director,
        "imdb_name_basics_raw": w.bronze.names,
    }
    fks = list(quality.GOLD_FOREIGN_KEYS) + [("dim_director", "director_id", "imdb_name_basics_raw", "nconst")]
    return quality.suite(tables, tests={}, foreign_keys=fks)


QUERIES = _queries()


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Callables ``(spark, sf_dir) -> DataFrame`` for the driver contract."""
    return {name: (lambda fn: lambda spark, sf_dir: fn(Warehouse(spark, sf_dir)))(fn) for name, fn in QUERIES.items()}
