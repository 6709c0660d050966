"""The daily batch: raw files -> bronze tables -> gold star schema -> checks.

``build_bronze`` / ``build_gold`` return lazy frames (the fact is the one
exception: numbering its rows writes them to the checkpoint folder).
``run_daily`` writes every table as an idempotent full refresh, reading each
written table back before the next layer uses it, so each layer's lineage is
cut at a reliable copy and a lost executor only recomputes its own layer.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession

from reelhouse import schemas
from reelhouse.operators import quality
from reelhouse.operators.clean import REJECT_REASONS, enforce, observe_rejects
from reelhouse.plans import bronze as B
from reelhouse.plans import dims as D
from reelhouse.plans.fact import fact_movie_performance
from reelhouse.plans.views import STORED_VIEWS, view_full, view_limited, view_sql
from reelhouse.sources import files, sinks
from reelhouse.sources.catalog import Catalog
from reelhouse.sources.releases import Releases


# Key order of the rows inside each gold file (row-group skipping).
GOLD_ORDER = {
    "dim_movie": ["movie_id"], "dim_genre": ["genre_id"], "dim_director": ["director_id"],
    "dim_production": ["production_id"], "dim_date": ["full_date"], "fact_movie_performance": ["imdb_id", "date_id"],
}


@dataclass
class Bronze:
    tmdb_raw: DataFrame
    crew: DataFrame
    names: DataFrame
    basics: DataFrame | None = None


@dataclass
class Gold:
    dim_movie: DataFrame
    dim_genre: DataFrame
    dim_director: DataFrame
    dim_production: DataFrame
    dim_date: DataFrame
    fact: DataFrame
    extra: dict = field(default_factory=dict)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_movie": self.dim_movie,
            "dim_genre": self.dim_genre,
            "dim_director": self.dim_director,
            "dim_production": self.dim_production,
            "dim_date": self.dim_date,
            "fact_movie_performance": self.fact,
        }


def build_bronze(films_src: DataFrame, crew_src: DataFrame, names_src: DataFrame,
                 basics_src: DataFrame | None = None, observation: Observation | None = None,
                 **filter_args) -> Bronze:
    """Bronze frames from raw-shaped frames (the film filter always runs first)."""
    return Bronze(
        tmdb_raw=B.tmdb_raw(B.films_filtered(films_src, **filter_args), observation),
        crew=B.title_crew_raw(crew_src),
        names=B.name_basics_raw(names_src),
        basics=B.title_basics_raw(basics_src) if basics_src is not None else None,
    )


def build_dims(bronze: Bronze, as_of=None, key_algo: str = D.KEY_ALGO) -> dict[str, DataFrame]:
    films = bronze.tmdb_raw
    return {
        "dim_movie": D.dim_movie(films, key_algo),
        "dim_genre": D.dim_genre(films, key_algo),
        "dim_director": D.dim_director(bronze.crew, bronze.names, as_of, key_algo),
        "dim_production": D.dim_production(films, as_of, key_algo),
        "dim_date": D.dim_date(films, key_algo=key_algo),
    }


def build_gold(bronze: Bronze, as_of=None, key_algo: str = D.KEY_ALGO, **fact_args) -> Gold:
    dims = build_dims(bronze, as_of, key_algo)
    fact = fact_movie_performance(bronze.tmdb_raw, bronze.crew, key_algo=key_algo, **fact_args)
    return Gold(fact=fact, **dims)


class Store:
    """Where a run's tables go: folders replaced one by one, or releases switched layer by layer."""

    def __init__(self, spark: SparkSession, root: str, releases: bool):
        self.spark, self.root, self.releases = spark, root, releases
        self.catalog = Catalog(spark, root)
        self.staged: dict[str, dict[str, dict]] = {}

    def write(self, layer: str, name: str, df: DataFrame, **layout) -> None:
        if self.releases:
            entry = Releases(self.spark, f"{self.root}/{layer}").stage(name, df, **layout)
            self.staged.setdefault(layer, {})[name] = entry
        else:
            sinks.overwrite(df, self.catalog.path(layer, name), **layout)

    def read(self, layer: str, name: str) -> DataFrame:
        """This run's table."""
        if self.releases:
            return Releases(self.spark, f"{self.root}/{layer}").scan(self.staged[layer][name])
        return self.catalog.tables(layer, [name])[name]

    def publish(self, layer: str) -> None:
        if self.releases:
            Releases(self.spark, f"{self.root}/{layer}").publish(*self.staged[layer].values())


def store_gold(spark: SparkSession, tables: dict[str, DataFrame], database: str) -> None:
    """Gold tables in the catalog, with their descriptions, and the two views over them as stored SQL."""
    for name, df in tables.items():
        described = quality.describe(df, schemas.COLUMN_COMMENTS.get(name, {}))
        sinks.replace_table(spark, described, f"{database}.{name}", comment=schemas.TABLE_COMMENTS.get(name),
                            sort_by=GOLD_ORDER[name])
    relations = {name: f"`{database}`.`{name}`" for name in tables}
    for name in STORED_VIEWS:
        sinks.create_view(spark, f"{database}.{name}", view_sql(name, relations))


def run_daily(
    spark: SparkSession,
    films_csv: str,
    crew_tsv: str,
    names_tsv: str,
    out_root: str,
    basics_tsv: str | None = None,
    run_date: str | None = None,
    as_of=None,
    raw_partitions: int | None = None,
    check: bool = True,
    multi_line: bool | None = None,
    releases: bool = False,
    database: str | None = None,
) -> dict:
    """One full refresh of the warehouse under ``out_root`` (Parquet folders).

    Film files are split over many tasks, line breaks inside quoted cells
    included (``multi_line`` as in ``files.read_films_csv``).  gzip dumps are read
    by one task each and dealt to ``raw_partitions`` (default: the shuffle
    partitions).

    With ``releases`` the bronze tables are switched in together, and the gold
    tables together after the quality rules passed (``sources.releases``); a run
    that dies, or fails its rules, leaves the day before readable.  Without, each
    table's folder is replaced in turn.  ``database`` also stores the gold tables
    with their descriptions in the catalog, and the two views as SQL text there;
    without, the views live as long as the session.

    Returns row counts, the film rows rejected by reason and the quality results.
    Raises ``QualityError`` when ``check`` is set and a rule fails.
    """
    run_date = run_date or _dt.date.today().isoformat()
    root = out_root.rstrip("/")
    raw_partitions = raw_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    store = Store(spark, root, releases)
    # Raw layer: keep today's copy of the film file (by run date); rejects are counted as it is written.
    films_raw = files.read_films_csv(spark, films_csv, multi_line=multi_line, partitions=raw_partitions if multi_line else None)
    rejected = Observation("tmdb_rejected")
    sinks.write_run(observe_rejects(films_raw, rejected), f"{root}/raw/tmdb", run_date)
    films_raw = sinks.read_latest(spark, f"{root}/raw/tmdb").drop("run_date")
    crew_raw = files.read_tsv(spark, crew_tsv, ["tconst", "directors"], partitions=raw_partitions)
    names_raw = files.read_tsv(spark, names_tsv, ["nconst", "primaryName", "primaryProfession"],
                               partitions=raw_partitions)
    basics_raw = (files.read_tsv(spark, basics_tsv, ["tconst", "primaryTitle", "startYear", "runtimeMinutes"],
                                 partitions=raw_partitions) if basics_tsv else None)

    loaded = Observation("tmdb_loaded")
    b = build_bronze(films_raw, crew_raw, names_raw, basics_raw)
    layout = {
        "tmdb_raw": ("imdb_id",), "imdb_title_crew_raw": ("tconst",),
        "imdb_name_basics_raw": ("nconst",), "imdb_title_basics_raw": ("tconst",),
    }
    frames = {"tmdb_raw": b.tmdb_raw, "imdb_title_crew_raw": b.crew, "imdb_name_basics_raw": b.names}
    if b.basics is not None:
        frames["imdb_title_basics_raw"] = b.basics
    for name, df in frames.items():
        store.write("bronze", name, df, sort_by=layout[name], max_rows_per_file=500_000,
                    observation=loaded if name == "tmdb_raw" else None)
    sinks.write_snapshot(B.films_snapshot(B.films_filtered(films_raw)), f"{root}/lakehouse/tmdb_bronze", schemas.TMDB_SNAPSHOT)
    store.publish("bronze")
    read = {name: store.read("bronze", name) for name in frames}
    bronze = Bronze(read["tmdb_raw"], read["imdb_title_crew_raw"], read["imdb_name_basics_raw"],
                    read.get("imdb_title_basics_raw"))

    dims = build_dims(bronze, as_of)
    for name, df in dims.items():
        store.write("gold", name, enforce(df, schemas.GOLD[name]), sort_by=GOLD_ORDER[name])
    fact = fact_movie_performance(bronze.tmdb_raw, bronze.crew)
    store.write("gold", "fact_movie_performance", enforce(fact, schemas.FACT), sort_by=GOLD_ORDER["fact_movie_performance"])
    gold = Gold(fact=store.read("gold", "fact_movie_performance"), **{name: store.read("gold", name) for name in dims})
    results = quality.run_suite(gold.tables(), foreign_keys=quality.GOLD_FOREIGN_KEYS, fail=check)
    store.publish("gold")
    if database:
        store_gold(spark, gold.tables(), database)

    views = {
        "analytical_view_full": view_full(gold.fact, gold.dim_movie, gold.dim_date, gold.dim_director,
                                          gold.dim_genre, gold.dim_production),
        "analytical_view_limited": view_limited(gold.fact, gold.dim_movie, gold.dim_date, gold.dim_director,
                                                gold.dim_genre, gold.dim_production),
    }
    for name, v in views.items():
        sinks.publish_view(v, name)

    counts = {n: df.count() for n, df in read.items()}
    counts.update({n: df.count() for n, df in gold.tables().items()})
    seen = rejected.get
    return {"run_date": run_date, "tmdb_loaded": loaded.get.get("rows"), "rows": counts, "tmdb_read": seen.get("rows"),
            "rejected": {r: seen[r] for r in REJECT_REASONS},
            "quality": [r.asDict() for r in results]}
