"""Bronze layer: typed, filtered raw tables.

Raw text -> quality filter -> NULL fills -> declared bronze schema.  Text
columns are never NULL in bronze (missing is ''); ids that are missing drop
the row; unparsable numbers become NULL (films) or -1 (title basics).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.functions.exprs import num, parse_date
from reelhouse.operators.clean import (
    drop_incomplete,
    enforce,
    fill_int,
    fill_text,
    filter_films,
    select_existing,
)
from reelhouse.sources.files import sample_first

FILM_TEXT = ["imdb_id", "title", "production_companies", "genres", "original_language"]
# The columns the film table declares.
FILM_LOAD_COLUMNS = [
    "imdb_id", "title", "release_date", "production_companies", "budget", "revenue",
    "vote_average", "original_language", "vote_count", "runtime", "genres",
]


def films_filtered(raw: DataFrame, **filter_args) -> DataFrame:
    """Raw film rows that pass the quality filter (all raw columns kept)."""
    return filter_films(select_existing(raw, schemas.RAW_FILM_COLUMNS), **filter_args)


def tmdb_raw(filtered: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Bronze film table from filtered raw rows.

    Text NULL -> '', release date parsed (rows without one dropped), numbers
    coerced with ``try_cast`` and stored in the declared types.  Pass an
    ``Observation`` to get the loaded row count without an extra pass.
    """
    df = select_existing(filtered, FILM_LOAD_COLUMNS)
    df = fill_text(df, FILM_TEXT)
    df = df.withColumn("release_date", parse_date("release_date")).filter(F.col("release_date").isNotNull())
    numeric = {
        "budget": "bigint", "revenue": "bigint", "vote_average": "float",
        "vote_count": "bigint", "runtime": "int",
    }
    # Direct cast first (exact for 64-bit integers), then via DOUBLE for text
    # such as '123.0'; anything else, NaN too, becomes NULL.
    df = df.withColumns({
        c: num(c).try_cast(t) if t == "float" else F.coalesce(F.col(c).try_cast(t), num(c).try_cast(t))
        for c, t in numeric.items() if c in df.columns
    })
    # Text columns absent from the file are stored as '' like present ones.
    out = fill_text(enforce(df, schemas.TMDB_RAW), FILM_TEXT)
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    return out


def title_crew_raw(raw: DataFrame) -> DataFrame:
    """Bronze crew: rows without ``tconst`` dropped, missing directors -> ''."""
    df = drop_incomplete(select_existing(raw, ["tconst", "directors"]), ["tconst"])
    return enforce(fill_text(df, ["directors"]), schemas.TITLE_CREW_RAW)


def name_basics_raw(raw: DataFrame) -> DataFrame:
    """Bronze names: rows without ``nconst`` dropped, missing text -> ''."""
    df = drop_incomplete(select_existing(raw, ["nconst", "primaryName", "primaryProfession"]), ["nconst"])
    return enforce(fill_text(df, ["primaryName", "primaryProfession"]), schemas.NAME_BASICS_RAW)


def title_basics_raw(raw: DataFrame) -> DataFrame:
    """Bronze title basics: years/runtimes -> INT with -1 for unknown, title NULL -> ''."""
    df = drop_incomplete(select_existing(raw, ["tconst", "primaryTitle", "startYear", "runtimeMinutes"]), ["tconst"])
    df = fill_int(fill_text(df, ["primaryTitle"]), ["startYear", "runtimeMinutes"], -1)
    return enforce(df, schemas.TITLE_BASICS_RAW)


def films_snapshot(films: DataFrame, n: int | None = None, order_by=("imdb_id",)) -> DataFrame:
    """Lakehouse snapshot of the filtered film file, renamed and typed.

    All rows, or the first ``n`` of ``order_by`` if asked for.

    Rows with any missing kept value are dropped; release dates become
    microsecond timestamps (unparsable -> NULL); vote counts that are not whole
    numbers become NULL instead of failing the load.
    """
    rows = films if n is None else sample_first(films, n, list(order_by) if order_by else None)
    df = rows.withColumnsRenamed({"vote_average": "vote_avg"})
    df = drop_incomplete(select_existing(df, [f.name for f in schemas.TMDB_SNAPSHOT.fields]))
    vc = num("vote_count")
    df = df.withColumns({
        "release_date": F.col("release_date").cast("string").try_cast("timestamp_ntz"),
        "vote_count": F.when(vc == F.floor(vc), vc.try_cast("int")),
        "revenue": num("revenue"),
        "vote_avg": num("vote_avg"),
    })
    return enforce(df, schemas.TMDB_SNAPSHOT)
