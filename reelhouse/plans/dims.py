"""Gold dimensions: movie, genre, director, production company, calendar.

Every dimension is keyed by a hash of its natural key, so keys are computed
row by row (no sequence, no global ordering, no shuffle to assign them).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.calendar import holiday_name, is_weekend, season, weekday_name
from reelhouse.functions.exprs import first_item, surrogate_key
from reelhouse.operators.joins import DEFAULT_BROADCAST_ROWS, reduce_then_left_join

# Portable 60-bit MD5 keys by default (any engine can recompute them);
# ``"xxhash64"`` is the faster Spark-only choice.
KEY_ALGO = "md5_60"


def _as_of(as_of: _dt.date | str | None) -> Column:
    """Validity start date: a fixed date, or today's date when ``None``."""
    if as_of is None:
        return F.current_date()
    return F.lit(as_of).cast("date")


def _non_blank(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


def dim_movie(films: DataFrame, key_algo: str = KEY_ALGO) -> DataFrame:
    """One row per trimmed title.

    The attributes come from one whole source row: the one with the smallest
    (imdb_id, release_date, runtime, language), so a row never mixes films.
    """
    src = films.filter(_non_blank("title")).select(
        F.trim("title").alias("movie_title"),
        F.struct(
            "imdb_id",
            "release_date",
            F.col("runtime").alias("movie_runtime"),
            F.col("original_language").alias("language"),
        ).alias("r"),
    )
    picked = src.groupBy("movie_title").agg(F.min("r").alias("r"))
    return picked.select(
        surrogate_key("movie_title", key_algo).alias("movie_id"),
        F.col("r.imdb_id").alias("imdb_id"),
        "movie_title",
        F.col("r.release_date").alias("release_date"),
        F.col("r.movie_runtime").alias("movie_runtime"),
        F.col("r.language").alias("language"),
    )


def dim_genre(films: DataFrame, key_algo: str = KEY_ALGO) -> DataFrame:
    """Distinct first genres of non-empty genre lists (a blank first item is kept)."""
    names = films.filter(_non_blank("genres")).select(first_item("genres").alias("genre_name")).distinct()
    return names.select(surrogate_key("genre_name", key_algo).alias("genre_id"), "genre_name")


def dim_production(films: DataFrame, as_of=None, key_algo: str = KEY_ALGO) -> DataFrame:
    """Distinct non-blank first production companies, current as of ``as_of``."""
    names = (
        films.filter(_non_blank("production_companies"))
        .select(first_item("production_companies").alias("production_name"))
        .distinct()
        .filter(_non_blank("production_name"))
    )
    return names.select(
        surrogate_key("production_name", key_algo).alias("production_id"),
        "production_name",
        _as_of(as_of).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def dim_director(
    crew: DataFrame,
    names: DataFrame,
    as_of=None,
    key_algo: str = KEY_ALGO,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Distinct first directors of the crew table, named from the person table.

    The person table is the largest input: when the distinct director ids are
    few enough it is first reduced by a broadcast semi-join, otherwise the
    ids (already hash-partitioned by their DISTINCT) meet it in one shuffle join.
    """
    ids = (
        crew.filter(_non_blank("directors"))
        .select(first_item("directors").alias("director_id"))
        .distinct()
    )
    people = names.select("nconst", "primaryName")
    joined = reduce_then_left_join(ids, people, "director_id", "nconst", max_broadcast_rows)
    return joined.filter(F.col("director_id").isNotNull()).select(
        surrogate_key("director_id", key_algo).alias("imdb_dir_name_id"),
        "director_id",
        F.col("primaryName").alias("director_name"),
        _as_of(as_of).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(1).alias("is_current"),
    )


def calendar(dates: DataFrame, date_col: str = "full_date", strict_thanksgiving: bool = False,
             key_algo: str = KEY_ALGO, weekday_by_name: bool = False) -> DataFrame:
    """Calendar attributes for a frame with one DATE column per row.

    Weekday tests (weekend, Labor Day, Thanksgiving) use the weekday number.
    ``weekday_by_name=True`` reproduces the model's literal output instead: it
    compares the short weekday name with full names, so those tests are never
    true (``is_weekend`` is always 0, neither holiday is tagged).
    """
    d = F.col(date_col)
    return dates.select(
        surrogate_key(d, key_algo).alias("date_id"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.weekofyear(d).alias("week"),
        weekday_name(d).alias("weekday"),
        season(d).alias("season"),
        is_weekend(d, by_name=weekday_by_name).alias("is_weekend"),
        holiday_name(d, strict_thanksgiving=strict_thanksgiving, weekday_by_name=weekday_by_name)
        .alias("holiday_name"),
    ).select(
        "*",
        F.when(F.col("holiday_name").isNotNull(), 1).otherwise(0).alias("is_holiday"),
        F.lit(None).cast("int").alias("days_until_holiday"),
        F.lit(None).cast("int").alias("days_after_holiday"),
    )


def dim_date(films: DataFrame, date_col: str = "release_date", strict_thanksgiving: bool = False,
             key_algo: str = KEY_ALGO, weekday_by_name: bool = False) -> DataFrame:
    """Calendar rows for the distinct non-NULL dates of ``date_col`` (see
    ``calendar`` for ``weekday_by_name``)."""
    dates = films.select(F.col(date_col).cast("date").alias("full_date")).filter(
        F.col("full_date").isNotNull()
    ).distinct()
    return calendar(dates, "full_date", strict_thanksgiving, key_algo, weekday_by_name)
