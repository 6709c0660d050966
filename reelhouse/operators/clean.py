"""Cleaning operators: quality filter, null fills, typed coercion, schema enforcement."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.functions.exprs import fill_int_expr, num, parse_date


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the frame's own column order."""
    wanted = set(columns)
    return df.select([c for c in df.columns if c in wanted])


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in ``subset`` (or in any column when omitted)."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def fill_text(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """NULL -> '' for the given text columns that exist (others untouched)."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in present})


def fill_int(df: DataFrame, cols: Iterable[str], default: int = -1) -> DataFrame:
    """Text -> INT for the given columns, ``default`` where missing or unparsable."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: fill_int_expr(c, default) for c in present})


#: Reasons of a rejected film row, in the order they are looked for.
REJECT_REASONS = ("no id", "no title", "no release date", "too early", "status", "too short", "no rating", "no votes")


def film_rules(
    df: DataFrame,
    min_year: int = 2000,
    status: str = "released",
    min_runtime: float = 40,
    min_rating: float = 0,
    min_votes: float = 0,
    date_col: str = "release_date",
) -> list[Column]:
    """The conditions of the film quality filter, in the order of ``REJECT_REASONS``.

    An id, a title and a parsable release date in ``min_year`` or later, status
    equal to ``status`` ignoring case (missing = ''), and runtime / rating / vote
    count strictly above the thresholds, where unparsable or missing numbers
    count as 0.
    """
    def col(name: str):
        # A missing optional column behaves like an all-NULL column.
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    rd = parse_date(col(date_col))
    return [
        col("imdb_id").isNotNull(),
        col("title").isNotNull(),
        rd.isNotNull(),
        F.year(rd) >= min_year,
        F.lower(F.coalesce(col("status").cast("string"), F.lit(""))) == status.lower(),
        F.coalesce(num(col("runtime")), F.lit(0.0)) > min_runtime,
        F.coalesce(num(col("vote_average")), F.lit(0.0)) > min_rating,
        F.coalesce(num(col("vote_count")), F.lit(0.0)) > min_votes,
    ]


def filter_films(df: DataFrame, **rules) -> DataFrame:
    """Film quality filter (one pushed-down ``filter``): the rows that meet all ``film_rules``."""
    return df.filter(reduce(and_, film_rules(df, **rules)))


def reject_reason(df: DataFrame, **rules) -> Column:
    """The first of the ``film_rules`` that a row breaks, by its reason; NULL for a row that passes."""
    return F.coalesce(*[F.when(~ok, F.lit(why)) for ok, why in zip(film_rules(df, **rules), REJECT_REASONS)])


def observe_rejects(df: DataFrame, observation: Observation, **rules) -> DataFrame:
    """``df`` unchanged; the job that reads it counts its rows, and the rejected ones by reason, on the side."""
    why = reject_reason(df, **rules)
    return df.observe(observation, F.count(F.lit(1)).alias("rows"),
                      *[F.count_if(F.coalesce(why == r, F.lit(False))).alias(r) for r in REJECT_REASONS])


def enforce(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Project ``df`` onto ``schema``: same names, order and types.

    Columns missing from ``df`` become typed NULLs (unless ``strict``).  Casts
    are ANSI casts, so a value that does not fit raises instead of wrapping.
    """
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif strict:
            raise ValueError(f"column {f.name!r} missing")
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(cols)
