"""Scalar column expressions used by the models and reports.

Every function returns a ``Column`` built from ``pyspark.sql.functions``, so
it stays inside whole-stage code generation.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def first_item(col: ColumnOrName, sep: str = ",") -> Column:
    """Trimmed first element of a delimited list.

    ``'' -> ''`` and ``NULL -> NULL``; never raises on an empty list (unlike
    ``element_at`` on a split).
    """
    return F.trim(F.split_part(_c(col), F.lit(sep), F.lit(1)))


def first_word(col: ColumnOrName) -> Column:
    """Text before the first space (the whole text when there is none)."""
    return F.split_part(_c(col), F.lit(" "), F.lit(1))


def surrogate_key(col: ColumnOrName, algo: str = "xxhash64") -> Column:
    """64-bit surrogate key of a natural key (NULL stays NULL).

    ``xxhash64``  fastest; Spark-specific values.
    ``md5_60``    first 60 bits of the MD5 of the key text, as a non-negative
                  BIGINT; portable (any engine with md5 gives the same value).
    Dates hash as their ISO ``yyyy-MM-dd`` text.
    """
    text = _c(col).cast("string")
    if algo == "xxhash64":
        return F.when(text.isNotNull(), F.xxhash64(text))
    if algo == "md5_60":
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    raise ValueError(f"unknown key algorithm {algo!r}")


def num(col: ColumnOrName) -> Column:
    """Dirty text/number -> DOUBLE, unparsable and NaN -> NULL."""
    return F.nullif(_c(col).try_cast("double"), F.lit(float("nan")))


def parse_date(col: ColumnOrName) -> Column:
    """Dirty text/date -> DATE, unparsable -> NULL."""
    return _c(col).try_cast("date")


def fill_int_expr(col: ColumnOrName, default: int = -1) -> Column:
    """Text -> INT, with ``default`` for missing or unparsable values."""
    return F.coalesce(_c(col).try_cast("double").try_cast("int"), F.lit(default))


def popularity(rating: ColumnOrName, votes: ColumnOrName) -> Column:
    """``rating * ln(1 + votes)`` as DOUBLE."""
    return _c(rating).cast("double") * F.log1p(_c(votes).cast("double"))


def bucketize(
    col: ColumnOrName, edges: Sequence[float], labels: Sequence[str], else_label: str
) -> Column:
    """First label whose upper edge (inclusive) is >= the value, else ``else_label``.

    NULL values fall through to ``else_label`` (all comparisons are unknown).
    """
    if len(edges) != len(labels):
        raise ValueError("edges and labels must have the same length")
    c = _c(col)
    expr = None
    for edge, label in zip(edges, labels):
        expr = (F.when(c <= edge, label) if expr is None else expr.when(c <= edge, label))
    return F.lit(else_label) if expr is None else expr.otherwise(else_label)


def rating_band(col: ColumnOrName, low: float = 6.0, high: float = 8.0) -> Column:
    """LOW / MID / HIGH generalisation of a rating; NULL and NaN -> UNKNOWN."""
    c = _c(col).cast("double")
    return (
        F.when(c.isNull() | F.isnan(c), "UNKNOWN")
        .when(c < low, "LOW")
        .when(c < high, "MID")
        .when(c >= high, "HIGH")
        .otherwise("UNKNOWN")
    )


def year_range(col: ColumnOrName, year: int) -> Column:
    """``year(col) = year`` written as a closed-open date range.

    The range form reaches the Parquet reader as two pushed filters (and
    row-group min/max skipping); ``year(col) = y`` would push only IS NOT NULL.
    """
    c = _c(col)
    return (c >= F.lit(_dt.date(year, 1, 1))) & (c < F.lit(_dt.date(year + 1, 1, 1)))
