"""Readers for the raw inputs and the lakehouse snapshot.

Raw text is read as all-STRING columns (no schema inference pass over the
data); typing happens in the bronze models with ``try_cast``.  CSV files are split
also where quoted cells hold line breaks (``sources.records``).  gzip files cannot
be split; such reads take ``partitions`` for a round-robin ``repartition`` before
any heavy work.  The daily run then writes Parquet once and reads Parquet from
there on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.operators.clean import select_existing
from reelhouse.operators.windows import top_n
from reelhouse.sources.records import CSV_OPTIONS, read_csv_records


def read_films_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    multi_line: bool | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Film catalogue CSV: header row, double-quote quoting with doubled quotes.

    Line breaks inside quoted cells are kept and large files are split over many
    tasks (``records.read_csv_records``; a file that ends inside quotes raises).
    ``multi_line=True`` parses each file in one task instead; ``False`` takes
    every line for a record, which saves the pass that looks for line breaks
    where a file is known to hold none.  Only the ``columns`` that exist are kept
    (tolerant selection).
    """
    if multi_line is None:
        df = read_csv_records(spark, path)
    else:
        df = spark.read.options(**CSV_OPTIONS).option("header", True).option("multiLine", multi_line).csv(path)
    if columns is not None:
        df = select_existing(df, columns)
    if partitions:
        df = df.repartition(partitions)
    return df


def read_tsv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    partitions: int | None = None,
) -> DataFrame:
    """Tab-separated dump (optionally ``.gz``): ``\\N`` is NULL, quotes are literal.

    Every column is read as text; only ``columns`` are kept (those that exist).
    """
    df = (
        spark.read.option("sep", "\t")
        .option("header", True)
        .option("nullValue", "\\N")
        .option("quote", "")
        .csv(path)
    )
    df = select_existing(df, columns)
    if partitions:
        df = df.repartition(partitions)
    return df


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet snapshot folder (all files of the folder, not one named file).

    With ``schema`` the read is narrowed to those columns and types.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def sample_first(df: DataFrame, n: int, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows.

    With ``order_by`` the rows are the first in that order (ascending, NULLs
    last).  Without it, "first" means scan order: a scan-order index is
    attached, so the result does not depend on shuffle timing.  Either way
    the selection is a distributed top-n (``windows.top_n``) whose tasks each
    receive a bounded number of rows, however many partitions the input has.
    """
    if order_by:
        return top_n(df, [F.col(c).asc_nulls_last() for c in order_by], n)
    idx = "__scan_order"
    return top_n(df.withColumn(idx, F.monotonically_increasing_id()), [F.col(idx).asc()], n).drop(idx)
