"""Table writers and table management.

All writes are idempotent full refreshes (``mode("overwrite")``): a rerun of a
day replaces that day's tables.  ``replace_table`` writes the new rows aside and
then switches the catalog to them; ``sources.releases`` does so for folders.  Layout options mirror what a column store's
table definition gives: a sort key (Parquet min/max skipping), a partition
column (directory pruning) and a row cap per file (bounded file size).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def overwrite(
    df: DataFrame,
    target: str,
    fmt: str = "parquet",
    sort_by: Sequence[str] | None = None,
    partition_by: Sequence[str] | None = None,
    max_rows_per_file: int | None = None,
    as_table: bool = False,
    partitions: int | None = None,
    observation: Observation | None = None,
    cluster: bool = False,
    options: dict[str, str] | None = None,
) -> None:
    """Replace ``target`` (a path, or a table name with ``as_table``) with ``df``.

    ``sort_by``           sort rows inside each file on these keys (row-group
                          min/max statistics then skip data); no shuffle.
    ``cluster``           also range-partition on ``sort_by`` so files hold
                          disjoint key ranges (file-level skipping).  Costs a
                          shuffle plus a boundary-sampling pass over the input.
    ``partition_by``      one directory per value (pruned at read time).
    ``max_rows_per_file`` cap rows per output file (bounded write batches).
    ``partitions``        number of range partitions for ``sort_by``.
    ``observation``       collects the written row count during the write.  It
                          is attached above the range exchange, so the
                          boundary-sampling pass does not count rows twice.

    Spark cannot overwrite a path it is reading in the same plan: write to a
    new path (or table) and swap, never over the input.
    """
    out = df
    if sort_by:
        keys = [F.col(c).asc_nulls_last() for c in sort_by]
        if cluster:
            out = out.repartitionByRange(partitions, *keys) if partitions else out.repartitionByRange(*keys)
        out = out.sortWithinPartitions(*keys)
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    w = out.write.mode("overwrite").format(fmt).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_rows_per_file:
        w = w.option("maxRecordsPerFile", int(max_rows_per_file))
    if as_table:
        w.saveAsTable(target)
    else:
        w.save(target)


# Header, double-quote quoting with doubled quotes, no whitespace trimming.
CSV_WRITE_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str) -> None:
    """Rewrite a (filtered) film file as CSV with a header, to a *new* path.

    Values are written verbatim: the writer's default whitespace trimming is
    turned off, so a title such as ' Alpha' survives the round trip.
    """
    overwrite(df, path, fmt="csv", options=CSV_WRITE_OPTIONS)


def write_tsv_gz(df: DataFrame, path: str) -> None:
    """Write a dump in the person/title dump format: gzip tab-separated text
    with a header, ``\\N`` for NULL, no quoting and no whitespace trimming
    (one folder of part files, which the dump reader reads like one file)."""
    (df.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "\\N")
       .option("emptyValue", "").option("quote", "").option("escapeQuotes", False)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .option("compression", "gzip").csv(path))


def write_snapshot(df: DataFrame, target: str, schema, fmt: str = "parquet", as_table: bool = False) -> DataFrame:
    """Lakehouse snapshot: replace a folder, or a catalog table, with ``df`` cast to ``schema``.

    Drop-create-append collapses into one overwrite; ``fmt`` is any table
    format that the cluster's session offers.
    """
    from reelhouse.operators.clean import enforce

    if as_table:
        return replace_table(df.sparkSession, enforce(df, schema), target, fmt)
    overwrite(enforce(df, schema), target, fmt)
    return df.sparkSession.read.format(fmt).schema(schema).load(target)


def comment_table(spark: SparkSession, name: str, comment: str) -> None:
    """Store a table description in the catalog (``COMMENT ON TABLE``)."""
    spark.sql(f"COMMENT ON TABLE {name} IS '{_quoted(comment)}'")


def create_namespace(spark: SparkSession, name: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (idempotent)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def replace_table(spark: SparkSession, df: DataFrame, name: str, fmt: str = "parquet", comment: str | None = None,
                  **layout) -> DataFrame:
    """Replace a catalog table by ``df`` (which may read it) and return it.

    The rows go to a new folder under the namespace's location first.  If the
    table has the same columns already, one catalog change then points it to that
    folder: a job that dies before leaves the old table readable.  If columns
    differ, the table is dropped and created over the finished folder (a job that
    dies in between leaves no table, a rerun creates it).  The folder before the
    current one stays for queries that still read it, older ones go.  Column
    descriptions (``quality.describe``) and ``comment`` are kept in the catalog.
    """
    db = name.split(".")[0] if "." in name else spark.catalog.currentDatabase()
    table = name.split(".")[-1]
    create_namespace(spark, db)
    root = f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/{table}-versions"
    folder = f"{root}/{uuid.uuid4().hex}"
    overwrite(df, folder, fmt=fmt, **layout)
    full = f"`{db}`.`{table}`"
    exists = spark.catalog.tableExists(f"{db}.{table}")
    if exists and not layout.get("partition_by") and _described(spark.table(full).schema) == _described(df.schema):
        before = _location(spark, full)
        spark.sql(f"ALTER TABLE {full} SET LOCATION '{folder}'")
    else:
        before = _location(spark, full) if exists else None
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        columns = ", ".join(f"`{n}` {t}" + (f" COMMENT '{_quoted(c)}'" if c else "") for n, t, c in _described(df.schema))
        parts = ", ".join(f"`{c}`" for c in layout.get("partition_by") or ())
        spark.sql(f"CREATE TABLE {full} ({columns}) USING {fmt} " + (f"PARTITIONED BY ({parts}) " if parts else "") + f"LOCATION '{folder}'")
        if parts:
            spark.catalog.recoverPartitions(f"{db}.{table}")
    if comment is not None:
        comment_table(spark, full, comment)
    spark.catalog.refreshTable(f"{db}.{table}")
    _drop_folders(spark, root, {folder.rsplit("/", 1)[-1], (before or "").rstrip("/").rsplit("/", 1)[-1]})
    return spark.table(name)


def _described(schema) -> list[tuple]:
    return [(f.name, f.dataType.simpleString(), (f.metadata or {}).get("comment")) for f in schema.fields]


def _location(spark: SparkSession, name: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def _drop_folders(spark: SparkSession, root: str, keep: set[str]) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for entry in fs.listStatus(path):
        if entry.getPath().getName() not in keep:
            fs.delete(entry.getPath(), True)


def create_view(spark: SparkSession, name: str, query: str, comment: str | None = None) -> DataFrame:
    """Durable view: its SQL text is stored in the catalog, any later session reads it by name."""
    if "." in name:
        create_namespace(spark, name.split(".")[0].strip("`"))
    note = f" COMMENT '{_quoted(comment)}'" if comment else ""
    spark.sql(f"CREATE OR REPLACE VIEW {name}{note} AS {query}")
    return spark.table(name)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Register a lazy view of this session (no data written); the frame is returned unchanged."""
    df.createOrReplaceTempView(name)
    return df


def write_run(df: DataFrame, root: str, run_date: str, column: str = "run_date") -> None:
    """Store one run of a raw snapshot under ``root/run_date=...``.

    Dynamic partition overwrite (a per-write option, so concurrent writers
    are unaffected) replaces only that run's folder: earlier runs are kept and
    a rerun of the same day is idempotent.
    """
    (df.withColumn(column, F.lit(run_date).cast("date"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(column).parquet(root))


def list_runs(spark: SparkSession, root: str, column: str = "run_date") -> list[str]:
    """Run dates present under ``root`` (its directories; no data file is listed)."""
    pat = re.compile(rf"{re.escape(column)}=([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(m.group(1) for n in names for m in [pat.fullmatch(n)] if m)


def read_latest(spark: SparkSession, root: str, column: str = "run_date") -> DataFrame:
    """The most recent run, read with partition pruning (only its folder is scanned)."""
    runs = list_runs(spark, root, column)
    if not runs:
        raise FileNotFoundError(f"no runs under {root}")
    folder = f"{root.rstrip('/')}/{column}={runs[-1]}"
    return spark.read.option("basePath", root).parquet(folder).filter(F.col(column) == F.lit(runs[-1]).cast("date"))


def append_new_columns(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Schema evolution: the rows of both, existing columns first, then those only ``new`` has.

    Columns that a side lacks are NULL in its rows.  Types of existing columns
    win (ANSI cast), which is what appending columns to a table means.
    """
    types = {f.name: f.dataType for f in existing.schema.fields}
    typed = new.select([F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in new.columns])
    return existing.unionByName(typed, allowMissingColumns=True)
