"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import string
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from reelhouse.session import configure, ensure_checkpoint_dir

# Rows of an Arrow batch sent to a Python worker: whole documents may be long.
BATCH_ROWS = "1000"


def ship_code(spark: SparkSession) -> None:
    """Give the Python workers this package, once for each application (as ``--py-files`` would)."""
    sc = spark.sparkContext
    if getattr(sc, "_reelhouse_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="reelhouse-code-")), "reelhouse_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(target)  # read by the driver, served to the executors
    sc._reelhouse_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    """What the operators rely on: code on the workers, a checkpoint folder, small Arrow batches."""
    configure(spark)
    ensure_checkpoint_dir(spark)
    ship_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def id_bucket(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m`` (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(m))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def trim() -> None:
    """Give freed memory back to the system: Python workers outlive their tasks."""
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage: a Parquet table in the session's shared folder, read back.

    A table takes a fraction of a checkpoint's bytes, and its plan carries no
    constraints on, which grow with every round of an iterative job.  It goes
    when the application ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def drop_tables(*frames: DataFrame) -> None:
    """Delete the tables of ``cut`` frames that nothing reads any more (what came of them is cut itself)."""
    for df in frames:
        at = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._cut_path)
        at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def add_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], list], fields: list[T.StructField],
                drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` without ``drop`` and with the ``fields`` that ``fn`` derives from each Arrow batch."""
    keep = [f for f in df.schema.fields if f.name not in drop]
    names = [f.name for f in keep] + [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            old = [b.column(b.schema.get_field_index(f.name)) for f in keep]
            yield pa.RecordBatch.from_arrays(old + fn(b), names=names)

    return df.mapInArrow(run, T.StructType(keep + fields))
