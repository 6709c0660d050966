"""Intermediate tables: Parquet in the session's shared checkpoint folder, gone when the application ends."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from reelhouse.session import ensure_checkpoint_dir


def settled(df: DataFrame) -> DataFrame:
    """``df`` written once and read back.

    Like a reliable checkpoint it cuts the lineage and fixes the rows, their order
    and their files on shared storage, whichever executors are lost; as a columnar
    table it takes fewer bytes and can be read by column.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/reelhouse-settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)
