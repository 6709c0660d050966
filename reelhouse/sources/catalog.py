"""Named tables by layer: ``source("bronze", t)`` and ``ref(model)``.

A catalog is a root folder with one Parquet folder per table
(``<root>/<layer>/<table>``).  Models take DataFrames as arguments, so the
dependency graph between models is plain function composition; the catalog
only resolves names to scans (with column pruning and filter pushdown).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelhouse import schemas


class Catalog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def source(self, layer: str, table: str) -> DataFrame:
        """Scan of a loaded table; bronze tables are read with their declared schema."""
        reader = self.spark.read
        declared = schemas.BRONZE.get(table) if layer == "bronze" else None
        if declared is not None:
            reader = reader.schema(declared)
        return reader.parquet(self.path(layer, table))

    def ref(self, model: str, layer: str = "gold") -> DataFrame:
        """Scan of a built model."""
        return self.spark.read.parquet(self.path(layer, model))

    def tables(self, layer: str, names) -> dict[str, DataFrame]:
        return {n: (self.source(layer, n) if layer == "bronze" else self.ref(n, layer)) for n in names}
