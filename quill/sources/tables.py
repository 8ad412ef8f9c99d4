"""Base-table scans: one Parquet dataset per table, read with its declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quill.sources.schemas import SCHEMAS


class Tables:
    """Lazy accessor for the input tables under ``root``.

    ``tables.orders`` is a plain ``spark.read.parquet``: nothing is read until
    an action, and Catalyst prunes columns and pushes filters into the scan.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def get(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in SCHEMAS:
            reader = reader.schema(SCHEMAS[name])
        return reader.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.get(name)

    def register(self, names=None) -> None:
        """Expose tables as temp views for ``spark.sql``."""
        for n in names or SCHEMAS:
            self.get(n).createOrReplaceTempView(n)
