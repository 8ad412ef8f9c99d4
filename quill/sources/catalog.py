"""Definitions that outlive a session: tables, views and SQL table functions of a
catalog database.

A temp view ends with its session and has the run date of its definition in
it. Here the input tables are catalog tables over their files, views are
catalog views, and a view that depends on the run date is a SQL table function
with the date as its argument: any session of the catalog reads it, each with
a date of its own. Readers get the plan inlined, so filters reach the scan.
"""

from __future__ import annotations

import datetime as dt
import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quill.sources.tables import Tables


def _name(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        raise ValueError(f"not a plain name: {name!r}")
    return name


class Database:
    """A database of the session's catalog (``spark.sql.catalogImplementation``
    decides whether it lasts for the application or in a metastore)."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, _name(name)

    @classmethod
    def over(cls, spark: SparkSession, root: str) -> Database:
        """The database of one input folder: its name follows from the path."""
        return cls(spark, f"quill_{zlib.crc32(root.rstrip('/').encode()):08x}")

    def define_tables(self, tables: Tables, names: list[str]) -> None:
        """``CREATE TABLE`` over the files of ``tables``; a defined one stays."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.name}")
        for n in names:
            path = tables.path(_name(n)).replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name}.{n} USING parquet LOCATION '{path}'")

    def define_view(self, name: str, query: str) -> None:
        """``CREATE OR REPLACE VIEW``; unqualified names are those of this database."""
        self._here(lambda: self.spark.sql(f"CREATE OR REPLACE VIEW {_name(name)} AS {query}"))

    def define_function(self, name: str, arguments: dict[str, str], columns: str, query: str) -> None:
        """``CREATE OR REPLACE FUNCTION name(arguments) RETURNS TABLE (columns) RETURN query``."""
        args = ", ".join(f"{_name(a)} {kind}" for a, kind in arguments.items())
        self._here(lambda: self.spark.sql(f"CREATE OR REPLACE FUNCTION {_name(name)}({args}) RETURNS TABLE ({columns}) "
                                          f"RETURN {query}"))

    def view(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.name}.{_name(name)}")

    def call(self, name: str, *arguments: dt.date | int | str) -> DataFrame:
        """``SELECT * FROM name(arguments)``, the arguments bound as parameters."""
        marks = ", ".join("?" * len(arguments))
        return self._here(lambda: self.spark.sql(f"SELECT * FROM {_name(name)}({marks})",
                                                 args=[F.lit(a) for a in arguments]))

    def _here(self, run):
        """A table function has no qualified name, and a definition keeps the
        database it was made in."""
        old = self.spark.catalog.currentDatabase()
        self.spark.catalog.setCurrentDatabase(self.name)
        try:
            return run()
        finally:
            self.spark.catalog.setCurrentDatabase(old)
