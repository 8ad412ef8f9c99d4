"""What every report builder receives: the session, the input tables, the
run date, and the table store for reports that write."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from quill.functions.dates import AS_OF
from quill.sources.sinks import TableStore
from quill.sources.tables import Tables


@dataclass
class Ctx:
    spark: SparkSession
    root: str
    as_of: dt.date = AS_OF
    store_root: str | None = None
    _store: TableStore | None = field(default=None, repr=False)

    def __post_init__(self):
        self.t = Tables(self.spark, self.root)

    @property
    def store(self) -> TableStore:
        if self._store is None:
            self._store = TableStore(self.spark, self.store_root)
        return self._store
