"""Tables in (Parquet scans with declared schemas) and tables out (sinks)."""

from quill.sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS
from quill.sources.sinks import TableStore, align_by_name
from quill.sources.tables import Tables

__all__ = ["FOREIGN_KEYS", "PRIMARY_KEYS", "SCHEMAS", "TableStore", "Tables", "align_by_name"]
