"""Table sinks: create-as, append, truncate-and-reload, versioned rewrite.

Parquet files cannot be updated in place and a job may not overwrite the path
it reads from, so every table is a folder of *versions*, and a version is a
folder of *parts*, each written by one job::

    <root>/<table>/v000001/p000001/   (create, reload or update)
    <root>/<table>/v000001/p000002/   (an append to it)
    <root>/<table>/v000002/p000001/   (the next create, reload or update)

A part is visible once its ``_SUCCESS`` exists: readers take the committed
parts of the newest version that has one, so a failed or running job never
exposes partial output and a retry never doubles rows. That replaces the
reference's COMMIT points. One writer at a time: a write claims the table by
creating a marker file exclusively, and a second writer fails. The root is the
shared folder from ``spark.checkpoint.dir`` (see ``session``).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.session import table_root


class RuleViolation(ValueError):
    """Rows to write broke a rule of the table; ``counts`` has rows per rule."""

    def __init__(self, name: str, counts: dict[str, int]):
        super().__init__(f"{name!r} not written: " + ", ".join(f"{r}: {n} rows" for r, n in counts.items()))
        self.counts = counts


class TableBusy(RuntimeError):
    """Another write to the table is running (or died: see ``release``)."""


class TableStore:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or table_root(spark)).rstrip("/")
        self.audited: dict[str, int] = {}      # rows per rule that the last audited write broke

    # -- paths, versions and parts --------------------------------------------
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _numbered(self, path: str, letter: str) -> list[int]:
        """Numbers of the folders ``<letter>000000`` in ``path``, ascending."""
        p, fs = self._fs(path)
        if not fs.exists(p):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
        return sorted(int(n[1:]) for n in names if n[:1] == letter and n[1:].isdigit())

    def _version_path(self, name: str, v: int) -> str:
        return f"{self.root}/{name}/v{v:06d}"

    def _part_paths(self, name: str, v: int) -> list[str]:
        """Committed parts of a version."""
        out = []
        for n in self._numbered(self._version_path(name, v), "p"):
            path = f"{self._version_path(name, v)}/p{n:06d}"
            p, fs = self._fs(f"{path}/_SUCCESS")
            if fs.exists(p):
                out.append(path)
        return out

    def versions(self, name: str) -> list[int]:
        """Committed versions of ``name``, oldest first."""
        return [v for v in self._numbered(f"{self.root}/{name}", "v") if self._part_paths(name, v)]

    def _latest(self, name: str) -> int | None:
        for v in reversed(self._numbered(f"{self.root}/{name}", "v")):
            if self._part_paths(name, v):
                return v
        return None

    def exists(self, name: str) -> bool:
        return self._latest(name) is not None

    def current_paths(self, name: str) -> list[str]:
        v = self._latest(name)
        if v is None:
            raise FileNotFoundError(f"table {name!r} has no committed version")
        return self._part_paths(name, v)

    def read(self, name: str) -> DataFrame:
        """``SELECT * FROM name`` on the newest committed version."""
        return self._read_parts(self.current_paths(name))

    def _read_parts(self, paths: list[str]) -> DataFrame:
        return self.spark.read.parquet(*paths)

    # -- one writer at a time --------------------------------------------------
    def _claim_path(self, name: str) -> str:
        return f"{self.root}/{name}/_writer"

    @contextmanager
    def _writer(self, name: str):
        p, fs = self._fs(self._claim_path(name))
        fs.mkdirs(p.getParent())
        if not fs.createNewFile(p):
            raise TableBusy(f"another write to {name!r} holds {self._claim_path(name)}; "
                            "if its job is dead, call release()")
        try:
            yield
        finally:
            fs.delete(p, False)

    def release(self, name: str) -> None:
        """Drop the claim of a writer that died."""
        p, fs = self._fs(self._claim_path(name))
        fs.delete(p, False)

    # -- writes -------------------------------------------------------------
    def _write_part(self, df: DataFrame, path: str, partition_by=None, sort_within=None,
                    rules: dict[str, Column] | None = None, enforce: bool = True) -> None:
        """One job. With ``rules`` (name -> what must not be FALSE, as in a SQL CHECK)
        the rows that break each are counted by that job itself; a part that
        breaks one is deleted instead of committed, unless ``enforce`` is off."""
        seen = None
        if rules:
            seen = Observation()
            df = df.observe(seen, F.count(F.lit(1)).alias("rows"),
                            *[F.count_if(~F.coalesce(ok, F.lit(True))).alias(r) for r, ok in rules.items()])
        if sort_within:
            # partition columns first: the partitioned writer needs that order
            df = df.sortWithinPartitions(*(list(partition_by or []) + list(sort_within)))
        w = df.write.mode("errorifexists")
        if rules:
            # the commit marker comes after the rules have been looked at
            w = w.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        if seen is not None:
            self.audited = {r: n for r, n in seen.get.items() if r != "rows"}
            broken = {r: n for r, n in self.audited.items() if n}
            if broken and enforce:
                p, fs = self._fs(path)
                fs.delete(p, True)
                raise RuleViolation(path[len(self.root) + 1:].split("/")[0], broken)
            p, fs = self._fs(f"{path}/_SUCCESS")
            fs.create(p).close()

    def _write_new_version(self, df: DataFrame, name: str, **layout) -> DataFrame:
        # after every folder, committed or not: a failed job's leftovers are
        # never reused and never read
        dirs = self._numbered(f"{self.root}/{name}", "v")
        path = self._version_path(name, (dirs[-1] + 1) if dirs else 1) + "/p000001"
        self._write_part(df, path, **layout)
        return self._read_parts([path])

    def create_as(self, df: DataFrame, name: str, replace: bool = True, **layout) -> DataFrame:
        """``CREATE TABLE name AS SELECT``; ``replace`` = drop first if present."""
        with self._writer(name):
            if not replace and self.exists(name):
                raise FileExistsError(f"table {name!r} exists")
            return self._write_new_version(df, name, **layout)

    def create_empty(self, name: str, schema: T.StructType) -> DataFrame:
        """``CREATE TABLE name (...)`` with no rows."""
        return self.create_as(self.spark.createDataFrame([], schema), name)

    def reload(self, df: DataFrame, name: str, schema: T.StructType | None = None, **layout
               ) -> DataFrame:
        """``TRUNCATE`` then ``INSERT … SELECT``: a new version with only ``df``,
        columns aligned by name to the declared ``schema`` (the table's DDL)
        or, without one, to the existing table."""
        with self._writer(name):
            if schema is not None:
                df = align_by_name(df, schema)
            elif self.exists(name):
                df = align_by_name(df, self.read(name).schema)
            return self._write_new_version(df, name, **layout)

    def append(self, df: DataFrame, name: str, **audit) -> DataFrame:
        """``INSERT INTO name SELECT …``: one more part of the current version,
        visible as a whole once it is committed.

        Columns are matched by name (never by position) and cast to the
        table's types, so a reordered select cannot swap two columns."""
        with self._writer(name):
            return self._append(df, name, **audit)

    def _append(self, df: DataFrame, name: str, **audit) -> DataFrame:
        current = self.read(name)
        v = self._version_path(name, self._latest(name))
        df = align_by_name(df, current.schema)
        self._write_part(df, f"{v}/p{self._numbered(v, 'p')[-1] + 1:06d}", **audit)
        return self.read(name)

    def append_keyed(self, df: DataFrame, name: str, key: str, order: list[str],
                     start: int = 1, step: int = 1) -> DataFrame:
        """``INSERT INTO name SELECT seq.NEXTVAL, …``: dense keys in ``order``,
        continuing after the largest key already in the table (a sequence
        keeps its position between inserts); ``start`` when it is empty. The
        claim covers the drawing of keys, so two inserts cannot draw the same."""
        from quill.operators.keys import assign_keys
        with self._writer(name):
            current = self.read(name)
            top = current.agg(F.max(key)).first()[0]
            first = start if top is None else top + step
            keyed = assign_keys(df, order, key=key, start=first, step=step)
            return self._append(keyed.drop(*[c for c in order if c not in current.columns]), name)

    def append_sparse(self, df: DataFrame, name: str, key: str, start: int = 1, step: int = 1,
                      **block) -> DataFrame:
        """``INSERT INTO name SELECT seq.NEXTVAL, …`` with keys that are only unique and
        above all earlier ones (a sequence with a cache leaves gaps too): drawn
        in blocks by the tasks that write, one pass, no shuffle. The greatest key
        is measured by the write itself and kept as the table's high-water mark,
        so that neither this insert nor the next one reads the table."""
        from quill.operators.keys import block_keys
        with self._writer(name):
            top = self.high_water(name, key)
            keyed = block_keys(df, key, start if top is None else top + step, step, **block)
            seen = Observation()
            out = self._append(keyed.observe(seen, F.max(key).alias("top")), name)
            if seen.get["top"] is not None:
                p, fs = self._fs(f"{self.root}/{name}/_top_{key}/{seen.get['top']}")
                fs.create(p).close()
            return out

    def high_water(self, name: str, key: str) -> int | None:
        """The greatest key that :meth:`append_sparse` has given out."""
        p, fs = self._fs(f"{self.root}/{name}/_top_{key}")
        marks = [int(st.getPath().getName()) for st in fs.listStatus(p)] if fs.exists(p) else []
        return max(marks, default=None)

    def replace_with(self, df_fn, name: str) -> DataFrame:
        """Rewrite a table from its own current content (``UPDATE``): the new
        content is computed from version N and committed as N+1."""
        with self._writer(name):
            return self._write_new_version(df_fn(self.read(name)), name)

    def vacuum(self, name: str, keep: int = 2) -> list[int]:
        """Retention: delete committed versions older than the newest ``keep``,
        and uncommitted leftovers older than the newest committed version.
        A folder newer than the newest commit may be a running write and is
        never touched. Readers of a removed version must have finished."""
        committed = self.versions(name)
        if not committed:
            return []
        kept, newest = set(committed[-max(keep, 1):]), committed[-1]
        removed = [v for v in self._numbered(f"{self.root}/{name}", "v") if v not in kept and v <= newest]
        for v in removed:
            p, fs = self._fs(self._version_path(name, v))
            fs.delete(p, True)
        return removed


def align_by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for insert: {missing}")
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    if extra:
        raise ValueError(f"columns not in target table: {extra}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
