"""Session helpers: the shared table folder and a local session for tests and bench."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

TABLE_SUBDIR = "quill_tables"
#: for local sessions without spark.checkpoint.dir; one folder, not one per call
LOCAL_CHECKPOINT_DIR = os.path.join(tempfile.gettempdir(), "quill-local")


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, as named by ``spark.checkpoint.dir``.

    Read from the session, and the same on every call. Only a local session
    (one machine, one process) may leave the setting out: it then uses
    ``LOCAL_CHECKPOINT_DIR``. Anywhere else that is a configuration error,
    because a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        d = LOCAL_CHECKPOINT_DIR
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def table_root(spark: SparkSession) -> str:
    """Where the reports' derived tables (create-as, append, reload, versions) are
    written: one folder per application, so that two applications never claim
    the same table. Tables that outlive an application get an explicit root."""
    return f"{shared_dir(spark)}/{TABLE_SUBDIR}/{spark.sparkContext.applicationId}"


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "quill", event_log_dir: str | None = None) -> SparkSession:
    """Local session used by tests and bench.py; clusters bring their own.
    ``event_log_dir`` writes Spark's event log there (stage and task times
    without the UI; see tools/stages.py)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # no per-call Python call-site capture (several JVM round trips per
        # Column function while a plan is built); a documented PySpark switch
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir)
                   .config("spark.eventLog.compress", "false"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark
