"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings every job here relies on.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # Call sites of every expression cost a round trip to the JVM each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Without it shuffle files stay until the driver's collector finds that nothing refers to them.
SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_dirs: dict[str, str] = {}
_sweeping = {"blocks": 0, "before": None}
_lock = threading.Lock()


def build_session(app: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    # Jobs run side by side share the executors evenly, by pool.
    builder = builder.config("spark.scheduler.mode", "FAIR")
    if master:
        builder = builder.master(master)
    for name, value in {**SQL_SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a temporary folder, since a machine-local
    path is invisible to the executors of a cluster.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="run-")
    return _local_dirs[context.applicationId]


@contextmanager
def swept(spark: SparkSession):
    """Shuffle files of a query that runs within the block go when the query ends.

    The setting is the session's, so blocks of several threads share it: the last one to end
    puts back what was set before the first.
    """
    with _lock:
        if not _sweeping["blocks"]:
            _sweeping["before"] = spark.conf.get(SWEEP, None)
            spark.conf.set(SWEEP, "true")
        _sweeping["blocks"] += 1
    try:
        yield
    finally:
        with _lock:
            _sweeping["blocks"] -= 1
            if not _sweeping["blocks"]:
                before = _sweeping["before"]
                spark.conf.unset(SWEEP) if before is None else spark.conf.set(SWEEP, before)


def checkpointed(df):
    """Cut the lineage of ``df`` through the shared folder (never on executor disks)."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df):
    """``df`` as a table in the shared folder: lineage is cut, and its plan runs once (a checkpoint's runs twice)."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    with swept(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
