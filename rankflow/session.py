"""Session defaults and shared scratch locations.

Scratch data (round-trip files, lineage cuts) always lives under the folder the
cluster names in ``spark.checkpoint.dir`` so it is visible to every executor and
survives executor loss.  A private folder is created only when that setting is
unset, which is the local-test case.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def session_defaults(shuffle_partitions: int = 8) -> dict[str, str]:
    """Configuration every rankflow session runs with."""
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Catalyst/AQE decides broadcast by measured size; 32 MB is a checked bound.
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }


def get_session(master: str | None = None, app: str = "rankflow",
                shuffle_partitions: int = 8, extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with rankflow defaults.

    With ``master=None`` (a submitted job) defaults are applied only to settings
    that the submitter left unset; ``extra`` always applies.
    """
    from pyspark import SparkConf

    builder = SparkSession.builder.appName(app)
    submitted = SparkConf()  # holds what spark-submit passed
    if master:
        builder = builder.master(master)
    for k, v in session_defaults(shuffle_partitions).items():
        if master or not submitted.contains(k):
            builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the session's Python workers once, for sessions that were started where
    they can't import it (Spark serves the archive to all executors)."""
    sc = spark.sparkContext
    if getattr(sc, "_rankflow_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="run-"), "rankflow.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    z.write(file, os.path.relpath(file, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._rankflow_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    A private folder stands in only for a ``local`` master (tests).  On any
    other master an unset folder is an error: executors do not share a
    machine-local folder.
    """
    global _LOCAL_CHECKPOINT
    sc = spark.sparkContext
    path = sc.getConf().get(CHECKPOINT_KEY, None)
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
        path = _LOCAL_CHECKPOINT = _LOCAL_CHECKPOINT or tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


_LOCAL_CHECKPOINT: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "rankflow-scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (Hadoop) file system; access errors raise."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


#: Scopes that are open: each collects the scratch tables written in it.
_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def scratch_scope() -> Iterator[list[str]]:
    """Collects the paths of the tables that :func:`materialize` writes inside; whoever opens the
    scope may remove them once nothing reads them any more."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield made
    finally:
        _SCOPES.remove(made)


def remove_scratch(spark: SparkSession, paths: Iterable[str]) -> None:
    """Deletes scratch tables (paths that a scope collected)."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it
    back: later passes scan compact columnar files (with pruning and pushdown)
    instead of recomputing the lineage, and executor loss cannot lose it."""
    path = scratch_path(df.sparkSession, name)
    for scope in _SCOPES:
        scope.append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
