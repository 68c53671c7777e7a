"""Intermediate tables that are used several times, and folders for files."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows that a task of a costly projection gets, and the most tasks that rows are dealt over.
ROWS_OF_A_TASK, MOST_TASKS = 4_000, 4_000

_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``; only a local session without it gets one of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    app, master = spark.sparkContext.applicationId, spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if app not in _folders:
        _folders[app] = tempfile.mkdtemp(prefix="civigrid-")
    return _folders[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has; what is written there goes when the driver's process ends."""
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may have gone first
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` (cheap to count, such as a table's columns) dealt over tasks by its number of rows, by ``keys`` if there are any.

    Narrow tables are read in few tasks however many rows they have; what costs much for each row would then be those
    tasks' work. A task gets about ``ROWS_OF_A_TASK`` rows; from ``MOST_TASKS`` on they get more.
    """
    n = min(MOST_TASKS, max(1, -(-df.count() // ROWS_OF_A_TASK)))
    return df.repartition(n, *keys)


def staged(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept by ``checkpoint()`` in the folder that the session names.

    What follows reads columns, not the expressions behind them: a filter on a classification would otherwise be pushed
    below it with all its patterns inlined. A lost executor costs nothing that is already there.
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()
