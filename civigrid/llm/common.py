"""Helpers shared by the operators: tables written to the shared folder, and row batches for Arrow functions."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_fallback: dict[str, str] = {}
_cleaned: set[str] = set()
_kept: dict[str, Callable[[], None]] = {}
_turn: str | None = None

#: Rows whose number is at most this may be broadcast; beyond it, operators join by shuffle.
BROADCAST_ROWS = 500_000
#: Rows and bytes of a batch that goes to Python.
BATCH_ROWS, BATCH_BYTES = 512, 16 << 20
#: A key of more rows than this, and than a HOT_KEYS-th of all rows, is dealt over at most MOST_SALTS tasks.
HOT_ROWS, HOT_KEYS, MOST_SALTS = 256, 100_000, 4096


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Only where a session in local mode has no such setting is a local folder made; on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="civigrid-")
    return _fallback[app]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: the lineage ends there, and a lost executor costs no work.

    The folder carries the application's id and goes when the driver's process ends; a scheduler can remove what a
    killed driver leaves.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    plain = df.select(*(F.col(f"`{c}`").cast("string").alias(c) if kind == "void" else F.col(f"`{c}`") for c, kind in df.dtypes))
    plain.write.parquet(path)
    if path.rsplit("/", 1)[0] not in _cleaned:
        _cleaned.add(path.rsplit("/", 1)[0])
        atexit.register(_remove, spark, path.rsplit("/", 1)[0])
    return spark.read.schema(plain.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes a table that ``written`` made and that nothing will read again, so that its disk is free for what follows."""
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _remove(df.sparkSession, file)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (cheap to count, such as a written table) marked for broadcast if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.count() <= rows else df


def by_key(rows: DataFrame, single: DataFrame, key: str, *, how: str = "inner", spread_by: str) -> DataFrame:
    """``rows`` joined with ``single`` (a cheap table with one row for each key; no other column in common).

    If ``single`` is small it is broadcast and nothing is shuffled. Else the join is by shuffle, and the rows of a key
    that many have are dealt over salts by a hash of ``spread_by``, so no key is one task's work. A null key meets nothing.
    """
    n = single.count()
    if n <= BROADCAST_ROWS and narrow(single):
        return rows.join(F.broadcast(single), key, how)
    return spread(rows, single, key, how=how, by=spread_by)


def narrow(df: DataFrame) -> bool:
    """Whether arrays, if there are any, hold so few elements in all that ``BROADCAST_ROWS`` rows stay within some tens of MB."""
    wide = [F.greatest(F.size(f.name), F.lit(0)).cast("long") for f in df.schema if f.dataType.typeName() == "array"]
    return not wide or (df.agg(F.sum(sum(wide[1:], wide[0]))).first()[0] or 0) <= 4 * BROADCAST_ROWS


def spread(rows: DataFrame, single: DataFrame, key: str, *, how: str = "inner", by: str, total: int | None = None, sizes: DataFrame | None = None, hint: str | None = None) -> DataFrame:
    """``rows`` joined with ``single`` (one row for each key) by shuffle, frequent keys over several tasks.

    Keys of more than ``total / HOT_KEYS`` rows (at least HOT_ROWS) are counted first; there are at most HOT_KEYS of them,
    and only these keys with their numbers of salts are broadcast. Rows of such a key are dealt over its salts by a hash
    of ``by``, and its one row in ``single`` stands there once for each salt. Null keys are set aside by their hash too.
    ``sizes`` (the key and n, its number of rows) spares the counting where that is known. Spark broadcasts a side that it
    takes to be tiny all the same; ``hint`` ("merge") has it shuffle at every size, so that disk is measured as it grows.
    """
    total = rows.count() if total is None else total
    limit = max(HOT_ROWS, total // HOT_KEYS)
    if sizes is None:
        sizes = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    hot = F.broadcast(sizes.withColumnRenamed(key, "_hot").where(F.col("n") > limit).select("_hot", F.least(F.lit(MOST_SALTS), F.ceil(F.col("n") / limit)).cast("int").alias("_salts")))
    salts = F.when(F.col(key).isNull(), F.lit(MOST_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    left = rows.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.pmod(F.xxhash64(F.col(by)), salts).cast("int")).drop("_hot", "_salts")
    right = single.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_hot", "_salts")
    return left.join(right.hint(hint) if hint else right, [key, "_salt"], how).drop("_salt")


def _remove(spark: SparkSession, folder: str) -> None:
    """Deletes an application's intermediate tables when its driver ends."""
    with contextlib.suppress(Exception):  # the JVM may have gone first
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def digest(*cols: Column) -> Column:
    """A 128-bit key of the given columns (nulls differ from empty strings), as 16 bytes."""
    marked = [F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.length(c).cast("string"), F.lit(":"), c)) for c in cols]
    return F.unhex(F.md5(F.concat(*marked)))


def small_batches(spark: SparkSession) -> None:
    """Has rows go to Python in batches of at most ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes, in this session, unless it says otherwise.

    With Spark's 10,000 rows, a batch of texts takes some hundred MB of an executor's memory outside the heap, several times over.
    """
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, str(value))


def turn(operator: str) -> None:
    """Called by an operator's task in a worker: what other operators keep in this worker goes, so that only one's cache is there at a time."""
    global _turn
    if _turn not in (None, operator):
        for name, clear in _kept.items():
            if name != operator:
                clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only glibc has it
            ctypes.CDLL(None).malloc_trim(0)
    _turn = operator


def kept_by(operator: str, clear: Callable[[], None]) -> None:
    """Says how to drop what an operator keeps between its tasks."""
    _kept[operator] = clear


def portions(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, so that a worker has few texts as Python objects at a time.

    Spark bounds a batch by rows and by bytes (``spark.sql.execution.arrow.max*PerBatch``).
    """
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
        pa.default_memory_pool().release_unused()
