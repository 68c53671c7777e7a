"""Sharding by proportional stratified interleaving, on DataFrame operations only.

Each source's rows are shuffled by a seeded hash and ranked; a row's fractional rank is its rank, plus a phase of its
source, over the source's number of rows. Sorted by it, all sources run through the table side by side, each at its own
rate, so that any stretch holds the corpus' mixture; the order is cut into shards whose counts are at most one apart.
The phase, from 0 to 1 by a seeded hash, spreads sources of a few rows over all shards.

Rows of equal text are rows like all others: the shuffle deals them as it deals the rest of their source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civigrid.llm.common import by_key, written
from civigrid.llm.ranks import numbered

#: Hexadecimal digits of a row's hash by which its source is shuffled, and of a source's phase.
ROW_DIGITS, PHASE_DIGITS = 15, 8


def hashed(text: Column, digits: int) -> Column:
    """The first digits of a text's MD5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def assigned(docs: DataFrame, shards: int = 8, seed: int = 11, keep: tuple[str, ...] = ()) -> DataFrame:
    """Where each row goes: doc_id, source, size (bytes and 1), text_crc32, the columns ``keep``, shard and slot.

    Works on narrow rows: a text is read once, for its size and checksum. A null text counts as an empty one, a null
    source is a source of its own and a null doc_id is an id of its own. Repeated rows each have their own slot. Rows that
    agree in id, size and checksum are in any order among themselves. An empty table gives an empty one; columns beyond
    doc_id, text, source and ``keep`` are ignored.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    text, key = F.coalesce(F.col("text").cast("binary"), F.lit(b"")), F.coalesce(F.concat(F.lit("v"), F.col("doc_id").cast("string")), F.lit("n"))
    narrow = docs.select("doc_id", F.col("source").cast("string").alias("source"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), key.alias("_key"), *keep)
    stratum = F.coalesce(F.concat(F.lit("v"), F.col("source")), F.lit("n"))
    shuffled = hashed(F.concat_ws(":", F.lit(str(seed)), "_key", F.col("size").cast("string"), F.col("text_crc32").cast("string")), ROW_DIGITS)
    rows = written(narrow.select("*", stratum.alias("_stratum"), shuffled.alias("_hash")), "shard-rows")
    ranked = numbered(rows, "_stratum", "_hash", "_key", "size", "text_crc32", name="_place")
    sources = ranked.groupBy("_stratum").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    phase = hashed(F.concat_ws(":", F.lit(str(seed)), "_stratum"), PHASE_DIGITS) / F.lit(float(16**PHASE_DIGITS))
    fraction = ((F.col("_place") - F.col("_first")) + phase) / F.col("_rows")
    mixed = written(by_key(ranked, sources, "_stratum", spread_by="_hash").withColumn("_fraction", fraction).drop("_place", "_first", "_rows"), "shard-fractions")
    total = mixed.count()
    placed = numbered(mixed, "_fraction", "_stratum", name="_place")
    shard = F.expr(f"_place * {shards} DIV {max(total, 1)}")
    first = F.expr(f"(_shard * {total} + {shards - 1}) DIV {shards}")
    return placed.withColumn("_shard", shard).select("doc_id", "source", "size", "text_crc32", *keep, F.col("_shard").cast("int").alias("shard"), (F.col("_place") - first).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 8, seed: int = 11) -> None:
    """Writes the documents to ``path``/shard=K as Parquet, in the order of their slots; a column of theirs named shard or slot is replaced.

    Texts are shuffled twice: to their place, and by ranges of shard and slot into files, so no task writes a whole shard.
    """
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "shard-documents")
    places = assigned(rows, shards, seed, keep=("_row",)).select("_row", "shard", "slot")
    own = rows.drop("shard", "slot").join(places, "_row").drop("_row")
    own.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
