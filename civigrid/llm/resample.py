"""Importance resampling towards a target corpus by hashed n-grams, over bucket-partitioned inverted postings.

Each document's features are its runs of words, hashed to buckets. Chunks of documents give, for each bucket, one row with
the documents that have it and their counts: the postings, which are shuffled to their bucket. There the two corpora meet,
the bucket's gain (the log ratio of its share in the target and in the documents) is computed, and each posting's
contribution is sent back to its chunk, where contributions are added up by document. Frequent buckets are dealt over
salts by chunk, and their counts are added up by partial sums first, so no bucket is one task's work.

A document's weight is the floored mean of its features' gains. Seeded Gumbel noise is added, and the highest scores are
drawn without replacement: a sample by importance.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civigrid.llm.common import portions, small_batches, written
from civigrid.llm.ranks import numbered

#: Buckets of features, least words of a document that may be drawn, documents of a hundred that are drawn, and the noise's seed.
BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 10, 2024
#: Postings and documents of a chunk; the last document of a chunk adds at most as many postings as there are buckets.
CHUNK_POSTINGS, CHUNK_DOCS = 1 << 18, 30_000
#: Chunks whose rows of a bucket meet under one salt; a bucket has one row of each chunk at most.
SALT_CHUNKS = 2048
#: A gain of 1000 is one natural logarithm.
SCALE = 1000
#: Runs of ASCII letters, digits and everything beyond ASCII, in lower-cased UTF-8.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def features(raw: bytes, low: int, high: int, buckets: int) -> tuple[int, np.ndarray]:
    """A text's number of words, and the buckets of all its runs of ``low`` to ``high`` words."""
    words = WORD.findall(raw.lower())  # of bytes: A-Z only
    found = []
    for n in range(low, high + 1):
        runs = words if n == 1 else map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False))
        found.append(np.fromiter(map(zlib.crc32, runs), np.uint32, max(0, len(words) - n + 1)))
    return len(words), (np.concatenate(found) % buckets).astype(np.int32)


class Chunk:
    """Documents whose postings go together."""

    def __init__(self):
        self.ids, self.words, self.features, self.keys, self.counts, self.postings = [], [], [], [], [], 0

    def add(self, key, words: int, buckets: np.ndarray) -> None:
        own, counts = np.unique(buckets, return_counts=True)
        self.keys.append(own.astype(np.int64) << 16 | len(self.ids))
        self.counts.append(counts)
        self.ids.append(key)
        self.words.append(words)
        self.features.append(len(buckets))
        self.postings += len(own)

    def full(self) -> bool:
        return self.postings >= CHUNK_POSTINGS or len(self.ids) >= CHUNK_DOCS

    def rows(self, name: int, ids: pa.DataType) -> pa.RecordBatch:
        """One row for each bucket with its documents (their number in the chunk) and counts; before them one, of bucket -1, with the documents."""
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts).astype(np.int64)
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.diff(keys >> 16, prepend=-1)) if len(keys) else np.zeros(0, np.int64)
        n, offsets = len(first) + 1, np.concatenate(([0, 0], first[1:], [len(keys)])) if len(first) else np.zeros(2)
        offsets = pa.array(offsets, pa.int32())
        whole = pa.array([0, *[len(self.ids)] * n], pa.int32())
        columns = {
            "chunk": pa.array(np.full(n, name, np.int64)),
            "bucket": pa.array(np.concatenate(([-1], keys[first] >> 16)), pa.int32()),
            "total": pa.array(np.concatenate(([0], np.add.reduceat(counts, first) if len(first) else [])), pa.int64()),
            "at": pa.ListArray.from_arrays(offsets, pa.array(keys & 0xFFFF, pa.int16())),
            "n": pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
            "ids": pa.ListArray.from_arrays(whole, pa.array(self.ids, ids)),
            "words": pa.ListArray.from_arrays(whole, pa.array(self.words, pa.int64())),
            "features": pa.ListArray.from_arrays(whole, pa.array(self.features, pa.int64())),
        }
        return pa.RecordBatch.from_pydict(columns)


def postings(texts: DataFrame, low: int, high: int, buckets: int) -> DataFrame:
    """Postings of (key, text) in chunks: chunk, bucket, total, at, n; and the chunks' documents, in the rows of bucket -1.

    Chunks are cut inside the scan's partitions, so texts are never shuffled.
    """
    small_batches(texts.sparkSession)
    source = texts.select("key", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("raw"))
    kind = source.schema["key"].dataType.simpleString()

    def inverted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, chunk, ids = TaskContext.get().partitionId() << 32, Chunk(), None
        for b in portions(batches):
            ids = b.schema.field(0).type
            for key, raw in zip(b.column(0), b.column(1), strict=True):
                chunk.add(key.as_py(), *features(raw.as_py(), low, high, buckets))
                if chunk.full():
                    yield chunk.rows(name, ids)
                    name, chunk = name + 1, Chunk()
        if chunk.ids:
            yield chunk.rows(name, ids)

    return source.mapInArrow(inverted, f"chunk long, bucket int, total long, at array<short>, n array<int>, ids array<{kind}>, words array<long>, features array<long>")


def gains(docs: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gain) for each bucket that either corpus has, from their postings' counts, added up by bucket side by side."""
    both = docs.select("bucket", F.col("total").alias("s"), F.lit(0).cast("long").alias("t")).union(target.select("bucket", F.lit(0).cast("long"), "total"))
    totals = both.where("bucket >= 0").groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    all_s, all_t = (float(x or 0) for x in both.agg(F.sum("s"), F.sum("t")).first())
    s, t = F.col("s").cast("double") + 1, F.col("t").cast("double") + 1
    gain = F.floor(F.lit(float(SCALE)) * F.log(t * F.lit(all_s + buckets) / (s * F.lit(all_t + buckets))))
    return totals.select("bucket", gain.alias("gain"))


def weighed(docs: DataFrame, target: DataFrame, *, low: int = 1, high: int = 1, buckets: int = BUCKETS, key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_features, weight) of each document; ``docs`` has ``key`` and text, ``target`` has text."""
    own = written(postings(docs.select(F.col(key).alias("key"), "text"), low, high, buckets), "postings")
    aim = written(postings(target.select(F.lit(0).alias("key"), "text"), low, high, buckets).select("bucket", "total"), "target-postings")
    gain = written(gains(own, aim, buckets), "gains")
    lists = own.where("bucket >= 0").select("chunk", "bucket", "at", "n")
    heads = own.where("bucket < 0").select("chunk", F.lit(None).cast("long").alias("gain"), F.lit(None).cast("array<short>").alias("at"), F.lit(None).cast("array<int>").alias("n"), "ids", "words", "features")
    salts = -(-heads.count() // SALT_CHUNKS) or 1
    salted = gain.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = lists.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(salts)).cast("int")).join(salted.hint("merge"), ["bucket", "salt"])
    lone = {c: F.lit(None).cast(heads.schema[c].dataType).alias(c) for c in ("ids", "words", "features")}
    parts = met.select("chunk", "gain", "at", "n", *lone.values()).union(heads)
    kind = docs.schema[key].dataType.simpleString()

    def reduced(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        head = rows.filter(rows.column("gain").is_null())
        lists = rows.filter(rows.column("gain").is_valid())
        ids, words, n = (head.column(c).chunk(0).flatten() for c in ("ids", "words", "features"))
        n, weight = n.to_numpy(zero_copy_only=False), np.zeros(len(ids), np.int64)
        for b in lists.to_batches():
            at, counts = (b.column(c) for c in ("at", "n"))
            each = np.repeat(b.column("gain").to_numpy(zero_copy_only=False), np.diff(at.offsets.to_numpy()))
            np.add.at(weight, at.flatten().to_numpy(), each * counts.flatten().to_numpy().astype(np.int64))
        return pa.table({key: ids, "n_words": words, "n_features": pa.array(n), "weight": pa.array(weight // np.maximum(n, 1))})

    return parts.groupBy("chunk").applyInArrow(reduced, f"`{key}` {kind}, n_words long, n_features long, weight long")


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise of a row, in thousandths, from a seeded hash of its key."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + 0.5) / F.lit(float(1 << 32)))))


def resampled(docs: DataFrame, target: DataFrame, *, low: int = 1, high: int = 1, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED, key: str = "doc_id") -> DataFrame:
    """For each document its key, n_words, n_features, weight, score, and rank among the drawn (from 1; null if not drawn).

    Of the documents with at least ``least_words`` words, ``percent`` of a hundred are drawn, the highest scores first and the
    smaller key (null first) among equals. A null text has no words and no features, which weigh 0; a null key has the noise of an empty one. Repeated
    rows are rows of their own, with equal scores. Empty tables are corpora without features; other columns are ignored.
    """
    weights = weighed(docs, target, low=low, high=high, buckets=buckets, key=key)
    scored = written(weights.withColumn("score", F.col("weight") + noise(F.col(key), seed)), "scores")
    may = F.col("n_words") >= least_words
    drawn = percent * scored.where(may).count() // 100
    placed = numbered(scored, ~may, F.desc("score"), F.asc_nulls_first(key), name="_place")
    return placed.select(*scored.columns, F.when(may & (F.col("_place") < drawn), F.col("_place") + 1).alias("rank"))


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents with all their columns; all rows of a drawn key, no row without a key."""
    key = options.get("key", "doc_id")
    chosen = resampled(docs, target, **options).where("rank IS NOT NULL").select(key).distinct()
    return docs.join(chosen, key, "left_semi")
