"""Near-duplicate documents: shingle sets, many universal-hash minima, banding, signature verification, components.

Texts with the same shingle set are one class from the start. Classes that share a band of their signatures are
compared: first each with the smallest class of its bucket, then, where a bucket still has several components, all
pairs across components, in blocks. A pair whose minima agree too seldom is dropped; the others are confirmed on the
full sets, so no link below the threshold is ever made, and one at the threshold is missed with a chance below 1e-6.
Sets are of 64-bit shingle hashes: a text of a million words has two equal ones of different shingles with a chance of 3e-8.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civigrid.llm.common import by_key, dropped, portions, small, small_batches, spread, turn, written
from civigrid.llm.components import Forest, components

#: Bands and rows of a band, for a threshold of 0.8 and for 0.85 and more; a link at the threshold is missed with a chance of (1 - t ** rows) ** bands.
ROWS, BANDS = 5, {0.80: 36, 0.85: 28}
#: Members, and shingles of all members, of a bucket's block in the pass over pairs across components (the other block has twice as much).
BLOCK, BLOCK_SHINGLES = 448, 2_000_000
#: Shingles that are hashed at a time.
STEP = 512


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words (ASCII white space divides; A-Z count as a-z)."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, text.encode().lower().split()), np.uint64)


def shingles(text: str, k: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's ``k``-word shingles; with fewer words, of the whole sequence."""
    h = word_hashes(text)
    if not len(h):
        return h
    n = max(1, len(h) - k + 1)
    size = min(k, len(h))
    mix = np.full(n, 0x9E3779B97F4A7C15 + size, np.uint64)
    for i in range(size):
        mix = (mix ^ h[i : i + n]) * np.uint64(0xFF51AFD7ED558CCD)
        mix ^= mix >> np.uint64(32)
    return np.unique(mix)


class Hashes:
    """Universal hash functions: the upper 32 bits of a x + b mod 2^64, x of 32 bits; signatures are their minima."""

    def __init__(self, n: int, seed: int = 20):
        rng = np.random.default_rng(seed)
        self.a, self.b = (rng.integers(0, 1 << 64, (n, 1), dtype=np.uint64) for _ in range(2))
        self.a |= np.uint64(1)
        self.room = np.empty((n, STEP), np.uint64)

    def signature(self, s: np.ndarray) -> np.ndarray:
        x = (s ^ (s >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
        out = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(x), STEP):  # bounded memory for very long texts
            part = x[at : at + STEP]
            y = self.room[:, : len(part)]
            np.multiply(self.a, part, out=y)
            np.add(y, self.b, out=y)
            np.minimum(out, y.min(axis=1), out=out)
        return (out >> np.uint64(32)).astype(np.uint32)


def signed(docs: DataFrame, k: int, bands: int) -> DataFrame:
    """doc_id, n_shingles, key (of the set, 16 bytes; null without words), signature."""

    def sign(batches):
        turn("minhash")
        hashes = Hashes(bands * ROWS)
        for b in portions(batches):
            sizes, keys, signs = [], [], []
            for t in b.column(1).to_pylist():
                s = shingles(t or "", k)
                sizes.append(len(s))
                keys.append(set_key(s))
                signs.append(hashes.signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.binary())], names=["doc_id", "n_shingles", "key", "signature"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(sign, "doc_id long, n_shingles long, key binary, signature binary")


def set_key(s: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None


def shortened(classes: DataFrame) -> DataFrame:
    """key and bytes, the last byte of each minimum of the signature."""

    def cut(batches):
        for b in portions(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([np.frombuffer(x, np.uint32).astype(np.uint8).tobytes() for x in b.column(1).to_pylist()], pa.binary())], names=["key", "bytes"])

    return classes.select("key", "signature").mapInArrow(cut, "key binary, bytes binary")


def banded(classes: DataFrame) -> DataFrame:
    """band, bucket (a hash of the band and its minima), key and doc_id, for each band of each class."""

    def deal(batches):
        for b in portions(batches):
            rows = [np.frombuffer(x, np.uint32).reshape(-1, ROWS) for x in b.column(2).to_pylist()]
            sizes = np.array([len(x) for x in rows], np.int64)
            at = pa.array(np.repeat(np.arange(len(rows)), sizes))
            buckets = [xxhash.xxh3_64_intdigest(r.tobytes(), seed=i) - (1 << 63) for x in rows for i, r in enumerate(x)]
            yield pa.RecordBatch.from_arrays([pa.array([i for n in sizes for i in range(n)], pa.int32()), pa.array(buckets, pa.int64()), b.column(0).take(at), b.column(1).take(at)], names=["band", "bucket", "key", "doc_id"])

    return classes.select("key", "doc_id", "signature").mapInArrow(deal, "band int, bucket long, key binary, doc_id long")


def least_equal(n: int, threshold: float) -> int:
    """Minima that must agree; a pair at the threshold has fewer with a chance of about 1e-8 (5.7 standard deviations)."""
    return int(np.floor(n * threshold - 5.7 * np.sqrt(n * threshold * (1 - threshold))))


def full_sets(docs: DataFrame, wanted: DataFrame, k: int, bands: int) -> DataFrame:
    """key, its set and signature, for the classes in ``wanted`` (key, doc_id): made from the texts of those documents only."""

    def make(batches):
        hashes = Hashes(bands * ROWS)
        for b in portions(batches):
            sets = [shingles(t or "", k) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([hashes.signature(s).tobytes() if len(s) else None for s in sets], pa.binary())], names=["key", "shingles", "signature"])

    ids = wanted.select(F.col("doc_id").alias("wanted_id")).distinct()
    texts = docs.join(small(written(ids, "minhash-wanted")), F.col("doc_id") == F.col("wanted_id"), "left_semi").select("text")
    # Another row of the same id may have another text.
    return texts.mapInArrow(make, "key binary, shingles binary, signature binary").where("key IS NOT NULL").dropDuplicates(["key"])


PAIR = ["u", "v", "a", "b"]  # of two classes: ids, keys
PAIRS = "u long, v long, a binary, b binary"


def beside(pairs: DataFrame, single: DataFrame, value: str) -> DataFrame:
    """Pairs with ``x`` and ``y``, the ``value`` of their keys a and b; a's that have very many partners are spread over tasks."""
    x, y = single.select(F.col("key").alias("a"), F.col(value).alias("x")), single.select(F.col("key").alias("b"), F.col(value).alias("y"))
    return spread(pairs, x, "a", by="b", hint="merge").join(y.hint("merge"), "b").select(*PAIR, "x", "y")


def likely(pairs: DataFrame, classes: DataFrame, limit: int) -> DataFrame:
    """The pairs whose signatures agree in at least ``limit`` minima, by the last byte of each: it agrees wherever a minimum does."""

    def alike(batches):
        for b in portions(batches):
            x, y = (np.array([np.frombuffer(v, np.uint8) for v in c.to_pylist()]).reshape(b.num_rows, -1) for c in (b.column(4), b.column(5)))
            yield pa.RecordBatch.from_arrays(b.columns[:4], names=PAIR).filter(pa.array((x == y).sum(axis=1) >= limit, pa.bool_()))

    return beside(pairs, classes, "bytes").mapInArrow(alike, PAIRS)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union of their full sets."""

    def check(batches):
        for b in portions(batches, 64):
            keep = []
            for x, y in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True):
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(b.columns[:4], names=PAIR).filter(pa.array(keep, pa.bool_()))

    return beside(pairs, sets, "shingles").mapInArrow(check, PAIRS)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """For each document: doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept.

    Links: 100 * intersection >= ``percent`` * union of the sets of ``k``-word shingles. A null or empty text has no
    set and is linked with nothing. Rows that repeat a doc_id are documents of that id: with equal sets they are one
    class. A null doc_id is kept and never linked, as it has no id to be reached by. Ties there are none: the smallest
    id stands for a group. Very long texts are read to the end; other columns are ignored; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    threshold = percent / 100
    bands = next((n for t, n in sorted(BANDS.items(), reverse=True) if threshold >= t), 0)
    if not bands:
        raise ValueError("the threshold must be 80 percent or more")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = written(signed(given, k, bands), "minhash")
    # One class for each distinct set, named by its smallest id; its rows' signatures are equal.
    wide = written(made.where("doc_id IS NOT NULL AND key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles")), "minhash-wide")
    # Signatures are most of both tables, so what is read later is kept without them.
    rows = written(made.drop("signature"), "minhash-rows")
    dropped(made)
    classes = written(wide.drop("signature"), "minhash-classes")
    member = rows.where("doc_id IS NOT NULL AND key IS NOT NULL")
    named = classes.select("key", F.col("doc_id").alias("u"))
    # Rows of one id are one document, so an id with several sets ties their classes.
    ids = member.select("doc_id", "key").distinct().groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    same_id = member.join(ids, "doc_id").select(F.col("doc_id").alias("v"), "key").distinct().join(named, "key").select("u", "v")
    # Only buckets of several classes matter: they are counted by their numbers alone, and rows of the others go no further.
    buckets = banded(wide)
    sizes = written(buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "minhash-sizes")
    # By a shuffle at every size: its bytes grow as the classes do, and the buckets' sizes are known already.
    shared = written(spread(buckets, sizes.select("bucket"), "bucket", by="key", total=bands * classes.count(), sizes=sizes, hint="merge"), "minhash-buckets")
    # Each class of a bucket beside the one with the smallest id.
    least = written(shared.groupBy("bucket").agg(F.min(F.struct("doc_id", "key")).alias("least")).select("bucket", F.col("least.doc_id").alias("u"), F.col("least.key").alias("a")), "minhash-least")
    limit = least_equal(bands * ROWS, threshold)
    stars = spread(shared, least, "bucket", by="key", sizes=sizes, hint="merge").where("key <> a").select("u", F.col("doc_id").alias("v"), "a", F.col("key").alias("b")).distinct()
    stars = written(stars, "minhash-stars")
    dropped(least)
    dropped(sizes)
    near = written(likely(stars, shortened(wide), limit), "minhash-pairs")
    dropped(stars)
    dropped(wide)
    ends = near.select(F.col("a").alias("key")).union(near.select("b")).distinct()
    sets = written(full_sets(given, classes.select("key", "doc_id").join(ends, "key", "left_semi"), k, bands), "minhash-sets")
    links = written(confirmed(near, sets, percent).select("u", "v").union(same_id), "minhash-links")
    first = written(components(links.toDF("a", "b")).select(F.col("node").alias("doc_id"), "component"), "minhash-first")
    # Buckets that still hold several components, and pairs that no star had: pairs across components, in blocks.
    placed = written(by_key(shared.select("band", "bucket", "key", "doc_id"), first, "doc_id", how="left", spread_by="bucket").select("band", "bucket", "key", F.coalesce("component", "doc_id").alias("component")), "minhash-placed")
    dropped(shared)
    dealt = written(dealt_across(placed, classes.select("key", "n_shingles")), "minhash-dealt")
    dropped(placed)
    more = dealt.select("key").distinct().join(sets.select("key"), "key", "left_anti")
    sets = sets.unionByName(written(full_sets(given, classes.select("key", "doc_id").join(more, "key", "left_semi"), k, bands), "minhash-sets"))
    crossing = written(across(spread(dealt, sets, "key", by="group", hint="merge"), limit, percent), "minhash-crossing")
    found = components(links.toDF("a", "b").union(crossing)).select(F.col("node").alias("u"), "component")
    # Of classes that are linked or have several rows; all other documents stand alone.
    tied = classes.select("key", "n", F.col("doc_id").alias("u")).join(found, "u", "left").where("n > 1 OR component IS NOT NULL").select("key", F.coalesce("component", "u").alias("component_id"))
    out = by_key(rows.select("doc_id", "n_shingles", "key"), written(tied, "minhash-verdict"), "key", how="left", spread_by="doc_id")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def dealt_across(placed: DataFrame, sizes: DataFrame) -> DataFrame:
    """The members of buckets that hold more than two classes in several components, dealt into groups.

    Each class outside the bucket's largest component is compared with all classes of the other components. Those
    outside and all of the bucket are dealt into blocks of bounded rows and bytes, and a pair of blocks is a group, so
    no task gets a whole large bucket.
    """
    sized = placed.join(sizes, "key")
    parts = sized.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"))
    info = parts.groupBy("bucket").agg(F.max(F.struct("n", "w", "component")).alias("most"), F.sum("n").alias("n"), F.sum("w").alias("w"), F.count("*").alias("parts")).where("parts > 1 AND n > 2")

    def blocks(n: Column, w: Column, times: int) -> Column:
        return F.greatest(F.lit(1), F.ceil(n / (times * BLOCK)), F.ceil(w / (times * BLOCK_SHINGLES))).cast("int")

    info = info.select("bucket", F.col("most.component").alias("main"), blocks(F.col("n") - F.col("most.n"), F.col("w") - F.col("most.w"), 1).alias("outer_blocks"), blocks(F.col("n"), F.col("w"), 2).alias("blocks"))
    members = by_key(placed, written(info, "minhash-info"), "bucket", spread_by="key")
    outside = F.when(F.col("component") == F.col("main"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))

    def every(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    def one(n: str) -> Column:
        return F.array(F.pmod(F.xxhash64("key"), F.col(n)).cast("int"))

    both = members.withColumn("outside", F.explode(outside))
    both = both.withColumn("outer_block", F.explode(F.when(F.col("outside"), one("outer_blocks")).otherwise(every("outer_blocks"))))
    both = both.withColumn("block", F.explode(F.when(F.col("outside"), every("blocks")).otherwise(one("blocks"))))
    return both.select("band", F.xxhash64("bucket", "outer_block", "block").alias("group"), "key", "component", "outside")


def across(dealt: DataFrame, limit: int, percent: int) -> DataFrame:
    """Links between components (by their names), confirmed on the full sets: of each group, as many as connect what its links connect.

    Pairs whose signatures agree in fewer than ``limit`` minima are left out, and so are those that share an earlier
    band, where they are looked at already.
    """

    def compare(t: pa.Table) -> pa.Table:
        ids, band = t.column("component").to_pylist(), t.column("band")[0].as_py()
        comp = np.array(ids)
        signs = np.array([np.frombuffer(v, np.uint32) for v in t.column("signature").to_pylist()])
        sets = [np.frombuffer(v, "<u8") for v in t.column("shingles").to_pylist()]
        inner = np.flatnonzero(~np.array(t.column("outside").to_pylist()))
        forest = Forest()
        for i in np.flatnonzero(np.array(t.column("outside").to_pylist())):
            near = inner[comp[inner] != comp[i]]
            same = signs[near] == signs[i]
            near = near[(same.sum(axis=1) >= limit) & ~same.reshape(len(near), -1, ROWS)[:, :band].all(axis=2).any(axis=1)]
            near = [j for j in near.tolist() if forest.top(ids[i]) != forest.top(ids[j]) and 100 * min(len(sets[i]), len(sets[j])) >= percent * max(len(sets[i]), len(sets[j]))]
            if not near:
                continue
            sizes = np.array([len(sets[j]) for j in near])
            flat = np.concatenate([sets[j] for j in near])
            at = np.minimum(np.searchsorted(sets[i], flat), len(sets[i]) - 1)
            both = np.add.reduceat((sets[i][at] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            for j in np.array(near)[100 * both >= percent * (len(sets[i]) + sizes - both)].tolist():
                forest.tie(ids[i], ids[j], (ids[i], ids[j]))
        return pa.table({"a": pa.array([x[0] for x in forest.ties], pa.int64()), "b": pa.array([x[1] for x in forest.ties], pa.int64())})

    return dealt.groupBy("group").applyInArrow(compare, "a long, b long")


def deduplicated(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with its columns: that of the smallest id. Texts without words are groups of their own.

    Of rows that repeat an id one stays; rows without an id all stay.
    """
    verdict = written(near_duplicates(docs, k, percent), "minhash-verdict")
    gone = small(written(verdict.where("NOT kept").select("doc_id").distinct(), "minhash-gone"))
    repeated = small(written(verdict.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "minhash-repeated"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    stay = docs.join(gone, "doc_id", "left_anti").select(*columns)
    once = stay.join(repeated, "doc_id", "left_semi").select("doc_id", F.struct(*columns).alias("row")).groupBy("doc_id").agg(F.first("row").alias("row")).select("row.*")
    return stay.join(repeated, "doc_id", "left_anti").select(*columns).union(once)
