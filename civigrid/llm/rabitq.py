"""Embedding near-dedup on binary codes of randomly rotated vectors, with stored correction factors.

A unit vector is rotated and its coordinates' signs are its code, the vertex o' of a cube. The stored factor f = <o', o>
makes <o', q> / f an unbiased estimate of <o, q> for a unit vector q, which is stored in the same frame at 8 bits a
coordinate. The estimate is off by at most sqrt((1 - f^2) / f^2) sqrt(1 - <o, q>^2) and, but for a chance of 1e-8, by
at most ``SIGMAS`` / sqrt(d - 1) of that. A pair whose estimates (one from either side) with this bound and that of the
8 bits stay below the threshold is settled by its codes; only the others are computed again from the vectors, in double
precision, and only the vectors of such pairs are fetched.

Candidates share a run of sign bits in one of several independent rotations, so vectors are never all compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civigrid.llm.common import by_key, portions, small_batches, spread, written
from civigrid.llm.components import components

#: Chance to miss a pair that lies exactly at the threshold; the number of rotations follows from it.
MISS = 1e-7
#: Standard deviations of the estimate's error that its confidence bound has.
SIGMAS = 5.7
#: Rows of a large bucket's block, of small buckets that go together, of one product, and up to which a bucket's pairs are listed with those of others.
BLOCK, TOGETHER, TILE, LISTED = 4096, 1024, 256, 32
#: Allowance for rounding in single precision; when pairs are looked at again with their vectors, it is half as much.
SLACK = 2e-5


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same for all workers."""
    q, r = np.linalg.qr(np.random.default_rng([dim, seed]).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def runs(bits: int, threshold: float) -> int:
    """Runs of ``bits`` signs that are needed so that a pair at the threshold shares one, but for a chance of ``MISS``."""
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return math.ceil(math.log(MISS) / math.log1p(-agree))


class Coder:
    """Makes the stored records of vectors of one dimension: factor, scale, sign bits, coordinates at 8 bits, runs of signs."""

    def __init__(self, dim: int, bits: int, count: int):
        self.dim, self.bits, self.count = dim, bits, count
        self.spin = rotation(dim, 0)
        self.more = np.concatenate([rotation(dim, i + 1) for i in range(-(-count * bits // dim))], axis=1)[:, : count * bits]

    def records(self, x: np.ndarray) -> np.ndarray:
        """A row of bytes for each vector (any length but zero)."""
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        turned = unit @ self.spin
        scale = np.abs(turned).max(axis=1) / 127
        signs = turned >= 0
        factor = np.abs(turned).sum(axis=1) / math.sqrt(self.dim)
        places = (unit @ self.more >= 0).reshape(len(x), self.count, self.bits) @ (1 << np.arange(self.bits, dtype=np.uint64))
        parts = (factor.astype("<f4")[:, None], scale.astype("<f4")[:, None], np.packbits(signs, axis=1), np.rint(turned / scale[:, None]).astype(np.int8), (places & 0xFFFFFFFF).astype("<u4"))
        return np.concatenate([np.ascontiguousarray(p).view(np.uint8).reshape(len(x), -1) for p in parts], axis=1)


class Codes:
    """Stored records, read: codes ``o``, factors ``f``, coordinates ``q`` with the most that <o', q> can be off by them, runs."""

    def __init__(self, raw: np.ndarray, dim: int):
        wide = -(-dim // 8)
        self.dim = dim
        self.f = raw[:, :4].copy().view("<f4").ravel()
        scale = raw[:, 4:8].copy().view("<f4").ravel()
        self.o = (np.unpackbits(raw[:, 8 : 8 + wide], axis=1)[:, :dim] * np.float32(2) - np.float32(1)) / np.float32(math.sqrt(dim))
        self.q = raw[:, 8 + wide : 8 + wide + dim].copy().view(np.int8) * scale[:, None]
        self.off = scale * np.float32(math.sqrt(dim) / 2)
        self.runs = raw[:, 8 + wide + dim :].copy().view("<u4")

    def margin(self, t: float) -> np.ndarray:
        """How far below <o, q> >= t the estimate from a code can be, but for the 8 bits of q."""
        reach = math.sqrt(1 - t * t) * min(1.0, SIGMAS / math.sqrt(max(1, self.dim - 1)))
        return reach * np.sqrt(np.maximum(0, 1 - self.f**2)) / self.f

    def open_pairs(self, i: np.ndarray, j: np.ndarray, t: float, slack: float) -> np.ndarray:
        """Of listed pairs, those that the estimates don't settle."""
        m, ok = self.margin(t), np.ones(len(i), bool)
        for a, b in ((i, j), (j, i)):
            ok &= np.einsum("ij,ij->i", self.o[a], self.q[b]) / self.f[a] >= t - m[a] - self.off[b] / self.f[a] - slack
        return ok

    def open_block(self, a: np.ndarray, b: np.ndarray, t: float, slack: float) -> tuple[np.ndarray, np.ndarray]:
        """Of all pairs of ``a`` and ``b``, those that the estimates don't settle."""
        m = self.margin(t)
        one = self.o[a] @ self.q[b].T >= (t - m[a] - slack)[:, None] * self.f[a][:, None] - self.off[b][None, :]
        two = self.q[a] @ self.o[b].T >= (t - m[b] - slack)[None, :] * self.f[b][None, :] - self.off[a][:, None]
        x, y = np.nonzero(one & two)
        return a[x], b[y]

    def unseen(self, i: np.ndarray, j: np.ndarray, run: np.ndarray) -> np.ndarray:
        """Whether a pair's first shared run is the one it is met in; in later ones it has been looked at."""
        out = np.ones(len(i), bool)
        for at in range(0, len(i), 1 << 16):
            s = slice(at, at + (1 << 16))
            same = self.runs[i[s]] == self.runs[j[s]]
            out[s] = ~(same & (np.arange(same.shape[1]) < run[i[s]][:, None])).any(axis=1)
        return out


def undecided(c: Codes, group: np.ndarray, side: np.ndarray, run: np.ndarray, t: float, slack: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group that the codes leave open and that no earlier run has, in slices; rows are sorted by group.

    ``side`` is 0 or 1 where a group is a pair of a bucket's blocks (pairs have one row of each), else 2.
    """
    bounds = np.flatnonzero(np.diff(group, prepend=group[0] - 1)) if len(group) else np.zeros(0, int)
    sizes = np.diff(np.append(bounds, len(group)))
    listed = np.repeat((sizes <= LISTED) & (side[bounds] == 2 if len(bounds) else True), sizes)
    for k in range(1, LISTED):
        i = np.flatnonzero((group[k:] == group[:-k]) & listed[k:]) if k < len(group) else np.zeros(0, int)
        if not len(i):
            break
        for at in range(0, len(i), 1 << 15):
            a = i[at : at + (1 << 15)]
            a = a[c.unseen(a, a + k, run)]
            yield (x := a[c.open_pairs(a, a + k, t, slack)]), x + k
    for first, n in zip(bounds.tolist(), sizes.tolist(), strict=True):
        if listed[first]:
            continue
        rows = np.arange(first, first + n)
        left, right = (rows, rows) if side[first] == 2 else (rows[side[rows] == 0], rows[side[rows] == 1])
        for at in range(0, len(left), TILE):
            a, b = c.open_block(left[at : at + TILE], right, t, slack)
            if side[first] == 2:
                a, b = a[a < b], b[a < b]
            new = c.unseen(a, b, run)
            yield a[new], b[new]


def linked(x: np.ndarray, i: np.ndarray, j: np.ndarray, t: float) -> np.ndarray:
    """Whether the cosine of listed pairs is at least ``t``, in double precision."""
    norm, out, step = np.linalg.norm(x, axis=1), np.zeros(len(i), bool), max(1, 2_000_000 // x.shape[1])
    for at in range(0, len(i), step):
        a, b = i[at : at + step], j[at : at + step]
        out[at : at + step] = np.einsum("ij,ij->i", x[a], x[b]) / (norm[a] * norm[b]) >= t
    return out


def join_up(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Lower ``label`` (the row that a row is tied to) until both rows of every pair have the same."""
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while not (label == label[label]).all():
            label[:] = label[label]


def near_vectors(vectors: DataFrame, threshold: float = 0.98, bits: int | None = None) -> DataFrame:
    """For each row: vec_id, n_links, component_id (smallest vec_id reachable by links, itself included), kept.

    Rows with equal labels (null equals nothing) and equally many components are linked if their cosine is at least
    ``threshold``. A vector that is null, empty or zero, or has a null or non-finite component, links with nothing, and
    neither does one without a vec_id: it is kept, with no component. Rows that repeat a vec_id are vectors of their own
    for ``n_links`` and share their component. Other columns are ignored; an empty table gives no rows.
    """
    small_batches(vectors.sparkSession)
    single = dict(vectors.dtypes)["embedding"] == "array<float>"
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("v"))
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False)) & F.exists("v", lambda x: x != 0)
    key = F.when(fine, F.unhex(F.md5(F.to_json(F.struct("label", "v")))))
    rows = written(given.withColumn("key", key), "vectors")
    member = rows.where("key IS NOT NULL")
    # Equal vectors of a label are one class: they are links of each other, and have the same links.
    grouped = member.groupBy("key").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("v").alias("v"))
    classes = written(grouped.withColumn("class", F.monotonically_increasing_id()), "vector-classes")
    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first().n or 1
    if bits is None:  # so that unlike vectors of the largest label seldom share a run, at any size
        bits = min(31, 4 + max(6, math.ceil(math.log2(largest))))
    count = runs(bits, threshold)
    kind = np.float32 if single else np.float64

    def encode(batches):
        coders: dict[int, Coder] = {}
        for b in portions(batches):
            vs = [np.array(v, np.float64) for v in b.column(2).to_pylist()]
            records, buckets = [b""] * len(vs), [()] * len(vs)
            labels = b.column(1).to_pylist()
            for d in {len(v) for v in vs}:
                own = [i for i, v in enumerate(vs) if len(v) == d]
                if d not in coders:
                    coders[d] = Coder(d, bits, count)
                raw = coders[d].records(np.array([vs[i] for i in own]))
                for i, r in zip(own, raw, strict=True):
                    records[i] = r.tobytes()
                    of = f"{labels[i]}|{d}|".encode()
                    tail = records[i][-4 * count :]
                    buckets[i] = [xxhash.xxh3_64_intdigest(of + tail[4 * k : 4 * k + 4], seed=k) - (1 << 63) for k in range(count)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(v) for v in vs], pa.int32()), pa.array(records, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))], names=["class", "d", "code", "buckets"])

    codes = written(classes.select("class", "label", "v").mapInArrow(encode, "class long, d int, code binary, buckets array<long>"), "vector-codes")
    buckets = codes.select("class", F.posexplode("buckets").alias("run", "bucket"))
    sizes = written(buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "vector-sizes")
    members = written(by_key(buckets, sizes, "bucket", spread_by="class"), "vector-buckets")
    # Each pair of blocks of a large bucket is a group, so a bucket of any size is spread over tasks; small buckets go together.
    blocks = members.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    paired = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    together = max(1, members.count() // TOGETHER)
    low, high = F.least("block", "other"), F.greatest("block", "other")
    side = F.when(low == high, F.lit(2)).otherwise((F.col("block") == high).cast("int"))
    dealt = paired.select("class", "run", F.xxhash64("bucket", low, high).alias("group"), side.alias("side"), F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("bucket"), F.lit(together))).otherwise(F.xxhash64("bucket", low, high)).alias("place"))

    def tables(t: pa.Table) -> Iterator[tuple[pa.Table, Codes, np.ndarray, np.ndarray, np.ndarray]]:
        t = t.sort_by([("d", "ascending"), ("group", "ascending"), ("class", "ascending")])
        d = t.column("d").to_numpy()
        for own in np.unique(d):
            first, last = np.searchsorted(d, [own, own + 1])
            part = t.slice(first, last - first)
            raw = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(len(part), -1)
            yield part, Codes(raw, int(own)), part.column("group").to_numpy(), part.column("side").to_numpy(), part.column("run").to_numpy()

    def sift(t: pa.Table) -> pa.Table:
        """The rows that have a pair left open by the codes."""
        parts = []
        for part, c, group, sides, run in tables(t):
            keep = np.zeros(len(part), bool)
            for i, j in undecided(c, group, sides, run, threshold, SLACK):
                keep[i] = keep[j] = True
            parts.append(part.filter(pa.array(keep)))
        return pa.concat_tables(parts)

    def compare(t: pa.Table) -> pa.Table:
        """Each class's links, and as many ties as connect what the links connect."""
        out = []
        for part, c, group, sides, run in tables(t):
            x = np.frombuffer(b"".join(part.column("v").to_pylist()), kind).reshape(len(part), -1).astype(np.float64)
            n, node, names = part.column("n").to_numpy(), part.column("node").to_numpy(), part.column("label").to_numpy(zero_copy_only=False)
            degree, label = np.zeros(len(part), np.int64), np.arange(len(part))
            for i, j in undecided(c, group, sides, run, threshold, SLACK / 2):
                real = linked(x, i, j, threshold)
                i, j = i[real], j[real]
                same = names[i] == names[j]
                i, j = i[same], j[same]
                np.add.at(degree, i, n[j])
                np.add.at(degree, j, n[i])
                join_up(label, i, j)
            tied = np.flatnonzero(label != np.arange(len(part)))
            some = np.flatnonzero(degree)
            out.append(pa.table({"class": part.column("class").take(pa.array(some)), "links": pa.array(degree[some]), "a": pa.nulls(len(some), pa.int64()), "b": pa.nulls(len(some), pa.int64())}))
            out.append(pa.table({"class": pa.nulls(len(tied), pa.int64()), "links": pa.nulls(len(tied), pa.int64()), "a": pa.array(node[tied]), "b": pa.array(node[label[tied]])}))
        return pa.concat_tables(out)

    packed = codes.select("class", "d", "code")
    coded = spread(dealt, packed, "class", by="group")
    layout = "class long, run int, group long, side int, place long, d int, code binary"
    names = [x.split()[0] for x in layout.split(", ")]
    left = written(coded.select(*names).groupBy("place").applyInArrow(sift, layout), "vector-open")

    def as_bytes(batches):
        for b in portions(batches):
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array([np.array(v, kind).tobytes() for v in b.column(4).to_pylist()], pa.binary())], names=["class", "node", "n", "label", "v"])

    wanted = classes.join(left.select("class").distinct(), "class", "left_semi").select("class", "node", "n", "label", "v").mapInArrow(as_bytes, "class long, node long, n long, label string, v binary")
    found = written(spread(left, wanted, "class", by="group").groupBy("place").applyInArrow(compare, "class long, links long, a long, b long"), "vector-links")
    degree = found.where("class IS NOT NULL").groupBy("class").agg(F.sum("links").alias("links"))
    ids = member.select("vec_id", "key").distinct().groupBy("vec_id").agg(F.min("key").alias("least"), F.count("*").alias("n")).where("n > 1")
    several = member.join(ids.select("vec_id", "least"), "vec_id").select("vec_id", "key").distinct().join(classes.select("key", "node"), "key").select(F.col("vec_id").alias("a"), F.col("node").alias("b")).where("a <> b")
    tied = components(found.where("a <> b").select("a", "b").union(several))
    # Of classes with a link or several rows; all others stand alone. A node's component is its smallest id.
    named = classes.select("class", "key", "node", "n").join(degree, "class", "left").join(tied, "node", "left")
    verdict = named.where("n > 1 OR links IS NOT NULL OR component IS NOT NULL").select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    out = by_key(rows.select("vec_id", "key"), written(verdict, "vector-verdict"), "key", how="left", spread_by="vec_id")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
