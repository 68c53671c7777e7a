"""Best-fit packing by patterns: non-negative least squares over few-document length patterns, then best fit.

The driver sees only the histogram of piece lengths (at most ``limit`` numbers) and makes a plan from it; pieces find
their place in the plan by length and by rank among the pieces of that length, so they are never collected or sorted.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civigrid.llm.common import portions, small_batches, written
from civigrid.llm.wordbpe import encoder

#: Lengths are rounded up to this many tokens where patterns are enumerated; real lengths are used from then on.
GRID = 8
#: Documents in an enumerated pattern.
DEPTH = 3


def patterns(parts: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All multisets of at most ``depth`` positive whole numbers (largest first) that sum to ``parts``."""
    found, open_ = [], [((), parts)]
    while open_:
        head, left = open_.pop()
        top = min(left, head[-1] if head else left)
        if left <= top:
            found.append((*head, left))
        if len(head) + 1 < depth:
            more = depth - len(head)
            open_ += [((*head, n), left - n) for n in range(-(-left // more), top + 1) if n < left]
    return sorted(set(found), reverse=True)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """Least squares with x >= 0 by an active set: the variable of steepest descent enters, negative ones leave."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    scale = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(rounds or 3 * a.shape[0]):
        slope = a.T @ (b - a[:, active] @ x[active])
        slope[active] = -np.inf
        enter = int(np.argmax(slope))
        if slope[enter] <= scale:
            break
        active[enter] = True
        while True:
            own = np.flatnonzero(active)
            part = a[:, own]
            try:
                z = np.linalg.solve(part.T @ part, part.T @ b)
            except np.linalg.LinAlgError:
                z = np.linalg.lstsq(part, b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[own] = z
                break
            bad = z <= 0
            step = np.min(x[own][bad] / np.maximum(x[own][bad] - z[bad], 1e-300))
            x[own] += step * (z - x[own])
            drop = own[bad & (x[own] <= 1e-12 * max(1.0, x.max()))]
            drop = drop if len(drop) else own[bad][:1]
            x[drop] = 0
            active[drop] = False
            if not active.any():
                break
    return x


class Plan:
    """Groups of like sequences. ``rows``: for runs of pieces of one length, by rank, where they stand."""

    def __init__(self, counts: dict[int, int], limit: int):
        self.limit, self.counts = limit, dict(counts)
        self.next_rank: dict[int, int] = defaultdict(int)
        self.sequences = 0
        self.rows: list[tuple[int, int, int, int, int, int]] = []  # length, first rank, pieces, first sequence, pieces of it in each sequence, offset
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)  # space left: (first sequence, sequences)

    def place(self, length: int, first: int, n: int, each: int, left: int) -> int:
        """``each`` pieces in each of ``n`` sequences from ``first`` on, which have ``left`` tokens free; the tokens free then."""
        self.rows.append((length, self.next_rank[length], n * each, first, each, self.limit - left))
        self.next_rank[length] += n * each
        self.counts[length] -= n * each
        return left - each * length

    def new(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n


def plan(counts: dict[int, int], limit: int, grid: int = GRID, depth: int = DEPTH) -> Plan:
    """Patterns fitted to the histogram and rounded down, then the residual pieces from the longest by best fit."""
    p = Plan(counts, limit)
    if p.counts.get(limit):  # nothing goes beside these
        n = p.counts[limit]
        p.place(limit, p.new(n), n, 1, limit)
    parts = limit // grid
    if parts >= 2 and any(p.counts.values()):
        shapes = patterns(parts, depth)
        a, b = np.zeros((parts, len(shapes))), np.zeros(parts)
        for j, s in enumerate(shapes):
            np.add.at(a[:, j], np.array(s) - 1, 1)
        for length, n in p.counts.items():
            b[min(parts, -(-length // grid)) - 1] += n
        within = {k: sorted((x for x in p.counts if x and min(parts, -(-x // grid)) == k and p.counts[x]), reverse=True) for k in range(1, parts + 1)}
        for repeat, shape in sorted(zip(np.floor(nnls(a, b) + 1e-9).astype(int).tolist(), shapes, strict=True), reverse=True):
            if repeat:
                fill(p, shape, repeat, within, grid)
    for length in sorted((x for x in p.counts if p.counts[x]), reverse=True):
        best_fit(p, length)
    return p


def fill(p: Plan, shape: tuple[int, ...], repeat: int, within: dict[int, list[int]], grid: int) -> None:
    """Up to ``repeat`` sequences of one pattern: real lengths of a bin from the longest on, and the last one is the longest that fits."""
    while repeat > 0:
        slots: list[int] = []
        for k in shape[:-1]:
            x = next((x for x in within[k] if p.counts[x] > slots.count(x)), None)
            if x is None:
                return
            slots.append(x)
        room = p.limit - sum(slots)
        x = next((x for x in range(room, (shape[-1] - 1) * grid, -1) if p.counts.get(x, 0) > slots.count(x)), None)
        if x is None:
            return
        slots.append(x)
        n = min([repeat, *(p.counts[x] // slots.count(x) for x in set(slots))])
        first, left = p.new(n), p.limit
        for x in dict.fromkeys(slots):
            left = p.place(x, first, n, slots.count(x), left)
        p.open[left].append((first, n))
        repeat -= n


def best_fit(p: Plan, length: int) -> None:
    """All pieces left of one length: each into the fullest sequence that has room, else into a new one."""
    for left in sorted(x for x in p.open if x >= length):
        while p.counts[length] and p.open[left]:
            first, n = p.open[left].pop()
            each = left // length
            if p.counts[length] < each:
                each = p.counts[length]
            take = min(n, p.counts[length] // each)
            if take < n:
                p.open[left].append((first + take, n - take))
            p.open[p.place(length, first, take, each, left)].append((first, take))
        if not p.counts[length]:
            return
    each = p.limit // length
    if full := p.counts[length] // each:
        first = p.new(full)
        p.open[p.place(length, first, full, each, p.limit)].append((first, full))
    if rest := p.counts[length]:
        first = p.new(1)
        p.open[p.place(length, first, 1, rest, p.limit)].append((first, 1))


def pieces(docs: DataFrame, tokenizer: str, limit: int, end_id: int = 0) -> DataFrame:
    """Each document's ids followed by ``end_id``, cut into pieces of at most ``limit`` tokens.

    A null text counts as empty. ``task`` and ``nth`` number the pieces of one length within a task.
    """
    small_batches(docs.sparkSession)

    def cut(batches):
        from pyspark import TaskContext

        task, seen, enc, end = TaskContext.get().partitionId(), defaultdict(int), encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for b in portions(batches):
            ids, rows = b.column(0).to_pylist(), []
            for i, coded in zip(ids, enc.ids_of([x or "" for x in b.column(1).to_pylist()]), strict=True):
                coded += end
                for piece, at in enumerate(range(0, len(coded), 4 * limit)):
                    part = coded[at : at + 4 * limit]
                    n = len(part) // 4
                    rows.append((i, piece, at // 4, n, zlib.crc32(part), task, seen[n]))
                    seen[n] += 1
            c = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(c, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long")


def pack(docs: DataFrame, tokenizer: str, limit: int = 2048, end_id: int = 0, grid: int = GRID, depth: int = DEPTH) -> DataFrame:
    """Whole documents in sequences of at most ``limit`` tokens; only longer ones are cut, at multiples of ``limit``.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null and empty texts are one token
    (``end_id``). Repeated rows are packed each for itself; an empty table gives no rows; other columns are ignored.
    Among pieces of equal length, places go by the order in which tasks met them, so another run may swap such pieces.
    """
    spark = docs.sparkSession
    cut = written(pieces(docs, tokenizer, limit, end_id), "pieces")
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    ranked = per_task.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)))
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `limit` rows
    rows = plan(counts, limit, grid, depth).rows
    made = spark.sparkContext.broadcast(np.array(sorted(rows), dtype=np.int64).reshape(-1, 6))  # bounded by patterns and lengths, not by documents

    def assign(batches):
        p = made.value
        key = p[:, 0] * (1 << 44) + p[:, 1]
        for b in portions(batches):
            length, rank = (b.column(b.schema.get_field_index(x)).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("length", "rank"))
            row = p[np.searchsorted(key, length * (1 << 44) + rank, side="right") - 1] if len(length) else p[:0]
            at = rank - row[:, 1]
            cols = [b.column(b.schema.get_field_index(x)) for x in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(row[:, 3] + at // np.maximum(row[:, 4], 1), pa.int64()), pa.array(row[:, 5] + at % np.maximum(row[:, 4], 1) * length, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return cut.join(ranked.select("length", "task", "before"), ["length", "task"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.coalesce("before", F.lit(0))).alias("rank")).mapInArrow(assign, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
