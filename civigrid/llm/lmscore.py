"""Cross-entropy difference: a target and a background n-gram model over one vocabulary score each document.

The vocabulary is every word and sign of all documents, the same for both models. Counts of words and word
bigrams come from every document: target from those labelled good, background from all others with text. Both models
interpolate bigrams and words the same way, and the background's counts are scaled to the target's size, so neither
gains from more data. A document's score is the mean over its tokens and its end of target loss minus background loss: the lower,
the more it is like the target. The model that counted a document scores it without its own counts.

The counts grow with the corpus and stay in a distributed table. Documents are dealt into chunks; a chunk sends each of
its distinct n-grams once, as a key of at least 50 hash bits with its counts, to the key's bucket, so a frequent n-gram is
only one entry for each chunk. A bucket adds up and sends the sums back to the chunks, which score their documents.
Only three totals reach the driver.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civigrid.llm.common import small, small_batches, written

#: Weight of an order against the lower one, in counts (Witten-Bell-like: n / (n + K)).
BACKOFF = 8.0
#: Characters of a chunk's documents, about, and of the corpus for each bucket beyond the least number of buckets.
CHUNK_CHARS = 2_000_000
BUCKET_CHARS = 40_000_000
LEAST_BITS = 10
VALUE_BITS = 40
#: A word, a sign, or one letter of a script that has no spaces between words.
TOKEN = re.compile(r"[฀-໿က-႟ក-៿぀-ヿ㐀-鿿]|[^\W฀-໿က-႟ក-៿぀-ヿ㐀-鿿]+|[^\w\s]")
#: Stands before and after each text, so a word is as often a context as it is a word.
EDGE = np.zeros(1, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keyed(texts: list[str | None], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of each text with its end, and two rows of keys with a column for each token of all texts: word, bigram.

    A key's upper ``bits`` are its bucket; its lowest bit is set for words alone, whose totals the buckets add up.
    """
    found = [np.fromiter(map(xxhash.xxh3_64_intdigest, TOKEN.findall(t or "")), np.uint64) for t in texts]  # the same in every process
    sizes = np.array([len(x) and len(x) + 1 for x in found], np.int64)
    if not sizes.any():
        return sizes, np.empty((2, 0), np.uint64)
    word = np.concatenate([y for x in found if len(x) for y in (x, EDGE)])
    keys = np.stack([mixed(word ^ np.uint64(0xD6E8FEB86659FD93)), mixed(mixed(np.roll(word, 1) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(3) ^ word)])
    keys = keys >> np.uint64(64 - VALUE_BITS - bits) & ~np.uint64(1)
    keys[0] |= np.uint64(1)
    return sizes, keys


COUNTS = "target binary, target_more binary, background binary, background_more binary"
SENT = f"bucket int, chunk long, grams binary, {COUNTS}"
SUMS = f"bucket int, chunk long, {COUNTS}, n_target long, n_background long, n_words long"


def binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Rows of bytes: ``values`` (one row of bytes each) from bound to bound."""
    width = values.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def as_bytes(values: np.ndarray) -> np.ndarray:
    return values.view(np.uint8).reshape(len(values), values.itemsize)


def packed(name: str, counts: np.ndarray, bounds: np.ndarray) -> dict[str, pa.Array]:
    """Counts from bound to bound: a byte each, and those of 255 or more in full in a second column."""
    many = counts >= 255
    more = np.append(0, np.cumsum(many))[bounds]
    return {name: binaries(as_bytes(np.where(many, 255, counts).astype(np.uint8)), bounds), f"{name}_more": binaries(as_bytes(counts[many].astype(np.uint64)), more)}


def unpacked(t: pa.Table, name: str) -> np.ndarray:
    counts = np.frombuffer(joined(t.column(name)), np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(joined(t.column(f"{name}_more")), np.uint64)
    return counts


def sender(bits: int):
    """A chunk's distinct n-grams with their counts, by bucket."""

    def send(t: pa.Table) -> pa.Table:
        sizes, keys = keyed(t.column("text").to_pylist(), bits)
        flags = np.tile(np.repeat(np.array(t.column("target").to_pylist(), bool), sizes), 2)
        own, at = np.unique(keys.ravel(), return_inverse=True)
        n = np.bincount(at, minlength=len(own))
        target = np.bincount(at, flags, len(own)).astype(np.int64)
        buckets, first = np.unique(own >> np.uint64(VALUE_BITS), return_index=True)
        bounds = np.append(first, len(own))
        chunk = t.column("chunk")[0].as_py()
        return pa.table({"bucket": pa.array(buckets.astype(np.int32)), "chunk": pa.array(np.full(len(buckets), chunk, np.int64)), "grams": binaries(as_bytes(own)[:, : VALUE_BITS // 8], bounds), **packed("target", target, bounds), **packed("background", n - target, bounds)})

    return send


def joined(column: pa.ChunkedArray) -> bytes:
    return b"".join(column.to_pylist())


def add_up(t: pa.Table) -> pa.Table:
    """A bucket's sums, for each chunk in the order of the n-grams it sent; the first row has the bucket's totals of words."""
    width = VALUE_BITS // 8
    bounds = np.cumsum([0, *(len(x) // width for x in t.column("grams").to_pylist())])
    raw = np.frombuffer(joined(t.column("grams")), np.uint8).reshape(-1, width)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :width] = raw
    own, at = np.unique(wide.view(np.uint64).ravel(), return_inverse=True)
    target, background = (np.bincount(at, unpacked(t, c), len(own)).astype(np.int64) for c in ("target", "background"))
    word = own & np.uint64(1) == 1
    totals = [int(target[word].sum()), int(background[word].sum()), int(word.sum())]
    first = np.zeros(t.num_rows, np.int64)
    first[0] = 1
    return pa.table({"bucket": t.column("bucket"), "chunk": t.column("chunk"), **packed("target", target[at], bounds), **packed("background", background[at], bounds), **{k: pa.array(first * n) for k, n in zip(("n_target", "n_background", "n_words"), totals, strict=True)}})


def scorer(bits: int, n_target: int, n_background: int, n_words: int):
    """A chunk's documents with their scores, from the sums that the buckets sent back."""

    def score(docs: pa.Table, sums: pa.Table) -> pa.Table:
        sizes, keys = keyed(docs.column("text").to_pylist(), bits)
        total = np.zeros(len(sizes))
        if n_target and n_background and keys.size:
            sums = sums.sort_by("bucket")
            counts = [unpacked(sums, c) for c in ("target", "background")]
            own, at = np.unique(keys.ravel(), return_inverse=True)
            if len(own) != len(counts[0]):
                raise ValueError(f"{len(own)} n-grams of a chunk, but {len(counts[0])} sums")
            # Of each token's n-grams, how often its own document has them.
            doc = np.repeat(np.arange(len(sizes)), sizes)
            _, pair, held = np.unique(np.tile(doc, 2) * len(own) + at, return_inverse=True, return_counts=True)
            mine, flags = held[pair].reshape(2, -1), np.array(docs.column("target").to_pylist(), bool)
            target = n_target - sizes * flags
            scale = target / np.maximum(1, n_background - sizes * ~flags)
            losses = []
            for n, part, factor in ((counts[0], flags, np.ones(len(sizes))), (counts[1], ~flags, scale)):
                word, bigram = n[at].reshape(2, -1) - mine * part[doc]
                context, factor = np.roll(n[at[: len(doc)]], 1) - np.roll(mine[0], 1) * part[doc], factor[doc]
                low = (word * factor + 1) / (target[doc] + n_words)
                losses.append(-np.log2((bigram * factor + BACKOFF * low) / (context * factor + BACKOFF)))
            total = np.bincount(doc, losses[0] - losses[1], len(sizes))
            total[(target == 0) | (n_background == sizes * ~flags)] = 0  # no other document to compare with
        mean = [s / n if n else None for s, n in zip(total.tolist(), sizes.tolist(), strict=True)]
        return pa.table({"doc_id": docs.column("doc_id"), "n_tokens": pa.array(np.maximum(sizes - 1, 0)), "score": pa.array(mean, pa.float64())})

    return score


def lm_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For each document: doc_id, n_tokens (words and signs), score (mean loss difference in bits; lower is nearer to the target).

    A document is a target document if any row of ``labels`` with its doc_id has quality 1. Null texts and those without
    a word or sign have no tokens and a null score; without target or background text (but a document's own) scores are
    0. Repeated rows count as often as they stand there and each get a row, without one count of their own; equal texts
    of one side have equal scores; very long texts are read to the end. Null ids match no label; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("good_id")).distinct()
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    good = small(written(good, "good"))  # else the texts would be shuffled only to be marked
    chars = plain.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(chars / CHUNK_CHARS))
    bits = min(20, max(LEAST_BITS, math.ceil(math.log2(max(1, chars / BUCKET_CHARS)))))
    marked = plain.join(good, plain.doc_id == good.good_id, "left").select("doc_id", "text", F.col("good_id").isNotNull().alias("target"))
    dealt = marked.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    sent = dealt.groupBy("chunk").applyInArrow(sender(bits), SENT)
    sums = written(sent.groupBy("bucket").applyInArrow(add_up, SUMS), "lm-sums")
    totals = sums.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n_target", "n_background", "n_words"))).first()
    back = sums.drop("n_target", "n_background", "n_words")
    return dealt.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(scorer(bits, *totals), "doc_id long, n_tokens long, score double")
