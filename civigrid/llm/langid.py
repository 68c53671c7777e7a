"""Language identification: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

A document's vector is the mean of the embeddings of its words' subwords (the word itself and its letter n-grams,
hashed to buckets); logits are linear in that mean, so a word's part of the logits is one small row that a worker
computes once. The model is fitted in one task, on a bounded sample, and only the model reaches the driver. Probabilities are calibrated with one temperature on a fold that training does not see, and documents
whose calibrated score is below a threshold set on that fold are rejected.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from civigrid.llm.common import portions, small_batches, turn, written

#: Training documents for each language, at most about this many (hash sample); half as many again calibrate.
TRAIN_DOCS = 800
BUCKETS = 1 << 15  # at most 2^16
DIM = 16
EPOCHS = 6
GRAMS = (2, 3, 4)
#: Share of correctly predicted calibration documents that the rejection threshold may lose.
LOSS = 0.001
#: Words that a worker remembers, and bytes that they and their rows take; when either is reached it forgets all and goes on.
CACHE_WORDS, CACHE_BYTES = 300_000, 128 << 20
#: Words whose rows are added up at a time, and bytes of the subwords' rows that are.
SLICE, GATHERED = 50_000, 32 << 20
#: Word characters but digits and the underscore; other number signs (of categories No and Nl) are taken out afterwards.
WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def subwords(word: str) -> list[int]:
    """Bucket ids of a lower-case word and its n-grams with borders."""
    w = f"<{word}>"
    units = {w, *(w[i : i + n] for n in GRAMS for i in range(len(w) - n + 1))}
    return [zlib.crc32(u.encode()) % BUCKETS for u in sorted(units)]


def words_of(text: str) -> list[str]:
    """Runs of letters (Unicode category L) in lower case."""
    found = WORD.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [part for w in found for part in ([w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # of each bucket, its part of the logits (float32)
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        z = (means + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


class Scorer:
    """Applies a model to texts; remembers each word's summed rows and their number."""

    def __init__(self, model: Model):
        self.model, self.index, self.held = model, {}, 0
        self.rows = np.zeros((1024, len(model.languages) + 1))

    def _learn(self, new: list[str]) -> None:
        size = 4 * sum(map(len, new)) + len(new) * (100 + self.rows.itemsize * self.rows.shape[1])
        if len(self.index) + len(new) > CACHE_WORDS or self.held + size > CACHE_BYTES:
            self.index.clear()
            self.held = 0
            if len(self.rows) * self.rows[0].nbytes > CACHE_BYTES:  # a few very many words had made it larger
                self.rows = np.zeros((1024, self.rows.shape[1]))
        self.held += size
        ids = list(map(subwords, new))
        at = len(self.index)
        while at + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((min(len(self.rows), max(len(new), (32 << 20) // self.rows[0].nbytes)), self.rows.shape[1]))])
        self.rows[at : at + len(new), -1] = sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        most = max(1, GATHERED // max(1, self.model.table[:1].nbytes))
        upto, begin = np.cumsum(sizes), 0
        while begin < len(new):
            end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + most, "right")))
            flat = np.fromiter((x for i in ids[begin:end] for x in i), np.int64, int(sizes[begin:end].sum()))
            if len(flat) <= most:
                self.rows[at + begin : at + end, :-1] = np.add.reduceat(self.model.table[flat], np.concatenate([[0], np.cumsum(sizes[begin:end])[:-1]]), axis=0)
            else:  # one very long word
                self.rows[at + begin, :-1] = sum(self.model.table[flat[k : k + most]].sum(axis=0) for k in range(0, len(flat), most))
            begin = end
        self.index.update(zip(new, range(at, at + len(new)), strict=True))

    def mean(self, text: str) -> np.ndarray | None:
        words = words_of(text)
        if not words:
            return None
        # A slice has at most so many rows as a worker may keep, whatever the number of languages.
        n = max(1, min(SLICE, CACHE_BYTES // (2 * self.rows[0].nbytes)))
        total = sum(self._sum(words[at : at + n]) for at in range(0, len(words), n))
        return total[:-1] / total[-1]

    def _sum(self, words: list[str]) -> np.ndarray:
        """The sum of some words' rows."""
        index = self.index
        got = list(map(index.get, words))
        if None in got:
            self._learn(list({w for w, g in zip(words, got, strict=True) if g is None}))
            got = list(map(index.get, words))
            if None in got:
                self._learn(list({w for w in words if w not in index}))
                got = list(map(index.get, words))
        return self.rows[np.array(got)].sum(axis=0)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        means = [self.mean(t) if t and self.model.languages else None for t in texts]
        some = [m for m in means if m is not None]
        p = iter(self.model.probabilities(np.array(some))) if some else iter(())
        langs, scores = [], []
        for m in means:
            if m is None:
                langs.append(UNKNOWN)
                scores.append(0.0)
            else:
                row = next(p)
                langs.append(self.model.languages[int(row.argmax())])
                scores.append(float(row.max()))
        return langs, scores


def fit(docs: list[tuple[np.ndarray, np.ndarray, str]], seed: int = 7) -> Model:
    """SGD over documents given as (bucket ids, their shares, language); every third document calibrates."""
    languages = sorted({x[2] for x in docs})
    k = len(languages)
    rng = np.random.default_rng(seed)
    e, w, b = rng.normal(0, 0.1, (BUCKETS, DIM)), np.zeros((DIM, k)), np.zeros(k)
    data = [(i, c, languages.index(y)) for i, c, y in docs]
    held = [x for n, x in enumerate(data) if n % 3 == 2]
    train = [x for n, x in enumerate(data) if n % 3 != 2] or data
    steps = EPOCHS * len(train)
    for epoch in range(EPOCHS):
        for n, at in enumerate(rng.permutation(len(train))):
            i, c, y = train[at]
            rate = 1.0 * (1 - (epoch * len(train) + n) / steps)
            x = c @ e[i]
            z = x @ w + b
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = w @ p
            w -= rate * np.outer(x, p)
            b -= rate * p
            e[i] -= 4 * rate * c[:, None] * back
    model = Model(languages, (e @ w).astype(np.float32), b)
    held = held or data
    if held:
        means = np.array([c @ model.table[i] for i, c, _ in held])
        ys = np.array([y for *_, y in held])

        def loss(t: float) -> float:
            model.temperature = t
            return float(-np.log(np.maximum(model.probabilities(means)[np.arange(len(ys)), ys], 1e-12)).mean())

        model.temperature = min((float(t) for t in np.geomspace(0.1, 10, 41)), key=loss)
        p = model.probabilities(means)
        right = p.argmax(axis=1) == ys
        if right.any():
            model.threshold = float(min(0.5, np.quantile(p.max(axis=1)[right], LOSS)))
    return model


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))


FEATURES = "ids binary, shares binary, lang string"


def features(batches):
    """Of (text, lang): the text's bucket ids and their shares; texts without a letter are left out."""
    for b in portions(batches):
        rows = []
        for t, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            ids = [x for w in words_of(t) for x in subwords(w)]
            if ids:
                i, c = np.unique(np.array(ids, np.uint16), return_counts=True)
                rows.append((i.tobytes(), (c / c.sum()).astype(np.float32).tobytes(), lang))
        cols = list(zip(*rows, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.string())], names=["ids", "shares", "lang"])


def fitted(batches):
    """The model, in one row, of all rows of ``features``; the order of the rows has no part in it."""
    found = [r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)]
    if found:
        found.sort(key=lambda x: (zlib.crc32(x[0]), x[1], x[2]))
        m = fit([(np.frombuffer(i, np.uint16), np.frombuffer(c, np.float32), lang) for i, c, lang in found])
        yield pa.RecordBatch.from_pylist([{"languages": m.languages, "table": m.table.tobytes(), "bias": m.bias.tobytes(), "temperature": m.temperature, "threshold": m.threshold}])


def train(docs: DataFrame, per_language: int = TRAIN_DOCS, languages: int | None = None) -> Model:
    """Learn from text and non-null lang of rows whose fold is not 1 (a null id is in no fold and not learned from).

    At most about 1.5 times ``per_language`` documents of each language are read (with ``languages``, only of so many, the most
    frequent ones), chosen by a hash of the id: the languages' counts come first, then the hash bound for each. One task fits the model
    on their bucket counts, from a written table; the driver gets the model.
    """
    small_batches(docs.sparkSession)
    usable = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").cast("string"), F.col("lang").cast("string"), fold(F.col("doc_id")).alias("fold")).where("fold <> 1 AND lang IS NOT NULL AND text IS NOT NULL")
    found = usable.groupBy("lang").agg(F.count("*").alias("n"))
    counts = {r.lang: r.n for r in (found if languages is None else found.orderBy(F.desc("n"), "lang").limit(languages)).collect()}
    none = Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    if not counts:
        return none
    want = 3 * per_language // 2
    share = F.create_map(*(x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, want / n)))))
    chosen = usable.where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
    sample = written(chosen.select("text", "lang").mapInArrow(features, FEATURES), "language-sample")
    rows = sample.coalesce(1).mapInArrow(fitted, "languages array<string>, table binary, bias binary, temperature double, threshold double").collect()
    if not rows:
        return none
    r = rows[0]
    return Model(list(r.languages), np.frombuffer(bytes(r.table), np.float32).reshape(BUCKETS, -1), np.frombuffer(bytes(r.bias)), r.temperature, r.threshold)


def identify(docs: DataFrame, model: Model | None = None, per_language: int = TRAIN_DOCS, keep: list[str] | None = None, keep_text: bool = False) -> DataFrame:
    """A row for each document: doc_id, held_out, the columns ``keep`` and on demand the text, lang_pred, score, accepted.

    A text without a letter (Unicode category L), null or empty, gets ``und``, score 0 and is not accepted; so does every
    text if nothing can be learned. A null id counts as not held out. Ties go to the first language by name. Very long
    texts are read to the end, repeated rows give repeated rows, an empty table gives none; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    model = train(docs, per_language) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS times the languages, whatever the input
    keep = keep or []

    sent = ["_id", "_held", *keep, *(["_text"] if keep_text else [])]
    names = ["doc_id", "held_out", *keep, *(["text"] if keep_text else []), "lang_pred", "score", "accepted"]

    def predict(batches):
        turn("language")
        scorer = Scorer(shared.value)
        for b in portions(batches):
            langs, scores = scorer.predict(b.column(b.schema.get_field_index("_text")).to_pylist())
            ok = [x != UNKNOWN and s >= scorer.model.threshold for x, s in zip(langs, scores, strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in sent), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(ok, pa.bool_())], names=names)

    given = docs.select(F.col("doc_id").alias("_id"), F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("_held"), F.col("text").cast("string").alias("_text"), *keep)
    kinds = docs.schema
    text = [StructField("text", StringType())] if keep_text else []
    schema = StructType([StructField("doc_id", kinds["doc_id"].dataType), StructField("held_out", BooleanType()), *(StructField(c, kinds[c].dataType) for c in keep), *text, StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("accepted", BooleanType())])
    return given.mapInArrow(predict, schema)


def accepted(docs: DataFrame, per_language: int = TRAIN_DOCS) -> DataFrame:
    """The documents whose prediction is accepted, with their own columns."""
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text"))  # the text goes to Python once
    packed = docs.select("doc_id", "text", "lang", others.alias("row"))
    found = identify(packed, train(packed, per_language), keep=["row"], keep_text=True).where("accepted")
    return found.select(*((F.col("text").cast(docs.schema["text"].dataType) if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
