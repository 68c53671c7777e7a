"""Quality rules: cross-document line frequency per host, over the base rules of word counts and repetition.

A line is normalised (lower case, white space collapsed) and hashed; for each host the distinct documents that hold it
are counted, and a line above the limit is removed from that host's documents, whatever its length. The limit is a share
of the host's documents, with a floor for small hosts. A document that fails the base rules, or of which too little is
left, is rejected.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civigrid.llm.common import by_key, digest, portions, small, small_batches, turn, written
from civigrid.llm.urlfilter import LOWER, UPPER

#: A line is boilerplate if more distinct documents of its host hold it than this share of them and than this number.
LINE_SHARE = 0.02
LINE_FLOOR = 10
#: Words that must be left once lines are removed, as a number and as a share of the document's words.
LEFT_WORDS = 20
LEFT_SHARE = 0.3
SYMBOLS = "#*$%&|<>"


def line_key(line: bytes) -> bytes:
    """A line's key: lower case (A-Z), white space collapsed."""
    return hashlib.md5(b" ".join(line.lower().split())).digest()


def measures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    raw = text.encode()
    words = raw.split()  # ASCII white space only
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
    repeat = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(windows)) < len(windows):
            seen, twice = set(), set()
            for w in windows:
                (twice if w in seen else seen).add(w)
            upto = 0
            for i, w in enumerate(windows):
                if w in twice:
                    repeat += i + 3 - max(i, upto)
                    upto = i + 3
    return n, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat


MEASURED = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, line_keys array<binary>, line_words array<int>"


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with the base measures of ``text`` and, for each distinct line with a word, its key and the words that all its places have."""
    kinds = dict(docs.dtypes)

    def measure(batches):
        turn("quality")
        for b in portions(batches):
            rows, keys, sizes = [], [], []
            for t in b.column(b.schema.get_field_index("text")).to_pylist():
                t = t or ""
                rows.append(measures(t))
                own: dict[bytes, int] = {}
                for x in t.encode().split(b"\n"):
                    if n := len(x.split()):
                        k = line_key(x)
                        own[k] = own.get(k, 0) + n
                keys.append(list(own))
                sizes.append(list(own.values()))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(k)) for k in keep), *(pa.array(c, pa.int64()) for c in cols), pa.array(keys, pa.list_(pa.binary())), pa.array(sizes, pa.list_(pa.int32()))], names=[*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_keys", "line_words"])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(measure, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), MEASURED]))


def distinct_documents(rows: DataFrame, by: list[str]) -> DataFrame:
    """For each ``by``, the distinct documents that hold it, in ``documents``; ``rows`` has doc_id and ``repeats`` (whether other rows have the id).

    Rows whose id stands once are counted before the shuffle; only those that share an id are made distinct.
    """
    once = rows.where("NOT repeats").groupBy(*by).agg(F.count("*").alias("n"))
    more = rows.where("repeats").select(*by, "doc_id").distinct().groupBy(*by).agg(F.count("*").alias("n"))
    return once.union(more).groupBy(*by).agg(F.sum("n").alias("documents"))


def frequent_lines(rows: DataFrame, lines: DataFrame, floor: int, share: float) -> DataFrame:
    """host and line of the lines above the limit of their host."""
    often = distinct_documents(lines, ["host", "line"]).where(F.col("documents") > floor)
    hosts = distinct_documents(rows, ["host"]).select("host", F.col("documents").alias("of"))
    often = written(often, "quality-often")
    return by_key(often, hosts, "host", spread_by="line").where(F.col("documents") > F.col("of") * F.lit(share)).select("host", "line")


def judged(docs: DataFrame, *, floor: int = LINE_FLOOR, share: float = LINE_SHARE) -> DataFrame:
    """``docs`` (doc_id, text, source) with key, measures, base_failed, left_words, kept and ``removed`` line keys, without text.

    Rows that repeat a doc_id are one document for the line counts; rows without an id are each a document. Copies of a
    text under other ids count as the documents that they are. Null texts count as empty and fail; null sources are one
    host. Rows of equal text and host have one ``key`` and get the same verdict.
    """
    small_batches(docs.sparkSession)
    keyed = docs.select("doc_id", F.col("text").cast("string").alias("text"), digest(F.col("source").cast("string")).alias("host"), content_key().alias("key"))
    rows = written(measured(keyed, ["doc_id", "host", "key"]).withColumn("row", F.monotonically_increasing_id()), "quality")
    repeated = small(written(rows.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(True).alias("again")), "quality-repeated"))
    marked = rows.join(repeated, "doc_id", "left").withColumn("repeats", F.coalesce("again", F.lit(False)))
    lines = marked.select("row", "doc_id", "repeats", "host", F.explode(F.arrays_zip("line_keys", "line_words")).alias("l")).select("row", "doc_id", "repeats", "host", F.col("l.line_keys").alias("line"), F.col("l.line_words").alias("words"))
    often = written(frequent_lines(marked.select("host", "doc_id", "repeats"), lines, floor, share).select(F.struct("host", "line").alias("at")), "quality-lines")
    # Broadcast where they are few; else the line of a third of all documents is dealt over salts.
    hits = by_key(lines.select("row", F.struct("host", "line").alias("at"), "line", "words"), often, "at", spread_by="row")
    gone = hits.groupBy("row").agg(F.sum("words").alias("gone"), F.collect_set("line").alias("removed"))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("gone", F.lit(0))
    ok = (left >= LEFT_WORDS) & (left >= LEFT_SHARE * F.col("n_words"))
    return rows.drop("line_keys", "line_words").join(gone, "row", "left").withColumns({"left_words": left, "base_failed": base, "kept": ~base & ok}).drop("gone", "row", "host")


def content_key() -> Column:
    return digest(F.col("source").cast("string"), F.col("text").cast("string"))


def quality_rules(docs: DataFrame, **limits) -> DataFrame:
    """A row for each document: doc_id, the base measures, base_failed, left_words and kept.

    Empty tables give no rows; repeated rows give repeated rows; ties there are none (a line is above the limit or not);
    a very long text is measured like any other; other columns are ignored.
    """
    return judged(docs, **limits).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "left_words", "kept")


def without_lines(text: Column, removed: Column) -> Column:
    """A text without the lines whose keys are in ``removed``; their keys are made here as ``line_key`` makes them."""
    def key(line: Column) -> Column:
        return F.unhex(F.md5(F.trim(F.regexp_replace(F.translate(line, UPPER, LOWER), r"[\x20\x09-\x0D]+", " "))))

    return F.array_join(F.filter(F.split(text, "\n", -1), lambda line: ~F.array_contains(removed, key(line))), "\n")


def clean(docs: DataFrame, **limits) -> DataFrame:
    """The documents that pass, with their columns, without the lines above the limit (``n_chars`` follows the text).

    Verdicts are joined by content, and only those that change something; if they are few they are broadcast, and the
    texts are not shuffled. Columns of any other name are carried through as they are.
    """
    verdict = judged(docs, **limits).where("NOT kept OR removed IS NOT NULL").groupBy("key").agg(F.first("kept").alias("kept"), F.first("removed").alias("removed"))
    verdict = written(verdict, "quality-verdict")
    texts = docs.select(content_key().alias("key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("d"))
    found = by_key(texts, verdict, "key", how="left", spread_by="d.doc_id").where(F.coalesce("kept", F.lit(True)))
    gone = F.col("removed")
    text = F.when(gone.isNull(), F.col("d.text")).otherwise(without_lines(F.col("d.text").cast("string"), gone).cast(docs.schema["text"].dataType))
    out = found.withColumn("left", text)
    columns = {"text": F.col("left")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(gone.isNull(), F.col("d.n_chars")).otherwise(F.length("left").cast(docs.schema["n_chars"].dataType))
    return out.select(*(columns.get(c, F.col(f"d.`{c}`")).alias(c) for c in docs.columns))
