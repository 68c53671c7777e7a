import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from civigrid.llm import infill, resample, sharding
from civigrid.llm.common import written
from civigrid.llm.ranks import numbered
from tests.llm.helpers import documents, lower_ascii

EDGES = ["", None, "a", "é水\U0001f600", "x<P>y", " <S", "S>\n\n", "word " * 3000, "ein zwei\ndrei vier fünf", "\x00\x7f", "a" * 70_000]


def test_numbered_splits_equal_rows(spark):
    rows = written(spark.createDataFrame([(i % 3, "x") for i in range(5000)], "k int, v string").union(spark.createDataFrame([(None, "n")] * 7, "k int, v string")).repartition(5), "rows")
    got = numbered(rows, F.desc_nulls_last("k")).collect()
    assert sorted(r.position for r in got) == list(range(5007))
    assert [r.k for r in sorted(got, key=lambda r: r.position)] == sorted((r.k for r in got), key=lambda k: -1 if k is None else k, reverse=True)
    assert numbered(written(rows.limit(0), "none"), "k").count() == 0


def shards_by_hand(rows, shards, seed):
    """(doc_id, size, crc, shard, slot) of rows (doc_id, text, lang, source)."""
    by = defaultdict(list)
    for i, text, _, source in rows:
        raw = (text or "").encode()
        key = (i, len(raw) + 1, zlib.crc32(raw))
        shuffled = int(hashlib.md5(f"{seed}:{'n' if i is None else f'v{i}'}:{key[1]}:{key[2]}".encode()).hexdigest()[:15], 16)
        by["n" if source is None else "v" + source].append((shuffled, key))
    mixed = []
    for stratum, own in by.items():
        phase = int(hashlib.md5(f"{seed}:{stratum}".encode()).hexdigest()[:8], 16) / 2**32
        mixed += [((k + phase) / len(own), stratum, key) for k, (_, key) in enumerate(sorted(own, key=lambda x: x[0]))]
    placed = [key for _, _, key in sorted(mixed, key=lambda x: x[:2])]
    out = []
    for s in range(shards):
        first, end = (-(-k * len(placed) // shards) for k in (s, s + 1))
        out += [(*placed[p], s, p - first) for p in range(first, end)]
    return out


def test_shards_by_hand(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["copy", "copy of it", f"text {i}"]), "en", rng.choice(["hot"] * 5 + ["a", "b", None, f"rare{i}"])) for i in range(400)]
    rows += [(k, t, "en", "edge") for k, t in enumerate(EDGES)] + [(None, "no id", "en", "hot")] * 3 + [(7, "again", "en", "hot")] * 90
    docs = documents(spark, rows).withColumn("shard", F.lit("own")).withColumn("slot", F.lit(1.5)).withColumn("size", F.lit("big"))
    for shards in (1, 7, 8):
        got = sharding.assigned(docs, shards, 3).collect()
        assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got), key=repr) == sorted(shards_by_hand(rows, shards, 3), key=repr)
    # each shard has each source's share, up to what rounding and phases can move
    n, sources = len(rows), Counter(r[3] for r in rows)
    share = Counter((r.shard, r.source) for r in got)
    assert all(abs(share[s, name] - sources[name] / 8) < 2 for s in range(8) for name in sources)
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and sum(counts.values()) == n
    few = sharding.assigned(documents(spark, rows[:3]), 8).collect()
    assert len(few) == 3 and all(r.slot == 0 for r in few)
    assert sharding.assigned(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        sharding.assigned(docs, 0)


def test_written_shards_keep_rows_and_order(spark, tmp_path):
    rows = [(i, f"text {i}", "en", f"s{i % 4}") for i in range(60)] + [(3, "text 3", "en", "s3")]
    docs = documents(spark, rows).withColumn("slot", F.lit("theirs"))
    sharding.write_shards(docs, f"{tmp_path}/shards", 4)
    got = spark.read.parquet(f"{tmp_path}/shards")
    assert {*got.columns} == {*docs.columns, "shard", "slot"}
    back = got.collect()
    assert sorted((r.doc_id, r.text) for r in back) == sorted((i, t) for i, t, *_ in rows)
    want = {(r.doc_id, r.shard, r.slot) for r in sharding.assigned(docs, 4).collect()}
    assert {(r.doc_id, r.shard, r.slot) for r in back} == want
    for s in range(4):
        assert sorted(r.slot for r in back if r.shard == s) == list(range(sum(r.shard == s for r in back)))


def test_sharding_has_no_python(spark):
    plan = sharding.assigned(documents(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def units_by_hand(text, unit):
    if unit == "word":
        return re.findall(r"[\t-\r ]+|[^\t-\r ]+", text)
    return re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)


@pytest.mark.parametrize("unit", infill.UNITS)
def test_infill_by_hand(spark, monkeypatch, unit):
    rng = random.Random(9)
    rows = [(k, t) for k, t in enumerate(EDGES)] + [(100 + i, "".join(rng.choice("ab \né水<P>SM") for _ in range(rng.randint(0, 30)))) for i in range(300)] + [(104, "again"), (104, "again"), (None, "no id")]
    docs = documents(spark, rows).withColumn("form", F.lit("theirs")).withColumn("output", F.lit(3))
    made = infill.transformed(docs, unit=unit).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert len(made) == len(rows)
    want = []
    for i, text in rows:
        text, h = text or "", hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
        parts = units_by_hand(text, unit)
        n = len(parts)
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
        if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
            want.append((i, n, "plain", None, None, text, text))
        elif h4 % 100 < 20:
            want.append((i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text))
        else:
            want.append((i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text))
    assert sorted((tuple(r) for r in made), key=repr) == sorted(want, key=repr)
    assert {r.form for r in made} == {"plain", "spm", "psm"}
    monkeypatch.setattr(infill, "WINDOW", 3)  # a long text's units, window by window
    for _, text in rows[:60]:
        codes = infill.code_points((text or "")[:200].encode())
        parts, units = units_by_hand((text or "")[:200], unit), infill.Units(codes, unit)
        assert units.n == len(parts) and [units.start(k) for k in range(units.n + 1)] == [len("".join(parts[:k])) for k in range(len(parts) + 1)]


def test_infill_of_odd_bytes_and_markers(spark):
    odd = spark.sql("SELECT 5L AS doc_id, cast(X'61FF62C3' AS string) AS text")
    row = infill.transformed(odd, plain_percent=0).select("n", "form", F.hex(infill.restored(F.col("output"), F.col("form"))).alias("back")).first()
    assert row.n == 4 and row.form != "plain" and row.back == "61FF62C3"
    for markers in (("<P>", "<P>x", "<M>"), ("ab", "ba", "c"), ("aa", "b", "c"), ("", "b", "c"), ("a", "a", "c")):
        with pytest.raises(ValueError):
            infill.check_markers(markers)
    infill.check_markers(("<|pre|>", "<|suf|>", "<|mid|>"))
    with pytest.raises(ValueError):
        infill.transformed(odd, unit="sentence")
    assert infill.transformed(documents(spark, [])).count() == 0


def resampled_by_hand(docs, target, low, high, buckets, least, percent, seed):
    def found(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))
        return words, [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(low, high + 1) for i in range(len(words) - n + 1)]

    own, aim = [found(t) for _, t in docs], [found(t) for t in target]
    s, t = Counter(b for _, f in own for b in f), Counter(b for _, f in aim for b in f)
    total_s, total_t = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in s}
    rows = []
    for (i, _), (words, f) in zip(docs, own, strict=True):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(words), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    may = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    drawn = percent * len(may) // 100
    return [(*r, k + 1 if k < drawn else None) for k, r in enumerate(may)] + [(*r, None) for r in rows if r[1] < least]


@pytest.mark.parametrize(("low", "high", "buckets"), [(1, 1, 10_000), (1, 2, 64), (2, 3, 1000)])
def test_resample_by_hand(spark, monkeypatch, low, high, buckets):
    monkeypatch.setattr(resample, "CHUNK_POSTINGS", 300)
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["the"] * 5 + ["Été", "x1", "City", "水", f"w{rng.randint(0, 99)}"]) for _ in range(n))
    docs = [(i, text(rng.randint(0, 60))) for i in range(200)] + [(900 + k, t) for k, t in enumerate(EDGES)] + [(None, text(30)), (5, text(40)), (6, "same " * 25), (6, "same " * 25)]
    target = [text(15) for _ in range(20)] + [None, ""]
    aim = spark.createDataFrame([(k, t, 1) for k, t in enumerate(target)], "item_id long, text string, weight int")
    got = resample.resampled(documents(spark, docs).withColumn("score", F.lit("own")), aim, low=low, high=high, buckets=buckets, percent=30).collect()
    want = resampled_by_hand(docs, target, low, high, buckets, 20, 30, 2024)
    assert sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r.rank) for r in got), key=repr) == sorted(want, key=repr)


def test_resample_edges(spark):
    empty = documents(spark, [])
    some = documents(spark, [(i, f"a b c {i} " * 10) for i in range(30)])
    assert resample.resampled(empty, some).count() == 0
    got = resample.resampled(some, empty).collect()
    assert len(got) == 30 and sorted(r.rank for r in got if r.rank) == [1, 2, 3]
    drawn = resample.drawn_documents(some, some, percent=20)
    assert drawn.columns == some.columns and drawn.count() == 6


def test_resample_cuts_long_documents_and_many(monkeypatch):
    monkeypatch.setattr(resample, "CHUNK_POSTINGS", 50)
    long = " ".join(f"w{i % 5000}" for i in range(200_000)).encode()
    words, found = resample.features(long, 1, 1, 10_000)
    chunk = resample.Chunk()
    chunk.add(1, words, found)
    chunk.add(2, *resample.features(b"", 1, 1, 10_000))
    import pyarrow as pa

    rows = chunk.rows(9, pa.int64()).to_pylist()
    assert words == 200_000 and chunk.full() and rows[0]["ids"] == [1, 2] and rows[0]["features"] == [200_000, 0]
    assert sum(r["total"] for r in rows) == 200_000 and {len(r["at"]) for r in rows[1:]} == {1}
    assert np.array_equal(np.sort(np.unique(found)), sorted(r["bucket"] for r in rows[1:]))
