import random
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from tokenizers import Tokenizer  # noqa: E402

from civigrid.llm.packing import nnls, pack, patterns, plan  # noqa: E402
from civigrid.llm.sentencepieces import PieceCodec, coded  # noqa: E402
from civigrid.llm.tokencount import PrefixCounter, joined, token_counts  # noqa: E402
from civigrid.llm.wordbpe import ChunkEncoder  # noqa: E402
from tests.llm.helpers import documents  # noqa: E402

BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = "abcé'sst'll12²ß \n\t<|endoftext|>ΑΣσİ́ﬁ你好   🙂-_#ǅ\x00\x1c\x85 ▁"


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) + rng.choice(["", "<|endoftext|>x", "Hello, world's END"]) for _ in range(n)]


def test_chunks_equal_the_library():
    lib, enc = Tokenizer.from_file(BPE), ChunkEncoder(BPE)
    assert enc.chunked and enc.plain
    for t, ids in zip(texts(1500), enc.ids_of(texts(1500)), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, t
    every = "".join(f"x{chr(i)}y {chr(i)} " for i in range(0x180))
    assert np.frombuffer(enc.ids_of([every])[0], "<u4").tolist() == lib.encode(every, add_special_tokens=False).ids


def test_counts_equal_the_library_at_every_prefix():
    lib, c = Tokenizer.from_file(BPE), PrefixCounter(BPE)
    for t in texts(400, 2):
        chunks, counts = c.cumulative(t)
        assert (counts[-1] if counts else 0) == len(lib.encode(t, add_special_tokens=False).ids), t
        for budget in (0, 1, 4, 9):
            cut = c.fitting(t, chunks, counts, budget)
            allowed = [i for i in range(len(t) + 1) if i in (0, len(t), cut) or not (joined(t, i) or any(m.start() < i < m.end() for m in c.special.finditer(t)))]
            assert cut == max(i for i in allowed if i == 0 or len(lib.encode(t[:i], add_special_tokens=False).ids) <= budget), (t, budget)
    for w in ("internationalization", "thonst", "aaaaaaaaaaaaa"):
        assert c.word_prefixes(w) == [len(lib.encode(w[:i], add_special_tokens=False).ids) for i in range(len(w) + 1)]


@pytest.mark.parametrize("unit", ["a1,", "a", "don't", "\u00e9", "\u00e9,\u00df"])
def test_long_texts_without_spaces(unit):
    import time

    lib, c, t = Tokenizer.from_file(BPE), PrefixCounter(BPE), unit * (1_000_000 // len(unit))
    chunks, counts = c.cumulative(t)
    assert counts[-1] == len(lib.encode(t, add_special_tokens=False).ids)
    began = time.process_time()
    cut = c.fitting(t, chunks, counts, 500)
    assert time.process_time() - began < 1
    assert len(lib.encode(t[:cut], add_special_tokens=False).ids) <= 500 < len(lib.encode(t[: cut + 40], add_special_tokens=False).ids)


def test_token_counts_table(spark):
    rows = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "word"), (5, "word " * 3000), (6, "x" * 20000)]
    got = token_counts(documents(spark, rows), BPE, 2048).collect()
    lib = Tokenizer.from_file(BPE)
    by = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got), key=repr)
    assert by == sorted(((i, len(t or ""), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t in rows), key=repr)
    long = next(r for r in got if r.doc_id == 5)
    assert len(lib.encode(rows[5][1][: long.fit_chars], add_special_tokens=False).ids) == 2048
    assert token_counts(documents(spark, []), BPE).count() == 0


def test_sentence_pieces(spark):
    import sentencepiece

    other, codec = sentencepiece.SentencePieceProcessor(model_file=PIECES), PieceCodec(PIECES)
    sample = [*texts(1500, 3), "", " ", "   ", "a  b", "▁", "<s></s><unk>", "x" * 3000]
    codec.verify(PIECES)
    for t, ids in zip(sample, codec.encode(sample), strict=True):
        want = other.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == want, t
        assert codec.decode(ids) == other.decode(want) == codec.library.decode(want, skip_special_tokens=False)
        assert codec.agrees(t, ids)
    assert codec.encode_batch(sample[:50]) == other.encode(sample[:50]) and not codec.differing
    got = {r.doc_id: r for r in coded(documents(spark, [(1, None), (2, ""), (3, "Hé llo\n"), (4, "a▁b")]), PIECES).collect()}
    assert (got[1].n_tokens, got[1].round_trip, got[1].parity, got[1].ids_crc32) == (0, True, True, 0)
    assert got[3].round_trip and got[3].parity and not got[4].round_trip
    assert coded(documents(spark, []), PIECES).count() == 0


def test_patterns_and_least_squares():
    assert patterns(4, 3) == [(4,), (3, 1), (2, 2), (2, 1, 1)]
    rng = np.random.default_rng(1)
    a, x = rng.random((12, 30)), np.maximum(0, rng.normal(size=30))
    got = nnls(a, a @ x)
    assert (got >= 0).all() and np.allclose(a @ got, a @ x, atol=1e-6)


@pytest.mark.parametrize("counts", [{}, {64: 3}, {1: 1000}, {40: 50, 24: 49, 10: 7, 3: 100}, {i: i % 7 for i in range(1, 65)}, {33: 20}])
def test_plan_places_every_piece_once(counts):
    p = plan(counts, 64, grid=4)
    seen, used = {}, {}
    for length, first, n, sequence, each, offset in p.rows:
        for r in range(n):
            assert (length, first + r) not in seen
            seen[length, first + r] = 1
            used.setdefault(sequence + r // each, []).append((offset + r % each * length, length))
    assert len(seen) == sum(counts.values()) and len(used) == p.sequences
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    tokens = sum(k * v for k, v in counts.items())
    assert p.sequences <= max(-(-tokens // 64) * 1.25 + 1, sum(v for k, v in counts.items() if k > 32))


def test_pack(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.choice([0, 3, 20, 60, 150, 300])))) for i in range(150)] + [(7, None), (7, None), (None, "x")]
    got = pack(documents(spark, rows), BPE, 128).collect()
    lib = Tokenizer.from_file(BPE)
    want = []
    for i, t in rows:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(i, k, at, len(part := ids[at : at + 128]), zlib.crc32(np.array(part, "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 128))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128
    assert len(by) <= 1.05 * sum(r.length for r in got) / 128 + 1
    assert pack(documents(spark, []), BPE, 128).count() == 0


def unigram_model(path, prefix=True, squeeze=False):
    """A small unigram model, written field by field: scores by hand, byte pieces, nothing learned."""
    import struct

    def number(n, value):
        return bytes([n << 3 & 0x7F | (0x80 if n > 15 else 0), *([n >> 4] if n > 15 else []), value])

    def block(n, raw):
        size, out = len(raw), []
        while True:
            out.append(size & 127 | (128 if size > 127 else 0))
            size >>= 7
            if not size:
                return bytes([n << 3 | 2, *out]) + raw

    def piece(text, score, kind):
        return block(1, block(1, text.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", score) + number(3, kind))

    words = {"\u2581": -4.0, "\u2581the": -2.0, "\u2581th": -3.5, "e": -3.0, "th": -4.1, "he": -4.0, "t": -5.0, "h": -5.2, "\u2581cat": -3.0, "c": -6.0, "a": -4.5, "at": -4.4, "s": -3.3, "ca": -5.1, "\u00e9": -6.5, "\u2581s": -4.2}
    raw = piece("<unk>", 0, 2) + piece("<s>", 0, 3) + piece("</s>", 0, 3)
    raw += b"".join(piece(f"<0x{i:02X}>", -20.0, 6) for i in range(256)) + b"".join(piece(w, x, 1) for w, x in words.items())
    raw += block(2, number(3, 1) + number(35, 1)) + block(3, block(1, b"identity") + number(3, prefix) + number(4, squeeze) + number(5, 1))
    path.write_bytes(raw)
    return str(path)


@pytest.mark.parametrize(("prefix", "squeeze"), [(True, False), (False, False), (True, True)])
def test_unigram_model(spark, tmp_path, prefix, squeeze):
    import sentencepiece

    path = unigram_model(tmp_path / "small.model", prefix, squeeze)
    theirs, own = sentencepiece.SentencePieceProcessor(model_file=path), PieceCodec(path)
    rng = random.Random(6)
    texts = ["", "the cats", "that chat", " the  cat ", "th\u00e9 \u6c34 cat", "the\ncat\tsat", "e" * 400] + ["".join(rng.choice("the cast\u00e9\u6c34 ") for _ in range(30)) for _ in range(60)]
    assert own.model["unigram"] and own.model["byte_fallback"]
    assert own.encode_batch(texts) == [theirs.encode(t) for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [theirs.encode(t) for t in texts]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, texts[1]), (None, None)]  # repeated rows
    got = coded(documents(spark, rows), path).collect()
    assert len(got) == len(rows) and all(r.parity for r in got) and len({(r.ids_crc32, r.n_tokens) for r in got if r.doc_id == 1}) == 1
    assert all(r.round_trip for r in got if not squeeze)


def spaceless(seed, n, size):
    rng = random.Random(seed)
    return ["".join(chr(rng.randint(0x4E00, 0x5E00)) for _ in range(size)) + rng.choice(["", "。", " the", " a b"]) for _ in range(n)]


def test_texts_without_spaces_are_not_remembered():
    """What workers keep of such texts is bounded in bytes, and results don't depend on what is kept."""
    import sys

    from tokenizers import Tokenizer

    from civigrid.llm import sentencepieces
    from civigrid.llm.tokencount import PrefixCounter
    from civigrid.llm.wordbpe import LONGEST, ChunkEncoder

    texts = spaceless(4, 120, 700) + ["x" * 3000 + "!" * 500, "word " * 50] + ["!" * 100 + str(i) for i in range(20)]
    lib = Tokenizer.from_file(BPE)
    want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    e, c = ChunkEncoder(BPE), PrefixCounter(BPE)
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in e.ids_of(texts)] == want
        assert [c.cumulative(t)[1][-1] for t in texts] == list(map(len, want))
    for kept in (e.known, c.known):
        assert kept and max(map(len, kept)) <= LONGEST and sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in kept.items()) < 20_000
    p = sentencepieces.PieceCodec(PIECES)
    first = p.encode(texts)
    limit, sentencepieces.CACHE_BYTES = sentencepieces.CACHE_BYTES, 100_000
    try:
        for k in range(0, len(texts), 10):
            assert p.encode(texts[k : k + 10]) == first[k : k + 10]
            assert sum(map(len, [*p.known, *p.odd])) + sum(map(len, [*p.known.values(), *p.odd.values()])) < 150_000
    finally:
        sentencepieces.CACHE_BYTES = limit
