"""SentencePiece encoding and decoding on the ``tokenizers`` library.

The model protobuf is read field by field, and normaliser, white-space marker, scores or merges, and byte fallback are
rebuilt. A unigram model keeps its scores; in a byte-pair model the score orders the merges. Where no piece holds the
marker after another character, words are independent: each worker asks the library once for a repeated word, for many
new words in one batch of joined strings. The ids of every document are compared with those that the sentencepiece
library gives for it as a whole.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civigrid.llm.common import kept_by, portions, small_batches, turn

MARK = "▁"
NORMAL, UNK, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Words that a worker remembers, and bytes that they and their ids take; when either is reached it forgets all and goes on.
CACHE_WORDS, CACHE_BYTES, ENTRY = 600_000, 160 << 20, 150
#: Characters of a string of new words, and of the texts that are compared at a time.
JOINED, COMPARED = 20_000, 1 << 20
_loaded: dict[str, PieceCodec] = {}


def fields(raw: bytes):
    """(number, value) of each field of a protobuf message; messages and strings as bytes."""
    at, end = 0, len(raw)

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < end:
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            n = varint()
            value = raw[at : at + n]
            at += n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value = struct.unpack("<d" if kind == 1 else "<f", raw[at : at + n])[0]
            at += n
        else:
            raise ValueError(f"field kind {kind}")
        yield key >> 3, value


def parse(path: str) -> dict:
    """Pieces (text, score, kind) and the settings of a model file that bear on encoding; unset ones have the format's defaults."""
    with open(path, "rb") as f:
        raw = f.read()
    out = {"pieces": [], "unigram": True, "byte_fallback": False, "charsmap": b"", "prefix": True, "squeeze": True, "escape": True, "suffix": False}
    for number, value in fields(raw):
        if number == 1:
            piece = dict(fields(value))
            out["pieces"].append((piece.get(1, b"").decode(), piece.get(2, 0.0), piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(fields(value))
            kind = trainer.get(3, 1)
            if kind not in (1, 2):
                raise ValueError("only unigram and byte-pair models are supported")
            out |= {"unigram": kind == 1, "byte_fallback": bool(trainer.get(35, 0)), "suffix": bool(trainer.get(24, 0))}
        elif number == 3:
            norm = dict(fields(value))
            out |= {"charsmap": norm.get(2, b""), "prefix": bool(norm.get(3, 1)), "squeeze": bool(norm.get(4, 1)), "escape": bool(norm.get(5, 1))}
    return out


class PieceCodec:
    def __init__(self, path: str):
        from tokenizers import Regex, Tokenizer, decoders, normalizers
        from tokenizers.models import BPE, Unigram

        self.other, self.differing = None, 0  # the sentencepiece library's model, and how many texts it gave other ids for
        self.model = m = parse(path)
        if not m["escape"] or m["suffix"]:
            raise ValueError("only models that mark white space in front of words are supported")
        pieces = m["pieces"]
        vocab = {p: i for i, (p, _, _) in enumerate(pieces)}
        unk = next((i for i, p in enumerate(pieces) if p[2] == UNK), 0)
        if m["unigram"]:
            core = Unigram([(p, s) for p, s, _ in pieces], unk_id=unk, byte_fallback=m["byte_fallback"])
        else:
            usable = {p: s for p, s, k in pieces if k in (NORMAL, USER)}
            merges = []
            for p, s in usable.items():
                for i in range(1, len(p)):
                    if p[:i] in usable and p[i:] in usable:
                        merges.append((-s, vocab[p], vocab[p[:i]], vocab[p[i:]], p[:i], p[i:]))
            merges.sort()
            core = BPE(vocab, [x[4:] for x in merges], unk_token=pieces[unk][0], fuse_unk=True, byte_fallback=m["byte_fallback"])
        self.library = Tokenizer(core)
        steps = [normalizers.Precompiled(m["charsmap"])] if m["charsmap"] else []
        if m["squeeze"]:
            steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
            steps += [normalizers.Prepend(" ")] if m["prefix"] else []
        steps += [normalizers.Replace(" ", MARK)]
        self.plain = not m["charsmap"]
        self.library.normalizer = normalizers.Sequence(steps)
        self.library.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *([decoders.Strip(" ", 1, 0)] if m["prefix"] else [])])
        # Pieces that cross into a further word would tie words together; runs of marks belong to the word they precede.
        self.by_word = self.plain and not m["squeeze"] and all(MARK not in p.lstrip(MARK) and (len(p) == len(p.lstrip(MARK)) or len(p) - len(p.lstrip(MARK)) == 1 or not p.strip(MARK)) for p, _, k in pieces if k in (NORMAL, USER))
        self.raw = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else p.replace(MARK, " ").encode() for p, _, k in pieces]
        #: Whether a piece opens a word; in joined words every piece that does is a word's first.
        self.opens = np.array([p.startswith(MARK) for p, *_ in pieces])
        self.by_word = self.by_word and MARK in vocab
        self.known: dict[bytes, bytes] = {}  # by the word without its one marker in front
        self.held = 0  # bytes that both take
        self.odd: dict[str, bytes] = {}  # other runs: several markers, markers alone, a start without one
        self.words = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

    def given(self, text: str) -> str:
        """A text as the library gets it: with the space that stands in front of every text that isn't empty.

        Where the model squeezes spaces, the normaliser adds it once that is done.
        """
        return " " + text if text and self.model["prefix"] and not self.model["squeeze"] else text

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        """Ids by the library, by all its threads at once."""
        return [e.ids for e in self.library.encode_batch_fast([self.given(t) for t in texts], add_special_tokens=False)]

    def verify(self, path: str) -> None:
        """Load the sentencepiece library's model, once."""
        if self.other is None:
            import sentencepiece

            self.other = sentencepiece.SentencePieceProcessor(model_file=path)

    def agrees(self, text: str, ids: bytes) -> bool:
        return self.agree([text], [ids])[0]

    def agree(self, texts: list[str], ids: list[bytes]) -> list[bool]:
        """Whether the sentencepiece library gives these ids for each text as a whole."""
        out, at = [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (size < COMPARED or end == at):
                size += len(texts[end])
                end += 1
            theirs = self.other.encode(texts[at:end], num_threads=2)
            out += [x == np.frombuffer(own, "<u4").tolist() for x, own in zip(theirs, ids[at:end], strict=True)]
            at = end
        self.differing += out.count(False)
        return out

    def divided(self, text: str) -> list:
        """The words of a text: bytes of a word that one marker precedes, and other runs as strings with their markers."""
        raw = text.encode()
        if self.model["prefix"] and raw and b"  " not in raw and raw[:1] != b" " and raw[-1:] != b" " and MARK.encode() not in raw:
            return raw.split(b" ")
        return [w[1:].encode() if w[0] == MARK and len(w) > 1 and w[1] != MARK else w for w in self.words.findall(self.given(text).replace(" ", MARK))]

    def _alone(self, words: list[str]) -> list[list[int]]:
        """Ids of words, each asked for by itself."""
        return [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, new: list[bytes]) -> None:
        """Ask for new words, many of them joined in each string; the pieces that open words divide the ids again."""
        strings, at = [], 0
        while at < len(new):
            end, size = at, 0
            while end < len(new) and (size < JOINED or end == at):
                size += len(new[end])
                end += 1
            strings.append(new[at:end])
            at = end
        texts = [MARK + MARK.join(w.decode() for w in part) for part in strings]
        own = [np.array(e.ids, "<u4") for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        for part, ids in zip(strings, own, strict=True):
            first = np.flatnonzero(self.opens[ids])
            if len(first) != len(part):
                self.known.update(zip(part, (np.array(x, "<u4").tobytes() for x in self._alone([MARK + w.decode() for w in part])), strict=True))
                continue
            raw, ends = ids.tobytes(), (4 * np.append(first[1:], len(ids))).tolist()
            begin = 0
            for w, end in zip(part, ends, strict=True):
                self.known[w] = raw[begin:end]
                begin = end

    def encode(self, texts: list[str]) -> list[bytes]:
        """The same ids as little-endian unsigned 32-bit bytes, by way of the remembered words where words are independent."""
        if not self.by_word:
            return [np.array(x, "<u4").tobytes() for x in self.encode_batch(texts)]
        held, size, out = [], 0, []
        for t in texts:
            held.append(self.divided(t))
            size += len(t)
            if size > 1 << 20:
                self._finish(held, out)
                held, size = [], 0
        self._finish(held, out)
        return out

    def _finish(self, held: list[list], out: list[bytes]) -> None:
        known, odd = self.known, self.odd
        distinct = set().union(*held)
        new = distinct.difference(known)
        new.difference_update(odd)
        size = sum(5 * len(w) + ENTRY for w in new)
        if len(known) + len(odd) + len(new) > CACHE_WORDS or self.held + size > CACHE_BYTES:
            known.clear()
            odd.clear()
            new = distinct
            self.held, size = 0, sum(5 * len(w) + ENTRY for w in new)
        self.held += size
        self._learn([w for w in new if isinstance(w, bytes)])
        runs = [w for w in new if isinstance(w, str)]
        odd.update(zip(runs, (np.array(x, "<u4").tobytes() for x in self._alone(runs)), strict=True))
        for words in held:
            got = list(map(known.get, words))
            if None in got:
                got = [odd[w] if g is None else g for w, g in zip(words, got, strict=True)]
            out.append(b"".join(got))

    def decode(self, ids: bytes) -> str:
        """The text of ids: pieces, bytes put together (a broken sequence becomes U+FFFD), without the space in front."""
        raw = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        if self.model["prefix"] and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode(errors="replace")


def codec(path: str) -> PieceCodec:
    turn("pieces")
    if path not in _loaded:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        _loaded[path] = PieceCodec(path)
    return _loaded[path]


kept_by("pieces", _loaded.clear)


def coded(docs: DataFrame, model: str) -> DataFrame:
    """For each document: doc_id, n_tokens, ids_crc32, n_bytes_fallback, round_trip, parity.

    ``round_trip``: decoding gives the text back. ``parity``: the ids equal those that the sentencepiece library gives
    for the document as a whole. A null text counts as empty; an empty text has no
    tokens; a very long text is handled like any other. Repeated rows give repeated rows; other columns are ignored.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        c = codec(model)
        c.verify(model)
        fallback = np.array([k == BYTE for *_, k in c.model["pieces"]])
        for b in portions(batches):
            texts = [t or "" for t in b.column(1).to_pylist()]
            ids = c.encode(texts)
            arrays = [np.frombuffer(x, "<u4") for x in ids]
            sums = [zlib.crc32(x) for x in ids]
            parity = c.agree(texts, ids)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(a) for a in arrays], pa.int64()), pa.array(sums, pa.int64()), pa.array([int(fallback[a].sum()) for a in arrays], pa.int64()), pa.array([c.decode(x) == t for x, t in zip(ids, texts, strict=True)], pa.bool_()), pa.array(parity, pa.bool_())],
                names=["doc_id", "n_tokens", "ids_crc32", "n_bytes_fallback", "round_trip", "parity"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, n_bytes_fallback long, round_trip boolean, parity boolean")
