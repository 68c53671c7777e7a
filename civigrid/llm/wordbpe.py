"""Tokenisation of whole texts with a ``tokenizers`` file, one white-space-delimited chunk at a time.

Chunks are independent of each other when the file's pre-tokenizer never joins characters across white space; then
the ids of a text are the ids of its chunks in turn, and each worker asks the library only once for a repeated chunk.
For any other file the whole text goes to the library.
"""

from __future__ import annotations

import json
import os
import sys
from array import array

from civigrid.llm.common import kept_by, turn

assert sys.byteorder == "little" and array("I").itemsize == 4
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Chunks that a worker remembers, each of at most LONGEST bytes, which bounds the bytes too; when they are reached it
#: forgets all and goes on. Longer ones, as texts without spaces have, are asked for each time (results are the same).
CACHE_CHUNKS, LONGEST = 500_000, 64
_loaded: dict[str, ChunkEncoder] = {}


def splits_at_space(config: dict) -> bool:
    """Whether no token, normalisation step or added token can reach across ASCII white space."""
    pre, norm = config.get("pre_tokenizer") or {}, config.get("normalizer") or {}
    pres = pre.get("pretokenizers", [pre])
    norms = norm.get("normalizers", [norm]) if norm else []
    first = pres[0]
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and "\\s\\p{L}\\p{N}" in first["pattern"].get("Regex", "")
    plain = all(n.get("type") in ("NFC", "Lowercase") or n.get("type") == "Replace" and n["pattern"].get("Regex") == "\\s+" for n in norms)
    added = all(not any(c.isspace() for c in t["content"]) and not t["lstrip"] and not t["rstrip"] and not t["single_word"] for t in config.get("added_tokens", []))
    return bool(drops and plain and added) and config.get("truncation") is None and config.get("padding") is None


#: What ends many words; not the apostrophe, with which contractions begin.
TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def word_and_tail(chunk: str) -> tuple[str, str] | None:
    """A chunk of letters and then punctuation, as the two pre-tokens it has in lower case; None if it is anything else."""
    low = chunk.lower()
    word = low.rstrip(TAIL)
    return (word, low[len(word) :]) if word.isalpha() and max(word) < "\u0180" and "\u0130" not in chunk else None


def has_plain_words(library, config: dict) -> bool:
    """Whether ``word_and_tail`` is how this file lower-cases and divides such chunks."""
    normal = json.dumps(config.get("normalizer"))
    probe = "ab\u00e9" + TAIL
    return '"Lowercase"' in normal and "NFKC" not in normal and [x[1] for x in library.pre_tokenizer.pre_tokenize_str(probe)] == [(0, 3), (3, len(probe))]


def byte_symbols(library) -> dict[int, str]:
    """Each letter below U+0180 as the model's symbols for its bytes."""
    return {ord(c): "".join(w for w, _ in library.pre_tokenizer.pre_tokenize_str(c)) for c in map(chr, range(33, 0x180)) if c.isalpha()}


class ChunkEncoder:
    """``ids(text)`` gives the library's ids (no added special tokens) as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.chunked = splits_at_space(config)
        self.plain = self.chunked and has_plain_words(self.library, config)
        self.symbols = byte_symbols(self.library) if self.plain else {}
        self.tokenize = self.library.model.tokenize
        self.known: dict[bytes, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def _asked(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def ids_of(self, texts: list[str]) -> list[bytes]:
        if not self.chunked:
            return self._asked(texts)
        known, out, held, size = self.known, [], [], 0
        for text in texts:
            raw = text.encode()
            chunks = raw.split()  # ASCII white space only
            held.append((chunks, list(map(known.get, chunks))))
            size += len(raw)
            if size > 1 << 20:
                self._finish(held, out)
                held, size = [], 0
        self._finish(held, out)
        return out

    def _finish(self, held: list[tuple[list[bytes], list[bytes | None]]], out: list[bytes]) -> None:
        """Ask for what isn't known in some texts' chunks, and append the texts' ids to ``out``."""
        gaps = [[i for i, g in enumerate(got) if g is None] for _, got in held]
        new = self._learn({chunks[i] for (chunks, _), at in zip(held, gaps, strict=True) for i in at})
        for (chunks, got), at in zip(held, gaps, strict=True):
            for i in at:
                got[i] = new[chunks[i]]
            out.append(b"".join(got))

    def _word(self, word: str) -> bytes:
        """A plain word's ids by the library's model; normalising and dividing leave such a word as it is."""
        return array("I", [t.id for t in self.tokenize(word if word.isascii() else word.translate(self.symbols))]).tobytes()

    def _learn(self, new: set[bytes]) -> dict[bytes, bytes]:
        """The chunks' ids, remembered from now on; words that return with other punctuation or capitals are asked for once."""
        known, ids, ask = self.known, {}, []
        if len(known) + 2 * len(new) > CACHE_CHUNKS:
            known.clear()
        for c in new:
            two = word_and_tail(c.decode()) if self.plain else None
            if two is None:
                ask.append(c)
                continue
            word, tail = two
            key = word.encode()
            coded = known.get(key)
            if coded is None:
                coded = self._word(word)
                if len(key) <= LONGEST:
                    known[key] = coded
            if tail:
                end = self.tails.get(tail)
                if end is None:
                    end = self._asked([tail])[0]
                    if len(self.tails) < 10_000 and len(tail) <= LONGEST:
                        self.tails[tail] = end
                coded += end
            ids[c] = coded
        ids.update(zip(ask, self._asked([c.decode() for c in ask]), strict=True))
        known.update((c, x) for c, x in ids.items() if len(c) <= LONGEST)
        return ids


def encoder(path: str) -> ChunkEncoder:
    """One encoder for each file and worker process."""
    turn("chunks")
    if path not in _loaded:
        _loaded[path] = ChunkEncoder(path)
    return _loaded[path]


kept_by("chunks", _loaded.clear)
