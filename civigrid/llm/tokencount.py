"""Exact token counts by prefix dynamic programming over a byte-pair-encoding vocabulary with word ends.

For a word of symbols c1..cn the encoding of the open prefix c1..ci is the encoding of a shorter prefix followed by one
token that ends at i, and there is exactly one such token that the two merge sequences leave untouched at their border.
So one table entry for each prefix (its last token and its count) is filled from earlier entries, and the count of the
prefix taken as a whole word needs one more step with tokens that carry the word end. Nothing is encoded twice: a text's
counts are kept at the end of every chunk, and inside the chunk where a budget is passed the table of the word there has
the count at every character, so truncation and budgets are answered by looking up.
"""

from __future__ import annotations

import bisect
import itertools
import json
import re
import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civigrid.llm.common import kept_by, portions, small_batches, turn
from civigrid.llm.wordbpe import CACHE_CHUNKS, LONGEST, byte_symbols, has_plain_words, splits_at_space, word_and_tail

ASCII_WORDS = re.compile(r"[a-z]+|[0-9]|[^a-z0-9\s]+")
_loaded: dict[str, PrefixCounter] = {}


class PrefixCounter:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        model = config["model"]
        if model["type"] != "BPE" or not splits_at_space(config) or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("prefix counts need a byte-pair encoding whose words end at white space")
        library = Tokenizer.from_file(path)
        self.normal = library.normalizer.normalize_str if library.normalizer else str
        self.pre = library.pre_tokenizer.pre_tokenize_str
        self.plain = has_plain_words(library, config)
        self.symbols = byte_symbols(library)
        self.plain_ascii = self.plain and [w for w, _ in self.pre(self.normal("Ab12--3c"))][:5] == ["ab", "1", "2", "--", "3"]
        self.special = re.compile("|".join(re.escape(t["content"]) for t in config.get("added_tokens", [])) or r"(?!)")
        self.end = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        names = list(dict.fromkeys(itertools.chain(model["vocab"], map("".join, merges))))
        ids = {t: i for i, t in enumerate(names)}
        self.rank, parts = {}, {}
        for r, (a, b) in enumerate(merges):
            self.rank[ids[a], ids[b]] = r
            parts.setdefault(ids[a + b], (r, ids[a], ids[b]))
        # The spines: the tokens at a token's right (left) border, outermost first, each with the rank that forms it and the rank that uses it up.
        self.right, self.left = {}, {}
        for i in range(len(names)):
            for spines, side in ((self.right, 2), (self.left, 1)):
                spine, t, until = [], i, len(merges)
                while t in parts:
                    spine.append((t, parts[t][0], until))
                    until = parts[t][0]
                    t = parts[t][side]
                spines[i] = [*spine, (t, -1, until)]
        self.alone = {i for i in range(len(names)) if i not in parts or self._apart(parts[i][1], parts[i][2], parts[i][0])}
        self.open_trie, self.closed_trie = {}, {}
        for t, i in ids.items():
            if i in self.alone and (i in parts or len(t.removesuffix(self.end) if self.end else t) == 1):
                closed = bool(self.end) and t.endswith(self.end)
                node = self.closed_trie if closed or not self.end else self.open_trie
                for c in reversed(t[: -len(self.end)] if closed else t):
                    node = node.setdefault(c, {})
                node[""] = i
        if not self.end:
            self.open_trie = self.closed_trie
        #: Of the last so many prefixes at least one is a later prefix's but for its last token, so the least of them bounds all later counts.
        self.longest = max((len(t) for t in ids), default=1)
        self.fits: dict[tuple[int, int], bool] = {}
        self.known: dict[bytes, int] = {}
        self.tails: dict[str, int] = {}

    def _apart(self, a: int, b: int, below: int | None = None) -> bool:
        """Whether no merge crosses the border of tokens ``a`` and ``b`` (before rank ``below``)."""
        rank = self.rank
        for x, made, used in self.right[a]:
            for y, made_y, used_y in self.left[b]:
                r = rank.get((x, y))
                if r is not None and made < r < used and made_y < r <= used_y and (below is None or r < below):
                    return False
        return True

    def _step(self, trie: dict, word: str, end: int, last: list[int], count: list[int]) -> tuple[int, int]:
        """The last token and the count of ``word[:end]``, whose shorter prefixes are in the tables."""
        node, fits = trie, self.fits
        for at in range(end - 1, -1, -1):
            node = node.get(word[at])
            if node is None:
                break
            token = node.get("")
            if token is None:
                continue
            if at == 0:
                return token, 1
            pair = (last[at], token)
            ok = fits.get(pair)
            if ok is None:
                if len(fits) > 4 * CACHE_CHUNKS // 8:
                    fits.clear()
                ok = fits[pair] = self._apart(*pair)
            if ok:
                return token, count[at] + 1
        raise ValueError(f"no token ends {word[:end]!r}")

    def open_table(self, word: str, upto: int) -> tuple[list[int], list[int]]:
        last, count = [-1], [0]
        for i in range(1, upto + 1):
            t, n = self._step(self.open_trie, word, i, last, count)
            last.append(t)
            count.append(n)
        return last, count

    def word(self, word: str) -> int:
        """Tokens of one pre-token."""
        last, count = self.open_table(word, len(word) - 1)
        return self._step(self.closed_trie, word, len(word), last, count)[1]

    def word_prefixes(self, word: str) -> list[int]:
        """Tokens of each of its prefixes taken as a whole word, from the empty one on."""
        last, count = self.open_table(word, len(word) - 1)
        return [0, *(self._step(self.closed_trie, word, i, last, count)[1] for i in range(1, len(word) + 1))]

    def chunk(self, text: str) -> int:
        """Tokens of a text, by its words; strings of special tokens are one token each, as in the library."""
        two = word_and_tail(text) if self.plain and text else None
        if two is not None:
            word, tail = two
            key = word.encode()
            n = self.known.get(key)
            if n is None:
                n = self.word(word if word.isascii() else word.translate(self.symbols))
                if len(key) <= LONGEST:
                    self.known[key] = n
            return n + (self.tail(tail) if tail else 0)
        total, at = 0, 0
        for m in self.special.finditer(text):
            total += 1 + self.plain_part(text[at : m.start()])
            at = m.end()
        return total + self.plain_part(text[at:])

    def plain_part(self, text: str) -> int:
        """Tokens of a text without strings of special tokens; a pre-token that returns is counted once."""
        if self.plain_ascii and text.isascii() and text.isprintable() and "'" not in text:  # the same words without their places
            words = ASCII_WORDS.findall(text.lower())
        else:
            words = [w for w, _ in self.pre(self.normal(text))]
        return sum(n * self.word(w) for w, n in Counter(words).items())

    def tail(self, tail: str) -> int:
        n = self.tails.get(tail)
        if n is None:
            n = self.word(tail)
            if len(self.tails) < 10_000 and len(tail) <= LONGEST:
                self.tails[tail] = n
        return n

    def cumulative(self, text: str) -> tuple[list[bytes], list[int]]:
        """The white-space chunks of a text, and the exact count after each."""
        chunks, known = text.encode().split(), self.known
        got = list(map(known.get, chunks))
        if None in got:
            if len(known) > CACHE_CHUNKS:
                known.clear()
            long: dict[bytes, int] = {}  # of this text alone
            for i, n in enumerate(got):
                if n is None:
                    c = chunks[i]
                    kept = known if len(c) <= LONGEST else long
                    n = kept.get(c)
                    if n is None:
                        n = kept[c] = self.chunk(c.decode())
                    got[i] = n
        return chunks, list(itertools.accumulate(got))

    def fitting(self, text: str, chunks: list[bytes], counts: list[int], budget: int) -> int:
        """Characters of the longest prefix of ``text`` that has at most ``budget`` tokens, by the places where it may be cut.

        These are all places but those inside a special token and between characters that normalising joins.
        """
        if not counts or counts[-1] <= budget:
            return len(text)
        k = bisect.bisect_right(counts, budget)
        at = -1
        for m in itertools.islice(re.finditer(r"[^\x20\x09-\x0D]+", text), k, k + 1):
            at = m.start()
        return at + self.within(chunks[k].decode(), budget - (counts[k - 1] if k else 0))

    def within(self, own: str, budget: int) -> int:
        """The same for one chunk; a long one is read only as far as the budget goes."""
        size = 64 + 8 * max(0, budget)
        while True:
            size = min(size, len(own))
            for m in self.special.finditer(own, max(0, size - 256), min(len(own), size + 256)):
                if m.start() < size < m.end():
                    size = m.end()
            while size < len(own) and joined(own, size):
                size += 1
            best, settled = self._cut(own[:size], budget)
            if settled or size == len(own):
                return best
            size *= 4

    def by_character(self, w: str, part: str) -> list[int]:
        """Tokens of each prefix of a pre-token, which has the symbols ``w`` and the characters ``part``, from the empty one on."""
        if part[0] == "'" and len(part) > 1 and part[1].isalpha():  # a contraction: its prefixes are divided otherwise
            return [self.chunk(part[:x]) for x in range(len(part) + 1)]
        table = self.word_prefixes(w)
        sizes = (1 if len(w) == len(part) else len(c.encode()) for c in part)
        return [table[x] for x in itertools.accumulate(sizes, initial=0)]

    def _cut(self, text: str, budget: int) -> tuple[int, bool]:
        """The last place of ``text`` where its prefix keeps the budget, and whether no text after it can change that."""
        best = total = at = 0
        for m in itertools.chain(self.special.finditer(text), [None]):
            own = text[at : m.start() if m else len(text)]
            normal = self.normal(own)
            ends = places(own, normal, self.normal)
            words = self.pre(normal)
            for i, (w, (start, end)) in enumerate(words):
                n = self.word(w)
                if total + n <= budget and end in ends:
                    total += n
                    best = at + ends[end]
                    continue
                inside = self.by_character(w, normal[start:end])
                best = max([best, *(at + ends[start + x] for x, y in enumerate(inside) if total + y <= budget and start + x in ends)])
                total += n
                if total > budget:
                    return best, m is not None or i + 1 < len(words) or min(inside[-self.longest :]) + total - n > budget
            if m is not None:
                total += 1
                if total > budget:
                    return best, True
                best = at = m.end()
        return best, False


def joined(text: str, i: int) -> bool:
    """Whether normalising may join character ``i`` with the one before it: marks, vowels and finals of Hangul, white space after white space."""
    c = text[i]
    return unicodedata.category(c)[0] == "M" or "\u1160" <= c <= "\u11ff" or c.isspace() and text[i - 1].isspace()


def places(text: str, normal: str, normalise) -> dict[int, int]:
    """For each place in the normal form where the text may be cut, the place in the text."""
    if text.isascii() and len(text) == len(normal):
        return dict(zip(range(len(text) + 1), range(len(text) + 1), strict=True))
    starts = [i for i in range(len(text)) if i == 0 or not joined(text, i)]
    parts = [normalise(text[i:j]) for i, j in itertools.pairwise([*starts, len(text)])]
    if "".join(parts) != normal:
        return {0: 0, len(normal): len(text)}
    return dict(zip(itertools.accumulate(map(len, parts), initial=0), [*starts, len(text)], strict=True))


def counter(path: str) -> PrefixCounter:
    turn("counts")
    if path not in _loaded:
        _loaded[path] = PrefixCounter(path)
    return _loaded[path]


kept_by("counts", _loaded.clear)


def token_counts(docs: DataFrame, tokenizer: str, budget: int = 2048) -> DataFrame:
    """For each row: doc_id, n_bytes, n_tokens, over_limit (more than ``budget``) and fit_chars, the characters that fit.

    ``fit_chars`` is where the text can be cut so that the cut text has at most ``budget`` tokens; it is found in the
    stored counts (of several such places the last). A null or empty text has 0 of each; a very long text, with spaces or
    without, costs in proportion to its length. Repeated rows give repeated rows, an empty table none; other columns are ignored.
    """
    small_batches(docs.sparkSession)

    def count(batches):
        c = counter(tokenizer)
        for b in portions(batches):
            texts = [x or "" for x in b.column(1).to_pylist()]
            sizes, tokens, fits = [], [], []
            for t in texts:
                chunks, counts = c.cumulative(t)
                sizes.append(len(t.encode()))
                tokens.append(counts[-1] if counts else 0)
                fits.append(c.fitting(t, chunks, counts, budget))
            n = pa.array(tokens, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), n, pa.array([x > budget for x in tokens], pa.bool_()), pa.array(fits, pa.int64())], names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")
