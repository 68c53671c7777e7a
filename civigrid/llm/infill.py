"""Fill-in-the-middle: a text is cut in three and its pieces are put in another order between markers.

A text is decoded to a numpy array of code points (UTF-32). Neighbouring code points of different classes have a unit's
border between them; ``flatnonzero`` over windows gives the borders, the two ranks that a row's hash chooses are looked
up among them, and the slices are encoded again. Where each code point is a class of its own, units are code points.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civigrid.llm.common import portions, small_batches

#: What stands before the prefix, the suffix and the middle.
MARKERS = ("<P>", "<S>", "<M>")
#: Texts of a hundred that stay plain, and of the others those with the suffix first.
PLAIN_PERCENT, SUFFIX_FIRST_PERCENT = 10, 20
UNITS = ("code_point", "word", "line")
#: Code points whose classes are compared at a time, which bounds what a very long text takes beside itself.
WINDOW = 1 << 20
#: The code points of white space that separate words.
SPACES = np.array([9, 10, 11, 12, 13, 32], np.uint32)


def code_points(raw: bytes) -> np.ndarray:
    """A text's code points; a byte that isn't UTF-8 counts as one."""
    return np.frombuffer(raw.decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32)


def encoded(codes: np.ndarray) -> bytes:
    return codes.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogateescape")


def classes(codes: np.ndarray, unit: str) -> np.ndarray:
    """A class for each code point; neighbours of one class are in one unit."""
    if unit == "word":
        return np.isin(codes, SPACES)
    if unit == "line":
        return np.cumsum(np.concatenate(([False], codes[:-1] == 10)))
    return np.arange(len(codes))


def borders(codes: np.ndarray, at: int, unit: str) -> np.ndarray:
    """Places in the window from ``at`` where a unit begins, counted from ``at``."""
    if not at:
        kinds = classes(codes[:WINDOW], unit)
        return np.concatenate(([0], np.flatnonzero(kinds[1:] != kinds[:-1]) + 1))
    kinds = classes(codes[at - 1 : at + WINDOW], unit)
    return np.flatnonzero(kinds[1:] != kinds[:-1])


class Units:
    """A text's units: how many there are, and where each begins."""

    def __init__(self, codes: np.ndarray, unit: str):
        self.codes, self.unit = codes, unit
        self.upto = np.cumsum([0, *(len(borders(codes, at, unit)) for at in range(0, len(codes), WINDOW))])
        self.n = int(self.upto[-1])

    def start(self, rank: int) -> int:
        if rank >= self.n:
            return len(self.codes)
        k = int(np.searchsorted(self.upto, rank, "right")) - 1
        return k * WINDOW + int(borders(self.codes, k * WINDOW, self.unit)[rank - self.upto[k]])


def draws(seed: str, key: str) -> list[int]:
    """Four numbers of 32 bits from a row's hash."""
    digits = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def infill(raw: bytes, key: str, seed: str, unit: str, markers: tuple[bytes, bytes, bytes], plain: int, suffix_first: int) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, code points of prefix and middle (null if plain), and the output."""
    codes = code_points(raw)
    units = Units(codes, unit)
    h1, h2, h3, h4 = draws(seed, key)
    if not raw or any(m in raw for m in markers) or h3 % 100 >= 100 - plain:
        return units.n, "plain", None, None, raw
    low, high = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    a, b = units.start(low), units.start(high)
    prefix, middle, suffix = encoded(codes[:a]), encoded(codes[a:b]), encoded(codes[b:])
    p, s, m = markers
    if h4 % 100 < suffix_first:
        return units.n, "spm", a, b - a, b"".join((s, suffix, p, prefix, m, middle))
    return units.n, "psm", a, b - a, b"".join((p, prefix, s, suffix, m, middle))


def check_markers(markers: tuple[str, str, str]) -> None:
    """Markers must be found again in the output: none may hold another, or begin as one ends."""
    for i, x in enumerate(markers):
        for j, y in enumerate(markers):
            if not x or (i != j and x in y) or any(x.endswith(y[:k]) for k in range(1, min(len(x), len(y)))):
                raise ValueError(f"markers overlap: {x!r} and {y!r}")


def transformed(docs: DataFrame, *, seed: str = "1", unit: str = "code_point", markers: tuple[str, str, str] = MARKERS, plain_percent: int = PLAIN_PERCENT, suffix_first_percent: int = SUFFIX_FIRST_PERCENT, key: str = "doc_id", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row with n (units of its text), form, prefix_chars, middle_chars and output.

    Form is plain if the text is empty or null, holds a marker, or is drawn to be; else psm or, for the drawn share of
    them, spm. A row's draws depend on the seed and ``key`` alone (a null one counts as empty), so repeated rows have equal
    results. Texts of any length are cut as wholes; bytes that aren't UTF-8 come back as they were. Columns that aren't kept are ignored; kept
    ones must not have a result's name. An empty table gives an empty one.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}")
    check_markers(markers)
    small_batches(docs.sparkSession)
    source = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("_raw"), *keep)
    marks = tuple(m.encode() for m in markers)
    made = ["n", "form", "prefix_chars", "middle_chars", "output"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        for b in portions(batches):
            rows = [infill(raw.as_py(), k.as_py(), seed, unit, marks, plain_percent, suffix_first_percent) for k, raw in zip(b.column(0), b.column(1), strict=True)]
            columns = zip(*rows, strict=True) if rows else [[]] * len(made)
            yield pa.RecordBatch.from_arrays([*b.columns[2:], *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=[*keep, *made])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema)
    out = source.mapInArrow(cut, f"{own}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that gave an output, from the output and its form alone."""
    p, s, m = markers

    def between(start: str, end: str) -> Column:
        return F.substring_index(F.substring_index(output, end, 1), start, -1)

    middle = F.substring_index(output, m, -1)
    return F.when(form == "psm", F.concat(between(p, s), middle, between(s, m))).when(form == "spm", F.concat(between(p, m), middle, between(s, p))).otherwise(output)
