"""Rule tables compiled to columns: a score, the reasons that hold, the labels whose pattern is found.

Each table becomes one projection of its row; nothing is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[Column, float, Column | str]


def _lit(x: Column | str) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def holds(c: Column) -> Column:
    """A condition with null as false."""
    return F.coalesce(c, F.lit(False))


def present(items: list[Column]) -> Column:
    """The non-null of some string columns, in order."""
    return F.filter(F.array(*items).cast("array<string>"), lambda x: x.isNotNull())


def score(rules: list[Rule]) -> Column:
    """The sum of the weights of the rules that hold, as a double, in the rules' order."""
    total = F.lit(0.0)
    for condition, weight, _ in rules:
        total = total + F.when(holds(condition), F.lit(float(weight))).otherwise(F.lit(0.0))
    return total


def reasons(rules: list[Rule]) -> Column:
    return present([F.when(holds(condition), _lit(reason)) for condition, _, reason in rules])


def has_any(text: Column, terms: list[str]) -> Column:
    """Whether a text has any of some terms, also within words."""
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(text, F.lit(t))
    return holds(out)


def word_pattern(inner: str) -> str:
    """A case-insensitive pattern between borders of ASCII words (Java's ``\\b`` sees letters beyond ASCII as word characters)."""
    return rf"(?i)(?<![A-Za-z0-9_]){inner}(?![A-Za-z0-9_])"


def matches(text: Column, inner: str) -> Column:
    return holds(text.rlike(word_pattern(inner)))


def stem(inner: str) -> str:
    """What every text with a pattern of words has in it; all but the letters that may be missing at its end."""
    if not re.fullmatch(r"[a-z ]+\??", inner):
        raise ValueError(f"{inner} isn't words in lower case with perhaps one optional letter at the end")
    return inner[:-2] if inner.endswith("?") else inner


def found(text: Column, patterns: list[str]) -> Column:
    """Whether a text in lower case has any of the patterns; the expression is only tried on texts with a pattern's stem."""
    return holds(has_any(text, [stem(p) for p in patterns]) & text.rlike(word_pattern("(?:" + "|".join(patterns) + ")")))


def labels(text: Column, patterns: dict[str, str]) -> Column:
    """The labels of the patterns that a text in lower case has, in the table's order."""
    return present([F.when(found(text, [p]), F.lit(label)) for label, p in patterns.items()])


def jaccard(a: Column, b: Column) -> Column:
    """Common over all distinct elements of two arrays; 0 if either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))
