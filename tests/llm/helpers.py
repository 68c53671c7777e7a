"""Plain-Python versions of what the operators compute, for small tables."""

import re

DOC = "doc_id long, text string, lang string, source string, n_chars long, kept string, component_id string, row string, n_words string"


def documents(spark, rows):
    """Documents with extra columns whose names clash with those of results; rows are (doc_id, text[, lang[, source]])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1]) if r[1] is not None else None, "k", "c", "r", "n") for r in rows]
    return spark.createDataFrame(full, DOC)


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def groups(ids, linked):
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def near_copies(seed, n, words=120, edits=4):
    import random

    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 999)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(words)] = f"x{rng.randint(0, 999)}"
        out.append(" ".join(w))
    return out
