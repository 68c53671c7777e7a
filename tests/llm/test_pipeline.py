"""The stages against plain Python, and tables that are odd."""

import re
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from civigrid.llm import langid, quality  # noqa: E402
from civigrid.llm.queries import vocabulary  # noqa: E402
from tests.llm.helpers import documents, groups, lower_ascii, near_copies, shingles  # noqa: E402
from tests.llm.test_text import quality_by_hand  # noqa: E402

CLASHES = "removed array<string>, left_words long, `_quality_key` string, accepted boolean, lang_pred string, a string, b string, `row.x` string"


def odd_columns(spark, rows):
    """Documents with further columns, named as the operators name their own."""
    from pyspark.sql import functions as F

    docs = documents(spark, rows)
    return docs.select("*", *(F.lit(None).cast(x.split(" ", 1)[1]).alias(x.split(" ", 1)[0].strip("`")) for x in CLASHES.split(", ")))


def words(rng, sounds, n):
    return " ".join("".join(rng.choice(sounds) for _ in range(3)) for _ in range(n))


def corpus():
    import random

    rng = random.Random(11)
    sounds = {"en": ["the", "ing", "th", "er"], "de": ["sch", "ung", "der", "ei"]}
    rows = [(i, words(rng, sounds[lang], 70), lang, "h") for i in range(90) for lang in [rng.choice(list(sounds))]]
    rows = [(i, f"{t}\nSite menu and IMPRINT" if i % 2 else t, lang, s) for i, t, lang, s in rows]
    rows += [(200 + i, t.replace("w", "the").replace("x", "ing").translate(str.maketrans("0123456789", "abcdefghij")), "en", "k") for i, t in enumerate(near_copies(9, 5, words=300, edits=3))]
    rows += [(300, words(rng, sounds["de"], 9000), "de", "k"), (301, None, "en", "h"), (302, "", None, None), (303, "12 34 ½ " * 40, "en", "k"), (304, "the " * 200, "en", "k"), (None, words(rng, sounds["en"], 80), "en", None), (7, rows[7][1], "en", "h"), (305, words(rng, sounds["en"], 60), None, None)]
    return rows


def cleaned_by_hand(rows):
    """(id, text) of what the quality stage keeps."""
    def key(line):
        return " ".join(re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(line)))

    holders, of = {}, {}
    for n, (i, text, _, host) in enumerate(rows):
        who = ("row", n) if i is None else i
        of.setdefault(host, set()).add(who)
        for line in (text or "").split("\n"):
            if key(line):
                holders.setdefault((host, key(line)), set()).add(who)
    out = []
    for i, text, _, host in rows:
        n, *_, repeat = quality_by_hand(text)
        gone = {k for (h, k), who in holders.items() if h == host and len(who) > quality.LINE_FLOOR and len(who) > quality.LINE_SHARE * len(of[host])}
        lines = (text or "").split("\n")
        left = n - sum(len(key(x).split()) for x in lines if key(x) in gone)
        if n >= 50 and 100 * repeat <= 50 * n and left >= quality.LEFT_WORDS and left >= quality.LEFT_SHARE * n:
            out.append((i, "\n".join(x for x in lines if not key(x) or key(x) not in gone)))
    return out


def language_by_hand(model, text):
    """The language and its probability, one subword at a time."""
    total, n = np.zeros(len(model.languages)), 0
    for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
        for part in "".join(c if c.isalpha() else " " for c in word).split():
            for at in langid.subwords(part):
                total, n = total + model.table[at], n + 1
    if not n or not model.languages:
        return "und", 0.0
    z = (total / n + model.bias) / model.temperature
    p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    return model.languages[int(p.argmax())], float(p.max())


def test_language_forward_pass_by_hand(spark):
    rng = np.random.default_rng(2)
    model = langid.Model(["aa", "bb", "cc"], rng.normal(size=(langid.BUCKETS, 3)).astype(np.float32), rng.normal(size=3), 0.7, 0.45)
    texts = ["Abc def", "½² 12", "x" * 5000, "水火 abc½def Été", "", None, "a_b a1b", "abc " * 3000]
    got = {r.doc_id: r for r in langid.identify(documents(spark, list(enumerate(texts)) + [(0, texts[0])]), model).collect()}
    for i, t in enumerate(texts):
        lang, p = language_by_hand(model, t)
        assert got[i].lang_pred == lang and abs(got[i].score - p) < 1e-6 and got[i].accepted == (lang != "und" and p >= 0.45)


def test_stages_against_plain_python(spark, tmp_path):
    rows = corpus()
    docs = odd_columns(spark, rows)
    folder = str(tmp_path)
    one = corpus_pipeline.quality(spark, docs, folder)
    assert one.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in one.collect()), key=repr)
    assert kept == sorted(cleaned_by_hand(rows), key=repr) and (1, rows[1][1].split("\n")[0]) in kept and not {301, 302} & {i for i, _ in kept}
    two = corpus_pipeline.language(spark, one, folder)
    assert two.columns == docs.columns
    model = langid.train(one)
    fine = [(i, t) for i, t in kept for lang, p in [language_by_hand(model, t)] if lang != "und" and p >= model.threshold]
    spoken = sorted(((r.doc_id, r.text) for r in two.collect()), key=repr)
    assert spoken == sorted(fine, key=repr) and 303 not in {i for i, _ in spoken} and len(spoken) > 80
    three = corpus_pipeline.near_dedup(spark, two, folder)
    assert three.columns == docs.columns
    sets = {i: shingles(t, 5) for i, t in spoken if i is not None}
    first = groups(list(sets), lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    once = sorted((r.doc_id for r in three.collect()), key=repr)
    assert once == sorted([i for i in first if first[i] == i] + [None], key=repr) and 200 in once and not {201, 202, 203, 204} & set(once)
    packed = corpus_pipeline.packing(spark, three, folder).collect()
    from tokenizers import Tokenizer

    lib, texts = Tokenizer.from_file(vocabulary("word_bpe_49k.json")), {r.doc_id: r.text for r in three.collect()}
    sizes = Counter()
    for r in packed:
        sizes[r.doc_id] += r.length
    assert sizes == Counter({i: len(lib.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts.items()})
    places = {}
    for r in packed:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        assert [x for x, _ in sorted(p)] == [sum(n for _, n in sorted(p)[:k]) for k in range(len(p))] and sum(n for _, n in p) <= 2048


def test_stages_on_odd_tables(spark, tmp_path):
    for rows in ([], [(1, None, None, None), (1, None, None, None), (None, None, None, None), (2, "", "en", "h")]):
        docs = odd_columns(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:3]:
            assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert corpus_pipeline.quality(spark, docs, str(tmp_path)).count() == corpus_pipeline.language(spark, docs, str(tmp_path)).count() == 0
        assert corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).count() == (3 if rows else 0)  # one of each id, and the row without one
        assert corpus_pipeline.packing(spark, docs, str(tmp_path)).count() == len(rows)


def test_run(spark, tmp_path):
    documents(spark, corpus()).write.parquet(str(tmp_path / "documents.parquet"))
    ids = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {0, 89, 200, None} <= ids and not ids & {201, 202, 203, 204, 301, 302, 303}
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_dedup", "packing"] and corpus_pipeline.ORACLE_SQL is None
