import os
import re
from collections import Counter

import duckdb
import pytest

from civigrid.llm import langid, licenses, quality, queries, urlfilter
from civigrid.llm.lmscore import lm_scores
from tests.llm.helpers import documents, lower_ascii


def quality_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + d for i, w in enumerate(windows) if counts[w] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)


CASES = ["", None, "a", "a b c a b c a b c", "x x x x x x", "one two\none two\n \none two ", "é\u00a0ü # * $ | <>\r\n\x0bz", "a b c d a b c e " * 40, "w " * 60, "\n\n", "tab\tsep\x0cff", "p q r " + "s t u " * 2 + "p q r"]


def test_measures():
    for t in CASES:
        assert quality.measures(t or "") == quality_by_hand(t)


def filler(i, n=60):
    return " ".join(f"u{i}w{j}" for j in range(n))


def test_lines_above_the_limit_go(spark):
    menu, long = "Home About  CONTACT", " ".join(f"m{i}" for i in range(40))
    rows = [(i, f"{filler(i)}\n{menu if i % 2 else menu.lower()}\n{long}", "en", "big") for i in range(12)]
    rows += [(20 + i, f"{filler(20 + i)}\n{menu}", "en", f"h{i}") for i in range(12)]  # as often, but on other hosts
    rows += [(40, " ".join(["Home about contact"] * 1) + "\n" + filler(40, 5), "en", "big")]
    rows += [(50 + i, "\n".join(f"copied line {k} of text" for k in range(20)), "en", "big") for i in range(12)]  # plain copies are documents too
    rows += [(90, f"{filler(90)}\nonly here", "en", "big")] * 8  # repeated rows are one document
    rows += [(70, "Home about contact\n" * 30 + "x", "en", "big"), (71, None, "en", "big"), (72, "", None, None), (5, rows[5][1], "en", "big")]
    docs = documents(spark, rows)
    got = [r for r in quality.quality_rules(docs, floor=5, share=0.0).collect()]
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert all(by[i].kept and by[i].left_words == 60 for i in range(12)) and all(by[20 + i].left_words == 63 for i in range(12))
    assert all(by[50 + i].left_words == 0 and not by[50 + i].kept for i in range(12)) and by[90].left_words == 62
    assert by[70].left_words == 1 and not by[70].kept and by[71].base_failed and not by[72].kept
    for r in got:
        text = next(t for i, t, *_ in rows if i == r.doc_id)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == quality_by_hand(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    kept = {r.doc_id: r for r in quality.clean(docs, floor=5, share=0.0).collect()}
    assert kept.keys() == {r.doc_id for r in got if r.kept}
    assert kept[3].text == filler(3) and kept[3].n_chars == len(kept[3].text) and kept[20].text == rows[12][1]
    assert quality.clean(docs).columns == docs.columns and quality.quality_rules(documents(spark, [])).count() == 0


@pytest.mark.parametrize("words", [31, 500])
def test_lines_of_every_length_count(spark, words, tmp_path):
    import corpus_pipeline

    notice = " ".join(f"m{i}" for i in range(words))
    rows = [(i, f"{filler(i)}\n{notice}", "en", "big") for i in range(80)]
    rows += [(100 + i, f"{filler(100 + i)}\n{notice}", "en", f"h{i}") for i in range(60)]  # one on each host
    rows += [(200 + i, f"{filler(200 + i)}\n{notice if i < 11 else 'other'}", "en", "even") for i in range(550)]  # 2 of 100 are not more than the share
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op7_quality_rules(spark, str(tmp_path)).collect()}
    assert all(got[i].left_words == 60 and got[i].kept == (words < 140) for i in range(80))
    assert all(got[100 + i].left_words == 60 + words for i in range(60))
    assert all(got[200 + i].left_words == (60 + words if i < 11 else 60) for i in range(550))
    texts = {r.doc_id: r.text for r in corpus_pipeline.quality(spark, documents(spark, rows), str(tmp_path)).collect()}
    assert texts.keys() == {i for i in got if got[i].kept} and texts.get(1) == (filler(1) if words < 140 else None) and texts[100] == rows[80][1]


def test_equal_documents_count_each(spark):
    rows = [(i, f"{filler(1)}\nCopyright of the site", "en", "big") for i in range(80)] + [(100 + i, f"{filler(100 + i)}\ncopyright  of THE site", "en", "big") for i in range(3)]
    got = {r.doc_id: r for r in quality.quality_rules(documents(spark, rows)).collect()}
    assert all(got[i].left_words == 0 and not got[i].kept for i in range(80)) and all(got[100 + i].left_words == 60 and got[100 + i].kept for i in range(3))


def test_by_key_spreads_frequent_keys(spark, monkeypatch):
    from pyspark.sql import functions as F

    from civigrid.llm import common

    rows = spark.range(3000).select(F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.col("id").cast("string")).alias("k"))
    single = spark.createDataFrame([("hot", 1), ("5", 2), ("none", 3)], "k string, v int")
    for how in ("inner", "left"):
        wanted = sorted(map(repr, rows.join(single, "k", how).select("n", "v").collect()))
        assert sorted(map(repr, common.spread(rows, single, "k", how=how, by="n").select("n", "v").collect())) == wanted
        assert sorted(map(repr, common.by_key(rows, single, "k", how=how, spread_by="n").select("n", "v").collect())) == wanted


def test_language(spark):
    import random

    rng = random.Random(1)
    sounds = {"en": ["the", "ing", "th", "er"], "de": ["sch", "ung", "der", "ei"], "fr": ["eau", "que", "oi", "le"]}
    rows = [(i, " ".join("".join(rng.choice(sounds[lang]) for _ in range(3)) for _ in range(40)), lang) for i in range(600) for lang in [rng.choice(list(sounds))]]
    odd = [(1000, None, "en"), (1001, "", "en"), (1002, "123 !! 4 \u00bd \u00b2 \u2167 _", "fr"), (None, rows[0][1], "en"), (1003, rows[1][1], None), (1004, rows[1][1] * 300, None)]
    got = {r.doc_id: r for r in langid.identify(documents(spark, rows + odd), per_language=100).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and not got[i].accepted for i in (1000, 1001, 1002))
    held = [got[i] for i, *_ in rows if got[i].held_out]
    assert 150 < len(held) < 250 and not got[None].held_out
    assert sum(r.lang_pred == next(x[2] for x in rows if x[0] == r.doc_id) for r in held) >= 0.97 * len(held)
    assert got[1003].lang_pred == got[1004].lang_pred == rows[1][2] and 0 <= got[1003].score <= 1
    assert all(r.lang_pred == "und" for r in langid.identify(documents(spark, [(1, "abc", None)])).collect())
    assert langid.identify(documents(spark, [])).count() == 0
    kept = langid.accepted(documents(spark, rows + odd), 100)
    assert kept.columns == documents(spark, []).columns and kept.where("doc_id IN (1000, 1001, 1002)").count() == 0 and kept.count() >= 0.97 * len(rows)


def test_lm_scores(spark):
    rows = [(i, ("the cat sat on the mat " if i % 2 else "#$% zqx 0017 ") * 5) for i in range(40)] + [(50, None), (51, ""), (None, "the cat"), (52, "the cat sat on the mat")]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 30)] + [(1, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in lm_scores(documents(spark, rows), labels).collect()}
    assert got[50].score is None and got[51].n_tokens == 0
    assert all(got[i].score < got[j].score for i in (1, 35, 52) for j in (0, 36))
    flat = lm_scores(documents(spark, rows), labels.limit(0)).collect()
    assert {r.score for r in flat} == {0.0, None} and lm_scores(documents(spark, []), labels).count() == 0


def lm_by_hand(rows, good):
    """Scores from plain counters over all documents."""
    import math

    from civigrid.llm.lmscore import BACKOFF, TOKEN

    texts = {i: [*w, None] if w else [] for i, w in ((i, TOKEN.findall(t or "")) for i, t in rows)}
    counts = [Counter(), Counter()]
    for i, w in texts.items():
        for a, b in zip([None, *w], w, strict=False):
            counts[i in good].update([("word", b), ("context", a), ("pair", a, b)])
    kinds = len({k for c in counts for k in c if k[0] == "word"})
    b_sum, t_sum = (sum(n for k, n in c.items() if k[0] == "word") for c in counts)

    def loss(c, scale, t_sum, a, b):
        low = (c["word", b] * scale + 1) / (t_sum + kinds)
        return -math.log2((c["pair", a, b] * scale + BACKOFF * low) / (c["context", a] * scale + BACKOFF))

    out = {}
    for i, w in texts.items():
        own = Counter(k for a, b in zip([None, *w], w, strict=False) for k in (("word", b), ("context", a), ("pair", a, b)))
        t, b = counts[1].copy(), counts[0].copy()
        (t if i in good else b).subtract(own)
        n_t, n_b = t_sum - len(w) * (i in good), b_sum - len(w) * (i not in good)
        out[i] = sum(loss(t, 1, n_t, x, y) - loss(b, n_t / n_b, n_t, x, y) for x, y in zip([None, *w], w, strict=False)) / len(w) if w else None
    return out


def test_lm_losses_of_a_token(spark):
    """By hand: target "a b" twice, background "a c" and "d"; the vocabulary is a, b, c, d and the end."""
    import math

    rows = [(1, "a b"), (2, "a b"), (3, "a c"), (4, "d")]
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    got = {r.doc_id: (r.n_tokens, r.score) for r in lm_scores(documents(spark, rows), labels).collect()}
    # Document 1 is scored by the other target document (3 tokens) and by the background (5 tokens, scaled by 3 / 5).
    k, v, s = 8.0, 5, 3 / 5

    def loss(pair, word, context, f=1.0, total=3):
        return -math.log2((pair * f + k * (word * f + 1) / (total + v)) / (context * f + k))

    target = loss(1, 1, 1) + loss(1, 1, 1) + loss(1, 1, 1)  # start a, a b, b end
    background = loss(1, 1, 2, s) + loss(0, 0, 1, s) + loss(0, 2, 0, s)
    assert got[1][0] == 2 and abs(got[1][1] - (target - background) / 3) < 1e-9 and got[1] == got[2]
    # Document 4 is scored by the target (6 tokens) and by document 3 (3 tokens, scaled by 2).
    target = loss(0, 0, 2, 1, 6) + loss(0, 2, 0, 1, 6)
    background = loss(0, 0, 1, 2, 6) + loss(0, 1, 0, 2, 6)
    assert abs(got[4][1] - (target - background) / 2) < 1e-9


def test_lm_scores_by_words(spark, monkeypatch):
    import random

    from civigrid.llm import lmscore

    monkeypatch.setattr(lmscore, "CHUNK_CHARS", 2000, raising=False)
    rng = random.Random(4)
    phrases = ["red fox", "old dog", "big cat", "wet hen"]  # targets keep each pair's order, the others swap it: the same words

    def text(swap):
        return ", ".join(" ".join(p.split()[:: -1 if swap else 1]) for p in rng.choices(phrases, k=12))

    rows = [(i, text(i % 2)) for i in range(120)] + [(200, ""), (201, None), (202, " \n"), (203, "\u6c34\u706b red. fox"), (204, "fox")]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)], "doc_id long, quality int")
    got = {r.doc_id: r for r in lm_scores(documents(spark, rows), labels).collect()}
    assert max(got[i].score for i in range(60, 120, 2)) < min(got[i].score for i in range(61, 120, 2)) - 1
    wanted = lm_by_hand(rows, {i for i in range(60) if i % 2 == 0})
    assert got.keys() == wanted.keys() and got[203].n_tokens == 5
    assert all(got[i].score is None if x is None else abs(got[i].score - x) < 1e-5 for i, x in wanted.items())


def licenses_by_hand(text, templates=licenses.TEMPLATES):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))
    found = [(i, label) for label, ws in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(ws)] == list(ws)]
    labels, best = {x for _, x in found}, 0.0
    for name, t in templates.items():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(t))
        s = set(w)
        for i in range(0, len(words), len(w)):
            if 5 * len(s & set(words[i : i + 2 * len(w)])) >= 4 * len(s):
                labels.add(name)
                best = max(best, len(s & set(words[i : i + 2 * len(w)])) / len(s))
    at = [i for i, _ in found]
    return len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found})), ",".join(sorted(labels)), 1.0 if found else best


def license_rows(spark, rows, templates=None):
    return sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in licenses.scan(documents(spark, rows), templates).collect()), key=repr)


def test_licenses(spark):
    texts = ["", None, "MIT License", "mit-license mit\nlicense; General Public License 3 Apache license", "license mit", "É mit license é", "Licensed under CC BY-NC 4.0.", "licensed under cc by nc", "a\nLicensed under the Apache License, Version 2.0.\nb", "word " * 3000 + "general public license", "LICENSE", "public license", "This software and associated documentation files: permission is hereby granted, free of charge, to any person obtaining a copy", "mitlicense mit license license"]
    rows = list(enumerate(texts)) + [(2, texts[2]), (None, texts[3])]
    assert license_rows(spark, rows) == sorted(((i, *licenses_by_hand(t)) for i, t in rows), key=repr)
    assert licenses.scan(documents(spark, [])).count() == 0


def test_licenses_wrapped_shuffled_and_long(spark):
    import random
    import textwrap

    rng, rows, whole = random.Random(5), [], {}
    for name, t in licenses.TEMPLATES.items():
        w = t.split()
        for k in range(6):
            before = " ".join(rng.choice(["x", "the", "software", "of"]) for _ in range(rng.choice([0, 1, 17, 333])))
            own = list(w)
            if k == 1:
                rng.shuffle(own)
            if k == 2:  # some words fall out, so some of these pass and some don't
                own = [x for x in own if rng.random() > 0.2]
            if k == 3:  # spread too far apart
                own = [y for x in own for y in (x, "fill", "er", "s")]
            body = textwrap.fill(" ".join(own), 60, initial_indent=" * ", subsequent_indent=" * ") if k != 4 else " ".join(own)
            if k in (0, 1, 4):
                whole[len(rows)] = name
            rows.append((len(rows), f"{before}\n{body}\n{' z' * rng.choice([0, 5, 900])}"))
    rows += [(1000, "\n\n".join(licenses.TEMPLATES.values()) * 3), (1001, "the of and software license " * 20000), (1002, rows[0][1]), (1002, rows[0][1])]
    got = license_rows(spark, rows)
    assert got == sorted(((i, *licenses_by_hand(t)) for i, t in rows), key=repr)
    by = {r[0]: r for r in got}
    assert all(name in by[i][6].split(",") and by[i][7] == 1 for i, name in whole.items())
    own = {"one": "alpha beta gamma delta epsilon", "none": " . ", "two": "Alpha BETA"}
    rows = [(1, "x beta y alpha"), (2, "alpha " * 9 + "beta gamma delta"), (3, "alpha q q q q beta")]
    assert license_rows(spark, rows, own) == sorted(((i, *licenses_by_hand(t, {k: v for k, v in own.items() if k != "none"})) for i, t in rows), key=repr)
    assert {r[6] for r in license_rows(spark, rows, {})} == {""}


def url_by_hand(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = lower_ascii(re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host) :], re.S)[0]
    fit = [(len(h + p), h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_urls(spark):
    urls = [None, "", "nope", "://", "http://ORG", "http://a.ORG/x", "https://example.org/es/1?q", "https://www.example.org/en/12#x", "http://example.org/en/2", "http://notexample.org/en/1", "ftp://a.b.com/de/x://y", "http://com/fr/?a", "http://x.com/FR/", "http://org:80/", "http://u@example.org/es/", "http://example.org?/es/", "http://a..org/\nb", "http://.org/", "http://org./"]
    rows = [(i, u, "h", "p") for i, u in enumerate(urls)] + [(5, urls[5], "h", "p"), (None, urls[6], "h", "p")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, path string")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urlfilter.filter_urls(pages, urlfilter.rules_of(spark, queries.URL_RULES)).collect()), key=repr)
    assert got == sorted(((i, *url_by_hand(u)) for i, u, *_ in rows), key=repr)
    assert urlfilter.filter_urls(pages.limit(0), urlfilter.rules_of(spark, queries.URL_RULES)).count() == 0


def test_urls_with_many_rules(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "BROADCAST_ROWS", 2)  # the join is a shuffle, and most pages ask for the same expressions
    rows = [(i, f"http://s{i % 7}.com/{'de' if i % 3 else 'fr'}/{i}") for i in range(900)] + [(1000, None), (1001, "http://x.com/" + "a/" * 30000), (1002, "http://" + "a." * 500 + "com/de/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urlfilter.filter_urls(pages, urlfilter.rules_of(spark, queries.URL_RULES)).collect())
    assert [(x[0], x[3] or "", x[4]) for x in got] == [(i, w[2] or "", w[3]) for i, u in sorted(rows) for w in [url_by_hand(u)]]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    df = queries.queries()[name](spark, sf)
    wanted = con.sql(queries.oracle_sql()[name])
    order = sorted(df.columns)
    assert sorted(wanted.columns) == order
    assert sorted(map(repr, (tuple(r[c] for c in order) for r in df.collect()))) == sorted(map(repr, wanted.select(", ".join(order)).fetchall()))


def test_language_rows_are_bounded_in_bytes(monkeypatch):
    """300 languages, many words, and runs of letters as long as a text: the same means whatever is kept."""
    import numpy as np

    rng = np.random.default_rng(1)
    model = langid.Model([f"l{i:03}" for i in range(300)], rng.normal(size=(langid.BUCKETS, 300)).astype(np.float32), np.zeros(300))
    texts = [" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}q" for i in range(k, k + 400)) for k in range(0, 2000, 200)] + ["漢字" * 700, "か" * 5000 + " kana"]
    free = langid.Scorer(model)
    want = [free.mean(t) for t in texts]
    monkeypatch.setattr(langid, "CACHE_BYTES", 1 << 20)
    monkeypatch.setattr(langid, "GATHERED", 1 << 20)
    tight = langid.Scorer(model)
    for t, w in zip(texts * 2, want * 2, strict=True):
        assert np.allclose(tight.mean(t), w, atol=1e-5)
        assert tight.rows.nbytes <= 4 << 20 and tight.held <= 2 << 20
    by_hand = np.array([model.table[b] for w in langid.words_of(texts[-1]) for b in langid.subwords(w)]).mean(axis=0)
    assert np.allclose(want[-1], by_hand, atol=1e-5)
