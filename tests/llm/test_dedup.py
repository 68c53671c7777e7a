import os
import numpy as np
import pytest

from civigrid.llm import minhash
from civigrid.llm.components import Forest, components
from civigrid.llm.minhash import deduplicated, near_duplicates
from civigrid.llm import rabitq
from civigrid.llm.rabitq import Coder, Codes, join_up, linked, near_vectors, rotation, undecided
from tests.llm.helpers import documents, groups, near_copies, shingles


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, 200), (200, 150), (7, 7), (300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 31)}, 100: 100, 150: 100, 200: 100, 300: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    f = Forest()
    for a, b in ((3, 1), (2, 3), (1, 2)):
        f.tie(a, b, (a, b))
    assert len(f.ties) == 2 and f.top(3) == 1


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, k, percent):
    monkeypatch.setattr(minhash, "BLOCK", 3)  # buckets are dealt into several blocks
    texts = near_copies(1, 25) + near_copies(2, 12, edits=9) + near_copies(3, 3) + ["", None, "One", "one", "a b", "A B", " \t\n", "long " * 5000, "long " * 5001]
    texts += [texts[0], texts[0].upper(), texts[0]]
    rows = [(3 * i + 5, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in near_duplicates(documents(spark, rows), k, percent).collect()}
    sets = {i: shingles(t, k) for i, t in rows}
    want = groups(list(sets), lambda a, b: bool(sets[a]) and bool(sets[b]) and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]))
    assert {i: got[i].component_id for i in sets} == want
    assert all(got[i].n_shingles == len(sets[i]) and got[i].kept == (want[i] == i) for i in sets)
    kept = deduplicated(documents(spark, rows), k, percent)
    assert kept.columns == documents(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in want if want[i] == i)


def test_near_duplicates_odd_tables(spark):
    assert near_duplicates(documents(spark, [])).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "q r s t u v"), (2, "x y z 1 2 3"), (None, "a b c d e f"), (3, None), (4, "q r s t u v")]
    got = [(r.doc_id, r.component_id, r.kept) for r in near_duplicates(documents(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted([(1, 1, True), (1, 1, True), (2, 2, True), (2, 2, True), (None, None, True), (3, 3, True), (4, 2, False)], key=repr)
    assert sorted(r.doc_id or 0 for r in deduplicated(documents(spark, rows)).collect()) == [0, 1, 2, 3]


def test_signatures():
    s = minhash.shingles("a b c d a b c e", 3)
    assert (np.unique(s) == s).all() and len(s) == 5
    h = minhash.Hashes(400)
    a, b = minhash.shingles(" ".join(map(str, range(900))), 1), minhash.shingles(" ".join(map(str, range(300, 1200))), 1)
    assert abs((h.signature(a) == h.signature(b)).mean() - 0.5) < 0.1


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "k") for i, v, label in rows], "vec_id long, embedding array<float>, label int, kept string")


def test_near_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows = []
    for label in (0, 1):
        for _ in range(6):
            base = rng.normal(size=32)
            rows += [(base + rng.normal(size=32) * rng.choice([0.05, 0.13, 0.2]), label) for _ in range(12)]
    rows += [(rows[0][0], 0)] * 5 + [(rows[0][0] * 3, 0), (rows[0][0], 1), (rows[0][0], None)]
    data = [(10 + 2 * i, [float(np.float32(x)) for x in v], label) for i, (v, label) in enumerate(rows)]
    odd = [(1, None, 0), (2, [0.0] * 32, 0), (3, [None] + [1.0] * 31, 0), (4, [float("nan")] * 32, 0), (5, [float("inf")] * 32, 0), (6, [], 0), (7, [1.0, 2.0], 0), (8, [2.0, 4.0], 0)]
    got = {r.vec_id: r for r in near_vectors(vectors(spark, data + odd), 0.98).collect()}
    fine = {i: (np.array(v), label) for i, v, label in [*data, *odd[-2:]]}

    def linked(a, b):
        (x, p), (y, q) = fine[a], fine[b]
        return p is not None and p == q and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98

    want = groups(list(fine), linked)
    for i in fine:
        assert (got[i].component_id, got[i].kept, got[i].n_links) == (want[i], want[i] == i, sum(linked(i, j) for j in fine if j != i))
    assert all(got[i].n_links == 0 and got[i].kept and got[i].component_id == i for i in range(1, 7))
    assert near_vectors(vectors(spark, [])).count() == 0
    odd = [(4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (4, [0.0, 1.0], 1), (2, [0.0, 1.0], 1)]
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(vectors(spark, odd)).collect()]
    assert sorted(got, key=repr) == sorted([(4, 1, 2, False), (4, 1, 2, False), (None, 0, None, True), (4, 1, 2, False), (2, 1, 2, True)], key=repr)


def test_near_vectors_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(rabitq, "BLOCK", 7)  # buckets are dealt into pairs of blocks
    rng = np.random.default_rng(8)
    base = rng.normal(size=24)
    data = [(i, [float(x) for x in np.float32(base + rng.normal(size=24) * 0.06)], 1) for i in range(60)]
    got = {r.vec_id: r.n_links for r in near_vectors(vectors(spark, data)).collect()}
    x = np.array([v for _, v, _ in data])
    x /= np.linalg.norm(x, axis=1)[:, None]
    assert got == dict(enumerate((x @ x.T >= 0.98).sum(axis=1) - 1))


def test_codes_bound_and_estimate():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + rng.normal(size=x.shape) * 0.02
    spin = rotation(64, 0)
    assert np.allclose(spin @ spin.T, np.eye(64))
    c = Codes(Coder(64, 12, 9).records(np.concatenate([x, 3 * y])), 64)
    assert c.runs.shape == (800, 9) and c.runs.max() < 1 << 12
    i, j = np.arange(400), np.arange(400, 800)
    near = linked(np.concatenate([x, y]), i, j, 0.98)
    assert 200 < near.sum() and c.open_pairs(i, j, 0.98, 0.0)[near].all()
    far = x @ x[::-1].T
    guess = (c.o[:400] @ c.q[:400][::-1].T) / c.f[:400, None]
    assert abs((guess - far)[np.abs(far) < 0.5].mean()) < 0.01
    a, b = c.open_block(i, j, 0.98, 0.0)
    assert set(zip(i[near], j[near], strict=True)) <= set(zip(a, b, strict=True))


@pytest.mark.parametrize("listed", [1, 32])
def test_codes_decide_what_is_computed_again(monkeypatch, listed):
    monkeypatch.setattr(rabitq, "LISTED", listed)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 48))
    x = np.concatenate([centres[k] + rng.normal(size=(20, 48)) * s for k in range(6) for s in (0.05, 0.3)])
    c = Codes(Coder(48, 40 % 31, 4).records(x), 48)
    n = len(x)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    true = {(i, j) for i, j in zip(*np.nonzero(unit @ unit.T >= 0.98), strict=True) if i < j}
    again = [p for i, j in undecided(c, np.zeros(n, int), np.full(n, 2), np.zeros(n, int), 0.98, 0.0) for p in zip(i.tolist(), j.tolist(), strict=True)]
    assert len(set(again)) == len(again) and true <= set(again)
    assert len(again) < 0.2 * n * (n - 1) / 2 and min((unit @ unit.T)[i, j] for i, j in again) > 0.75  # the codes settle the others
    real = linked(x, *np.array(again).T, 0.98)
    assert {p for p, r in zip(again, real, strict=True) if r} == true
    # In a later run, pairs that share an earlier one are left out.
    later = [p for i, j in undecided(c, np.zeros(n, int), np.full(n, 2), np.full(n, 3), 0.98, 0.0) for p in zip(i.tolist(), j.tolist(), strict=True)]
    assert set(later) == {(i, j) for i, j in again if not (c.runs[i, :3] == c.runs[j, :3]).any()}
    # A pair of blocks has the pairs with a row of each.
    side = np.arange(n) % 2
    crossing = [p for i, j in undecided(c, np.zeros(n, int), side, np.zeros(n, int), 0.98, 0.0) for p in zip(i.tolist(), j.tolist(), strict=True)]
    assert {tuple(sorted(p)) for p in crossing} == {p for p in again if side[p[0]] != side[p[1]]}


def test_join_up():
    label = np.arange(9)
    join_up(label, np.array([8, 3, 5, 1]), np.array([3, 5, 8, 2]))
    assert label.tolist() == [0, 1, 1, 3, 4, 3, 6, 7, 3]


def test_known_sizes_spare_the_counting_and_spread_as_before(spark, monkeypatch):
    from civigrid.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 4)
    rows = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 9 + [2] * 3 + [3, None])], "k long, i long")
    single = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "k long, v string")
    sizes = spark.createDataFrame([(1, 9), (2, 3)], "k long, n long")
    wanted = sorted((r.k, r.i, r.v) for r in common.spread(rows, single, "k", by="i").collect())
    assert sorted((r.k, r.i, r.v) for r in common.spread(rows, single, "k", by="i", total=14, sizes=sizes).collect()) == wanted
    assert len(wanted) == 12


def test_a_dropped_table_is_gone_and_others_stay(spark):
    from civigrid.llm import common

    gone, stays = (common.written(spark.range(5), "t") for _ in range(2))
    folder = gone.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    common.dropped(gone)
    assert not os.path.exists(folder)
    assert stays.count() == 5


def test_signatures_and_sets_are_shuffled_at_every_size(spark):
    from civigrid.llm import minhash

    texts = [(i, " ".join(f"w{(i // 2) * 90 + j + (i % 2) * (j > 57)}" for j in range(60))) for i in range(6)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    signed = minhash.signed(docs, 5, 36).cache()
    pairs = signed.alias("x").crossJoin(signed.alias("y")).where("x.doc_id < y.doc_id").selectExpr("x.doc_id u", "y.doc_id v", "x.key a", "y.key b")
    # Signatures that only some need are made from their sets again; pairs meet the last bytes of minima, a quarter of them.
    sets = minhash.full_sets(docs, signed, 5, 36)
    assert sorted(map(tuple, sets.select("key", "signature").collect())) == sorted((r.key, r.signature) for r in signed.collect())
    short = minhash.shortened(signed)
    assert {len(r.bytes) for r in short.collect()} == {180}
    assert {(r.u, r.v) for r in minhash.likely(pairs, short, 120).collect()} == {(0, 1), (2, 3), (4, 5)}
    plan = minhash.beside(pairs, short, "bytes")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2
