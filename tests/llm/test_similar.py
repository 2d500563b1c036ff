"""Similarity joins, components and neighbours against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendgroups.llm import jaccard, lattice
from spendgroups.llm.components import connected_components
from spendgroups.llm.neighbours import nearest_neighbours


def parts_of(links, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("case", ["random", "chain", "star", "none", "self"])
def test_components(spark, case):
    rng = random.Random(3)
    links = {
        "random": [(rng.randint(-50, 50), rng.randint(-50, 50)) for _ in range(45)],
        "chain": [(i, i + 1) for i in range(12)],
        "star": [(0, i) for i in range(1, 30)] * 2,
        "none": [],
        "self": [(5, 5), (5, None)],
    }[case]
    found = connected_components(spark.createDataFrame(links, "a long, b long"))
    real = [(a, b) for a, b in links if b is not None and a != b]
    assert {r.id: r.label for r in found.collect()} == parts_of(real, {x for p in real for x in p})


def words(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def changed(rng, text, edits):
    w = text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = rng.choice("xyz") * rng.randint(1, 3)
    return " ".join(w)


def near_copies(rng, groups, sizes, edits):
    texts = []
    for _ in range(groups):
        base = " ".join("".join(rng.choice("abcdefg") for _ in range(4)) for _ in range(rng.choice(sizes)))
        texts += [base] + [changed(rng, base, rng.randint(0, edits)) for _ in range(rng.randint(0, 6))]
    return texts


def test_jaccard_equals_brute_force(documents):
    rng = random.Random(9)
    texts = [None, "", " \n", "one", "ONE", "one two", "a b c d e", "a b c d e f", "É b c d", "é b c d"]
    texts += near_copies(rng, 60, [5, 6, 8, 9, 10, 12, 20, 40, 90, 200], 5)
    texts += ["w" + " w" * 30_000, "same words here and again " * 200]
    sets = [shingles(t) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    assert len(links) > 50
    part = parts_of(links, range(len(sets)))
    rows = jaccard.jaccard_components(documents(texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {
        i: (len(s), part[i]) for i, s in enumerate(sets)
    }


def test_similar_sets_always_share_a_signature():
    """Any two sets of similarity 0.8 or more, of every size band, and just at the limit."""
    rng = np.random.default_rng(4)
    for n in [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 15, 18, 23, 31, 50, 77, 120, 300, 900]:
        for _ in range(40):
            base = np.unique(rng.integers(0, 1 << 63, n + n // 3, np.uint64))
            x = base[:n]
            cut = rng.integers(0, n // 5 + 1)
            most = (5 * (n - cut)) // 4 - n
            more = rng.integers(0, max(0, min(most, len(base) - n)) + 1)
            y = np.r_[x[cut:], base[n : n + more]]
            common = len(np.intersect1d(x, y))
            assert 100 * common >= 80 * len(np.union1d(x, y))
            assert np.intersect1d(jaccard.signatures(x), jaccard.signatures(np.sort(y))).size


def test_large_groups_are_split(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rng = random.Random(1)
    base = " ".join(f"w{i}" for i in range(120))
    texts = [changed(rng, base, 1) for _ in range(40)] + [base] * 5
    rows = jaccard.jaccard_components(documents(texts)).collect()
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i in range(45) for j in range(i)
             if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    part = parts_of(links, range(45))
    assert {r.doc_id: r.component_id for r in rows} == part


def test_jaccard_without_ids_repeats_and_empty_table(documents):
    docs = documents(["a b c d e f g"] * 3 + ["x"], ids=[None, 4, 4, None])
    rows = {(r.doc_id, r.component_id) for r in jaccard.jaccard_components(docs).collect()}
    assert rows == {(None, 4), (4, 4), (None, None)}
    assert jaccard.jaccard_components(docs).count() == 4
    assert jaccard.jaccard_components(docs.limit(0)).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, key string")


def test_nearest_points_are_lattice_points_and_nearest():
    x = np.random.default_rng(1).normal(size=(300, 8)) * 2
    points = lattice.nearest_points(x)
    steps = lattice.shortest_steps()
    assert len(steps) == 240
    twice = points * 2
    assert (twice == np.rint(twice)).all() and (points.sum(axis=1) % 2 == 0).all()
    best = ((x - points) ** 2).sum(axis=1)
    for step in steps:
        assert (best <= ((x - points - step) ** 2).sum(axis=1) + 1e-9).all()


def test_near_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK", 16)
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(300, 32))
    for _ in range(150):
        a = rows[rng.integers(0, len(rows))]
        noise = rng.normal(size=32)
        noise -= noise @ a / (a @ a) * a
        noise *= np.linalg.norm(a) / np.linalg.norm(noise)
        cosine = rng.uniform(0.88, 1.0)
        rows = np.r_[rows, [cosine * a + np.sqrt(1 - cosine**2) * noise]]
    rows = np.r_[rows, np.repeat(rows[:1], 40, axis=0)].astype(np.float32)
    table = vectors(spark, [(i, [float(c) for c in r], "k") for i, r in enumerate(rows)])
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1)[:, None]
    true = unit @ unit.T >= 0.9
    np.fill_diagonal(true, False)
    found = {r.vec_id: r for r in lattice.near_duplicates(table).collect()}
    n = np.array([found[i].n_links for i in range(len(rows))])
    assert (n <= true.sum(axis=1)).all() and n.sum() >= 0.97 * true.sum()
    assert found[len(rows) - 1].component_id == found[0].component_id
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_small_groups_are_checked_many_at_a_time():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 8))
    sizes = [2] * 2000 + [1, 5, 70, 3, 90]
    rows, groups = [], []
    for g, size in enumerate(sizes):
        two = g % 3 == 0 and size > 2
        for _ in range(size):
            v = base[rng.integers(0, 40)] + rng.normal(size=8) * 0.3
            rows.append((g, 0, int(two), int(two and rng.random() < 0.5), len(rows), int(rng.random() < 0.5), v.tolist()))
    names = ["cell", "block_i", "block_j", "side", "key", "own", "embedding"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int8(), pa.list_(pa.float64())]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
    table = pa.RecordBatch.from_arrays(columns, names)
    cut = [table.slice(i, 777) for i in range(0, len(rows), 777)]
    found = list(lattice._verify(iter(cut), 0.9))
    # One by one, they were as many batches as groups with links.
    assert len(found) < 10
    true = set()
    unit = np.array([r[6] for r in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    start = 0
    for g, size in enumerate(sizes):
        for i in range(start, start + size):
            for j in range(i + 1, start + size):
                two_blocks = rows[i][1] != rows[i][2]
                if (rows[i][5] or rows[j][5]) and (not two_blocks or rows[i][3] != rows[j][3]):
                    if unit[i] @ unit[j] >= 0.9:
                        true.add((i, j))
        start += size
    pairs = [p for b in found for p in zip(*b.to_pydict().values())]
    assert len(pairs) == len(set(pairs)) and set(pairs) == true and len(true) > 50


ODD = [(1, None, "k"), (2, [], "k"), (3, [0.0, 0.0], "k"), (4, [1.0, None], "k"),
       (5, [float("nan"), 1.0], "k"), (6, [float("inf"), 1.0], "k"), (7, [1.0, 0.0], "k"),
       (8, [2.0, 0.0], "k"), (9, [2.0, 0.0], "k"), (None, [1.0, 0.0], "k"), (10, [1.0, 0.0, 0.0], "k"),
       (7, [1.0, 0.0], "k")]


def test_near_vectors_odd_rows(spark):
    rows = lattice.near_duplicates(vectors(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    by_id = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows}
    assert all(by_id[i] == (0, i, True) for i in (1, 2, 3, 4, 5, 6, 10))
    assert by_id[7] == (4, 7, True) and by_id[8] == (4, 7, False) and by_id[None] == (4, 7, False)
    assert lattice.near_duplicates(vectors(spark, [])).count() == 0


def test_neighbours_odd_rows(spark):
    found = nearest_neighbours(vectors(spark, ODD), F.col("vec_id") >= 7, nearest=3).collect()
    listed = {}
    for r in sorted(found):
        listed.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert listed == {
        7: [(1, 8, 2.0), (2, 9, 2.0)],
        8: [(1, 9, 4.0), (2, 7, 2.0)],
        9: [(1, 8, 4.0), (2, 7, 2.0)],
    }
    assert nearest_neighbours(vectors(spark, []), F.col("vec_id") > 0).count() == 0


def test_neighbours_recall_and_order(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 24)) * 2
    x = (centres[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 24))).astype(np.float32)
    x[2000:2100] = x[0]
    rows = vectors(spark, [(i, [float(c) for c in v], "k") for i, v in enumerate(x)])
    found = nearest_neighbours(rows, F.col("vec_id") % 50 == 0, nearest=20, parts=8, sample=2000)
    by_query = {}
    for r in sorted(found.collect()):
        by_query.setdefault(r.query_id, []).append((r.vec_id, r.score))
    scores = x.astype(float) @ x.astype(float).T
    hits = 0
    for q in range(0, 3000, 50):
        order = sorted((-scores[q, j], j) for j in range(3000) if j != q)[:20]
        got = by_query[q]
        assert len(got) == 20 and all(abs(s - scores[q, j]) < 1e-9 for j, s in got)
        assert got == sorted(got, key=lambda p: (-p[1], p[0]))
        hits += len({j for _, j in order} & {j for j, _ in got})
    assert hits >= 0.9 * 20 * 60


def test_an_id_on_several_texts(spark, documents):
    rng = random.Random(8)
    a, b = (" ".join(rng.choices([f"{x}{i}" for i in range(300)], k=60)) for x in "ab")
    texts = [a, a + " end", b, b + " end", a, None, "", b]
    ids = [0, 1, 1, 5, 0, 1, 1, None]
    rows = jaccard.jaccard_components(documents(texts, ids=ids)).collect()
    found = sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id) for r in rows)
    n = len(shingles(a)), len(shingles(b))
    m = len(shingles(a + " end")), len(shingles(b + " end"))
    assert found == sorted([(0, n[0], 0), (1, m[0], 0), (1, n[1], 1), (5, m[1], 1), (0, n[0], 0), (1, 0, 1), (1, 0, 1), (-1, n[1], 1)])


def test_sets_without_any_id(spark, documents):
    rng = random.Random(9)
    a = " ".join(rng.choices([f"a{i}" for i in range(300)], k=60))
    rows = jaccard.jaccard_components(documents([a, a + " end"], ids=[None, 4])).collect()
    assert [r.component_id for r in rows] == [4, 4]


@pytest.mark.parametrize("n", [60, 500, 2000])
def test_neighbours_come_through_learned_parts(spark, n, monkeypatch):
    from spendgroups.llm import neighbours

    rng = np.random.default_rng(n)
    centres = rng.normal(size=(12, 24))
    x = (centres[rng.integers(0, 12, n)] + rng.normal(size=(n, 24)) * 0.5).astype(np.float32)
    learned = []
    real = neighbours.learn_router
    monkeypatch.setattr(neighbours, "learn_router", lambda *a: learned.append(a[1]) or real(*a))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = nearest_neighbours(table, F.col("vec_id") % 20 == 0).collect()
    assert learned[0] > 1
    pairs = {(r.query_id, r.vec_id) for r in found}
    y = x.astype(np.float64)
    hits = wanted = 0
    for q in range(0, n, 20):
        scores = y @ y[q]
        scores[q] = -np.inf
        best = np.argsort(-scores, kind="stable")[:20]
        hits += sum((q, int(j)) in pairs for j in best)
        wanted += len(best)
    assert hits >= 0.9 * wanted
