"""Mixing against a plain computation of the targets."""

import random
import re

from spendgroups.llm.mixing import WEIGHTS, mix_sources, numbered


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    goal, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = goal - sum(2 * sizes[s] for s in capped)
        heft = sum(weight[s] for s in names if s not in capped)
        target = {s: 2.0 * sizes[s] if s in capped else rest * weight[s] / heft for s in names}
        above = {s for s in names if s not in capped and target[s] > 2 * sizes[s]}
        if not above:
            return target
        capped |= above


def test_targets_copies_and_reruns(documents):
    rng = random.Random(2)
    texts = [None, "", " \t ", "word " * 4000]
    texts += [" x\x0by\n" * rng.randint(0, 60) for _ in range(1500)]
    sources = [rng.choice(["b", "a", "a", "a", "é", "Z", None, "tiny"]) for _ in texts]
    docs = documents(texts, sources=sources)
    rows = mix_sources(docs, group=16).collect()
    assert len(rows) == len(texts)
    sizes = {}
    for text, source in zip(texts, sources):
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target, taken = plain_targets(sizes), dict.fromkeys(sizes, 0)
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or ""))
        assert r.source_size == sizes[r.source]
        assert abs(r.target - target[r.source]) < 1e-6 * max(1.0, r.target)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    most = {s: max(r.size for r in rows if r.source == s) for s in sizes}
    for s in sizes:
        assert abs(taken[s] - target[s]) <= most[s] / 2 + 1e-6
    assert sorted(rows) == sorted(mix_sources(docs.repartition(7), group=16).collect())


def test_chance_is_fair(documents):
    """With a target of one and a half of a source, half its words are taken twice."""
    rows = mix_sources(documents(["w " * (1 + i % 9) for i in range(900)])).collect()
    for size in range(1, 10):
        twice = [r.taken == 2 * r.size for r in rows if r.size == size]
        assert 0.3 < sum(twice) / len(twice) < 0.7


def test_repeated_rows_no_ids_and_empty_tables(documents):
    docs = documents(["a b c"] * 40, ids=[1] * 20 + [None] * 20, sources=["s"] * 40)
    rows = mix_sources(docs, group=4).collect()
    assert len(rows) == 40 and sum(r.taken for r in rows) in range(178, 183)
    assert mix_sources(docs.limit(0)).count() == 0
    assert [r.taken for r in mix_sources(documents([None, ""])).collect()] == [0, 0]


def test_equal_rows_are_numbered_in_chunks(spark):
    rows = spark.createDataFrame(
        [(1, "s", 3)] * 25 + [(1, None, 3)] * 4 + [(None, None, 3)] * 11 + [(2, "s", 0)],
        "doc_id long, source string, size long",
    )
    found = numbered(rows, chunk=5).collect()
    expected = [(1, "s", 3, i) for i in range(1, 26)] + [(1, None, 3, i) for i in range(1, 5)]
    expected += [(None, None, 3, i) for i in range(1, 12)] + [(2, "s", 0, 1)]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
    assert numbered(rows.limit(0)).count() == 0


def test_one_repeated_row_makes_up_the_table(documents):
    rows = mix_sources(documents(["a b c"] * 3000, ids=[5] * 3000, sources=["s"] * 3000)).collect()
    assert len(rows) == 3000 and abs(sum(r.taken for r in rows) - 13_500) <= 2
