"""Periodic runs against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendgroups.llm import periodic
from spendgroups.llm.periodic import repeated_text, runs_digest, with_runs


def brute(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rng):
    words = []
    for _ in range(rng.randint(0, 5)):
        q = rng.choice([1, 2, 3, 5, 8, 9, 10, 15, 16, 17, 18, 31, 32, 33, 40, 64, 65])
        v = rng.choice([1, 2, 3, 50])
        unit = [f"{rng.randint(0, v)}" for _ in range(q)]
        words += (unit * 8)[: rng.randint(0, q * 7)]
    return words


@pytest.mark.parametrize("together", [50, periodic.TOGETHER])
def test_runs_equal_brute_force(spark, documents, monkeypatch, together):
    rng = random.Random(5)
    texts = [repetitive(rng) for _ in range(150)]
    monkeypatch.setattr(periodic, "TOGETHER", together)
    found = []
    for part in periodic._slices([w.encode() for w in t] for t in texts):
        found += periodic._searched(part)
    for words, (runs, kept) in zip(texts, found):
        assert [tuple(r) for r in runs.tolist()] == brute(words)
        assert kept.decode() == collapsed(words, brute(words))


def test_column(spark, documents):
    texts = [None, "", " \t\n", "a", "x " * 5, "x " * 6, "é\x0bB b a c " * 4, "Ab ab " * 9, "x " * 6]
    docs = documents(texts).withColumn("runs", F.lit(1)).withColumn("a.b", F.lit(2))
    rows = {r.doc_id: r for r in with_runs(docs).collect()}
    for i, text in enumerate(texts):
        words = [w.decode() for w in (text or "").encode().split()]
        assert [tuple(r) for r in rows[i].runs] == brute(words)
        assert rows[i].collapsed == collapsed(words, brute(words))
    assert rows[0]["a.b"] == 2 and rows[0]["_email_found"] == "kept"
    assert [tuple(r) for r in rows[6].runs] == [(0, 16, 4)]


def test_very_long_period(spark, documents):
    rng = np.random.default_rng(2)
    unit = [f"w{i}" for i in rng.integers(0, 50_000, 60_000)]
    words = ["start"] + unit * 4 + unit[:7] + ["end"]
    row = with_runs(documents([" ".join(words)])).first()
    assert [tuple(r) for r in row.runs] == [(1, 4 * len(unit) + 7, len(unit))]
    assert row.collapsed.split(" ") == ["start", *unit, "end"]


def test_digest(spark, documents):
    text = " ".join(f"w{i}" for i in range(40))
    docs = documents([text] * 60 + [None, "", "one"])
    made = {r.doc_id: r.t for r in docs.select("doc_id", repeated_text(F.col("doc_id"), F.col("text")).alias("t")).collect()}
    rows = {r.doc_id: r for r in runs_digest(docs).collect()}
    assert len(rows) == 63
    for i, row in rows.items():
        runs = brute((made[i] or "").split())
        assert row.n_runs == len(runs)
        if runs:
            s, n, q = max(runs, key=lambda r: (r[1], -r[0], -r[2]))
            assert (row.start, row.length, row.period, row.exponent_milli) == (s, n, q, 1000 * n // q)
        else:
            assert (row.start, row.length, row.period, row.exponent_milli) == (None,) * 4
        assert len(row.runs_sha256) == len(row.collapsed_sha256) == 64
    assert any(row.n_runs for row in rows.values())
    assert runs_digest(docs.limit(0)).count() == 0
