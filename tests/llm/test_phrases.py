"""Collocations against brute force."""

import random
import re
from collections import Counter

import pytest

from spendgroups.llm import phrases
from spendgroups.llm.phrases import phrase_collocations


def brute(rows, longest, least, best):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    often = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}

    def inside(p, q):
        return any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))

    out = []
    for (lang, p), a in often.items():
        if any(x == lang and len(q) > len(p) and b >= a and inside(p, q) for (x, q), b in often.items()):
            continue
        cuts = []
        for k in range(1, len(p)):
            l, r = f[lang, p[:k]], f[lang, p[k:]]
            cuts.append((1000 * a * n[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.append((lang, " ".join(p), a, l, r, n[lang], score))
    ranked = []
    for lang in {row[0] for row in out}:
        mine = sorted(
            (row for row in out if row[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode())
        )
        ranked += [(row[0], i + 1, *row[1:]) for i, row in enumerate(mine[:best])]
    return sorted(ranked)


@pytest.mark.parametrize("longest, least, best", [(5, 6, 2000), (3, 3, 10), (2, 4, 5), (5, 1, 40)])
def test_equals_brute_force(spark, documents, monkeypatch, longest, least, best):
    monkeypatch.setattr(phrases, "HOT", 0.1)
    rng = random.Random(longest)
    stock = ["of the", "Of  The, red.", "new york city", "é É a", "x x x x x x x", "", "a\tb c d e f", "End!"]
    texts = [None, "", " . ", "!"] + [" ".join(rng.choices(stock, k=rng.randint(1, 12))) for _ in range(60)]
    langs = [rng.choice(["en", "de", None, "und"]) for _ in texts]
    docs = documents(texts, langs)
    found = phrase_collocations(docs, longest, least, best)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.collect()) == brute(zip(langs, texts), longest, least, best)


def test_products_beyond_64_bits(spark):
    rows = spark.createDataFrame(
        [(10**12, 10**12, 10**12, 3 * 10**13), (100, 10**13, 100, 10**13)], "a long, l long, r long, n long"
    )
    found = [r.score for r in rows.select(phrases._score().alias("score")).collect()]
    assert found == [1000 * 3 * 10**13 // 10**12, 1000]


def test_no_phrases(spark, documents):
    assert phrase_collocations(documents(["a b c"])).count() == 0
    assert phrase_collocations(documents([None])).count() == 0
    assert phrase_collocations(documents(["a"]).limit(0)).count() == 0


def test_table_of_bits_full(spark, documents, monkeypatch):
    """Phrases that share bits with others are counted for nothing, but none is lost."""
    monkeypatch.setattr(phrases, "_table_of_bits", lambda p: phrases.np.full(phrases.BITS // 8, 255, "u1"))
    texts = ["a b c d e f", "a b c. d e f", "b c d"] * 4
    found = phrase_collocations(documents(texts, ["en"] * 12), 5, 4, 50)
    assert sorted(tuple(r) for r in found.collect()) == brute([("en", t) for t in texts], 5, 4, 50)


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "WINDOW", 20)
    text = "One two. three four five six seven eight; nine! ten"
    batch = phrases.pa.RecordBatch.from_pydict({"lang": ["en", "de", "en"], "text": [text, "", None]})
    parts = [part for _, held in phrases._windows(iter([batch])) for part in held]
    pieces = [p.split() for part in parts for p in part.split(b".") if p.split()]
    assert pieces == [p.split() for p in text.lower().encode().translate(bytes.maketrans(b";!", b"..")).split(b".")]
    assert len(parts) > 2


def test_tables_of_counts_are_not_broadcast_by_a_guess(spark):
    cuts = spark.createDataFrame([("en", "a b", "a"), ("en", "a c", "a")], "lang string, phrase string, head string")
    counts = spark.createDataFrame([("en", "a", 7), ("de", "a", 8)], "lang string, head string, l long")
    found = phrases._looked_up(cuts, counts, "head")
    assert sorted((r.phrase, r.l) for r in found.collect()) == [("a b", 7), ("a c", 7)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
