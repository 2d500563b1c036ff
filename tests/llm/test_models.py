"""Language and toxicity models against plain versions and held-out accuracy."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from spendgroups.llm import ppm, toxicity

LANGS = {"aa": ["ba", "bo", "ka", "li", "mo"], "bb": ["st", "er", "in", "und", "ch"], "cc": ["ção", "ñe", "que", "l'", "é"]}


def written(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(n=240, seed=1):
    rng = random.Random(seed)
    langs = [rng.choice(list(LANGS)) for _ in range(n)]
    return [written(rng, LANGS[x], rng.randint(1, 60)) for x in langs], langs


def plain_lengths(texts, langs, share):
    """Code lengths by dictionaries, one byte at a time."""
    counts = defaultdict(lambda: [Counter() for _ in range(4)])
    for text, lang in zip(texts, langs):
        b = b"\0\0\0" + text.encode()
        for i in range(3, len(b)):
            for k in range(4):
                counts[lang][k][b[i - k : i + 1]] += 1

    def cost(lang, run):
        tables = counts[lang]
        size = sum(tables[0].values())
        total = 0.0
        for k in range(3, -1, -1):
            part = run[3 - k :]
            after = {g: n for g, n in tables[k].items() if g[:-1] == part[:-1]}
            kept = {g: n for g, n in after.items() if k == 0 or n >= share * size}
            if not kept:
                continue
            n, kinds = sum(after.values()), len(after)
            if part in kept:
                return total - math.log2(kept[part] / (n + kinds))
            total -= math.log2((n - sum(kept.values()) + kinds) / (n + kinds))
        return total + 8.0

    def length(lang, text):
        b = b"\0\0\0" + text.encode()
        return sum(cost(lang, b[i - 3 : i + 1]) for i in range(3, len(b)))

    return length


def test_code_lengths_equal_plain_ones(documents):
    texts, langs = corpus(40)
    share = 2e-3
    model = ppm.learn_languages(documents(texts, langs), share)
    assert model.langs == sorted(set(langs))
    plain = plain_lengths(texts, langs, share)
    probes = [texts[0], "", "zzz \0 \x01", "é" * 3, texts[5][:7]]
    found = model.lengths(pa.array(probes)) / ppm.UNIT
    for i, lang in enumerate(model.langs):
        for j, text in enumerate(probes):
            assert abs(found[i, j] - plain(lang, text)) < 1e-4 * (1 + len(text))


def test_long_texts_are_coded_in_windows(documents, monkeypatch):
    texts, langs = corpus(60)
    model = ppm.learn_languages(documents(texts, langs))
    whole = model.lengths(pa.array([*texts, "".join(texts)]))
    monkeypatch.setattr(ppm, "WINDOW", 50)
    assert (model.lengths(pa.array([*texts, "".join(texts)])) == whole).all()


def test_language_of_held_out_documents(documents):
    texts, langs = corpus()
    rows = ppm.language_ids(documents(texts, langs)).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd_rows(documents):
    texts, langs = corpus(30)
    docs = documents([*texts, None, "", "123 !", "\n", texts[0], texts[0]], [*langs, *[None] * 4, None, "xx"])
    rows = {r.doc_id: r for r in ppm.language_ids(docs).collect()}
    assert [(rows[i].lang_pred, rows[i].score) for i in range(30, 34)] == [("und", 0.0)] * 4
    assert len(rows) == 36
    assert ppm.language_ids(docs.limit(0)).count() == 0
    alone = ppm.language_ids(documents(["words", None])).collect()
    assert {r.lang_pred for r in alone} == {"und"}


def labelled(spark, n=600, seed=2):
    rng = random.Random(seed)
    plain = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        toxic = rng.random() < 0.3
        w = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        if toxic:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randrange(len(w)), rng.choice(["vile", "nasty"]))
        rows.append((i, " ".join(w), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int"), rows


def test_ratios_equal_plain_kneser_ney(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_PAIRS", 3)
    table, rows = labelled(spark, 120)
    share = 1e-3
    model = toxicity.learn_models(toxicity.pair_counts(table), share)
    pairs = [Counter(), Counter()]
    for _, text, label in rows:
        w = ["", *text.split()]
        pairs[label].update(zip(w, w[1:]))
    words = [Counter(), Counter()]
    heads = [Counter(), Counter()]
    contexts = Counter(w for _, w in {*pairs[0], *pairs[1]})
    for k in (0, 1):
        for (v, w), n in pairs[k].items():
            words[k][w] += n
            heads[k][v] += n
    n = [sum(c.values()) for c in words]
    kept = [w for w in contexts if any(words[k][w] >= max(1, share * n[k]) for k in (0, 1))]
    kept_pairs = [p for p in {*pairs[0], *pairs[1]} if any(pairs[k][p] >= max(3, share * n[k]) for k in (0, 1))]
    d = toxicity.DISCOUNT

    def word_p(k, w):
        rest = 1 - sum(max(words[k][x] - d, 0) for x in kept) / n[k]
        if w not in kept:
            return rest / sum(contexts.values())
        return max(words[k][w] - d, 0) / n[k] + rest * contexts[w] / sum(contexts.values())

    def pair_p(k, v, w):
        own = {p: max(pairs[k][p] - d, 0) / max(1, heads[k][v]) for p in kept_pairs if p[0] == v}
        return own.get((v, w), 0.0) + (1 - sum(own.values())) * word_p(k, w)

    for text in ("vile w1 w2", "unknown w3 nasty vile", "w5"):
        w = ["", *text.split()]
        plain = [math.log(pair_p(1, a, b)) - math.log(pair_p(0, a, b)) for a, b in zip(w, w[1:])]
        assert np.allclose(model.ratios(toxicity._pairs(pa.array([text]))[0]), plain, atol=1e-6)


def test_expressions_that_tasks_do_not_hold_count_as_well(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_PAIRS", 3)
    table, _ = labelled(spark, 400)
    extra = [(1000 + i, "seldom evil w1 w2", 1) for i in range(5)]
    table = table.unionByName(spark.createDataFrame(extra, table.schema))
    counts = toxicity.pair_counts(table).cache()
    text = pa.array(["w5 seldom evil", "vile w1 w2 w3", ""])
    pairs = toxicity._pairs(text)[0]
    # No word makes up this share; each still says what it says in a model that is held.
    whole = toxicity.learn_models(counts, 0.5)
    assert whole.rest is None and whole.ratios(pairs)[1] > 2
    split = toxicity.learn_models(counts, 0.5, None, 0)
    assert split.rest.count() > 50 and len(split.word_p) == 0
    docs = table.select("doc_id", "text").unionByName(
        spark.createDataFrame([(None, None), (7, ""), (7, "w9 new words")], "doc_id long, text string")
    )
    columns = ("doc_id", "text", "features")
    one = toxicity.with_features(docs, whole).select(*columns).collect()
    two = toxicity.with_features(docs, split).select(*columns).collect()
    assert len(one) == len(two) == docs.count()
    by_text = {r.text: r.features for r in one}
    assert all(np.allclose(by_text[r.text], r.features, atol=1e-12) for r in two)
    middle = toxicity.learn_models(counts, 0.003, None, 0)
    assert len(middle.word_p) and middle.rest.count()
    three = toxicity.with_features(docs, middle).select(*columns).collect()
    assert all(np.allclose(by_text[r.text], r.features, atol=1e-12) for r in three)


def test_scores_do_not_depend_on_what_tasks_hold(spark):
    table, _ = labelled(spark, 300)
    docs, labels = table.select("doc_id", "text"), table.select("doc_id", "toxic")
    one = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels).collect()}
    two = toxicity.toxicity_scores(docs, labels, 0.01, held=0).collect()
    assert len(two) == len(one) and all(abs(one[r.doc_id] - r.score) < 1e-9 for r in two)


def test_toxicity_of_held_out_documents(spark):
    table, rows = labelled(spark)
    truth = {i: label for i, _, label in rows}
    docs, labels = table.select("doc_id", "text"), table.select("doc_id", "toxic")
    found = toxicity.toxicity_scores(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.9 * len(held)
    hidden = labels.withColumn("toxic", F.expr("CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - toxic ELSE toxic END"))
    again = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, hidden).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in found)


def test_copies_of_a_text_count_once_and_stay_together(spark):
    rows = [(0, "vile words", 1)] * 50 + [(1, "vile words", 0), (2, None, 0), (3, "", 0), (4, "fair words", 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    once = {r.text: r.toxic for r in toxicity._texts_once(table).collect()}
    assert once == {"vile words": 1, "": 0, "fair words": 0}
    keys = [r._key for r in toxicity._texts_once(labelled(spark)[0]).collect()]
    assert all(0 <= key < 1 for key in keys) and 0.4 < sum(keys) / len(keys) < 0.6


def test_all_texts_but_the_calibration_are_counted(spark, monkeypatch):
    table, rows = labelled(spark, 400)
    words = sum(len(text.split()) for _, text, _ in rows)
    seen = []
    learn = toxicity.learn_models
    monkeypatch.setattr(toxicity, "learn_models", lambda c, *a: seen.append(c) or learn(c, *a))
    toxicity.learn_toxicity(table, fitted=20)
    counted = seen[0].agg(F.sum(F.col("ordinary") + F.col("toxic"))).first()[0]
    assert 0.85 * words < counted < words


def test_toxicity_odd_rows(spark):
    table, _ = labelled(spark, 60)
    more = spark.createDataFrame([(None, "vile", None), (900, None, 1), (901, "", 0), (902, "x" * 9000 + " vile", None)], table.schema)
    docs = table.unionByName(more).withColumn("features", F.lit("kept"))
    labels = table.unionByName(more).select("doc_id", "toxic")
    rows = toxicity.toxicity_scores(docs, labels).collect()
    assert len(rows) == 64 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert toxicity.toxicity_scores(docs.limit(0), labels.limit(0)).count() == 0
    assert toxicity.toxicity_scores(docs, labels.limit(0)).count() == 64


def test_pairs_of_a_few_occurrences_are_in_the_models(spark):
    table, _ = labelled(spark, 200)
    extra = [(1000 + i, f"w{i} odd pair w{9 - i}", 1) for i in range(5)]
    extra += [(2000 + i, f"odd w{i} w{i + 9} pair", 0) for i in range(5)]
    counts = toxicity.pair_counts(table.unionByName(spark.createDataFrame(extra, table.schema)))
    model = toxicity.learn_models(counts.cache())
    together, apart = (toxicity._pairs(pa.array([text]))[0] for text in ("odd pair", "pair w299 odd"))
    # Five times toxic, never ordinary, of words that are as frequent in both classes.
    assert model.ratios(together)[1] > model.ratios(apart)[0] + 1


def test_pairs_are_handed_on_in_parts(spark, monkeypatch):
    _, rows = labelled(spark, 200)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([t for _, t, _ in rows]), pa.array([x for _, _, x in rows])], ["text", "toxic"]
    )

    def summed(batches):
        table = pa.Table.from_batches(batches).group_by(["head", "word"])
        return {(r["head"], r["word"]): (r["ordinary_sum"], r["toxic_sum"]) for r in table.aggregate([("ordinary", "sum"), ("toxic", "sum")]).to_pylist()}

    whole = list(toxicity._count_batches(iter([batch])))
    monkeypatch.setattr(toxicity, "PAIRS", 500)
    monkeypatch.setattr(toxicity, "SLICE", 10)
    parts = list(toxicity._count_batches(iter([batch])))
    assert len(parts) > len(whole) and max(map(len, parts)) < 1500
    assert summed(parts) == summed(whole)
    passes = [summed(toxicity._count_batches(iter([batch]), i, 3)) for i in range(3)]
    assert all(passes) and sum(map(len, passes)) == len(summed(whole))
    assert {k: v for part in passes for k, v in part.items()} == summed(whole)


def test_texts_are_not_shuffled_for_what_tasks_do_not_hold(spark):
    table, _ = labelled(spark, 100)
    model = toxicity.learn_models(toxicity.pair_counts(table), 0.5, None, 0)
    plan = toxicity.with_features(table, model)._jdf.queryExecution().executedPlan().toString()
    assert model.rest.count() and "Join" not in plan and "Exchange" not in plan
