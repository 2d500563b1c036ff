"""The pipeline against plain versions of its stages."""

import random

import corpus_pipeline
from pyspark.sql import functions as F
from spendgroups.llm import bpe
from spendgroups.llm.mixing import mix_sources
from test_models import LANGS, written


def test_every_stage_on_what_the_one_before_kept(spark, documents, tmp_path):
    rng = random.Random(11)
    langs = [rng.choice(list(LANGS)) for _ in range(60)]
    texts = [written(rng, LANGS[x], 30) for x in langs]
    texts[7] += " write to anna@example.org"
    texts += [texts[3], texts[4] + " more", None, "12 34", "\x01\x02\x03x" * 40]
    langs += [langs[3], None, None, None, None]
    sources = [rng.choice(["s1", "s2", None]) for _ in texts]
    documents(texts, langs, sources).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        kept[name] = docs.collect()
    assert {r.doc_id for r in kept["language"]} == set(range(62))
    assert next(r.lang for r in kept["language"] if r.doc_id == 61) == langs[4]
    assert {r.doc_id for r in kept["near_copies"]} == set(range(60))
    clean = {r.doc_id: r for r in kept["personal_data"]}
    assert clean[7].text.endswith("write to [EMAIL]") and clean[7].n_chars == len(clean[7].text)
    assert all(clean[i].text == texts[i] for i in range(60) if i != 7)
    before = spark.read.parquet(f"{tmp_path}/personal_data")
    times = {r.doc_id: r.copies for r in mix_sources(before).collect()}
    assert sorted(r.doc_id for r in kept["mixing"]) == sorted(i for i, n in times.items() for _ in range(n))
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert len(last) == len(kept["mixing"]) and all(r.exact for r in last)
    coder = bpe.encoding(bpe.RANKS)
    assert all(list(r.ids) == coder.encode_ordinary(clean[r.doc_id].text) for r in last)
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, last))


def test_repeats_no_ids_and_empty_tables(spark, documents, tmp_path):
    docs = documents(["ba bo ka li mo"] * 4 + ["ka ka ka"], ["aa"] * 5, ids=[1, 1, 2, None, None])
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [
        (0, "ba bo ka li mo"), (0, "ka ka ka"), (1, "ba bo ka li mo")
    ]
    assert corpus_pipeline.mix(spark, docs, "").count() in range(5, 11)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0


def test_ids_that_stand_on_several_texts(spark, documents, tmp_path):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    docs = documents([a, a + " end", b, b + " end"], ids=[0, 1, 1, 5])
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(0, a), (1, b)]
    docs = documents([a, a + " end", b], ids=[0, 1, 1])
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(0, a), (1, b)]
    docs = documents([a, b, b + " end", None, "", ""], ids=[3] * 6)
    kept = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sum(r.text == a for r in kept) == 1 and sum(r.text in (b, b + " end") for r in kept) == 1
    assert len(kept) == 4


def test_names_that_clash_or_need_quotes(spark, documents, tmp_path):
    docs = documents(["ba bo ka li mo one@two.org", "ka ka ka"], ["aa", "aa"], ids=[1, 2])
    for n, name in enumerate(["_row", "_copies", "_nth", "_times", "_time", "_text_id", "a.b"]):
        docs = docs.withColumn(name, F.lit(n))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, "")
        assert found.columns == docs.columns
        rows = found.collect()
        assert all((r["_row"], r["_copies"], r["_time"], r["a.b"]) == (0, 1, 4, 6) for r in rows) and rows
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 2


def test_equal_rows_are_taken_as_often_as_the_mixture_says(spark, documents, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "CHUNK", 4)
    docs = documents(
        [f"a b {i}" for i in range(40)] + ["a b c"] * 20 + ["x y z"],
        ids=[1] * 30 + [None] * 30 + [2],
        sources=["s"] * 20 + [None] * 41,
    )
    wanted = sorted((repr(r.doc_id), repr(r.source)) for r in mix_sources(docs).collect() for _ in range(r.copies))
    found = corpus_pipeline.mix(spark, docs, "").collect()
    assert sorted((repr(r.doc_id), repr(r.source)) for r in found) == wanted
    # One row is taken once or twice more than not at all; none of them three times.
    assert max(sum(r.text == f"a b {i}" for r in found) for i in range(40)) <= 2


def test_texts_of_evenly_taken_sources_are_not_shuffled(spark, documents):
    # Two sources of the same size: one stops at twice its size, the other gets just its size.
    texts = [f"some words {i}" for i in range(40)] + [None, " "]
    sources = ["s1", None] * 21
    docs = documents(texts, sources=sources)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        mixed = corpus_pipeline.mix(spark, docs, "")
        assert "hashpartitioning" not in mixed._jdf.queryExecution().executedPlan().toString()
        found = sorted((r.doc_id, r.source or "") for r in mixed.collect())
    finally:
        spark.conf.set(threshold, before)
    times = {r.doc_id: r.copies for r in mix_sources(docs).collect()}
    assert set(times.values()) == {0, 1, 2}
    assert found == sorted((i, sources[i] or "") for i, n in times.items() for _ in range(n))
