"""BPE and token counts against the libraries."""

import hashlib
import random

from spendgroups.llm import bpe, tokencount


def sampled(alphabet, n, length, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, length))) for _ in range(n)]


EDGES = [None, "", " ", "x", "a" * 120_000, "a b " * 40_000, "é漢字🙂 " * 9000, "\n" * 70_000 + "x",
         " " * 200_000 + "y", "<|endoftext|> a <|startoftext|><|ENDOFTEXT|>", "İſ ΣΑΣ"]
MIXED = [*"aAbB1²é 'stdlrevem\n\t\x0b\x1c\x85\xa0_-!<|>漢　🙂̇", "<|endoftext|>", "İ", "ﬁ"]


def test_bpe_equals_the_library_and_decodes(documents):
    texts = EDGES + sampled(MIXED, 300, 60)
    coder = bpe.encoding(bpe.RANKS)
    for row in bpe.bpe_digest(documents(texts)).collect():
        text = texts[row.doc_id] or ""
        ids = coder.encode_ordinary(text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_texts_are_cut_at_safe_places_only():
    coder = bpe.encoding(bpe.RANKS)
    for text in sampled(MIXED, 2000, 80, seed=3):
        parts = list(bpe.chunks(text, 8))
        assert "".join(parts) == text
        assert [i for p in parts for i in coder.encode_ordinary(p)] == coder.encode_ordinary(text)


def test_blanks_that_the_matcher_cannot_take():
    ids = bpe.encode_text("x" + " " * 1_600_000 + "y")
    assert bpe.decode_ids(ids).decode() == "x" + " " * 1_600_000 + "y"


def test_counts_equal_the_library(documents):
    texts = EDGES + sampled(MIXED, 400, 40, seed=4)
    model = tokencount.tokenizer(tokencount.MODEL)
    for row in tokencount.token_counts(documents(texts)).collect():
        text = texts[row.doc_id] or ""
        n = len(model.encode(text, add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 2048)


def test_plain_characters_are_split_as_the_library_does():
    counter = tokencount.Counter(tokencount.MODEL, tokencount.whole_tokens(tokencount.MODEL))
    model = tokencount.tokenizer(tokencount.MODEL)
    for c in map(chr, range(0x300)):
        for text in (c, f"a{c}b", f"1{c}{c} '{c}s"):
            assert counter.count(text) == len(model.encode(text, add_special_tokens=False).ids)


def test_whole_tokens_are_one_token():
    model = tokencount.tokenizer(tokencount.MODEL)
    whole = sorted(tokencount.whole_tokens(tokencount.MODEL))
    assert len(whole) > 30_000
    assert all(len(c.ids) == 1 for c in model.encode_batch(whole[::50], add_special_tokens=False))


def test_other_columns_repeats_and_empty_tables(documents):
    docs = documents(["a b", "a b"], ids=[None, None])
    coded = bpe.with_decoded(bpe.with_token_ids(docs))
    assert coded.columns == [*docs.columns, "ids", "decoded"] and coded.count() == 2
    assert [r.n_tokens for r in tokencount.with_token_counts(docs).collect()] == [2, 2]
    assert bpe.bpe_digest(docs.limit(0)).count() == 0
    assert tokencount.token_counts(docs.limit(0)).count() == 0
