"""Personal data and secrets against plain regular expressions in Python."""

import hashlib
import random
import re

import pytest

from spendgroups.llm.pii import find_pii, pii_digest, redact
from spendgroups.llm.secret_scan import RULES, read_ledger, scan_secrets, secrets_digest


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c)
        if i % 2:
            n = n * 2 - (9 if n > 4 else 0)
        total += n
    return total % 10 == 0


def digits(text):
    return re.sub("[^0-9]", "", text)


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        lambda m: all(int(x) <= 255 for x in m[0].split(".")),
    ),
    "card": (
        r"[0-9]([\x20-]?[0-9])+",
        lambda m: 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])),
    ),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m[0])) <= 15),
}
KEY = "(?:password|passwd|secret|token|api_?key)"
SECRETS = {
    "assign": (
        rf"""(?ai:({KEY}))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[2]) >= 6,
    ),
    "access": ("AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": ("[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def plain(text, rules):
    return {
        kind: [(m.start(), m.end()) for m in re.finditer(pattern, text or "") if test(m)]
        for kind, (pattern, test) in rules.items()
    }


def joined(spans):
    return ",".join(f"{k}:{a}:{z}" for k, a, z in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def sampled(alphabet, n=250, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(n)]


EDGES = [None, "", " ", "é" * 70_000, "a" * 100_000, "1" * 50_000, "1 23 " * 20_000,
         "1.2.3." * 20_000, "a@b.c_d@e.f", "a" + "@b.c" * 9000, "+1" + " " * 60_000 + "2345678",
         "1.2.3.4.5.6.7.8", "999.1.1.1", "000001.2.3.0255", "🙂 x@y.zz 4111-1111 1111 1111"]


def test_pii_equals_plain_patterns(documents):
    texts = [*EDGES, *sampled(["a", "@", ".", "1", "+", "-", " ", "12", "255", "é", "(", "b@c.d"]),
             *sampled("0123456789 -", seed=6), *sampled(["4111", "1111", " ", "-", "+1"], seed=7)]
    rows = pii_digest(documents(texts)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        base = plain(texts[row.doc_id], PII)
        flat = [(k, a, z) for k in PII for a, z in base[k]]
        assert [row[f"n_{k}"] for k in PII] == [len(base[k]) for k in PII], texts[row.doc_id]
        assert row.base_sha256 == sha(joined(flat))
        assert set(joined(flat).split(",")) <= set(row.spans.split(",")) | {""}


def test_checksums_and_context_decide_about_further_kinds(documents):
    texts = ["pay to DE89 3704 0044 0532 0130 00 now", "pay to DE88 3704 0044 0532 0130 00 now",
             "her ssn is 123-45-6789", "part 123-45-6789", "ssn 000-45-6789"]
    found = {r.doc_id: [(s.kind, s.value) for s in r.pii if s.kind in ("iban", "national_id")]
             for r in find_pii(documents(texts)).collect()}
    assert found[0] == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert found[1] == [] and found[3] == [] and found[4] == []
    assert found[2] == [("national_id", "123-45-6789")]


def test_account_numbers_end_where_their_country_says(documents):
    texts = ["DE89 3704 0044 0532 0130 00 BIC COBADEFF", "DE89370400440532013000 BIC COBADEFF",
             "DE893704004405320130 00X", "ZZ89370400440532013000", "GB82 WEST 1234 5698 7654 32 NO93 8601 1117 947"]
    rows = find_pii(documents(texts)).orderBy("doc_id").collect()
    found = [[s.value for s in r.pii if s.kind == "iban"] for r in rows]
    assert found == [[texts[0][:27]], [texts[1][:22]], [], [],
                     ["GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947"]]


def test_context_words_are_whole_words_and_no_patterns(documents):
    texts = ["classname 123-45-6789", "SSN: 123-45-6789", "ssns 123-45-6789", "hotel +1 555 123 4567",
             "tel. +1 555 123 4567"]
    rows = pii_digest(documents(texts)).orderBy("doc_id").collect()
    assert [r.scores for r in rows] == ["", "600", "", "700", "1000"]
    words = {"national_id": ("n.o", "(")}
    rows = find_pii(documents(["nxo 123-45-6789", "n.o 123-45-6789", "( 123-45-6789"]), context_words=words)
    assert [len(r.pii) for r in rows.orderBy("doc_id").collect()] == [0, 1, 1]


def test_context_raises_the_score(documents):
    rows = find_pii(documents(["call +1 555 123 4567", "see +1 555 123 4567"])).orderBy("doc_id")
    scores = [r.pii[0].score for r in rows.collect()]
    assert scores == [1.0, 0.7]


def test_redaction_replaces_every_span_and_keeps_columns(documents):
    docs = documents(["mail a@b.cc or 1.2.3.4!", None, "plain", "a@b.cc" ])
    clean = redact(find_pii(docs))
    assert clean.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts == {0: "mail [EMAIL] or [IP]!", 1: None, 2: "plain", 3: "[EMAIL]"}


def test_secrets_equal_plain_patterns(documents):
    texts = [None, "", "token=token:abcdef", "AKIA" * 10, "f" * 100_000, "passwOrd : 'hunter22'",
             "ſecret=abcdefg", "password=" + "x" * 60_000, "api_key" + " " * 60_000 + "=abcdef",
             *sampled(["token", "=", ":", " ", "'", "Secret", "abc", "é", "f0" * 6, "AKIA", "Z9" * 5])]
    rows = secrets_digest(documents(texts)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        base = plain(texts[row.doc_id], SECRETS)
        order = list(SECRETS)
        flat = sorted((a, order.index(k), z) for k in SECRETS for a, z in base[k])
        assert [row[f"n_{k}"] for k in SECRETS] == [len(base[k]) for k in SECRETS]
        assert row.base_sha256 == sha(joined([(order[k], a, z) for a, k, z in flat]))


def test_ledger_scans_each_version_and_rule_version_once(spark, documents, tmp_path):
    path = f"{tmp_path}/ledger"
    docs = documents(["token=abcdef1", "token=abcdef1", "nothing", None])
    first = scan_secrets(docs, path, RULES[:1])
    assert [len(r.findings) for r in first.orderBy("doc_id").collect()] == [1, 1, 0, 0]
    assert read_ledger(spark, path).count() == 3
    again = scan_secrets(docs.union(documents(["AKIA" + "Z" * 16])), path, RULES[:2])
    assert sorted(len(r.findings) for r in again.collect()) == [0, 0, 1, 1, 1]
    rules = sorted(tuple(r.rules) for r in read_ledger(spark, path).collect())
    assert rules == [("access@1",)] * 3 + [("assign@1",)] * 3 + [("assign@1", "access@1")]


@pytest.mark.parametrize("digest", [pii_digest, secrets_digest])
def test_rows_without_id_repeats_and_empty_tables(documents, digest):
    docs = documents(["a@b.cc token=abcdef1"] * 3, ids=[None, 7, 7])
    assert digest(docs).count() == 3
    assert digest(docs.limit(0)).count() == 0


def test_overlapping_spans_are_cut_out_together(spark, documents):
    docs = documents(["a 4111 1111 1111 1 111.22.33.44 b", "x@y.org"])
    rows = redact(find_pii(docs)).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["a [CARD] b", "[EMAIL]"]


def test_a_ledger_with_repeated_rows(spark, documents, tmp_path):
    path = f"{tmp_path}/ledger"
    docs = documents(["token=abcdef1", "none"])
    first = scan_secrets(docs, path).collect()
    spark.read.parquet(path).write.parquet(f"{tmp_path}/copy")
    spark.read.parquet(f"{tmp_path}/copy").write.mode("append").parquet(path)
    assert sorted(map(repr, scan_secrets(docs, path).collect())) == sorted(map(repr, first))
    more = scan_secrets(documents(["token=abcdef1", "secret: abcdef2", None]), path).collect()
    assert [len(r.findings) for r in sorted(more, key=lambda r: r.doc_id)] == [1, 1, 0]
