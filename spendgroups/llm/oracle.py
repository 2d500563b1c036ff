"""SQL with the same result, for the queries that SQL can state."""

from __future__ import annotations

from spendgroups.llm.pii import CONTEXT_WORDS, IBAN_BY_LENGTH, context_pattern
from spendgroups.llm.pii import RULES as PII_RULES


def _spans(kind: str, rank: int, pattern: str, test: str) -> str:
    """A list of (kind, rank, start, end) from text ``t`` for matches that pass ``test``."""
    found, gaps = f"regexp_extract_all(t, '{pattern}')", f"string_split_regex(t, '{pattern}')"
    return f"""list_filter(list_transform(range(1, len({found}) + 1), lambda i: {{
        'kind': '{kind}', 'rank': {rank},
        'start': list_sum(list_transform({gaps}[1:i], lambda x: length(x)))::BIGINT
            + coalesce(list_sum(list_transform({found}[1:i - 1], lambda x: length(x))), 0)::BIGINT,
        'v': {found}[i],
        'around': lower(right({gaps}[i], 48) || ' ' || left({gaps}[i + 1], 48))
    }}), lambda s: coalesce({test}, false))"""


_DIGITS = "regexp_replace(s.v, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(string_split(reverse({_DIGITS}), ''), lambda c, i:
    CASE WHEN i % 2 = 1 THEN c::INT ELSE c::INT * 2 - CASE WHEN c::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""
_PART = "0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_CODE = "replace(s.v, ' ', '')"
_IBAN_NUMBER = f"""array_to_string(list_transform(string_split({_CODE}[5:] || {_CODE}[1:4], ''),
    lambda c: CASE WHEN c BETWEEN 'A' AND 'Z' THEN (ascii(c) - 55)::VARCHAR ELSE c END), '')"""
_MOD97 = f"""list_reduce(list_prepend(0::BIGINT, list_transform(string_split({_IBAN_NUMBER}, ''),
    lambda c: c::BIGINT)), lambda r, v: (r * 10 + v) % 97) = 1"""

_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_IP = r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"
_CARD = r"[0-9](?:[ -]?[0-9])+"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_IBAN = rf"\b(?:{IBAN_BY_LENGTH})\b"
_NATIONAL = r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"

_JOINED = "array_to_string(list_transform({0}, lambda s: s.kind || ':' || s.start || ':' || (s.start + length(s.v))), ',')"

_ID_WORDS = context_pattern(CONTEXT_WORDS["national_id"])
_ALL1 = "list_concat(list_concat(list_concat(email, ip), list_concat(card, phone)), list_concat(iban, national_id))"
_POINTS = " ".join(
    f"WHEN '{rule.kind}' THEN {round(rule.certainty * 1000)} + "
    f"300 * regexp_matches(s.around, '{context_pattern(CONTEXT_WORDS[rule.kind])}')::INT"
    for rule in PII_RULES
)

OP1 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS (SELECT doc_id,
    CASE WHEN contains(t, '@') THEN {_spans("email", 0, _EMAIL, "true")} ELSE [] END AS email,
    CASE WHEN regexp_matches(t, '[0-9]\\.[0-9]') THEN {_spans("ip", 1, _IP, f"regexp_full_match(s.v, '{_PART}[.]{_PART}[.]{_PART}[.]{_PART}')")} ELSE [] END AS ip,
    CASE WHEN regexp_matches(t, '[0-9]([ -]?[0-9]){{15}}') THEN {_spans("card", 2, _CARD, f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}")} ELSE [] END AS card,
    CASE WHEN contains(t, '+') THEN {_spans("phone", 3, _PHONE, f"length({_DIGITS}) BETWEEN 8 AND 15")} ELSE [] END AS phone,
    CASE WHEN regexp_matches(t, '[A-Z]{{2}}[0-9]{{2}} ?[A-Z0-9]') THEN {_spans("iban", 4, _IBAN, _MOD97)} ELSE [] END AS iban,
    CASE WHEN regexp_matches(t, '[0-9]-[0-9]{{2}}-[0-9]') THEN {_spans("national_id", 5, _NATIONAL, "NOT regexp_matches(s.v, '^(000|666|9)|-00-|-0000$') AND regexp_matches(s.around, '{_ID_WORDS}')")} ELSE [] END AS national_id
    FROM d)
SELECT doc_id, len(email)::BIGINT AS n_email, len(ip)::BIGINT AS n_ip, len(card)::BIGINT AS n_card,
    len(phone)::BIGINT AS n_phone,
    sha256({_JOINED.format("list_concat(list_concat(email, ip), list_concat(card, phone))")}) AS base_sha256,
    {_JOINED.format(_ALL1)} AS spans,
    array_to_string(list_transform({_ALL1}, lambda s: least(1000, CASE s.kind {_POINTS} END)), ',') AS scores
FROM f
"""

_KEYWORD = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
_HEAD = rf"{_KEYWORD}[\x22\x27]? *[:=] *[\x22\x27]?"
_VALUE = "[A-Za-z0-9+/_.=-]"
_ALL2 = "list_sort(list_transform({0}, lambda s: {{'start': s.start, 'rank': s.rank, 'kind': s.kind, 'v': s.v}}))"

OP2 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS (SELECT doc_id,
    CASE WHEN regexp_matches(t, '{_HEAD}') THEN {_spans("assign", 0, _HEAD + _VALUE + "+", f"regexp_full_match(s.v, '{_HEAD}{_VALUE}{{6,}}')")} ELSE [] END AS assign,
    CASE WHEN contains(t, 'AKIA') THEN {_spans("access", 1, "AKIA[A-Z0-9]+", "length(s.v) >= 20")} ELSE [] END AS access,
    CASE WHEN regexp_matches(t, '[0-9a-f]{{24}}') THEN {_spans("hex", 2, "[0-9a-f]+", "length(s.v) >= 24")} ELSE [] END AS hex,
    CASE WHEN contains(t, '-----BEGIN ') THEN {_spans("private_key", 3, "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", "true")} ELSE [] END AS private_key,
    CASE WHEN contains(t, 'eyJ') THEN {_spans("signed_token", 4, "eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}", "true")} ELSE [] END AS signed_token
    FROM d)
SELECT doc_id, len(assign)::BIGINT AS n_assign, len(access)::BIGINT AS n_access, len(hex)::BIGINT AS n_hex,
    sha256({_JOINED.format(_ALL2.format("list_concat(list_concat(assign, access), hex)"))}) AS base_sha256,
    {_JOINED.format(_ALL2.format("list_concat(list_concat(list_concat(assign, access), hex), list_concat(private_key, signed_token))"))} AS spans
FROM f
"""

_ID_BYTES = "string_split(coalesce(doc_id::VARCHAR, ''), '')"
# crc32 of the id: each byte is taken in, followed by eight shifts.
_CRC = f"""xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    list_filter({_ID_BYTES}, lambda c: c <> ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda s, b: xor(xor(s, b) >> 1, CASE WHEN xor(s, b) % 2 = 1 THEN 3988292384 ELSE 0 END)))"""

OP11 = rf"""
WITH h AS (SELECT doc_id, {_CRC} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
a AS (SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM a),
d AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n),
        lambda i: CASE WHEN i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END) ELSE w END AS w FROM p),
pos AS (SELECT doc_id, n, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS i FROM d),
same AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM pos AS x JOIN pos AS y
    ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
island AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM same),
stretch AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM island GROUP BY doc_id, q, g),
run AS (SELECT doc_id, start, length, min(q) AS period FROM stretch
    WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
listed AS (SELECT doc_id, list({{'s': start, 'z': start + length, 'q': period}}) AS runs, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t
    FROM run GROUP BY doc_id),
best AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
    period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
    sha256(coalesce(t, '')) AS runs_sha256,
    sha256(array_to_string(CASE WHEN runs IS NULL THEN w ELSE list_transform(list_filter(range(n),
        lambda i: len(list_filter(runs, lambda r: i >= r.s + r.q AND i < r.z)) = 0), lambda i: w[i + 1]) END, ' ')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id)
"""

OP12 = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM g, range(1, 6) t(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k >= 2 AND f >= 100),
kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c AS o WHERE o.lang = c.lang
    AND o.k > c.k AND o.f >= c.f AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))),
cut AS (SELECT kept.lang, kept.phrase, kept.f AS a, x.x AS place,
        array_to_string(string_split(kept.phrase, ' ')[1:x.x], ' ') AS head,
        array_to_string(string_split(kept.phrase, ' ')[x.x + 1:], ' ') AS rest
    FROM kept, range(1, 5) x(x) WHERE x.x < kept.k),
scored AS (SELECT cut.lang, cut.phrase, cut.a, one.f AS l, two.f AS r, n.n, cut.place,
        ((1000::HUGEINT * cut.a * n.n) // (one.f::HUGEINT * two.f))::BIGINT AS score
    FROM cut JOIN f AS one ON one.lang = cut.lang AND one.phrase = cut.head
        JOIN f AS two ON two.lang = cut.lang AND two.phrase = cut.rest
        JOIN n ON n.lang = cut.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, place) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n, score FROM lowest QUALIFY rank <= 2000
"""

OP13 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
    FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
    vec_id, score FROM s QUALIFY rank <= 5
"""

ORACLE_SQL: dict[str, str] = {
    "op1_pii": OP1,
    "op2_secrets": OP2,
    "op11_periodic_runs": OP11,
    "op12_phrases": OP12,
    "op13_top_products": OP13,
}
