"""DuckDB SQL for the queries that SQL can say.

The others rest on a tokenizer (2, 10), on trained trees (5) or on hashes that DuckDB
doesn't have (6, 9); tests hold them against brute force, round trips and held-out labels.
"""

from __future__ import annotations

from rateweave.llm import chat_trees, pii

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Each 100-byte window as hex digits; all but the first of equal ones cover what goes.
OP1 = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS s
      FROM (SELECT doc_id, h, unnest(range(0, CAST(length(h) / 2 AS BIGINT) - 99)) AS p FROM b)),
dup AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS n FROM w) WHERE n > 1),
mark AS (SELECT doc_id, p, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 1 ELSE 0 END AS fresh FROM dup),
isle AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM mark),
run AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS z FROM isle GROUP BY doc_id, k),
gap AS (SELECT run.doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY run.doc_id ORDER BY a), 0) AS last FROM run),
cut AS (SELECT b.doc_id, sum(z - a) AS gone, count(*) AS runs, max(z) AS tail,
               string_agg(substr(h, CAST(2 * last + 1 AS BIGINT), CAST(2 * (a - last) AS BIGINT)), '' ORDER BY a) AS head
        FROM gap JOIN b ON b.doc_id = gap.doc_id GROUP BY b.doc_id)
SELECT b.doc_id, CAST(length(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(runs, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, CAST(2 * coalesce(tail, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM b LEFT JOIN cut ON cut.doc_id = b.doc_id
"""


def _escaped(column: str) -> str:
    for plain, written in chat_trees.ESCAPES:
        column = f"replace({column}, '{plain}', '{written}')"
    return column


_MARKS = len(chat_trees.OPEN) + len(chat_trees.CLOSE) + len(chat_trees.END)

OP3 = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS txt FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || txt || chr(10), '' ORDER BY turn, role, txt)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(txt) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN txt ELSE '' END, '' ORDER BY turn, role, txt)) AS loss_sha256,
       CAST(sum({_MARKS} + length({_escaped("role")}) + length({_escaped("txt")})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

OP4 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
g AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 2], chr(10))) AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM g GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
         WHERE 100 * common >= 90 * (x.size + y.size - common)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT d.doc_id, coalesce(n.size, 0) AS n_shingles, min(reach.b) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id, n.size
"""

_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

OP7 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 11, 2))) AS i FROM b WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM win),
occ AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS s
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, size)),
hit AS (SELECT occ.doc_id, occ.p, occ.n, win.item FROM occ JOIN win ON win.s = occ.s AND win.n = occ.n),
pos AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos ON pos.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id
"""

#: The patterns of the contract in DuckDB's dialect, which has no look-around; iban edges by word boundary.
_PII = {
    "email": "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+",
    "ip": "[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)",
    "card": "[0-9]([\\x20-]?[0-9])+",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
    "iban": f"\\b(?:{'|'.join(pii.ACCOUNT_LENGTHS)})[0-9]{{2}}",         # what may begin one
}
_OK = {
    "email": "true",
    "ip": "len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR CAST('0' || right(ltrim(x, '0'), 4) AS INT) > 255)) = 0",
    "card": "length(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 16 AND 19 AND "
            "list_sum(list_transform(range(1, length(regexp_replace(m, '[^0-9]', '', 'g')) + 1), "
            "lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr(reverse(regexp_replace(m, '[^0-9]', '', 'g')), i, 1) AS INT) ELSE "
            "CAST(substr('0246813579', CAST(substr(reverse(regexp_replace(m, '[^0-9]', '', 'g')), i, 1) AS INT) + 1, 1) AS INT) END)) % 10 = 0",
    "phone": "length(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 8 AND 15",
    "iban": "m <> '' AND list_reduce(list_transform(string_split(substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4), ''), "
            "lambda c: CAST(CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END AS BIGINT)), "
            "lambda a, x: (CASE WHEN x > 9 THEN a * 100 ELSE a * 10 END + x) % 97, CAST(0 AS BIGINT)) = 1",
}


_ACCOUNT = "|".join(f"{c}[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for c, n in pii.ACCOUNT_LENGTHS.items())


def _near(kind: str) -> str:
    """The score of a span in percent."""
    words, score = pii.CONTEXT[kind]
    text = f"substr(t, greatest(a - {pii.NEAR}, 0) + 1, z - greatest(a - {pii.NEAR}, 0) + {pii.NEAR})"
    return f"CASE WHEN regexp_matches({text}, '(?i)(?:^|[^A-Za-z0-9_])(?:{words})') THEN {round(min(1.0, score + 0.1) * 100)} " \
           f"ELSE {round(score * 100)} END"


def _spans(rank: int, kind: str) -> str:
    # an account number runs from what begins it for its country's length; none begins inside the one before
    whole = f"SELECT doc_id, t, a, regexp_extract(substr(t, a + 1, 70), '^(?:{_ACCOUNT})\\b') AS m FROM (SELECT * FROM"
    outer, close = (whole, ")") if kind == "iban" else ("SELECT * FROM", "")
    apart = """
QUALIFY coalesce(a >= max(z) OVER (PARTITION BY doc_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true)""" \
        if kind == "iban" else ""
    return f"""
SELECT doc_id, k, kind, a, z, {_near(kind)} AS score FROM (
SELECT doc_id, t, {rank} AS k, '{kind}' AS kind, a, a + length(m) AS z FROM ({outer} (
  SELECT doc_id, t, ms[i] AS m, CAST(list_sum(list_transform(ps[1:i], lambda x: length(x)))
         + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a
  FROM (SELECT doc_id, t, ms, ps, unnest(range(1, len(ms) + 1)) AS i FROM (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_PII[kind]}') AS ms,
           string_split_regex(coalesce(text, ''), '{_PII[kind]}') AS ps FROM documents))){close})
WHERE {_OK[kind]}{apart})"""


OP8 = f"""
WITH s AS ({" UNION ALL ".join(_spans(k, kind) for k, kind in enumerate(pii.PATTERNS))}),
t AS (SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in pii.BASE)},
             string_agg(concat_ws(':', kind, a, z), ',' ORDER BY k, a) FILTER (k < {len(pii.BASE)}) AS base,
             string_agg(concat_ws(':', kind, a, z), ',' ORDER BY k, a) AS spans,
             string_agg(concat_ws(':', kind, a, z, score), ',' ORDER BY k, a) AS scored FROM s GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in pii.BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scored, '') AS scored
FROM documents d LEFT JOIN t ON t.doc_id = d.doc_id
"""


def _codebook_round(before: str, after: str) -> str:
    """Parts to the nearest entries of codebook ``before`` (a table with ``_a``), and the codebook after it."""
    return f"""
{before}_a AS MATERIALIZED (
  SELECT rid, j, arg_min(e, d * 64 + e) AS e, min(d) AS d
  FROM (SELECT p.rid, p.j, c.e, CAST(list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM p JOIN {before} c USING (j))
  GROUP BY rid, j),
{after} AS MATERIALIZED (
  SELECT c.j, c.e, coalesce(m.x, c.x) AS x
  FROM {before} c LEFT JOIN (
    SELECT j, e, list((s - ((s % n) + n) % n) // n ORDER BY k) AS x
    FROM (SELECT a.j, a.e, t.k, CAST(sum(p.x[t.k]) AS BIGINT) AS s, count(*) AS n
          FROM {before}_a a JOIN p USING (rid, j) CROSS JOIN (SELECT unnest(range(1, w + 1)) AS k FROM width) t
          GROUP BY a.j, a.e, t.k)
    GROUP BY j, e) m USING (j, e))"""


OP13 = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
width AS (SELECT max(len(v)) // 16 AS w FROM kept),
p AS MATERIALIZED (
  SELECT rid, j, v[j * w + 1 : j * w + w] AS x FROM kept, width, (SELECT unnest(range(16)) AS j)),
c0 AS MATERIALIZED (
  SELECT j, e, x FROM p JOIN (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM kept) USING (rid)
  WHERE e < 64),{_codebook_round("c0", "c1")},{_codebook_round("c1", "c2")},{_codebook_round("c2", "c3")},
books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY j, e)) AS codebooks_sha256 FROM c2),
coded AS (SELECT rid, string_agg(lower(format('{{:02x}}', e)), '' ORDER BY j) AS code, CAST(sum(d) AS BIGINT) AS error
          FROM c2_a GROUP BY rid)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, b.codebooks_sha256
FROM kept k JOIN coded c USING (rid) CROSS JOIN books b
"""

ORACLE_SQL: dict[str, str] = {
    "op1_suffix_dedup": OP1,
    "op3_chat_trees": OP3,
    "op4_ngram_join": OP4,
    "op7_decontaminate": OP7,
    "op8_pii": OP8,
    "op13_cover_codes": OP13,
}
