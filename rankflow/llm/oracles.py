"""DuckDB SQL of the corpus queries that SQL can express at the size of the check."""

from __future__ import annotations

# Words of the decontamination and license contracts, as a DuckDB list.
_ALNUM = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP2 = f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_ALNUM} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(list_slice(w, p, p + least(13, len(w)) - 1), ' ') AS g
       FROM i, LATERAL (SELECT unnest(range(1, greatest(1, len(w) - 12) + 1)) AS p) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT doc_id, p, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS g
       FROM d, ks, LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS p)),
m AS (SELECT dw.doc_id, dw.p, dw.k, iw.item_id FROM dw JOIN iw USING (k, g)),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM (SELECT DISTINCT doc_id, p, k FROM m)) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)"""

# Terms of the search contract.
_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
s AS (SELECT count(*) AS nn, sum(len(w)) AS ll FROM d WHERE len(w) > 0),
dt AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM dt GROUP BY 1),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM f, s),
it AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
p AS (SELECT it.item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * nn) // ll))))) AS score
      FROM it JOIN dt USING (term) JOIN w USING (term), s GROUP BY ALL),
k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM p WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM k WHERE rank <= 10"""


def _crc_table() -> list[int]:
    """The table of crc32 for the reflected polynomial EDB88320."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


# Words one edit apart share what is left of them after a deletion, or one is what is left of the other.
OP13 = f"""
WITH RECURSIVE runs AS (SELECT id, run, count(*) AS n FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
tab AS (SELECT {_crc_table()}::UBIGINT[] AS t),
coded AS (SELECT run, n, hex(encode(id || ':' || run)) AS x FROM runs),
hashed AS (SELECT run, n, xor(list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(range(1, length(x) // 2 + 1), lambda i: CAST('0x' || substr(x, CAST(2 * i - 1 AS BIGINT), 2) AS UBIGINT))),
      lambda c, b: xor(t[CAST(xor(c, b) & 255 AS BIGINT) + 1], c >> 8)), 4294967295::UBIGINT) AS h FROM coded, tab),
cut AS (SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM hashed),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
del AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM v)),
pair AS (SELECT a.word AS u, b.word AS w, b.n AS wn FROM del a JOIN del b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
         UNION SELECT a.word, v.word, v.n FROM del a JOIN v ON a.rest = v.word
         UNION SELECT v.word, a.word, a.n FROM del a JOIN v ON a.rest = v.word),
near AS (SELECT u AS word, count(*) AS n_near, max(wn) AS most FROM pair GROUP BY 1),
best AS (SELECT near.word, n_near, most, min(w) AS nearest FROM near JOIN pair ON near.word = pair.u AND pair.wn = most GROUP BY ALL),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * v.n THEN nearest END AS form, CASE WHEN most >= 10 * v.n THEN most END AS form_n
      FROM v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS at, form AS next FROM f UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN f ON walk.next = f.word)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n FROM f JOIN walk ON f.word = walk.word WHERE walk.next IS NULL"""

# Bytes as hex, two digits each; a place in the table is doc_id and byte in one number.
OP3 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, p, md5(substr(x, 2 * p - 1, 200)) AS h, doc_id * 4294967296 + p AS place
      FROM d, LATERAL (SELECT unnest(range(1, len(x) // 2 - 98)) AS p)),
f AS (SELECT h, min(place) AS first FROM w GROUP BY h HAVING count(*) > 1),
r AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS new FROM w JOIN f USING (h) WHERE place > first),
i AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM r) GROUP BY doc_id, run),
c AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last FROM i GROUP BY doc_id),
s AS (SELECT doc_id, lag(b, 1, 1) OVER (PARTITION BY doc_id ORDER BY a) AS a, a AS b FROM i
      UNION ALL SELECT d.doc_id, coalesce(last, 1), len(x) // 2 + 1 FROM d LEFT JOIN c USING (doc_id)),
k AS (SELECT doc_id, string_agg(substr(x, CAST(2 * a - 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)), '' ORDER BY a) AS kept FROM s JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(kept)) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id) JOIN k USING (doc_id)"""

ORACLES = {"op2_decontaminate": OP2, "op3_suffixes": OP3, "op11_search": OP11, "op13_spelling": OP13}
