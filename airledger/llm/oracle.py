"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from airledger.llm import licenses

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS hex,
             row_number() OVER (PARTITION BY body ORDER BY page_id NULLS LAST) AS place,
             first_value(page_id) OVER (PARTITION BY body ORDER BY page_id NULLS LAST) AS first_id FROM p)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(hex, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN first_id END AS refers_to
FROM h
"""

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS win
       FROM (SELECT item, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
hits AS (SELECT DISTINCT doc_id, k, i, item FROM dw JOIN bw USING (k, win)),
n AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS spot FROM hits) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""

#: CRC-32 goes over a text's bytes with the reflected table, which is made by its eight-step rule.
_CRC_TABLE = """bits AS (SELECT i::BIGINT AS i, i::BIGINT AS v, 0 AS step FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, step + 1 FROM bits WHERE step < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE step = 8)"""


def _crc(text: str) -> str:
    """CRC-32 of a text's bytes, where tab is joined."""
    octets = f"string_split(regexp_replace(hex(encode({text})), '(..)', '\\1 ', 'g'), ' ')[:-2]"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform({octets}, lambda x: ('0x' || x)::BIGINT)), "
            "lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295)")


#: The jump walk is a recursion with the published 64-bit generator in HUGEINT.
SHARDING = f"""
WITH RECURSIVE {_CRC_TABLE},
doc AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
crc AS (SELECT doc_id, strlen(body) + 8 AS size, {_crc("body")} AS text_crc32 FROM doc, tab),
keyed AS (SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 16))::UBIGINT::HUGEINT AS k,
   (('0x' || substr(md5(concat_ws(':', doc_id::VARCHAR, size::VARCHAR, text_crc32::VARCHAR)), 1, 8))::BIGINT % 1024) AS slice FROM crc),
walk AS (SELECT DISTINCT k AS key0, k AS k, 0::BIGINT AS pos, 0::BIGINT AS shard, 0::BIGINT AS grown FROM keyed
  UNION ALL SELECT key0, nk, floor((pos + 1) * (2147483648.0::DOUBLE / ((nk // 8589934592) + 1)::DOUBLE))::BIGINT, CASE WHEN pos < 24 THEN pos ELSE shard END, pos
  FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616 AS nk FROM walk WHERE pos <= 24)),
last AS (SELECT key0, max(shard) AS shard, max(grown) AS grown FROM walk GROUP BY key0)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY slice, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown::INTEGER AS grown_shard
FROM keyed JOIN last ON k = key0
"""

#: Near words share the word with one place blanked out, or are the word with one place left out.
SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all({_LOWER}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
counted AS (SELECT doc, run, count(*) AS k FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, k, {_crc("doc || ':' || run")} AS h FROM counted, tab),
slipped AS (SELECT k, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed),
w AS (SELECT word, sum(k)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
p AS (SELECT word, n, i, substr(word, 1, i - 1) AS before, substr(word, i + 1) AS after FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM w)),
less AS (SELECT DISTINCT p.word, p.n, w.word AS near, w.n AS near_n FROM p JOIN w ON w.word = p.before || p.after),
near AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM p a JOIN p b ON a.i = b.i AND a.before = b.before AND a.after = b.after AND a.word <> b.word
  UNION SELECT * FROM less UNION SELECT near, near_n, word, n FROM less),
stat AS (SELECT word, count(*) AS n_near FROM near GROUP BY word),
form AS (SELECT word, near AS form, near_n AS form_n FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1 AND near_n >= 5 * n),
walk AS (SELECT word, word AS spot, 0 AS step FROM w UNION ALL SELECT walk.word, form.form, step + 1 FROM walk JOIN form ON form.word = walk.spot),
ends AS (SELECT word, arg_max(spot, step) AS root FROM walk GROUP BY word)
SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, form, form_n, root
FROM w LEFT JOIN stat USING (word) LEFT JOIN form USING (word) JOIN ends USING (word)
"""

HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM v a JOIN v r ON r.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0),
pos AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank, id AS negative_id,
       positive_score, score AS negative_score
FROM pos JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def _values(rows: list[tuple]) -> str:
    text = lambda x: f"'{x}'" if isinstance(x, str) else "[" + ", ".join(map(text, x)) + "]" if isinstance(x, list) else str(x)
    return "(VALUES " + ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows) + ")"


_PADDED = "' ' || array_to_string(w, ' ') || ' '"
LICENSES = f"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, {_WORDS} AS w FROM documents),
template AS (SELECT t, label, must FROM {_values([(t, label, must) for t, (_, label, must) in enumerate(licenses.TEMPLATES)])} x(t, label, must)),
post AS (SELECT word, t, place FROM {_values(licenses.postings())} x(word, t, place)),
base AS (SELECT phrase, label FROM {_values(list(licenses.BASE.items()))} x(phrase, label)),
pos AS (SELECT uid, unnest(w) AS word, unnest(range(len(w))) AS spot FROM d),
ahead AS (SELECT uid, spot, word || ' ' || coalesce(lead(word) OVER o, '') AS two, word || ' ' || coalesce(lead(word) OVER o, '') || ' ' || coalesce(lead(word, 2) OVER o, '') AS three
  FROM pos WINDOW o AS (PARTITION BY uid ORDER BY spot)),
placed AS (SELECT uid, spot, label FROM ahead JOIN base ON two = phrase OR three = phrase),
based AS (SELECT uid, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, list_sort(list_distinct(list(label))) AS base_labels FROM placed GROUP BY uid),
mark AS (SELECT uid, pos.word, spot FROM pos JOIN (SELECT DISTINCT word FROM post) p ON p.word = pos.word),
have AS (SELECT word, count(DISTINCT uid) AS n FROM mark GROUP BY word),
weight AS (SELECT DISTINCT post.word, coalesce(n, 0) AS n, greatest(1, round(1000 * ln(((SELECT count(*) FROM d) + 1) / (coalesce(n, 0) + 1)))::BIGINT) AS weight FROM post LEFT JOIN have ON have.word = post.word),
whole AS (SELECT t, sum(weight) AS whole FROM post JOIN weight USING (word) GROUP BY t),
looked AS (SELECT uid, word FROM (SELECT DISTINCT uid, word FROM mark) JOIN weight USING (word) QUALIFY row_number() OVER (PARTITION BY uid ORDER BY n, word) <= {licenses.LOOKED}),
agreed AS (SELECT uid, t, spot - place AS start, sum(weight) AS weight FROM mark JOIN looked USING (uid, word) JOIN post USING (word) JOIN weight USING (word)
  GROUP BY uid, t, start HAVING count(*) >= {licenses.AGREEING}),
likely AS (SELECT uid, label, must, round(weight / whole, 6) AS share FROM agreed JOIN whole USING (t) JOIN template USING (t) WHERE round(weight / whole, 6) >= {licenses.SHARE}),
sure AS (SELECT uid, list(DISTINCT label) AS labels, max(share) AS share FROM likely JOIN d USING (uid)
  WHERE len(list_filter(must, lambda p: NOT contains({_PADDED}, ' ' || p || ' '))) = 0 GROUP BY uid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(array_to_string(base_labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base_labels, []), coalesce(labels, [])))), ','), '') AS labels,
       CASE WHEN n_base IS NOT NULL THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN based USING (uid) LEFT JOIN sure USING (uid)
"""

ORACLE = {"op1_warc": WARC, "op3_decontaminate": DECONTAMINATE, "op7_sharding": SHARDING, "op11_spelling": SPELLING,
          "op12_hard_negatives": HARD_NEGATIVES, "op13_licenses": LICENSES}
