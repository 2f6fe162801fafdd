r"""DuckDB SQL for the corpus queries that SQL can express: exact links, plain string digests and plain distances.

The other operators learn, hash with functions DuckDB lacks, or assemble tokens; tests hold those to brute force.
"""

from __future__ import annotations

from barloom.llm import divergence, neardup, spelling, vectors

#: Every id with the smallest id that links reach from it; ``link`` has both directions.
_REACH = "reach(id, other) AS (SELECT a, b FROM link UNION SELECT r.id, l.b FROM reach r JOIN link l ON l.a = r.other)"

NEAR_DEDUP = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos, len(w) AS n
  FROM (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents)
), runs AS (
  SELECT doc_id, pos, n, concat_ws(' ', word, {", ".join(f"lead(word, {k}) OVER d" for k in range(1, neardup.WORDS))}) AS s
  FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), sets AS (
  SELECT DISTINCT doc_id, s FROM runs WHERE pos = 1 OR pos + {neardup.WORDS - 1} <= n
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), both_have AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), near AS (
  SELECT a, b FROM both_have c JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c.n >= {neardup.PERCENT} * (p.n + q.n - c.n)
), link AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near), {_REACH},
named AS (SELECT id, least(id, min(other)) AS root FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(r.root, d.doc_id) AS component_id, coalesce(r.root, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN named r ON r.id = d.doc_id
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, k, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(k, r)
), sized AS (
  SELECT *, length('<|im_start|>') + length('<|im_end|>') + 2
    + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g'))
    + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

EMBEDDINGS = f"""
WITH RECURSIVE good AS (
  SELECT vec_id FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x FROM embeddings)
  GROUP BY vec_id HAVING count(x) = count(*) AND bool_and(isfinite(x)) AND max(abs(x)) > 0
), vec AS (
  SELECT vec_id, embedding::DOUBLE[] AS e, len(embedding) AS d FROM embeddings WHERE vec_id IN (SELECT vec_id FROM good)
), near AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vec x JOIN vec y ON x.vec_id < y.vec_id
  WHERE CASE WHEN x.d = y.d THEN list_cosine_similarity(x.e, y.e) >= {vectors.COSINE} ELSE false END
), link AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near), {_REACH},
named AS (SELECT id, least(id, min(other)) AS root FROM reach GROUP BY id),
degree AS (SELECT a AS id, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(g.n, 0)::BIGINT AS n_links, coalesce(r.root, v.vec_id) AS component_id, coalesce(r.root, v.vec_id) = v.vec_id AS kept
FROM embeddings v LEFT JOIN degree g ON g.id = v.vec_id LEFT JOIN named r ON r.id = v.vec_id
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DIVERGENCE = rf"""
WITH texts AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS id, {_LOWER.format("coalesce(text, '')")} AS text FROM documents
), terms AS (
  SELECT lang, source, id, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts
), counts AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n, count(DISTINCT id) AS docs FROM terms GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n) AS total FROM counts GROUP BY ALL HAVING sum(docs) >= {divergence.DOCUMENTS}
), sizes AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(total) AS n FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM texts
), cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.total, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS n_group
  FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
  SELECT c.lang, c.source, c.term, c.n, 1 + {divergence.SCALE}::HUGEINT * (c.n + 1) // (c.n_group + s.v) AS p,
    1 + {divergence.SCALE}::HUGEINT * (c.total + 1) // (s.n + s.v) AS q
  FROM cells c JOIN sizes s ON s.lang = c.lang
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP}
"""

#: Bytes of the UTF-8 form of a Latin-1 string, and the checksum over them.
_BYTES = "flatten([CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 | (unicode(c) >> 6), 128 | (unicode(c) & 63)] END FOR c IN string_split({}, '')])"
_CRC = "xor(list_reduce({}, lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)"

SPELLING = rf"""
WITH RECURSIVE steps AS (
  SELECT i AS byte, 0 AS k, i AS c FROM range(256) t(i)
  UNION ALL SELECT byte, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
), crcs AS (
  SELECT list(c::BIGINT ORDER BY byte) AS crc FROM steps WHERE k = 8
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents
), found AS (
  SELECT run, n, {_CRC.format(_BYTES.format("coalesce(doc_id::VARCHAR, '') || ':' || run"))} AS h
  FROM (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL), crcs
), words AS (
  SELECT CASE WHEN h % {spelling.DAMAGE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM found GROUP BY 1 HAVING length(word) >= {spelling.LETTERS} AND sum(n) >= {spelling.TIMES}
), spots AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS spot FROM words
), holes AS (
  SELECT word, n, spot, substr(word, 1, spot - 1) || substr(word, spot + 1) AS rest FROM spots
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM holes a JOIN holes b ON a.rest = b.rest AND a.spot = b.spot AND a.word <> b.word
  UNION SELECT a.word, a.n, w.word, w.n FROM holes a JOIN words w ON w.word = a.rest
  UNION SELECT w.word, w.n, a.word, a.n FROM holes a JOIN words w ON w.word = a.rest
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= {spelling.FACTOR} * w.n THEN b.other END AS form, CASE WHEN b.m >= {spelling.FACTOR} * w.n THEN b.m END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), chains AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chains c JOIN forms f ON f.word = c.next
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chains c ON c.word = f.word AND c.next IS NULL
"""

SQL = {
    "op2_minhash_near_dedup": NEAR_DEDUP,
    "op3_chat_formatting": CHAT,
    "op9_embedding_near_dedup": EMBEDDINGS,
    "op11_source_divergence": DIVERGENCE,
    "op13_spelling_variants": SPELLING,
}
