"""DuckDB SQL of the operators that SQL can express; rules are written out, not imported."""

from __future__ import annotations

# CRC-32 of ASCII text `s` as a list fold; `t` is the table of the reflected polynomial.
CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t)"""


def crc_of(codes: str) -> str:
    return (f"xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], {codes}),"
            " lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])))")


# The input of a leaf's digest: `-` for null, else byte count, colon, value.
def field_of(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


ORACLE_SQL = {
    "op6_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t-\r]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)""",
    "op8_line_dedup": r"""
WITH ls AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
hosts AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
shares AS (SELECT source, line, count(DISTINCT doc_id) AS n FROM ls
           WHERE NOT regexp_full_match(line, '[ \t-\r]*') GROUP BY source, line),
boiler AS (SELECT s.source, s.line FROM shares s JOIN hosts h ON h.source IS NOT DISTINCT FROM s.source
           WHERE s.n >= 5 AND s.n > 0.02 * h.pages),
marked AS (SELECT l.*, b.line IS NOT NULL AS dropped FROM ls l LEFT JOIN boiler b
           ON b.source IS NOT DISTINCT FROM l.source AND b.line = l.line)
SELECT doc_id, count(*) AS n_lines, CAST(sum(dropped::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    # Levels from the leaves up as rows (g, level, pos, digest), then a fold of every leaf upwards over its runs.
    "op11_merkle_manifest": rf"""
WITH RECURSIVE {CRC_TABLE},
d AS (SELECT documents.*, CASE WHEN {crc_of("list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)")} % 3 = 0
             THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS other
      FROM documents, crc),
leaves AS (
  SELECT doc_id, lang, sha256({" || ".join(field_of(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS leaf,
         sha256({" || ".join(field_of(c) for c in ("doc_id", "source", "lang", "n_chars", "other"))}) AS altered FROM d),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) AS g, count(*) OVER (PARTITION BY lang) AS n,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
up AS (
  SELECT g, 0 AS level, pos, leaf AS digest, n FROM placed
  UNION ALL
  SELECT g, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (max(n) + 7) // 8
  FROM up WHERE n > 1 GROUP BY g, level, pos // 8),
subroots AS (SELECT g, g - 1 AS pos, digest, (SELECT max(g) FROM placed) AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS g, 0 AS level, pos, digest, n FROM subroots
  UNION ALL
  SELECT g, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (max(n) + 7) // 8
  FROM top WHERE n > 1 GROUP BY g, level, pos // 8),
runs AS (
  SELECT g, level, pos // 8 AS run, list(digest ORDER BY pos) AS ds FROM up WHERE n > 1 GROUP BY g, level, pos // 8),
top_runs AS (
  SELECT level, pos // 8 AS run, list(digest ORDER BY pos) AS ds FROM top WHERE n > 1 GROUP BY level, pos // 8),
fold AS (
  SELECT doc_id, g, pos AS row, 0 AS level, pos, altered AS digest, '' AS proof FROM placed
  UNION ALL
  SELECT f.doc_id, f.g, f.row, f.level + 1, f.pos // 8,
         sha256(array_to_string(ds[:f.pos % 8], '') || f.digest || array_to_string(ds[f.pos % 8 + 2:], '')),
         f.proof || array_to_string(ds[:f.pos % 8], '') || array_to_string(ds[f.pos % 8 + 2:], '')
  FROM fold f JOIN runs r ON r.g = f.g AND r.level = f.level AND r.run = f.pos // 8),
ended AS (SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY g, row ORDER BY level DESC) = 1),
top_fold AS (
  SELECT doc_id, g, row, 0 AS level, g - 1 AS pos, digest, proof FROM ended
  UNION ALL
  SELECT f.doc_id, f.g, f.row, f.level + 1, f.pos // 8,
         sha256(array_to_string(ds[:f.pos % 8], '') || f.digest || array_to_string(ds[f.pos % 8 + 2:], '')),
         f.proof || array_to_string(ds[:f.pos % 8], '') || array_to_string(ds[f.pos % 8 + 2:], '')
  FROM top_fold f JOIN top_runs r ON r.level = f.level AND r.run = f.pos // 8),
whole AS (SELECT * FROM top_fold QUALIFY row_number() OVER (PARTITION BY g, row ORDER BY level DESC) = 1),
root AS (SELECT digest AS root FROM top WHERE n = 1)
SELECT w.doc_id, p.leaf, s.digest AS subroot, root, sha256(w.proof) AS proof_sha256, w.digest AS folded_root,
       w.digest = root AS verified
FROM whole w JOIN placed p ON p.g = w.g AND p.pos = w.row JOIN subroots s ON s.g = w.g, root""",
    # Near words by letters left out: at one place of both (replaced), or of the longer one (inserted).
    "op13_spelling_variants": rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
hexed AS (SELECT doc_id, run, hex(encode(doc_id::VARCHAR || ':' || run)) AS x, count(*) AS n
          FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
summed AS (
  SELECT run, n, {crc_of("list_transform(range(1, strlen(x) + 1, 2), lambda i: ('0x' || x[i:i + 1])::BIGINT)")} AS h
  FROM hexed, crc),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word,
         CAST(sum(n) AS BIGINT) AS n FROM summed GROUP BY 1 HAVING sum(n) >= 2 AND length(word) >= 7),
cuts AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(lack := -n, other := encode(other))) AS b FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -b.lack >= 10 * w.n THEN decode(b.other) END AS form, CASE WHEN -b.lack >= 10 * w.n THEN -b.lack END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word),
up AS (
  SELECT word, word AS last, 0 AS steps FROM forms
  UNION ALL SELECT u.word, f.form, steps + 1 FROM up u JOIN forms f ON f.word = u.last WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(last, steps) AS root FROM up GROUP BY word)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN ends ON ends.word = f.word""",
}
