"""DuckDB SQL of the operators that SQL can express, each written another way
than the operator works."""

from __future__ import annotations

DECONTAMINATE = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
doc_words AS (
  SELECT rid, unnest(w) AS w, generate_subscripts(w, 1) AS pos FROM (
    SELECT rid, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM docs)),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS k FROM (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL) WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (
    SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM items)),
sizes AS (SELECT DISTINCT k FROM item_windows),
ahead AS (
  SELECT rid, pos, list(w) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS ws FROM doc_words),
doc_windows AS (SELECT rid, pos, k, array_to_string(ws[1:k], ' ') AS s FROM ahead, sizes WHERE len(ws) >= k),
hits AS (SELECT d.rid, d.pos, d.k, i.item FROM doc_windows d JOIN item_windows i ON i.k = d.k AND i.s = d.s),
hit_words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(pos, pos + k)) AS p FROM (SELECT DISTINCT rid, pos, k FROM hits)) GROUP BY rid),
hit_items AS (SELECT rid, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS named FROM (SELECT DISTINCT rid, item FROM hits WHERE item IS NOT NULL) GROUP BY rid),
sizes_of AS (SELECT rid, count(*) AS n_words FROM doc_words GROUP BY rid)
SELECT d.doc_id, coalesce(s.n_words, 0) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.named, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN sizes_of s USING (rid) LEFT JOIN hit_words h USING (rid) LEFT JOIN hit_items i USING (rid)
"""

# crc32 byte by byte from its table (polynomial 0xEDB88320); near words share a residue (the word less one code point)
SPELLING = r"""
WITH RECURSIVE bits(i, step, c) AS (
  SELECT i, 0, CAST(i AS BIGINT) FROM range(256) t(i)
  UNION ALL
  SELECT i, step + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM bits WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY i) AS crcs FROM bits WHERE step = 8),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
    FROM documents WHERE text IS NOT NULL) WHERE length(run) >= 7 GROUP BY doc_id, run),
spelled AS (SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS bytes FROM runs),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(length(bytes) // 2), lambda i: CAST('0x' || substr(bytes, CAST(2 * i + 1 AS INT), 2) AS BIGINT))),
    lambda c, b: xor(c // 256, crcs[xor(c % 256, b) + 1]))) AS h
  FROM spelled, crc_table),
typed AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
residues AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS residue FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM residues a JOIN residues b ON a.i = b.i AND a.residue = b.residue AND a.word <> b.word
  UNION SELECT a.word, a.residue FROM residues a JOIN words b ON b.word = a.residue
  UNION SELECT a.residue, a.word FROM residues a JOIN words b ON b.word = a.residue),
ranked AS (
  SELECT x.word, x.other, o.n AS m, count(*) OVER (PARTITION BY x.word) AS n_near,
         row_number() OVER (PARTITION BY x.word ORDER BY o.n DESC, x.other) AS rank
  FROM near x JOIN words o ON o.word = x.other),
forms AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
         CASE WHEN r.m >= 10 * w.n THEN r.other END AS form, CASE WHEN r.m >= 10 * w.n THEN r.m END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.rank = 1),
ways(word, stop) AS (
  SELECT word, word FROM forms
  UNION ALL
  SELECT ways.word, forms.form FROM ways JOIN forms ON forms.word = ways.stop WHERE forms.form IS NOT NULL)
SELECT f.word, f.form, w.stop AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN ways w ON w.word = f.word JOIN forms e ON e.word = w.stop AND e.form IS NULL
"""

INFILL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS g FROM documents),
drawn AS (
  SELECT doc_id, text, CAST(n AS BIGINT) AS n, [CAST('0x' || substr(g, 8 * CAST(k AS INT) + 1, 8) AS BIGINT) for k in range(4)] AS h FROM docs),
cut AS (
  SELECT doc_id, text, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, substring(text, 1, CAST(a AS INT)) AS p, substring(text, CAST(a AS INT) + 1, CAST(b - a AS INT)) AS m, substring(text, CAST(b AS INT) + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

ORACLE: dict[str, str] = {
    "op11_decontaminate": DECONTAMINATE,
    "op12_spelling_variants": SPELLING,
    "op13_fill_in_middle": INFILL,
}
