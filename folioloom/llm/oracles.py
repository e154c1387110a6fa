"""SQL for the operators that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"

OP2 = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
), shingled AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM worded
), entries AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM shingled
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n AS both, count(*) AS shared
  FROM entries a JOIN entries b ON a.shingle = b.shingle AND a.doc_id != b.doc_id AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY ALL HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reached AS (
  SELECT a AS doc_id, b AS other FROM pairs UNION SELECT reached.doc_id, pairs.b FROM reached JOIN pairs ON reached.other = pairs.a
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(min(r.other), s.doc_id)) AS component_id
FROM shingled s LEFT JOIN reached r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.s
"""

OP11 = f"""
WITH worded AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), windows AS (
  SELECT row, s, md5(array_to_string(w[s + 1:s + 35], ' ')) AS h FROM (SELECT row, w, unnest(range(0, len(w) - 34)) AS s FROM worded)
), repeated AS (
  SELECT row, s FROM windows JOIN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1) USING (h)
), gone AS (
  SELECT DISTINCT row, unnest(range(s, s + 35)) AS i FROM repeated
), placed AS (
  SELECT row, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM worded
), kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM placed ANTI JOIN gone USING (row, i) GROUP BY row
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (row)
"""

OP12 = rf"""
WITH given AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), entries AS (
  SELECT row, lang, source, unnest(w) AS term FROM given
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS c FROM entries GROUP BY lang, term HAVING count(DISTINCT row) >= 3
), counts AS (
  SELECT lang, source, term, count(*)::HUGEINT AS c FROM entries SEMI JOIN kept USING (lang, term) GROUP BY ALL
), languages AS (
  SELECT lang, count(term)::HUGEINT AS v, coalesce(sum(c), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang FROM given) LEFT JOIN kept USING (lang) GROUP BY lang
), sizes AS (
  SELECT lang, source, v, coalesce(sum(c), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM given) JOIN languages USING (lang)
    LEFT JOIN counts USING (lang, source) GROUP BY ALL
), shares AS (
  SELECT lang, source, term, coalesce(counts.c, 0) AS c, 1 + (1000000000 * (coalesce(counts.c, 0) + 1)) // (n + v) AS p
  FROM sizes JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
  FROM sizes a JOIN sizes b ON a.lang = b.lang AND a.source != b.source
    LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
), terms AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value
  FROM shares JOIN (SELECT lang, term, 1 + (1000000000 * (c + 1)) // (n + v) AS q FROM kept JOIN languages USING (lang)) USING (lang, term) WHERE c > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms
)
SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= 200
"""

OP13 = r"""
WITH digested AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents
), drawn AS (
  SELECT doc_id, text, u, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM digested
), cut AS (
  SELECT doc_id, text, n, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(u[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
    array_to_string(u[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
    array_to_string(u[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS s FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form != 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form != 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""

ORACLES = {"op2_ngram_jaccard_join": OP2, "op11_substring_dedup": OP11, "op12_source_divergence": OP12, "op13_fill_in_middle": OP13}
