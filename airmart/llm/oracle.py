"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

# The base-32 alphabet.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

JACCARD = rf"""
WITH RECURSIVE
  words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
  placed AS (SELECT doc_id, len(w) AS m, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM words),
  runs AS (
    SELECT doc_id, m, k, concat_ws(' ', word, lead(word, 1) OVER p, lead(word, 2) OVER p, lead(word, 3) OVER p, lead(word, 4) OVER p) AS g
    FROM placed WINDOW p AS (PARTITION BY doc_id ORDER BY k)),
  grams AS (SELECT DISTINCT doc_id, g FROM runs WHERE k <= greatest(1, m - 4)),
  rows_ AS (SELECT doc_id, count(*) OVER (PARTITION BY doc_id) AS n, g FROM grams),
  shared AS (SELECT * FROM rows_ WHERE g IN (SELECT g FROM grams GROUP BY g HAVING count(*) > 1)),
  links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM shared a JOIN shared b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
  reached AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.y) AS component_id
FROM documents d JOIN reached r ON r.x = d.doc_id LEFT JOIN (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id) s ON s.doc_id = d.doc_id
GROUP BY d.doc_id
"""

WARC = f"""
WITH
  own AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha1(coalesce(html, '')) AS hex FROM pages),
  heads AS (SELECT hex, n, min(page_id) AS head FROM own GROUP BY hex, n),
  bits AS (
    SELECT own.*, head, array_to_string(list_transform(range(40), lambda i:
      substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (instr('0123456789abcdef', hex[i + 1]) - 1) + 1, 4)), '') AS b
    FROM own JOIN heads USING (hex, n))
SELECT page_id, n AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('{BASE32}', 1
    + 16 * CAST(b[5 * i + 1] AS INTEGER) + 8 * CAST(b[5 * i + 2] AS INTEGER) + 4 * CAST(b[5 * i + 3] AS INTEGER)
    + 2 * CAST(b[5 * i + 4] AS INTEGER) + CAST(b[5 * i + 5] AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN head = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN head <> page_id THEN head END AS refers_to
FROM bits
"""

# Every node of the trees by source and of the tree above them, then all siblings of each document.
MERKLE = """
WITH RECURSIVE
  table_(i, c) AS (
    SELECT i, list_reduce([CAST(i AS BIGINT)] || range(8), lambda c, k: CASE WHEN c %% 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
    FROM (SELECT unnest(range(256)) AS i)),
  codes AS (SELECT list(c ORDER BY i) AS t FROM table_),
  even AS (
    SELECT doc_id FROM documents, codes
    WHERE xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) %% 2 = 0),
  fields AS (
    SELECT doc_id, source, text,
      concat(%(doc_id)s, %(source)s, %(lang)s, %(n_chars)s) AS head,
      CASE WHEN crc32_even THEN replace(text, chr(10), '') ELSE text END AS changed
    FROM (SELECT *, doc_id IN (SELECT doc_id FROM even) AS crc32_even FROM documents)),
  own AS (
    SELECT doc_id, source, sha256(concat(head, %(text)s)) AS leaf, sha256(concat(head, %(changed)s)) AS folded,
      row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
    FROM fields),
  tree AS (
    SELECT source, 0 AS level, pos, n, leaf AS digest FROM own
    UNION ALL
    SELECT source, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY source, level, pos // 3, n),
  subroots AS (
    SELECT source, digest AS subroot, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
  top AS (
    SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 3, n),
  steps AS (
    SELECT o.doc_id, o.source, t.level, coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos < o.pos // p.v), '') AS before,
      coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos > o.pos // p.v), '') AS after
    FROM own o JOIN tree t ON o.source IS NOT DISTINCT FROM t.source AND t.n > 1
      JOIN (SELECT k, CAST(pow(3, k) AS BIGINT) AS v FROM (SELECT unnest(range(30)) AS k)) p ON p.k = t.level AND t.pos // 3 = o.pos // (3 * p.v)
    GROUP BY ALL
    UNION ALL
    SELECT o.doc_id, o.source, s.height + t.level, coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos < s.pos // p.v), ''),
      coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos > s.pos // p.v), '')
    FROM own o JOIN subroots s ON o.source IS NOT DISTINCT FROM s.source JOIN top t ON t.n > 1
      JOIN (SELECT k, CAST(pow(3, k) AS BIGINT) AS v FROM (SELECT unnest(range(30)) AS k)) p ON p.k = t.level AND t.pos // 3 = s.pos // (3 * p.v)
    GROUP BY o.doc_id, o.source, s.height, t.level),
  folds AS (
    SELECT doc_id, source, 0 AS level, folded AS digest FROM own
    UNION ALL
    SELECT f.doc_id, f.source, f.level + 1, sha256(concat(s.before, f.digest, s.after))
    FROM folds f JOIN steps s ON s.doc_id = f.doc_id AND s.source IS NOT DISTINCT FROM f.source AND s.level = f.level),
  ends AS (SELECT doc_id, source, arg_max(digest, level) AS folded_root FROM folds GROUP BY ALL),
  proofs AS (SELECT doc_id, source, string_agg(concat(before, after), '' ORDER BY level) AS p FROM steps GROUP BY ALL)
SELECT o.doc_id, o.leaf, s.subroot, r.digest AS root, sha256(coalesce(p.p, '')) AS proof_sha256, e.folded_root, e.folded_root = r.digest AS verified
FROM own o JOIN subroots s ON o.source IS NOT DISTINCT FROM s.source JOIN (SELECT digest FROM top WHERE n = 1) r ON true
  JOIN ends e ON e.doc_id = o.doc_id AND e.source IS NOT DISTINCT FROM o.source
  LEFT JOIN proofs p ON p.doc_id = o.doc_id AND p.source IS NOT DISTINCT FROM o.source
""" % {c: f"coalesce(concat(strlen(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)), '-')" for c in ("doc_id", "source", "lang", "n_chars", "text", "changed")}

COLLOCATIONS = rf"""
WITH
  pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
  words AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
  totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
  grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM words, range(1, 6) t(k)),
  counts AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
  found AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
  cuts AS (SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS c FROM found),
  scores AS (
    SELECT f.*, l.a AS l, r.a AS r, t.n, CAST((1000::HUGEINT * f.a * t.n) // (l.a::HUGEINT * r.a) AS BIGINT) AS score
    FROM cuts f JOIN totals t ON t.lang = f.lang JOIN counts l ON l.lang = f.lang AND l.phrase = array_to_string(f.w[1:f.c], ' ')
      JOIN counts r ON r.lang = f.lang AND r.phrase = array_to_string(f.w[f.c + 1:], ' ')),
  lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
  inner_ AS (
    SELECT DISTINCT lang, a, unnest(flatten(list_transform(range(2, k), lambda s: list_transform(range(1, k - s + 2), lambda i: array_to_string(w[i:i + s - 1], ' '))))) AS phrase
    FROM found),
  kept AS (SELECT * FROM lowest f WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = f.lang AND i.phrase = f.phrase AND 100 * i.a >= 100 * f.a))
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""


def all_oracles() -> dict[str, str]:
    return {"op2_jaccard": JACCARD, "op8_warc": WARC, "op11_collocations": COLLOCATIONS, "op13_merkle": MERKLE}
