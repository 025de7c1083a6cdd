"""DuckDB statements for the text operators that SQL can express."""

from __future__ import annotations

from hourmill.llm.quality_rules import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
  w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
               list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
  spot AS (SELECT doc_id, p, list_slice(ws, p, p + 7) AS win
         FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 7)) AS p FROM w)),
  twice AS (SELECT doc_id, p FROM spot QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
  cover AS (SELECT doc_id, sum(least(8, coalesce(lead_p - p, 8))) AS n
            FROM (SELECT doc_id, p, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS lead_p FROM twice) GROUP BY doc_id),
  m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
               CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
               CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
               CAST(len(ls) AS BIGINT) AS n_lines,
               CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words,
               len(list_filter(ws, lambda x: lower(x) IN ({_STOP}))) AS n_stop
        FROM w LEFT JOIN cover ON cover.doc_id = w.doc_id),
  b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * word_chars BETWEEN 250 * n_words AND 1200 * n_words
       AND 100 * n_symbols <= 10 * n_words AND 100 * n_stop >= 2 * n_words
       AND 100 * n_dup_lines <= 40 * n_lines AS kept
FROM b
"""

VECTORS = """
WITH RECURSIVE ok AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  link AS (SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b
           ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
  reach(u, v) AS (SELECT u, v FROM link UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u),
  comp AS (SELECT u, min(v) AS c FROM reach GROUP BY u),
  cnt AS (SELECT u, count(*) AS n FROM link GROUP BY u)
SELECT e.vec_id, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n_links,
       least(e.vec_id, coalesce(comp.c, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(comp.c, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN comp ON comp.u = e.vec_id LEFT JOIN cnt ON cnt.u = e.vec_id
"""

SHINGLES = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
  s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
               ELSE list_distinct(list_transform(generate_series(1, len(ws) - 4), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS g FROM d),
  x AS (SELECT doc_id, unnest(g) AS h FROM s),
  shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM x a JOIN x b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
  link AS (SELECT u, v FROM shared JOIN s p ON p.doc_id = u JOIN s q ON q.doc_id = v
           WHERE 100 * n >= 75 * (len(p.g) + len(q.g) - n)),
  reach(u, v) AS (SELECT u, v FROM link UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u),
  comp AS (SELECT u, min(v) AS c FROM reach GROUP BY u)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(c, s.doc_id)) AS component_id,
       s.doc_id = least(s.doc_id, coalesce(c, s.doc_id)) AS kept
FROM s LEFT JOIN comp ON comp.u = s.doc_id
"""

REPEATS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
  win AS (SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS g
          FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 19)) AS s FROM d)),
  again AS (SELECT doc_id, s FROM win QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, s) > 1),
  gone AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + 19)) AS i FROM again),
  kept AS (SELECT d.doc_id, w.i, w.word FROM d, (SELECT doc_id AS id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS i FROM d) w
           WHERE w.id = d.doc_id AND NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = w.id AND g.i = w.i)),
  txt AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM kept GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN txt ON txt.doc_id = d.doc_id
"""

NEGATIVES = """
WITH ok AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS own, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS s
        FROM ok a JOIN ok b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
  pos AS (SELECT a, b, s FROM s WHERE own QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
SELECT s.a AS anchor_id, pos.b AS positive_id,
       CAST(row_number() OVER (PARTITION BY s.a, pos.b ORDER BY s.s DESC, s.b) AS INTEGER) AS rank,
       s.b AS negative_id, pos.s AS positive_score, s.s AS negative_score
FROM pos JOIN s ON s.a = pos.a AND NOT s.own AND 30 * pos.s <= 100 * s.s AND 100 * s.s <= 90 * pos.s
QUALIFY row_number() OVER (PARTITION BY s.a, pos.b ORDER BY s.s DESC, s.b) <= 10
"""

PHRASES = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
  n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
  g AS (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS t
        FROM (SELECT lang, ws, m, unnest(generate_series(1, len(ws) - m + 1)) AS i FROM w, (VALUES (1), (2), (3)) AS k(m))),
  f AS (SELECT lang, m, t, count(*) AS f, string_split(t, ' ') AS ws FROM g GROUP BY ALL),
  cand AS (SELECT * FROM f WHERE m > 1 AND f >= 10),
  cut AS (SELECT c.lang, c.m, c.t, c.f, k, array_to_string(c.ws[1:k], ' ') AS a, array_to_string(c.ws[k + 1:], ' ') AS b
          FROM cand c, (VALUES (1), (2)) AS x(k) WHERE k < c.m),
  scored AS (SELECT cut.lang, cut.t, cut.f, fl.f AS l, fr.f AS r, k,
                    CAST((CAST(1000000 AS HUGEINT) * cut.f * cut.f) // (CAST(fl.f AS HUGEINT) * fr.f) AS BIGINT) AS score
             FROM cut JOIN f fl ON fl.lang = cut.lang AND fl.m = cut.k AND fl.t = cut.a
                      JOIN f fr ON fr.lang = cut.lang AND fr.m = cut.m - cut.k AND fr.t = cut.b
             QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.t ORDER BY score, k) = 1),
  gone AS (SELECT DISTINCT s.lang, s.t FROM cand s JOIN cand x ON x.lang = s.lang AND s.m = 2 AND x.m = 3
             AND (array_to_string(x.ws[1:2], ' ') = s.t OR array_to_string(x.ws[2:3], ' ') = s.t) WHERE 100 * x.f >= 50 * s.f)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.f DESC, encode(s.t)) AS rank,
       s.t AS phrase, s.f AS a, s.l, s.r, n.n, score
FROM scored s JOIN n ON n.lang = s.lang LEFT JOIN gone ON gone.lang = s.lang AND gone.t = s.t WHERE gone.t IS NULL
QUALIFY row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.f DESC, encode(s.t)) <= 2000
"""

ORACLES = {
    "op1_minhash": SHINGLES, "op4_quality_rules": RULES, "op10_cap_filters": VECTORS,
    "op11_repeats": REPEATS, "op12_hard_negatives": NEGATIVES, "op13_collocations": PHRASES,
}
