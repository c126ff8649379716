"""SQL of the queries that DuckDB can express on whole tables."""

from __future__ import annotations

from headway.llm import line_templates, rules

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda t: t <> '')"

SUBSTRING = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS text
            FROM docs, unnest(generate_series(1, len(w) - 34)) AS s(i)),
repeated AS (SELECT text FROM windows GROUP BY text HAVING count(*) > 1),
starts AS (SELECT doc_id, i FROM windows JOIN repeated USING (text)),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM starts, generate_series(0, 34) AS s(k)),
factors AS (SELECT doc_id, count(*) AS n FROM starts s
            WHERE NOT EXISTS (SELECT 1 FROM starts t WHERE t.doc_id = s.doc_id AND t.i = s.i - 1) GROUP BY doc_id),
kept AS (SELECT doc_id, count(g.i) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (g.i IS NULL) AS text
         FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs) LEFT JOIN gone g USING (doc_id, i)
         GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256, coalesce(f.n, 0)::BIGINT AS n_factors
FROM docs d LEFT JOIN kept k USING (doc_id) LEFT JOIN factors f USING (doc_id)
"""

#: Bytes as two hexadecimal digits each, so that they can be cut like text.
SUFFIXES = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (SELECT doc_id, b, h[2000 * b + 1:2000 * b + 2198] AS h FROM docs, unnest(generate_series(0, length(h) // 2000)) AS s(b)),
windows AS (SELECT doc_id, 1000 * b + j AS i, md5(h[2 * j + 1:2 * j + 200]) AS text
            FROM blocks, unnest(generate_series(0, least(999, length(h) // 2 - 100))) AS s(j)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY text ORDER BY doc_id, i) AS n FROM windows)
          WHERE n > 1),
marked AS (SELECT doc_id, i, max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p
           FROM later),
cut AS (SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span
        FROM marked),
spans AS (SELECT doc_id, span, min(i) AS first, max(i) + 100 AS past FROM cut GROUP BY doc_id, span),
edges AS (SELECT doc_id, span, first, past, lag(past, 1, 0) OVER (PARTITION BY doc_id ORDER BY first) AS before FROM spans),
pieces AS (SELECT e.doc_id, count(*) AS n_spans, sum(past - first) AS n_removed, max(past) AS past,
                  string_agg(h[2 * before + 1:2 * first], '' ORDER BY first) AS kept
           FROM edges e JOIN docs USING (doc_id) GROUP BY e.doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(p.kept, '') || h[2 * coalesce(p.past, 0) + 1:])) AS kept_sha256
FROM docs d LEFT JOIN pieces p USING (doc_id)
"""

_GRID = ", ".join(f"({i}, '{f}', {float(c)!r}::DOUBLE)" for f, cs in rules.GRID.items() for i, c in enumerate(cs))
_P = rules.RISK
_FEATURES = """unnest([{'feature': 'symbols_per_word', 'v': n_symbols / greatest(n_words, 1)},
    {'feature': 'dup_line_share', 'v': n_dup_lines / greatest(n_lines, 1)},
    {'feature': 'repeat_share', 'v': n_repeat_words / greatest(n_words, 1)},
    {'feature': 'long_words', 'v': word_chars / greatest(n_words, 1)},
    {'feature': 'short_words', 'v': -word_chars / greatest(n_words, 1)}])"""

QUALITY = f"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS body, {_WORDS} AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS l FROM documents),
windows AS (SELECT doc_id, i, w[i:i + 2] AS t FROM docs, unnest(generate_series(1, len(w) - 2)) AS s(i)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, generate_series(0, 2) AS s(k) GROUP BY doc_id),
m AS (SELECT doc_id, stratum, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
             (len(body) - len(translate(body, '#*$%&|<>', '')))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words FROM docs LEFT JOIN covered c USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1 AND max(quality) = 1),
labelled AS (SELECT doc_id, stratum, {_FEATURES} AS f FROM judged JOIN good USING (doc_id) WHERE NOT base_failed),
grid AS (SELECT * FROM (VALUES {_GRID}) AS g(level, feature, cutoff)),
over AS (SELECT doc_id, stratum, level, bool_or(f.v > cutoff) AS dropped FROM labelled JOIN grid ON f.feature = grid.feature GROUP BY ALL),
tested AS (SELECT stratum, level, count(*) AS n, count(*) FILTER (dropped) AS k FROM over GROUP BY ALL),
tails AS (SELECT stratum, level, k, n, (SELECT sum(exp(lgamma(n + 1.0) - lgamma(j + 1.0) - lgamma(n - j + 1.0)
             + j * ln({_P!r}) + (n - j) * ln(1 - {_P!r}))) FROM unnest(generate_series(0, k)) AS s(j)) AS p
          FROM tested WHERE k < n * {_P!r}),
rules AS (SELECT stratum, max(level) AS level FROM tails
          WHERE p <= {rules.DELTA!r} * n / (SELECT sum(n) FROM tested WHERE level = 0) GROUP BY ALL),
exceeding AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, stratum, {_FEATURES} AS f FROM judged) x
              JOIN rules r ON r.stratum = x.stratum JOIN grid g ON g.level = r.level AND g.feature = x.f.feature
              WHERE x.f.v > g.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM exceeding) AS kept
FROM judged
"""

_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _whole(scale: int) -> str:
    return f"list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT)"


#: Products of lists are doubles, exact for whole numbers of this size.
NEGATIVES = f"""
WITH e AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_whole(256)}::DOUBLE[] AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_FINITE}),
scored AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS id, b.label, list_inner_product(a.v, b.v)::BIGINT AS score
           FROM e a, e b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, own, id AS positive_id, score AS positive_score FROM scored WHERE label = own
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM (SELECT p.*, s.id, s.score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
      FROM positives p JOIN scored s USING (anchor_id)
      WHERE s.label <> p.own AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
WHERE rank <= 10
"""


def _rounds(rounds: int) -> str:
    """Assignments a0, a1 ... by the centroids c0, c1 ... of each round."""
    steps = ["""c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM e
             QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id), v) <= 16)"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS (SELECT row, vec_id, e.v, c, (list_inner_product(e.v, e.v) + list_inner_product(k.v, k.v)
                      - 2 * list_inner_product(e.v, k.v))::BIGINT AS d FROM e, c{r} k
                QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, c) = 1)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS (SELECT k.c, coalesce(m.v, k.v) AS v FROM c{r} k LEFT JOIN (
                  SELECT c, list(x ORDER BY i) AS v FROM (SELECT c, i, floor(sum(x) / count(*)) AS x FROM (
                      SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY c, i) GROUP BY c) m USING (c))""")
    return ",\n".join(steps)


CENTROIDS = f"""
WITH e AS (SELECT row_number() OVER () AS row, vec_id, {_whole(64)}::DOUBLE[] AS v FROM embeddings WHERE {_FINITE} AND len(embedding) = 64),
{_rounds(3)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(list_transform(k.v, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a3 JOIN c3 k USING (c)
"""

JACCARD = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[ \t-\r]+'), lambda t: t <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) BETWEEN 1 AND 3 THEN [array_to_string(w, ' ')] ELSE list_sort(list_distinct(list_transform(
             generate_series(1, len(w) - 3), lambda i: array_to_string(w[i:i + 3], ' ')))) END AS s FROM docs),
named AS (SELECT doc_id, len(s)::BIGINT AS n, md5(array_to_string(s, chr(10))) AS k, s FROM sets),
classes AS (SELECT k, any_value(n) AS n, any_value(s) AS s, min(doc_id) AS least FROM named WHERE n > 0 GROUP BY k),
postings AS (SELECT k, n, unnest(s) AS x FROM classes),
links AS (SELECT a.k AS a, b.k AS b FROM postings a JOIN postings b ON a.x = b.x AND a.k <> b.k
          GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT k, k AS r FROM classes UNION SELECT reach.k, links.b FROM reach JOIN links ON reach.r = links.a),
roots AS (SELECT reach.k, min(least) AS component_id FROM reach JOIN classes ON classes.k = reach.r GROUP BY reach.k)
SELECT doc_id, n AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE component_id END AS component_id
FROM named LEFT JOIN roots USING (k)
"""

ORACLE = {
    "op13_jaccard_join": JACCARD,
    "op1_line_dedup": line_templates.ORACLE,
    "op11_hard_negatives": NEGATIVES,
    "op12_centroids": CENTROIDS,
    "op2_substring": SUBSTRING,
    "op6_quality": QUALITY,
    "op8_suffix_array": SUFFIXES,
}
