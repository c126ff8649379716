"""Line dedup by a log-template tree, in DataFrame functions only.

A line goes down a tree of fixed depth: first by its number of tokens, then by its
leading tokens, where tokens with digits count as one wildcard.  In a leaf, lines are
one template if they agree in all tokens but the variable ones: tokens with digits
always are variable; in lines that are long enough, so are the tokens at the odd or at
the even places.  A template found in several documents is dropped from all but the
first of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from headway.llm.frames import written
from headway.llm.rules import WORDS, let

#: Levels of the tree below the number of tokens: leading tokens.
DEPTH = 3
#: Shorter lines are too common by chance to be a template.
MIN_TOKENS = 4
#: Lines of at least so many tokens may vary in every second token below the leading ones.
VARIABLE_TOKENS = 12
WILDCARD = "<*>"
_NO_ID = -1 << 63


def template_keys(line: Column, depth: int = DEPTH, min_tokens: int = MIN_TOKENS,
                  variable_tokens: int = VARIABLE_TOKENS) -> Column:
    """Hashes of the templates that a line belongs to, an array (empty: none)."""
    tokens = F.filter(F.split(line, WORDS), lambda t: t != "")
    masked = F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), WILDCARD).otherwise(t))
    none = F.array().cast("array<bigint>")

    def keys(t: Column) -> Column:
        n, lead = F.size(t), F.slice(t, 1, depth)
        parts = [F.filter(t, lambda x, i: (i < depth) | (i % 2 == which)) for which in (0, 1)]
        whole = F.xxhash64(n, F.lit(2), F.array_join(t, " "))
        halves = [F.xxhash64(n, F.lit(which), F.array_join(lead, " "), F.array_join(p, " ")) for which, p in enumerate(parts)]
        return F.when(n < min_tokens, none).when(n < variable_tokens, F.array(whole)).otherwise(F.array(whole, *halves))

    return let(masked, keys)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def dropped_lines(docs: DataFrame, **how) -> DataFrame:
    """(id, lines): places, from 0, of the lines to drop in each document that has any.

    ``id`` is the doc_id, or the least long for a null one.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"),
                       F.posexplode_outer(F.transform(_lines(F.col("text")), lambda x: template_keys(x, **how))).alias("line", "keys"))
    keyed = written(rows.select("id", "line", F.explode_outer("keys").alias("key")).filter("key is not null"), "templates")
    recurring = keyed.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    return (keyed.join(recurring.select("key", "first"), "key").filter("id > first")
            .groupBy("id").agg(F.collect_set("line").alias("lines")))


def without_recurring_lines(docs: DataFrame, **how) -> DataFrame:
    """All columns of the documents, with the text shortened, and ``n_lines``, ``n_dropped``.

    A line is dropped if one of its templates is also found in a document of a smaller
    doc_id; so the first document keeps its lines, and lines that only repeat within one
    document stay.  Lines are parted by \\n; remaining lines are joined by \\n again.  A
    text that loses nothing is unchanged; a null text stays null and has no line; a text
    whose lines all go is empty.  ``n_chars``, where there is one, follows the new text.
    Rows that repeat a doc_id are one document with one another, and so are null ids (they
    come first).  Empty tables give empty results.
    """
    gone = dropped_lines(docs, **how).select(F.col("id").alias("__id"), F.col("lines").alias("__gone"))
    joined = docs.join(gone, F.coalesce(docs.doc_id.cast("long"), F.lit(_NO_ID)) == gone["__id"], "left").drop("__id")
    lines = let(_lines(F.col("text")), lambda x: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("__gone")), lambda i: F.get(x, i)))
    many = F.when(F.col("text").isNull(), 0).otherwise(F.size(_lines(F.col("text")))).cast("long")
    less = F.coalesce(F.size(F.filter("__gone", lambda i: i < many)), F.lit(0)).cast("long")
    out = joined.withColumns({"n_lines": many, "n_dropped": F.greatest(less, F.lit(0).cast("long"))})
    out = out.withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(lines, "\n"))).drop("__gone")
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


#: The same for DuckDB, for the default parameters.
ORACLE = r"""
WITH lines AS (
    SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no
    FROM documents),
tokens AS (
    SELECT doc_id, line_no, line, list_transform(
        list_filter(regexp_split_to_array(line, '[ \t-\r]+'), lambda t: t <> ''),
        lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS t
    FROM lines),
keyed AS (
    SELECT doc_id, line_no, unnest(CASE WHEN len(t) < 4 THEN [] WHEN len(t) < 12 THEN [array_to_string(t, ' ') || ' w']
        ELSE [array_to_string(t, ' ') || ' w',
              len(t) || ' e ' || array_to_string(list_filter(t, lambda x, i: i <= 3 OR i % 2 = 1), ' '),
              len(t) || ' o ' || array_to_string(list_filter(t, lambda x, i: i <= 3 OR i % 2 = 0), ' ')] END) AS key
    FROM tokens),
recurring AS (SELECT key, min(doc_id) AS first_id FROM keyed GROUP BY key HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, line_no FROM keyed JOIN recurring USING (key) WHERE doc_id > first_id)
SELECT d.doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(g.line_no) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(d.line, chr(10) ORDER BY d.line_no) FILTER (g.line_no IS NULL), '')) AS kept_sha256
FROM lines d LEFT JOIN gone g ON d.doc_id = g.doc_id AND d.line_no = g.line_no
GROUP BY d.doc_id
"""
