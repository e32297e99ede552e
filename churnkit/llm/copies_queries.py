"""Queries of the operators that find repeated text, with the SQL that must agree."""

from pyspark.sql import functions as F

from churnkit.llm.frames import table
from churnkit.llm.ngram_join import ngram_jaccard_components, ngram_jaccard_degrees
from churnkit.llm.registry import query
from churnkit.llm.substrings import remove_repeats


@query(
    "op5_substring_dedup",
    r"""
WITH d AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), win AS (
    SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20
), later AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM win)
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1
), gone AS (
    SELECT doc_id, list(DISTINCT i + j) AS places FROM later, range(20) r(j) GROUP BY doc_id
), kept AS (
    SELECT d.doc_id, w, len(w) AS n, coalesce(len(gone.places), 0) AS n_gone,
        CASE WHEN places IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(places, i)) END AS k
    FROM d LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, n::BIGINT AS n_words, n_gone::BIGINT AS n_removed, sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256
FROM kept
""",
)
def op5_substring_dedup(spark, sf_dir):
    """Every document without the words of windows that start earlier in the corpus."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op1_ngram_jaccard",
    r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), grams AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach AS (
    SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT reach.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY reach.doc_id
""",
)
def op1_ngram_jaccard(spark, sf_dir):
    """Every document with the size of its shingle set and its component of near copies."""
    return ngram_jaccard_components(table(spark, sf_dir, "documents"))


@query(
    "op1_ngram_links",
    r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), grams AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach AS (
    SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
), degrees AS (
    SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT reach.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id,
    coalesce(any_value(n_links), 0)::BIGINT AS n_links
FROM reach LEFT JOIN sizes USING (doc_id) LEFT JOIN degrees USING (doc_id) GROUP BY reach.doc_id
""",
)
def op1_ngram_links(spark, sf_dir):
    """Every document with its component of near copies and the number of all its links."""
    return ngram_jaccard_degrees(table(spark, sf_dir, "documents"))
