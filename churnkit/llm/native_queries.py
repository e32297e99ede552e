"""Queries of the operators that use DataFrame functions only, with the SQL that must agree."""

from pyspark.sql import functions as F

from churnkit.llm.exact_dedup import exact_dedup
from churnkit.llm.frames import table
from churnkit.llm.line_rules import quality_rules
from churnkit.llm.registry import query
from churnkit.llm.sharding import shard_by_bytes


@query(
    "op2_sharding",
    """
WITH t AS (
    -- The byte table of CRC-32, from its polynomial.
    SELECT list_transform(range(256), lambda n: list_reduce(range(8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS tab
), b AS (
    SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size,
        list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes
    FROM documents
), sized AS (
    SELECT doc_id, size, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, tab[xor(c & 255, x) + 1]), 4294967295::BIGINT),
        4294967295) AS crc FROM b, t
), placed AS (
    SELECT *, sum(size) OVER (ORDER BY doc_id) AS bytes_to, sum(size) OVER () AS total FROM sized
), cut AS (
    SELECT *, least(((2 * bytes_to - size) * 40) // (2 * total), 39)::INTEGER AS shard FROM placed
)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM cut
""",
)
def op2_sharding(spark, sf_dir):
    """40 contiguous shards of nearly equal bytes."""
    return shard_by_bytes(table(spark, sf_dir, "documents"), shards=40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    "op3_quality_rules",
    r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, source AS host,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)),
            lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
    FROM documents
), win AS (
    SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5
), keyed AS (
    SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS k FROM win
), again AS (
    SELECT doc_id, i FROM keyed QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + j) AS n FROM again, range(5) r(j) GROUP BY doc_id
), lines AS (
    SELECT DISTINCT doc_id, host, k FROM (
        SELECT doc_id, host, unnest(list_transform(l,
            lambda x: trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g')))) AS k FROM d)
), hosts AS (
    SELECT source AS host, count(doc_id) AS n FROM documents GROUP BY source
), heavy AS (
    SELECT lines.host, k FROM lines JOIN hosts ON lines.host IS NOT DISTINCT FROM hosts.host
    GROUP BY lines.host, k, n HAVING count(DISTINCT doc_id) > 20 AND count(DISTINCT doc_id) > n * 0.02
), every_line AS (
    SELECT doc_id, host, unnest(list_transform(l,
        lambda x: trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g')))) AS k FROM d
), gone AS (
    SELECT doc_id, sum(len(string_split(e.k, ' '))) AS n FROM every_line e
    JOIN heavy ON e.k = heavy.k AND e.host IS NOT DISTINCT FROM heavy.host GROUP BY doc_id
), counted AS (
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
        coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS n_line_words_removed
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN gone USING (doc_id)
), judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        n_words - n_line_words_removed AS n_left FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_line_words_removed,
    NOT base_failed AND n_left >= 10 AND 100 * n_left >= 50 * n_words AS kept
FROM judged
""",
)
def op3_quality_rules(spark, sf_dir):
    """Base counts and line-frequency verdict of every document; the source is the host."""
    return quality_rules(table(spark, sf_dir, "documents"))


@query(
    "op9_exact_dedup",
    """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
)
def op9_exact_dedup(spark, sf_dir):
    """Every document with the copy that stays."""
    return exact_dedup(table(spark, sf_dir, "documents"))
