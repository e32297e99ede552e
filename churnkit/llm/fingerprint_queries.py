"""Queries of the operators that change or fingerprint single documents."""

from pyspark.sql import functions as F

from churnkit.llm.fill_middle import fill_in_middle, restore_texts
from churnkit.llm.fingerprints import fingerprint_edits
from churnkit.llm.frames import table
from churnkit.llm.registry import query


@query(
    "op12_fill_in_middle",
    r"""
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || doc_id) AS h
    FROM documents
), drawn AS (
    SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS y,
        ('0x' || h[17:24])::BIGINT % 100 AS z, ('0x' || h[25:32])::BIGINT % 100 AS w
    FROM units
), cut AS (
    SELECT doc_id, t, n,
        CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR z >= 90 THEN 'plain' WHEN w < 20 THEN 'spm' ELSE 'psm' END AS form,
        coalesce(array_to_string(u[1:least(x, y)], ''), '') AS p,
        coalesce(array_to_string(u[least(x, y) + 1:greatest(x, y)], ''), '') AS m,
        coalesce(array_to_string(u[greatest(x, y) + 1:n], ''), '') AS s
    FROM drawn
)
SELECT doc_id, n::BIGINT AS n, form,
    CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM cut
""",
)
def op12_fill_in_middle(spark, sf_dir):
    """Every document cut into prefix, middle and suffix in another order, and put together again."""
    filled = fill_in_middle(table(spark, sf_dir, "documents"))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return restore_texts(filled).select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@query("op13_fingerprints")
def op13_fingerprints(spark, sf_dir):
    """Fingerprints of every document and of an edited version, and how alike they and the next document are."""
    return fingerprint_edits(table(spark, sf_dir, "documents"))
