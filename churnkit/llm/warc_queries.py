"""Query of the WARC operator, with the SQL that must agree."""

from churnkit.llm.frames import table
from churnkit.llm.registry import query
from churnkit.llm.warc import mark_revisits, normalise_archives, read_archives, write_archives


@query(
    "op4_warc",
    """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload,
        octet_length(encode(coalesce(html, ''))) AS n FROM pages
), marked AS (
    SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY payload) ELSE page_id END AS first FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM marked
""",
)
def op4_warc(spark, sf_dir):
    """Every page as a record: written as whole-file streams, normalised, and read back by the index."""
    files = write_archives(mark_revisits(table(spark, sf_dir, "pages")))
    return read_archives(normalise_archives(files)).drop("url", "payload")
