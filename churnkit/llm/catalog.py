"""All queries of this subpackage, the pipeline included."""

from churnkit.llm import (  # noqa: F401  (registration)
    alignment_queries,
    copies_queries,
    fingerprint_queries,
    model_queries,
    native_queries,
    token_queries,
    warc_queries,
)
from churnkit.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
