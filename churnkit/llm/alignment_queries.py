"""Query of the cross-tokenizer alignment. SQL cannot express the vocabularies; a test compares with the libraries."""

import public_tokenizers

from churnkit.llm.alignment import align_tokenizers
from churnkit.llm.frames import table
from churnkit.llm.registry import query

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@query("op11_token_alignment")
def op11_token_alignment(spark, sf_dir):
    """Groups and links between the tokens of two tokenizers in every document, with corpus-wide counts of the linked pairs."""
    docs = table(spark, sf_dir, "documents")
    found = align_tokenizers(docs, public_tokenizers.path(A), public_tokenizers.path(B), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")
