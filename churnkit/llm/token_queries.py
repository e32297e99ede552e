"""Queries of the operators on token ids. SQL cannot express the vocabularies; tests compare with the libraries."""

import hashlib

import public_tokenizers
import pyarrow as pa

from churnkit.llm.frames import table
from churnkit.llm.packing import pack_documents
from churnkit.llm.rank_bpe import encode_texts, rank_bpe
from churnkit.llm.registry import query
from churnkit.llm.token_files import read_token_files, write_token_files

WORDS = "word_bpe_49k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark, sf_dir):
    """All documents in sequences of at most 2048 ids."""
    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path(WORDS), end_id=0, size=2048)


@query("op8_byte_bpe")
def op8_byte_bpe(spark, sf_dir):
    """Ids of every document by ranks, and their decoding, as digests."""
    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    encoded = encode_texts(table(spark, sf_dir, "documents"), ranks, pattern)

    def digests(batches):
        bpe = rank_bpe(ranks, pattern)
        for batch in batches:
            listed, decoded = [], []
            for packed in batch.column("ids"):
                ids = memoryview(packed.as_buffer()).cast("B").cast({2: "H", 4: "I"}[bpe.kind.itemsize]).tolist()
                listed.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(packed.as_py())).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_tokens"), pa.array(listed, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return encoded.mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op10_token_files")
def op10_token_files(spark, sf_dir):
    """All documents written as token files in id order and read back."""
    docs = table(spark, sf_dir, "documents")
    return read_token_files(write_token_files(docs, public_tokenizers.path(WORDS), end_id=2))
