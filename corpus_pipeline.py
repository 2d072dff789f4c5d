"""A pipeline over documents: quality, near-duplicates, benchmark passages, secrets, token ids.

Each stage takes the documents that the one before it kept, as written Parquet. A stage that
needs another table reads it from the data folder.
"""

import public_tokenizers

from tarmac.llm import bpe, contamination, quality, secrets, similar
from tarmac.llm.common import table
from tarmac.sources import stage

SHINGLE, SIMILARITY = 5, 0.8


def keep_good_quality(spark, docs, sf_dir):
    """Documents that the co-trained classifiers accept."""
    return quality.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def keep_one_of_near_duplicates(spark, docs, sf_dir):
    """One document, of least doc_id, of each group of near-duplicates.

    Near-duplicates share four fifths of their five-word shingles.
    """
    return similar.keep_one_of_each(docs, similarity=SIMILARITY, size=SHINGLE)


def drop_benchmark_passages(spark, docs, sf_dir):
    """Documents that are not contaminated by the benchmark."""
    return contamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark, docs, sf_dir):
    """All documents, with secrets replaced by their kinds."""
    return secrets.redact_secrets(docs)


def encode_and_decode(spark, docs, sf_dir):
    """All documents with their token ids and the digest of the text decoded from them."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode_and_decode_documents(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", keep_good_quality),
    ("SimHash near-dedup", keep_one_of_near_duplicates),
    ("benchmark decontamination", drop_benchmark_passages),
    ("secret scans", redact_secrets),
    ("byte-level BPE encoding and decoding", encode_and_decode),
]

ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage.keep(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
