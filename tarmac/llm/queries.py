"""The registered queries of the operators, over the whole given tables."""

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from tarmac.llm import (
    bpe,
    collocations,
    contamination,
    language,
    lexical,
    neighbours,
    oracle,
    passages,
    ppm,
    quality,
    secrets,
    sharding,
    simhash,
    token_files,
)
from tarmac.llm.common import table

QUERY_STEP = 20
SHARDS = 16


def op1_posting_lists(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest_neighbours(vectors, lambda key: key % QUERY_STEP == 0)


def op2_ppm(spark, sf_dir):
    return ppm.score_documents(table(spark, sf_dir, "documents"))


def op3_wu_manber(spark, sf_dir):
    report = contamination.contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return report.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_segmentations(spark, sf_dir):
    pieces = language.sentence_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return language.identify_languages(table(spark, sf_dir, "documents"), pieces)


def _byte_ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op5_transducer_bpe(spark, sf_dir):
    done = bpe.round_trip(
        table(spark, sf_dir, "documents"), _byte_ranks(), public_tokenizers.PATTERN
    )
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_bounded_ring(spark, sf_dir):
    return sharding.shard_rows(table(spark, sf_dir, "documents"), shards=SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_co_training(spark, sf_dir):
    return quality.quality_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op8_context_mixing(spark, sf_dir):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    read = token_files.token_files(table(spark, sf_dir, "documents"), tokenizer)
    return read.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op9_tiled_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op10_secret_layers(spark, sf_dir):
    return secrets.secret_report(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2("base", 256).alias("base_sha256"),
        "spans",
        "layers",
        "incomplete",
    )


def op11_passages(spark, sf_dir):
    return passages.remove_repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


def op12_dense_tiles(spark, sf_dir):
    return lexical.rank_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op13_setm(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_posting_lists": op1_posting_lists,
    "op2_ppm": op2_ppm,
    "op3_wu_manber": op3_wu_manber,
    "op4_segmentations": op4_segmentations,
    "op5_transducer_bpe": op5_transducer_bpe,
    "op6_bounded_ring": op6_bounded_ring,
    "op7_co_training": op7_co_training,
    "op8_context_mixing": op8_context_mixing,
    "op9_tiled_simhash": op9_tiled_simhash,
    "op10_secret_layers": op10_secret_layers,
    "op11_passages": op11_passages,
    "op12_dense_tiles": op12_dense_tiles,
    "op13_setm": op13_setm,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op3_wu_manber": oracle.CONTAMINATION,
    "op11_passages": oracle.PASSAGES,
    "op12_dense_tiles": oracle.LEXICAL,
    "op13_setm": oracle.COLLOCATIONS,
}
