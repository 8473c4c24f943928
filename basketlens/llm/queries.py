"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketlens.llm import bpe_codec, token_files
from basketlens.llm.common import load
from basketlens.llm.divergence import source_divergence
from basketlens.llm.line_dedup import dedup_lines
from basketlens.llm.mixing import mix
from basketlens.llm.near_duplicates import near_duplicates
from basketlens.llm.nearest import nearest
from basketlens.llm.quality_rules import quality_verdicts
from basketlens.llm.oracle import ORACLE_SQL  # noqa: F401  (read with QUERIES)
from basketlens.llm.resharding import reshard_documents, shard_slots
from basketlens.llm.spelling import spelling_variants
from basketlens.llm.subword_classifier import score_quality
from basketlens.llm.token_counts import count_tokens
from basketlens.llm.toxicity import score_toxicity


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file; any other path serves as well."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark, sf_dir):
    return mix(load(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "shard")


def op8_line_dedup(spark, sf_dir):
    return dedup_lines(load(spark, sf_dir, "documents").select("doc_id", "text"), threshold=10).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op2_near_duplicates(spark, sf_dir):
    return near_duplicates(load(spark, sf_dir, "documents"), percent=75).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op3_reshard(spark, sf_dir):
    layout = reshard_documents(load(spark, sf_dir, "documents"), n_old=12, n_new=16)
    return shard_slots(layout).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                      F.lit(None).cast("int").alias("grown_shard"))


def op7_nearest(spark, sf_dir):
    return nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op4_toxicity(spark, sf_dir):
    return score_toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op6_token_files(spark, sf_dir):
    path = token_files.new_files(spark)
    by_rank = token_files.write_token_files(load(spark, sf_dir, "documents"),
                                            tokenizer("byte_bpe_50k.json"), path, end_id=0)
    return token_files.token_file_digests(spark, path, by_rank)


def op9_token_counts(spark, sf_dir):
    return count_tokens(load(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), limit=4096)


def op10_bpe_codec(spark, sf_dir):
    return bpe_digests(load(spark, sf_dir, "documents"))


def bpe_digests(docs):
    """Token count and digests of the ids and of the bytes decoded from them."""
    from public_tokenizers import PATTERN

    ranks = tokenizer("byte_bpe_50k.tiktoken")
    encoded = bpe_codec.encode(docs, ranks, PATTERN, decoded=True)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_quality_rules(spark, sf_dir):
    return quality_verdicts(load(spark, sf_dir, "documents")).drop("r1", "r2", "host", "host_rate")


def op11_quality_classifier(spark, sf_dir):
    return score_quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op12_spelling_variants(spark, sf_dir):
    return spelling_variants(load(spark, sf_dir, "documents"))


def op13_source_divergence(spark, sf_dir):
    return source_divergence(load(spark, sf_dir, "documents"))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_reshard": op3_reshard,
    "op4_toxicity": op4_toxicity,
    "op7_nearest": op7_nearest,
    "op8_line_dedup": op8_line_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_token_files": op6_token_files,
    "op9_token_counts": op9_token_counts,
    "op10_bpe_codec": op10_bpe_codec,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_source_divergence": op13_source_divergence,
}
