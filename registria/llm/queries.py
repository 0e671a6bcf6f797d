"""The registered queries of the operators and, where SQL can say it, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import collocations, dedup_tree, language_crf, mixing, near_paths, packing, passages, secret_forest, sharding, spelling, token_counts, topk_blocks, toxicity

BPE = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_forest(spark, sf_dir):
    return secret_forest.secret_scan(table(spark, sf_dir, "documents"))


def op2_digest_tree_dedup(spark, sf_dir):
    return dedup_tree.exact_dedup(table(spark, sf_dir, "documents"), keep="max")


def op3_columnar_topk(spark, sf_dir):
    return topk_blocks.top_k(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op4_chosen_path_dedup(spark, sf_dir):
    return near_paths.near_dedup(table(spark, sf_dir, "documents"))


def op5_mixture_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE))


def op6_source_schedule(spark, sf_dir):
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op7_spliced_counts(spark, sf_dir):
    return token_counts.count_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE))


def op8_ratio_scaled_ngrams(spark, sf_dir):
    return toxicity.toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_word_crf(spark, sf_dir):
    return language_crf.language_digest(table(spark, sf_dir, "documents"))


def op10_interleaved_shards(spark, sf_dir):
    return sharding.shard_digest(table(spark, sf_dir, "documents"), shards=24)


def op11_gram_index_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_phrase_automata(spark, sf_dir):
    return passages.repeat_digest(table(spark, sf_dir, "documents"))


def op13_fingerprint_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_secret_forest, op2_digest_tree_dedup, op3_columnar_topk, op4_chosen_path_dedup, op5_mixture_packing, op6_source_schedule, op7_spliced_counts,
    op8_ratio_scaled_ngrams, op9_word_crf, op10_interleaved_shards, op11_gram_index_variants, op12_phrase_automata, op13_fingerprint_collocations,
)}

ORACLES = {
    "op2_digest_tree_dedup": dedup_tree.ORACLE,
    "op3_columnar_topk": topk_blocks.ORACLE,
    "op4_chosen_path_dedup": near_paths.ORACLE,
    "op6_source_schedule": mixing.ORACLE,
    "op11_gram_index_variants": spelling.ORACLE,
    "op12_phrase_automata": passages.ORACLE,
    "op13_fingerprint_collocations": collocations.ORACLE,
}
