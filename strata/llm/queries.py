"""Registered queries of the operators: thin wrappers with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from strata.llm import (
    bitpack,
    block_search,
    chat_windows,
    cotraining,
    cross_tokenizer,
    length_histogram,
    line_store,
    oracles,
    pfair_mix,
    pii_bootstrap,
    prefix_trie_join,
    quality_rules,
    string_tiling,
    suffix_dedup,
)
from strata.session import materialize, scratch_path
from strata.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op1_quality_rules": oracles.QUALITY_RULES,
    "op3_prefix_tree_join": oracles.NEAR_DUPLICATES,
    "op7_suffix_dedup": oracles.REPEATS,
    "op12_line_store": oracles.LINES,
    "op13_block_search": oracles.RANKED,
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(read_table(spark, sf_dir, "documents"))


@query
def op2_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.judged(cotraining.quality_scores(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")))


@query
def op3_prefix_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie_join.near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op4_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("<|im_end|><|im_start|>assistant ok")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    windows = materialize(chat_windows.chat_windows(turns), "chat-windows")
    return chat_windows.digests(chat_windows.read_turns(windows))


@query
def op5_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = length_histogram.length_counts(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return length_histogram.with_suffix_sums(materialize(counts, "length-histogram"))


@query
def op6_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_bootstrap.digests(pii_bootstrap.personal_data(read_table(spark, sf_dir, "documents")))


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


@query
def op8_bitpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "packed")
    bitpack.write_packed(read_table(spark, sf_dir, "documents"), path, tokenizer_path())
    return bitpack.read_documents(spark, path)


@query
def op9_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (pfair_mix.mixed(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "source", "mix_block", "mix_slot", "mix_position"))


@query
def op10_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_tiling.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op11_fragment_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return cross_tokenizer.cross_tokenizer_alignment(read_table(spark, sf_dir, "documents"), tokenizer_path(),
                                                     public_tokenizers.path("piece_bpe_32k.model"))


@query
def op12_line_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    state = line_store.insert(line_store.empty_state(), docs)
    return line_store.line_report(state, docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op13_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
