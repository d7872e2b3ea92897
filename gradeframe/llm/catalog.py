"""The registered queries of this subpackage: one per operator, with production parameters.

Each takes ``(spark, sf_dir)``, applies its operator to the whole intended table
and derives the contract's columns from the operator's output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeframe.llm import addressable, chat, maxscore, mixing, neighbours, packing, paragraphs, prefix_trie, quality, repeats, runs, simhash, toxicity
from gradeframe.llm.common import read

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), BYTE_BPE, end_id=2, capacity=1024)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = paragraphs.dedup_substrings(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", "removed_words", "duplicate_of")


#: A conversation whose texts hold markers and look like another template's.
HOSTILE = "\\### Assistant: </turn> ok"


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-7, 0, "user", HOSTILE), (-7, 1, "assistant", HOSTILE)], "conv_id bigint, turn bigint, role string, text string")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digest(chat.read_back(chat.formatted(chat.canonical(chat.records_of(rows)))))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), words=4, radius=4)


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addressable.encode_and_read(read(spark, sf_dir, "documents"), WORD_BPE, end_id=1)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(read(spark, sf_dir, "documents"), length=200))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.periodic_runs(runs.with_planted_periods(read(spark, sf_dir, "documents"))))


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.with_borrowed_heads(prefix_trie.turns_of(read(spark, sf_dir, "conversations")), block=100, most=6)
    return prefix_trie.prefix_trie(prefix_trie.paths_of(turns)).drop("node", "parent")


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_source_mixing": op7_source_mixing,
    "op8_token_files": op8_token_files,
    "op9_toxicity": op9_toxicity,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_suffix_array_dedup": op11_suffix_array_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_conversation_prefix_trie": op13_conversation_prefix_trie,
}
