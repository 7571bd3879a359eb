"""One query for each operator: production parameters, whole tables, whole results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.llm import (
    bpe, chat, chatdigest, embeddings, leaks, lmscore, negatives, packing, pages, quality, simhash, spelling, tokencounts, toxicity
)
from gapweave.llm.shared import table
from gapweave.llm.sql import CHAT_SQL, EMBEDDINGS_SQL, LEAKS_SQL, NEGATIVES_SQL, QUALITY_SQL

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: A text that speaks the template's own control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_text_density(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages"))


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], turns.schema)
    return chatdigest.digests(chat.format_chats(turns.unionAll(extra)))


def op4_cost_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack_texts(table(spark, folder, "documents"), WORD_TOKENIZER, with_ids=False, memo_words=400_000)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op5_backoff_automaton(spark: SparkSession, folder: str) -> DataFrame:
    return lmscore.score_corpus(table(spark, folder, "documents"))


def op6_quality_cascade(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_table(table(spark, folder, "documents"))


def op7_simhash_pigeonring(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_token_attribution(spark: SparkSession, folder: str) -> DataFrame:
    return tokencounts.token_counts(table(spark, folder, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op9_toxicity_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_table(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_collision_counting(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


def op11_trie_frontier(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))


def op12_aho_corasick(spark: SparkSession, folder: str) -> DataFrame:
    found = leaks.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op13_hyperplane_tree(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_text_density, op2_byte_bpe, op3_chat_format, op4_cost_packing, op5_backoff_automaton, op6_quality_cascade,
              op7_simhash_pigeonring, op8_token_attribution, op9_toxicity_ngrams, op10_collision_counting,
              op11_trie_frontier, op12_aho_corasick, op13_hyperplane_tree)
}
ORACLE_SQL: dict[str, str] = {
    "op3_chat_format": CHAT_SQL,
    "op6_quality_cascade": QUALITY_SQL,
    "op10_collision_counting": EMBEDDINGS_SQL,
    "op12_aho_corasick": LEAKS_SQL,
    "op13_hyperplane_tree": NEGATIVES_SQL,
}
