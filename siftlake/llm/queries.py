"""Registered queries of the operators: each applies one operator to its whole table."""

from pyspark.sql import DataFrame, SparkSession

from . import (
    bloomlm, decontaminate, divergence, importance, langid, ledger, mixing, nearcopies, preferences, surrogates, tokenstore, toxicity, urlfilter,
)
from .frames import new_folder


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(read(spark, sf_dir, "documents"))


def op2_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_table(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.near_copies(read(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file of the installed public tokenizers; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.preference_table(read(spark, sf_dir, "conversations"))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.surrogate_table(read(spark, sf_dir, "documents"))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = tokenstore.write_store(read(spark, sf_dir, "documents"), new_folder(spark, "token-store"), tokenizer_path())
    return tokenstore.read_digests(store)


def op7_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.rule_table(read(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_table(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloomlm.score_table(read(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_table(read(spark, sf_dir, "documents"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.url_table(read(spark, sf_dir, "pages"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_table(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence_table(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_leaks": op2_leaks,
    "op3_near_copies": op3_near_copies,
    "op4_preferences": op4_preferences,
    "op5_surrogates": op5_surrogates,
    "op6_token_store": op6_token_store,
    "op7_rule_ledger": op7_rule_ledger,
    "op8_toxicity": op8_toxicity,
    "op9_language_model": op9_language_model,
    "op10_language": op10_language,
    "op11_url_filter": op11_url_filter,
    "op12_importance": op12_importance,
    "op13_divergence": op13_divergence,
}

# SQL counterparts, where SQL can express the operator.
ORACLES = {
    "op4_preferences": preferences.SQL,
    "op7_rule_ledger": ledger.SQL,
    "op12_importance": importance.SQL,
    "op13_divergence": divergence.SQL,
}
