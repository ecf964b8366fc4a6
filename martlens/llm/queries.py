"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from martlens.llm import (decontam, golay, langid, minhash, mixing, pii, repair, simhash, substrings, tokens, toxicity, trie,
                          warc)
from martlens.llm.common import attach, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"), percent=85)


#: Vocabulary file of the token queries.
VOCABULARY = "word_bpe_49k.json"


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(table(spark, sf_dir, "documents"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_table(table(spark, sf_dir, "documents"))


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golay.near_groups(table(spark, sf_dir, "documents"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_table(table(spark, sf_dir, "conversations"))


def _attached(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        attach(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    f.__name__: _attached(f)
    for f in (op1_minhash, op2_tokens, op3_pii, op4_toxicity, op5_warc, op6_mixing, op7_substrings, op8_decontaminate,
              op9_langid, op10_simhash, op11_trie, op12_golay, op13_repair)
}
