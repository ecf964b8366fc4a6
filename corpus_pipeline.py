"""A corpus pipeline over ``documents``: clean, deduplicate, decontaminate, mix and write token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.llm import common, decontam, minhash, mixing, tokens, toxicity

#: Labels of rows whose crc32 of the id modulo 5 is 0 are held out, as in the toxicity query.
FOLDS, HELD = 5, 0

#: Near-duplicates share at least this percentage of their five-word shingles.
NEAR_PERCENT = 80

VOCABULARY = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; null and empty texts score low and stay."""
    common.attach(spark)
    labels = common.table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, common.id_remainder(F.col("doc_id"), FOLDS) != HELD)
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near-duplicates; documents without words are all kept."""
    common.attach(spark)
    return minhash.keep_first(docs, NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of a benchmark item."""
    return decontam.keep_uncontaminated(docs, common.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: the rows of part file 0 first, each file from its first row on."""
    return mixing.mixed_rows(docs, mixing.damped_weights(docs))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the mix; doc_id, start, n_tokens and ids_crc32 as read back from them."""
    common.attach(spark)
    import public_tokenizers

    order = "file_place"
    return tokens.token_files(_with_place(docs, order), public_tokenizers.path(VOCABULARY), order=order)


def _with_place(docs: DataFrame, name: str) -> DataFrame:
    """(doc_id, text) and the place of each row in the files that hold ``docs``; without files, places follow the ids."""
    number = [F.regexp_extract("_metadata.file_name", p, 1) for p in (r"^part-(\d+)", r"-c(\d+)")]
    part, chunk = (F.when(n == "", 0).otherwise(n.cast("long")) for n in number)
    place = part * (1 << 44) + chunk * (1 << 34) + F.col("_metadata.row_index")
    try:
        return docs.select("doc_id", "text", place.alias(name))
    except AnalysisException:
        return docs.select("doc_id", "text", F.col("doc_id").alias(name))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: SQL cannot express the learned scores and the tokenizer; tests check each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each result written below ``spark.checkpoint.dir`` and read again."""
    folder = common.run_folder(spark, "pipeline")
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
