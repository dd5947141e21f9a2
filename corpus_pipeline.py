"""A training corpus from ``documents``: filter, deduplicate, decontaminate, mix, write tokens.

Each stage takes (spark, docs, folder of tables) and returns a DataFrame; its
rows are written and read again before the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statwright.functions.storage import scratch_path
from statwright.llm import decontamination, mixing, ngram_jaccard, quality, token_codes
from statwright.llm.queries import table, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents inside the thresholds of their language and source."""
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8)."""
    return ngram_jaccard.deduplicate(docs, 5, (4, 5))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Benchmark passages cut out; documents made mostly of them dropped."""
    return decontamination.decontaminate(docs, table(spark, folder, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of each document, written to a file set and read back."""
    files = scratch_path(spark, "corpus-tokens")
    token_codes.write(docs, files, tokenizer_path())
    return token_codes.read(spark, files)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("token_files", token_files),
]

#: Tokenizers, balanced sampling and token files have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
