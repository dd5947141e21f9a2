"""The registered queries of the operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import scratch_path
from . import (backoff_lm, conversations, decontamination, licences, mixing, ngram_jaccard, pseudonyms, quality,
               substring_dedup, token_codes, toxicity, url_rules, whitening)
from .oracles import SQL  # noqa: F401

TOKENIZER = "word_bpe_49k.json"
#: For the registered query; callers of the operator bring their own.
PSEUDONYM_KEY = "registered query"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose 3-word shingles have a Jaccard similarity of 0.9 or more."""
    return ngram_jaccard.ngram_components(table(spark, folder, "documents"), 3, (9, 10))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows of ten words in the documents."""
    found = decontamination.hits(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


#: The given rules of the URL filter.
URL_RULES = [url_rules.Rule("allow", "com", "/"), url_rules.Rule("block", "example.com", "/en/"), url_rules.Rule("allow", "www.example.com", "/en/"),
             url_rules.Rule("block", "net", "/es/"), url_rules.Rule("block", "net", "/fr/")]


def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on all pages; a page's label blocks it where quality is 0 or toxic is 1."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked"))
    out = url_rules.judge(pages, URL_RULES, pages.join(labels, "page_id").select("url", "blocked"))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op4_token_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Token files of all documents, read back."""
    files = scratch_path(spark, "tokens")
    token_codes.write(table(spark, folder, "documents"), files, tokenizer_path())
    return token_codes.read(spark, files)


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """A mix of the sources at weights 5, 2, 1, repeating."""
    sizes = mixing.sized(table(spark, folder, "documents").select("doc_id", "source", "text"), keep_text=False)
    return mixing.mix(sizes).select("doc_id", "source", "size", "source_size", "target", "taken")


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Base measures and the verdict of thresholds by language and source."""
    from ..functions.storage import materialise
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    measured = materialise(quality.measure(docs, keep_text=False))
    return quality.judge(measured, quality.thresholds(measured)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Licence notices in all documents."""
    return licences.scan(table(spark, folder, "documents").select("doc_id", "text")).withColumn("dice", F.round("dice", 6))


def op6_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with personal numbers, dates and addresses replaced."""
    return pseudonyms.mask(table(spark, folder, "documents").select("doc_id", "text"), PSEUDONYM_KEY).select("doc_id", "n_found", "found", "text")


def op7_backoff_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Backoff scores of all documents, learned from six in seven."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out_of_training = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7)) == 2
    return backoff_lm.corpus(docs, ~out_of_training, keep_text=False).select(
        "doc_id", out_of_training.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learned from four fifths of the labels."""
    fold = "crc32(coalesce(cast(doc_id as string), '')) % 5 = 0"
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = toxicity.score(docs, table(spark, folder, "labels"), fold)
    return out.select("doc_id", F.expr(fold).alias("held_out"), "score", "predicted")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest repairs of all conversations after the planned damage."""
    out = conversations.repair(conversations.damaged(table(spark, folder, "conversations")), "copies")
    return out.report.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op12_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents without those in sequences of 35 words found twice."""
    out = substring_dedup.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"), keep_text=False)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The first four whitened coordinates of all embeddings, one row each."""
    out = whitening.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "x")
    return out.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id", (F.col("place") + 1).alias("component"), "n", F.col("deviation").try_cast("long").alias("deviation"), "x.whitened", "x.explained", "identity_error")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_ngram_jaccard, op2_decontamination, op3_url_rules, op4_token_codes, op5_licences,
                            op6_pseudonyms, op7_backoff_lm, op8_toxicity, op9_mixing, op10_quality, op11_conversation_repair,
                            op12_substring_dedup, op13_embedding_whitening)}
