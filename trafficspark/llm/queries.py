"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficspark.llm import decontamination, language_id, oracles, toxicity
from trafficspark.llm.bm25_search import top_k
from trafficspark.llm.common import crc_bucket
from trafficspark.llm.jaccard_join import join_groups
from trafficspark.llm.line_dedup import dedup_lines
from trafficspark.llm.lm_scoring import lm_scores
from trafficspark.llm.mixing import mix
from trafficspark.llm.spelling import spelling_variants
from trafficspark.llm.suffix_dedup import remove_repeats
from trafficspark.llm.token_binary import token_binary
from trafficspark.llm.token_counts import token_counts
from trafficspark.llm.whitening import whiten
from trafficspark.sources.shared import importable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents").select("doc_id", "text", (crc_bucket(F.col("doc_id"), 10) == 0).alias("held_out")))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_groups(table(spark, sf_dir, "documents"), words=3, num=90, den=100).select("doc_id", "n_shingles", "component_id")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = dedup_lines(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return left.select("doc_id", "n_lines", "n_removed", F.length(text).cast("long").alias("kept_chars"), F.sha2(text, 256).alias("kept_sha256"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.coalesce(crc_bucket(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"))
    model = language_id.fit(docs.where("not held_out"))
    return language_id.predict(docs, model, keep=("held_out",))


def op6_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_binary(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_passages")


def op8_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return top_k(docs, docs.where("doc_id % 20 = 0"), query_id_col="doc_id")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path(), budgets=(2048,))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), components=16)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(crc_bucket(F.col("doc_id"), 4) == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out)
    model = toxicity.fit(docs.where("not held_out"), table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs, model, keep=("held_out",)).select("doc_id", "held_out", "score", "predicted", "lang_pred")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scores": op1_lm_scores,
    "op2_decontamination": op2_decontamination,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_line_dedup": op4_line_dedup,
    "op5_language_id": op5_language_id,
    "op6_token_binary": op6_token_binary,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_bm25_search": op8_bm25_search,
    "op9_source_mix": op9_source_mix,
    "op10_token_counts": op10_token_counts,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_whitening": op12_whitening,
    "op13_toxicity": op13_toxicity,
}

ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": oracles.DECONTAMINATION,
    "op4_line_dedup": oracles.LINE_DEDUP,
    "op8_bm25_search": oracles.BM25,
}
