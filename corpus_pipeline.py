"""From raw documents to token files: language, near copies, benchmark leaks, source mix, token ids.

Each stage takes (spark, docs, sf_dir) and returns what it keeps of docs, with the columns of documents; the last
returns each document's place and checksum in the written token files. `run` writes every stage's result to the
shared folder and hands it on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficspark.llm import common, decontamination, jaccard_join, language_id, mixing, token_binary
from trafficspark.llm.queries import table, tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with the predicted language where `lang` is null.

    Null texts, texts without letters and, where no language was learned, all documents go. A `lang` that is given
    stays, whatever is predicted: what a source states is not overruled by a guess. Rows travel whole, so columns may
    have any names; repeated rows and null ids stay as they are; of an empty table nothing is left. Very long texts are
    read whole.
    """
    model = language_id.fit(docs)
    rows = docs.select(F.struct(*docs.columns).alias("row"), language_id.language(F.col("text"), model, spark).alias("told"))
    lang = F.coalesce(F.col("row.lang"), F.col("told")).alias("lang")
    return rows.where(F.col("told") != language_id.UNKNOWN).select(*(lang if c == "lang" else F.col(f"row.`{c}`") for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word similarity of 0.8 or more: that with the least doc_id, null last.

    Documents are told apart by id and text: of unlike texts that share an id, or have none, each stays unless it
    copies an earlier one; of rows alike in both, one stays. Documents without words all stay. Texts of any length take
    part whole, columns may have any names, and an empty table stays empty.
    """
    groups = common.stored(jaccard_join.join_groups(docs, words=5, num=8, den=10).where("node is not null").select("doc_id", "mark", "node"), "groups")
    keys = common.stored(groups.groupBy("node", "doc_id", "mark").agg(F.count(F.lit(1)).alias("rows")), "keys")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    first = common.stored(keys.groupBy("node").agg(F.min(order).alias("first")), "first")
    told = keys.join(first, "node").select("doc_id", "mark", "rows", (order == F.col("first")).alias("stays"))
    kept = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("of_id"), F.xxhash64(common.binary_large(F.col("text"))).alias("of_mark"))
    same = F.col("of_id").eqNullSafe(F.col("doc_id")) & (F.col("of_mark") == F.col("mark"))
    gone, repeated = (common.few(common.stored(told.where(c).select("doc_id", "mark"), "told")) for c in ("not stays", "stays and rows > 1"))
    kept = kept.join(gone, same, "left_anti")
    if repeated.isEmpty():
        return kept.select("row.*")
    once = kept.join(repeated, same, "left_semi").groupBy("of_id", "of_mark").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return kept.join(repeated, same, "left_anti").select("row.*").unionByName(once.select("row.*"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them; null texts, repeated rows and null ids stay as they are."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: null texts and those without words never, null is a
    source of its own, and repeated rows share their copies."""
    return mixing.mixed(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document (and copy), read back from the token files; null texts are empty."""
    return token_binary.token_binary(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("source_mix", mix_sources),
    ("token_binary", write_token_files),
]

#: SQL has neither the language model nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return docs
