"""The registered query of each operator, over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareledger.llm import chat, decontam, hard_negatives, language_model, licenses, near_dups, packing, simhash
from fareledger.llm import token_files, whitening
from fareledger.llm import line_dedup as lines
from fareledger.llm import quality_rules as quality
from fareledger.llm import toxicity as toxic
from fareledger.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licence_scan(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality.quality_rules(table(spark, sf_dir, "documents"), trusted)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.raw_transcripts(table(spark, sf_dir, "conversations"))
    known = turns.where(~toxic.held_out(F.col("conv_id"), 5))
    return chat.format_chats(turns, known)


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scores(table(spark, sf_dir, "documents"))


def op9_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.jaccard_classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_copies", "n_links")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = token_files.write_token_files(table(spark, sf_dir, "documents"),
                                          public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_token_files(files)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening(table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(spark, table(spark, sf_dir, "embeddings"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_license_scan": op2_license_scan,
    "op3_toxicity": op3_toxicity,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_chat_format": op7_chat_format,
    "op8_language_model": op8_language_model,
    "op9_near_dups": op9_near_dups,
    "op10_token_files": op10_token_files,
    "op11_whitening": op11_whitening,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_simhash": op13_simhash,
}
ORACLE = {
    "op2_license_scan": licenses.SQL,
    "op5_line_dedup": lines.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
}
