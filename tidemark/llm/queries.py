"""Every corpus operator as a query over the tables of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    collocations,
    exact_dedup,
    licenses,
    line_quality,
    mixing,
    packing,
    quality_rules,
    repeats,
    secrets,
    simhash,
    spelling,
    token_counts,
    toxicity,
)
from tidemark.llm.shared import tokenizer_file


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def exact_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(_documents(spark, folder))


def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, folder))
    return mixed.withColumn("position", F.round("position", 9))


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_groups(_documents(spark, folder))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


def packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_documents(spark, folder), tokenizer_file("byte_bpe_50k.json"))


def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(_documents(spark, folder))
    listed = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.array_join(listed, ",").alias("spans"), "n_checked"
    )


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_licenses(_documents(spark, folder))
    joined = [F.array_join(c, ",").alias(c) for c in ("licenses", "sentence_ids")]
    return found.select("doc_id", *joined, "n_sentences")


def repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeated_units(_documents(spark, folder))


def quality_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules.quality(_documents(spark, folder)).select(*names)


def toxic_scores(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(_documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def document_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, folder), tokenizer_file("word_bpe_49k.json"))


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    return line_quality.line_quality(_documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(_documents(spark, folder))


def phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_documents(spark, folder))


QUERIES = {
    "op1_secret_scan": secret_scan,
    "op2_simhash_near_dedup": near_duplicates,
    "op3_license_scan": license_scan,
    "op4_quality_rules": quality_verdicts,
    "op5_toxicity": toxic_scores,
    "op6_exact_dedup": exact_duplicates,
    "op7_repeated_passages": repeated_passages,
    "op8_source_mix": source_mix,
    "op9_token_counts": document_tokens,
    "op10_packing": packed_sequences,
    "op11_phrase_collocations": phrase_collocations,
    "op12_quality_classifier": quality_scores,
    "op13_spelling_variants": spelling_variants,
}
