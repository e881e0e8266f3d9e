"""The registered queries of this subpackage, each over whole tables with production settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsmelt.llm import (
    chat,
    decontamination,
    line_dedup,
    ngram_join,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    sharding,
    suffix_dedup,
    token_counts,
    vector_codes,
    warc,
)
from starsmelt.llm.common import read


def tokenizer_file(name: str) -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(read(spark, sf_dir, "documents")))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.find_passages(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_control_case(read(spark, sf_dir, "conversations"))
    return chat.digest(chat.format_chats(turns))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, read(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model).select(
        "doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.dedup_lines(read(spark, sf_dir, "documents")))


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(read(spark, sf_dir, "documents"))


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.with_limit(token_counts.count_tokens(
        read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model")))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = periodic_runs.plant_runs(read(spark, sf_dir, "documents"))
    return periodic_runs.digest(periodic_runs.find_runs(planted))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digest(vector_codes.compress(read(spark, sf_dir, "embeddings")))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.write_archives(read(spark, sf_dir, "pages"))
    return warc.digest(warc.merge_index(warc.read_captures(spark, folder)))


QUERIES = {f.__name__: f for f in (
    op1_pack, op2_suffix_dedup, op3_decontaminate, op4_chat, op5_shards, op6_quality, op7_lines,
    op8_rules, op9_tokens, op10_jaccard, op11_runs, op12_codes,
    op13_warc)}

ORACLE_SQL = {
    "op3_decontaminate": decontamination.SQL,
    "op4_chat": chat.SQL,
    "op5_shards": sharding.SQL,
    "op7_lines": line_dedup.SQL,
    "op8_rules": quality_rules.SQL,
    "op12_codes": vector_codes.SQL,
    "op13_warc": warc.SQL,
}
