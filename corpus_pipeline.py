"""Corpus pipeline: classify, drop repeated lines, drop near copies, decontaminate, pack.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept. All but the
last return the columns of ``documents``. Rows with a null id have no copies and lose no lines, but
are classified, decontaminated by their text and packed like others. Rows that repeat an id are one
document to the search for near copies and stay or go together, copies of one text among them; every
other stage judges each row by its own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsmelt.llm import decontamination, line_dedup, ngram_join, packing, quality_classifier
from starsmelt.llm.common import read, stage
from starsmelt.llm.queries import tokenizer_file

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Documents whose id is not dropped. The ids are staged, so Spark knows how many they are."""
    ids = stage(dropped.select(F.col("doc_id").alias("dropped_id")).distinct(), "dropped")
    return docs.join(ids, docs["doc_id"] == ids["dropped_id"], "left_anti").select(*COLUMNS)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject: a score of 0.5 or more."""
    model = quality_classifier.fit(docs, read(spark, sf_dir, "labels"))
    scored = quality_classifier.score(docs, model, keep=COLUMNS[2:])
    return scored.filter("score >= 0.5").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier document holds; ``n_chars`` follows."""
    return line_dedup.dedup_lines(docs, keep=("lang", "source")).withColumn(
        "n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by five-word shingles, 0.8 alike."""
    found = ngram_join.near_duplicates(docs, size=5, percent=80)
    return _without(docs, found.filter("component_id <> doc_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of which less than one word in twenty lies in benchmark passages, each by its own text."""
    found = decontamination.find_passages(docs, read(spark, sf_dir, "benchmark"), keep=COLUMNS[1:])
    return decontamination.contaminated(found).filter("NOT contaminated").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document, with its sequence and offset."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", classify_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram jaccard join", drop_near_copies),
    ("benchmark decontamination", decontaminate),
    ("packing", pack_sequences),
]
#: A trained model decides, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
