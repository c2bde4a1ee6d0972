"""The corpus pipeline: quality classifier, exact dedup, n-gram Jaccard join, mixing sources, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltworks.llm import classifier, exact_dedup, jaccard, mixing, packing
from siltworks.llm.common import settle, tables_written

ORACLE_SQL = None  # trained and hashed stages have no SQL; a test compares with a brute-force version


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the best grade is at least one half; toxic and junk documents go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", classifier.graded().alias("grade"))
    return classifier.select(docs, classifier.train(docs, labels))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts."""
    return jaccard.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids: one row per piece of a document."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources to target weights", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read by the next.

    What a stage wrote on its way is deleted with its end.  Whole texts of any length go through every stage.  Null and
    empty texts are rejected by the first; a null doc_id is a value like others, and rows that repeat doc_id and text
    are one document from the second on.  Further columns, whatever their names, are kept until the last stage.  An
    empty table gives an empty result, and without labels every text with a word passes the first stage.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        since = tables_written()
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}", since)
    return STAGES[-1][1](spark, docs, sf_dir)
