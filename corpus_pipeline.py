"""The corpus pipeline: documents through five stages, each written as Parquet and read again.

Every stage works on all rows that the one before it kept and returns the columns of documents; the
last one returns where each document's token ids lie in the binary files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.llm import nb_linear, odd_sketches, positional_index, token_files, water_filling
from starweave.llm.common import keep, table
from starweave.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents that the classifier finds toxic."""
    model = nb_linear.fit(docs, nb_linear.training_labels(table(spark, sf_dir, "labels")))
    scored = nb_linear.score(docs, model, more=("text", "lang", "source", "n_chars"))
    return scored.where("score < 0.5").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by five-word shingles, at a similarity of 0.8 or more."""
    return odd_sketches.deduplicated(docs, ["lang", "source", "n_chars"]).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents in which benchmark windows cover a twentieth of the words or more."""
    items = table(spark, sf_dir, "benchmark")
    judged = positional_index.contamination(docs, items, more=["lang", "source", "n_chars"])
    return judged.where(~F.col("contaminated")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and draw documents so that sources meet their target weights."""
    mixed = water_filling.mixed(docs, more=["lang"])
    return mixed.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files and return each document's place in them."""
    return token_files.tokenized(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: SQL expresses neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
