"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the
last return the columns of ``documents``. No stage fails on null ids, texts or sources, on empty
tables or on repeated rows; what each does with them stands with its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.llm.line_dedup import BATCHES, dedup_lines
from shelfwright.llm.common import file_batches
from shelfwright.llm.minhash_join import drop_near_duplicates
from shelfwright.llm.mixing import mix, quality_labels
from shelfwright.llm.packing import pack, tokenizer_path
from shelfwright.llm.toxic_segments import fit, held_out, score
from shelfwright.session import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that are predicted toxic by a model of the labels outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id")))
    return score(docs, fit(docs, labels)).where("predicted = 0").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more are cut out everywhere; n_chars follows. Every document stays."""
    out = dedup_lines(docs, arrivals=file_batches(docs, BATCHES))
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return drop_near_duplicates(docs).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, as so many rows; labelled quality weighs the draw."""
    labels = quality_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    mixed = mix(docs, labels=labels).where("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows with their places in the sequences. A row taken twice is packed twice."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: The first stage is a fitted model, which SQL cannot express; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = settle(docs)
    return docs
