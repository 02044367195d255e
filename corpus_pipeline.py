"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; what a stage
returns is written as Parquet and read again. All but the last return the columns of documents. An empty table
gives no rows. Texts that are null, empty or short fail the quality rules; stages after it keep them if they get any,
but the mix takes none without words. Rows that are alike are treated alike, but for near dedup, which keeps one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm import linededup, minhash, mixing, packing, quality
from loomspark.llm._common import delete, scratch, shared_dir, staged_at


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that spread over sites; n_chars follows the text."""
    out = linededup.remove_boilerplate(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return minhash.keep_one(docs, 5, (80, 100))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source schedule takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near dedup", near_dedup), ("source mix", source_mix), ("packing", pack)]

#: SQL expresses neither the learned rules nor the tokenizer; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; of the folders written only that of the result stays."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (_, function) in enumerate(STAGES):
        last, folder = folder, f"{shared_dir(spark)}/pipeline-{i}-{uuid.uuid4().hex}"
        with scratch(spark):
            docs = staged_at(function(spark, docs, sf_dir), folder)
        if last:
            delete(spark, last)
    return docs
