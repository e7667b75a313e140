"""A corpus from raw documents to packed sequences: each stage's result is written and read again.

``STAGES`` names the stages in order. Each function takes ``(spark, docs, sf_dir)`` and returns a
frame; all but the last return the columns of ``documents``. SQL cannot express the near-duplicate,
mixing and packing stages; ``tests/llm`` compare them with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import write_scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host passes."""
    from sensorloom.llm.host_rules import keep_good

    return keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines found on ten hosts or more, but for their first place."""
    from sensorloom.llm.line_dedup import without_spread_lines

    return without_spread_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the smallest id."""
    from sensorloom.llm.near_dedup import one_of_each

    return one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Hosts at weights 5, 2, 1 in turn and half as many words again; a document twice at most."""
    from sensorloom.llm.mixing import mixed

    return mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    import public_tokenizers

    from sensorloom.llm.packing import pack

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near dedup", near_copies),
    ("mixing", mixture),
    ("packing", sequences),
]

#: SQL cannot express all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_scratch(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
