"""The corpus pipeline: toxic documents go, repeated lines go, near copies go, the rest is mixed to target weights and
encoded. Every stage works on all that its predecessor kept.

Rows with null texts or ids pass as the operators define it; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mobspark.llm import bpe, common, lines, mixing, simhash, toxicity

#: Target weights of the mix; documents that look toxic after all have none.
TARGETS = {"high": 0.95, "low": 0.05}


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold."""
    return toxicity.reject_toxic(docs, common.table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier; those that lost all their lines go."""
    common.ship_package(spark)
    return lines.without_repeated_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    common.ship_package(spark)
    return simhash.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that a mix to the target weights takes, each at most once."""
    return mixing.mixed(docs, common.table(spark, sf_dir, "labels"), TARGETS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left."""
    common.ship_package(spark)
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"))
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


#: (name, function of spark, docs, sf_dir)
STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix),
    ("bpe_encoding", encode),
]

#: No SQL expresses the learned classifiers, the edit distance and the merge rounds; tests hold brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        made = common.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        common.drop_written(before)
        docs = before = made
    return docs
