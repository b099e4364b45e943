"""A training corpus in five stages: recognise, judge, deduplicate, mix, pack.

Every stage works on all that the one before it kept. ``run`` writes each result as Parquet
in the shared folder and reads it back for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablesync.llm.bagminhash import drop_near_copies
from tablesync.llm.deploy import ship
from tablesync.llm.langid import keep_recognised
from tablesync.llm.mixing import repeat_mixed
from tablesync.llm.packing import pack_documents
from tablesync.llm.quality import keep_good
from tablesync.llm.storage import stash


def _begin(spark: SparkSession) -> None:
    """Make the package importable on executors, and drop what earlier stages left behind: Spark
    frees broadcasts and shuffle files once the driver has collected their handles."""
    ship(spark)
    spark.sparkContext._jvm.System.gc()


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not recognised go."""
    _begin(spark)
    return keep_recognised(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    _begin(spark)
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    _begin(spark)
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix takes it: not at all, once or twice."""
    _begin(spark)
    return repeat_mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    _begin(spark)
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: The stages learn, hash and tokenise, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
