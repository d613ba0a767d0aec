"""The training-data pipeline: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's docs.
All but the last return the columns of documents. Every stage takes an empty table (and gives one), null, empty and very
long texts, null ids and sources, repeated rows and further columns of any name; what becomes of such rows is said at each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioflow.llm import decontamination, mixing, near_dup, quality, sharding
from folioflow.llm.common import Scratch
from folioflow.session import table

SHARDS = 16


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the classifier rejects go. Null texts are scored as empty ones; of repeated rows all go
    or all stay."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: one document of each near-duplicate group stays, that of the smallest doc_id, null ids last. Rows
    without words all stay; of repeated rows one stays."""
    return near_dup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents with a window of a benchmark item go. Rows without words stay; of repeated rows all go or all
    stay."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: each document as often as the mix takes it. Rows without words go; a null source is a source."""
    return mixing.apply_mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: adds each row's shard by doc_id, replacing a column of that name; a null id is the key 0."""
    return sharding.assign_shards(docs, "doc_id", SHARDS)


STAGES = [
    ("quality classifier", keep_good),
    ("near-duplicates", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]
#: The classifier is fitted and MinHash is no SQL function; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; what each returns is written to the shared folder."""
    own = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = own.table(stage(spark, docs, sf_dir))
    result = own.keep(STAGES[-1][1](spark, docs, sf_dir))
    own.clear()
    return result
