"""Repairs as functions from tables to tables; the caller that only wants a report doesn't write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.text import SAFE_PATH, normalize_url
from folioflow.operators.incremental import add_keys

#: Urls of test pages.
TEST_URLS = ("example.com", "test.com")


def drop_shells(docs: DataFrame, versions: DataFrame) -> DataFrame:
    return docs.join(versions.select(F.col("document_id").alias("id")), "id", "left_semi")


def _bad(url: Column) -> Column:
    return url.contains(" ") | url.contains(",")


def url_changes(docs: DataFrame, safe: str = SAFE_PATH) -> DataFrame:
    """Renames (id, source_url, new_url, applied) of urls with a space or comma. One whose new url another document
    has keeps its own; of several that would get one url the smallest id gets it."""
    bad = docs.filter(_bad(F.col("source_url"))).select("id", "source_url", normalize_url(F.col("source_url"), safe).alias("new_url")).filter("new_url <> source_url")
    taken = docs.select(F.col("source_url").alias("new_url"), F.lit(True).alias("taken")).distinct()
    first = F.row_number().over(Window.partitionBy("new_url").orderBy("id")) == 1
    return bad.join(taken, "new_url", "left").withColumn("applied", first & F.col("taken").isNull()).select("id", "source_url", "new_url", "applied")


def normalize_urls(docs: DataFrame, safe: str = SAFE_PATH) -> DataFrame:
    changes = url_changes(docs, safe).filter("applied").select("id", "new_url")
    return docs.join(changes, "id", "left").withColumn("source_url", F.coalesce("new_url", "source_url")).select(*docs.columns)


def normalize_keys(keys: DataFrame, safe: str = SAFE_PATH) -> DataFrame:
    url = F.when(_bad(F.col("url")), normalize_url(F.col("url"), safe)).otherwise(F.col("url"))
    return keys.select(url.alias("url"), "scraped_at").groupBy("url").agg(F.min("scraped_at").alias("scraped_at"))


def sync_keys(keys: DataFrame, docs: DataFrame, as_of: Column) -> DataFrame:
    return add_keys(keys, docs.select(F.col("source_url").alias("url"), as_of.alias("scraped_at")))


def purge_test_keys(keys: DataFrame) -> DataFrame:
    hit = F.lit(False)
    for u in TEST_URLS:
        hit = hit | F.col("url").contains(u)
    return keys.filter(~hit)


def repair_summary(docs: DataFrame, versions: DataFrame, keys: DataFrame) -> DataFrame:
    """What is left: totals, shells, bad urls."""
    have = versions.select(F.col("document_id").alias("id")).distinct().withColumn("v", F.lit(True))
    d = docs.join(have, "id", "left").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("v").isNull()).alias("shells"), F.count_if(_bad(F.col("source_url"))).alias("bad_urls"))
    return d.join(versions.agg(F.count(F.lit(1)).alias("versions"))).join(keys.agg(F.count(F.lit(1)).alias("keys")))
