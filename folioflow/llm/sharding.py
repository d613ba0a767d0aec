"""Operator 2, sharding by jump consistent hashing (Lamping and Veach, 2014), in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.llm.common import repeated

#: Fixed values of the published algorithm: the multiplier of its 64-bit linear congruential generator.
MULTIPLIER = 2862933555777941757
#: A key jumps about ln(shards) times; 96 jumps are more than twelve standard deviations above that for 2^31 shards.
MOST_JUMPS = 96


def _key(col: Column, kind: T.DataType) -> Column:
    """Whole numbers are their own 64-bit key, anything else is hashed; null counts as 0."""
    number = col.cast("long") if isinstance(kind, T.IntegralType) else F.xxhash64(col)
    exact = F.when(col.isNull(), F.lit(0)).otherwise(number).cast("decimal(20,0)")
    return F.when(exact < 0, exact + F.lit(str(2**64)).cast("decimal(20,0)")).otherwise(exact).cast("decimal(20,0)")


def jump(key: Column, shards: int) -> Column:
    """struct(b, j): the shard of an unsigned 64-bit key, and the shard count from which on it would move next."""
    if shards < 1:
        raise ValueError("at least one shard")
    big = F.lit(str(2**64)).cast("decimal(20,0)")
    times = F.lit(MULTIPLIER).cast("decimal(19,0)")

    def hop(at: Column, _: Column) -> Column:
        key = (((at["key"] * times) + F.lit(1)) % big).cast("decimal(20,0)")
        high = F.floor(key / F.lit(2**33).cast("decimal(20,0)")).cast("double")
        j = F.floor((at["j"] + 1).cast("double") * (F.lit(float(2**31)) / (high + 1.0))).cast("long")
        return F.when(at["j"] < shards, F.struct(at["j"].alias("b"), j.alias("j"), key.alias("key"))).otherwise(at)

    start = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"), key.alias("key"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, MOST_JUMPS))), start, hop)


def assign_shards(df: DataFrame, key: str, shards: int, column: str = "shard") -> DataFrame:
    """Adds the shard (0 to shards - 1) of each row's key; map-side, no shuffle. A column of that name is replaced.

    Equal keys share a shard whatever else the rows hold. With one shard more, a row either stays or moves to the new
    shard. Null keys count as the key 0. An empty table gives an empty table.
    """
    return df.withColumn(column, jump(_key(F.col(key), df.schema[key].dataType), shards)["b"].cast("int"))


def numbered_shards(docs: DataFrame, shards: int = 16, rows_per_bucket: int = 2000) -> DataFrame:
    """Shards documents (doc_id, text) by doc_id and numbers the rows of each shard without gaps.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32 (of the UTF-8 bytes, unsigned), law ('key'), shard, slot
    (0, 1, ... within the shard) and grown_shard (the shard when there is one more). A null text has no bytes: size 1
    and CRC 0. A null doc_id shards as the key 0. Rows alike in doc_id, size and CRC are counted before any shuffle by
    key and dealt consecutive slots, so one id may hold any share of the rows; other columns are left out.

    Slots come from counts per (shard, bucket) and a running sum inside each bucket. The bucket count follows the
    row count, so no task ever sorts a whole shard.
    """
    kind = docs.schema["doc_id"].dataType
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"))
    groups = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    buckets = max(1, docs.count() // (shards * rows_per_bucket))
    at = jump(_key(F.col("doc_id"), kind), shards)
    groups = groups.withColumn("jumped", at).select(
        "doc_id", "size", "text_crc32", "copies",
        F.col("jumped.b").cast("int").alias("shard"),
        F.when(F.col("jumped.j") == shards, F.lit(shards)).otherwise(F.col("jumped.b")).cast("int").alias("grown_shard"),
        F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(buckets)).alias("bucket"),
    )
    placed = docs.sparkSession.sql("""
        WITH totals AS (SELECT shard, bucket, sum(copies) AS n FROM {groups} GROUP BY shard, bucket),
        starts AS (SELECT shard, bucket, sum(n) OVER (PARTITION BY shard ORDER BY bucket) - n AS start FROM totals),
        ranked AS (SELECT *, sum(copies) OVER (PARTITION BY shard, bucket ORDER BY doc_id, size, text_crc32 ROWS UNBOUNDED PRECEDING) - copies AS before FROM {groups})
        SELECT r.*, s.start + r.before AS first FROM ranked r JOIN starts s ON r.shard = s.shard AND r.bucket = s.bucket""", groups=groups)
    return repeated(placed, "copies", "copy").select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("copy")).alias("slot"), "grown_shard")
