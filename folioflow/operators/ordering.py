"""Order and numbers over groups of any size, without a window that takes a group whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from folioflow.session import scratch_folder


def ranged(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Rows sorted by groups and order in ranges, one for each shuffle partition: row (all columns), group, key (the order),
    part (the range) and place (ascending along the order). ``order`` columns are of any sortable type, nulls first.

    A group may hold any share of the rows, since ranges are cut within it. The result is written to the shared folder,
    so that every reader sees the same ranges, also after an executor is lost.
    """
    spark = df.sparkSession
    rows = df.select(F.struct("*").alias("row"), F.struct(*[F.col(c) for c in by]).alias("group"), F.struct(*[F.col(c) for c in order]).alias("key"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = rows.repartitionByRange(ranges, "group", "key").sortWithinPartitions("group", "key")
    at = scratch_folder(spark, "ranges")
    sorted_.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")).write.parquet(at)
    return spark.read.parquet(at)


def number_rows(df: DataFrame, by: list[str], order: list[str], out: str) -> DataFrame:
    """Numbers the rows of each group from 1 in order: within their range, after the counts of the ranges before it. Rows
    alike in the order are numbered in any order."""
    rows = ranged(df, by, order)
    runs = rows.groupBy("group", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(F.col("group").alias("g"), F.col("part").alias("p"), (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    met = rows.join(starts, F.col("group").eqNullSafe(F.col("g")) & (F.col("part") == F.col("p")))
    return met.select(*[F.col("row").getField(c).alias(c) for c in df.columns if c != out], (F.col("place") + F.col("shift")).alias(out))


def carry_forward(df: DataFrame, value: str, by: list[str], order: str, out: str) -> DataFrame:
    """The nearest non-null value at or before each row in listing order, as a prefix scan: each range carries forward on
    its own, a small row for each range says what comes into it from those before, and rows before the first value of
    their range take that. Of rows alike in ``order`` those without a value come first."""
    rows = ranged(df, by, [order, value]).withColumn("value", F.col("row").getField(value))
    ends = rows.groupBy("group", "part").agg(F.max_by("value", F.when(F.col("value").isNotNull(), F.col("place"))).alias("end"))
    before = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col("group").alias("g"), F.col("part").alias("p"), F.last("end", ignorenulls=True).over(before).alias("carried"))
    here = F.last("value", ignorenulls=True).over(Window.partitionBy("group", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    met = rows.withColumn("here", here).join(carried, F.col("group").eqNullSafe(F.col("g")) & (F.col("part") == F.col("p")))
    return met.select(*[F.col("row").getField(c).alias(c) for c in df.columns if c != out], F.coalesce("here", "carried").alias(out))


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``, nulls first; rows alike in it come by a hash of their columns but maps. No task
    takes them all: the keys alone are sorted in ranges and numbered, and the rows up to the last key stay where they are.
    ``df`` is read several times, so it must be the same each time."""
    if n <= 0:
        return df.filter(F.lit(False))
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    key = F.struct(*[F.col(c) for c in order], F.xxhash64(*plain).alias("_tie"))
    keys = df.select(key.alias("key"), F.lit(0).alias("all"))
    if keys.count() <= n:
        return df
    numbered = number_rows(keys, ["all"], ["key"], "no").filter(F.col("no") <= n)
    top = numbered.filter(F.col("no") == n).first()["key"]
    last = F.struct(*[F.lit(top[f.name]).cast(f.dataType).alias(f.name) for f in keys.schema["key"].dataType.fields])
    alike = n - numbered.filter(F.col("key") < last).count()
    return df.filter(key < last).unionByName(df.filter(key == last).limit(alike))
