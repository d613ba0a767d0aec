"""What several operators need: tables in the shared folder, words, connected components."""

from __future__ import annotations

import uuid
from typing import ClassVar
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.session import shared_folder as shared_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme of the file system that Spark would use for it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a Hadoop path (file, hdfs, s3, gs; nothing in it escaped) and the path in it."""
    scheme, colon, rest = uri.partition(":")
    if not colon:
        return fs.LocalFileSystem(), uri
    rest = quote(rest, safe="/:@")
    uri = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + (f":{rest}" if rest.startswith("//") else f"://{rest}")
    return fs.FileSystem.from_uri(uri)


class Scratch:
    """Intermediate tables as Parquet in the shared folder: lineage ends there, so a lost executor costs
    only its running tasks. ``clear`` deletes them; what ``keep`` wrote stays for the caller's result until
    ``release_results`` is called."""

    #: Scratches of this process whose results are still there.
    kept: ClassVar[list[Scratch]] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def _write(self, df: DataFrame, folder: str) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{folder}/{self.count}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def table(self, df: DataFrame) -> DataFrame:
        return self._write(df, "work")

    def keep(self, df: DataFrame) -> DataFrame:
        if self not in Scratch.kept:
            Scratch.kept.append(self)
        return self._write(df, "kept")

    def drop(self, *frames: DataFrame) -> None:
        """Deletes tables of this scratch that no later step reads."""
        for df in frames:
            for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
                if f"/{self.root.rsplit('/', 1)[1]}/work/" in path:
                    self._delete(path)

    def _delete(self, path: str) -> None:
        jvm, jsc = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(jsc.hadoopConfiguration()).delete(where, True)

    def clear(self) -> None:
        self._delete(f"{self.root}/work")


def release_results() -> None:
    """Deletes the results that operators of this process keep in the shared folder; call it once their frames have
    been written or collected."""
    while Scratch.kept:
        own = Scratch.kept.pop()
        own._delete(own.root)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone. Pure ASCII texts take the faster built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, ASCII_UPPER, ASCII_LOWER))


def space_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), "")


#: Rows of a list of documents (an id and a hash, about 60 bytes held) up to which it is broadcast: 24 MB.
BROADCAST_ROWS = 400_000


def listed(listing: DataFrame) -> DataFrame:
    """A written list of documents that is small beside the corpus, ready to be joined with it: counted first, and
    broadcast up to BROADCAST_ROWS rows. Beyond them the join shuffles both sides."""
    return F.broadcast(listing) if listing.count() <= BROADCAST_ROWS else listing.hint("merge")


def repeated(df: DataFrame, times: str, number: str, chunk: int = 4096) -> DataFrame:
    """Each row ``times`` (long) times, numbered from 0 in the column ``number``. Rows grow in two steps, so that no
    array is longer than ``chunk`` or the count's ``chunk``-th part."""
    begin, most = F.col(f"{number}_"), F.lit(chunk).cast("long")
    steps = df.filter(F.col(times) > 0).withColumn(f"{number}_", F.explode(F.sequence(F.lit(0).cast("long"), F.col(times) - 1, most)))
    return steps.withColumn(number, F.explode(F.sequence(begin, F.least(begin + most, F.col(times)) - 1))).drop(f"{number}_")


#: Edges up to which the vertex tables of connected components are broadcast; about 10 MB.
BROADCAST_EDGES = 200_000


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """Connected components of the undirected ``edges`` (a, b): rows (id, component), component being the smallest id.

    Every vertex takes the smallest label of its neighbours and then the label of that label (pointer jumping), so a
    star ends after two rounds and a path of n vertices after about log n. Each round is a grouping with map-side
    minimum and two joins, written to the shared folder; a hot centre is one key of a join that adaptive execution
    splits. Up to BROADCAST_EDGES edges, counted first, the joins broadcast their vertex tables, which hold no more
    than two rows an edge; the steps are the same.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b")
    links = scratch.table(both.distinct())
    small = links.count() <= 2 * BROADCAST_EDGES
    sent = F.broadcast if small else lambda df: df
    labels = scratch.table(links.groupBy(F.col("a").alias("id")).agg(F.least(F.col("a"), F.min("b")).alias("component")))
    while True:
        near = links.join(sent(labels), links.b == labels.id).groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(sent(near), labels.id == near.a, "left").select("id", F.least("component", F.coalesce("near", "component")).alias("hop"), F.col("component").alias("was"))
        step = scratch.table(step)
        target = step.select(F.col("id").alias("t"), F.col("hop").alias("far"))
        new = scratch.table(step.join(sent(target), step.hop == target.t, "left").select("id", F.least("hop", F.coalesce("far", "hop")).alias("component"), "was"))
        scratch.drop(labels, step)
        changed = new.filter("component <> was").limit(1).count()
        labels = new.select("id", "component")
        if not changed:
            scratch.drop(links)
            return labels
