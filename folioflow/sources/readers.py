"""Scans of landed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.text import first_filled, strip

CASE_FIELDS = ("dataset", *(f"{name}_{lang}" for name in ("citation", "name", "url", "document_date", "unofficial_text") for lang in ("en", "fr")))


def _place() -> Column:
    """Where a row stands: its file's name and a number that ascends along the file, which one task reads whole."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("no"))


def read_case_records(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Parquet case-law records; only these columns are read."""
    df = spark.read.parquet(path).select(*CASE_FIELDS)
    return df.limit(limit) if limit else df


def read_act_tree(spark: SparkSession, path: str) -> DataFrame:
    """Acts with their regulations as products (pos, product_id, name, custom_id, regulation), each act before its own."""
    product = "struct<productId:string,name:string,customIdentifier:string>"
    rows = spark.read.schema(f"act {product}, regulations array<{product}>").json(path, multiLine=True).withColumn("act_no", _place())
    acts = rows.select("act_no", F.lit(-1).alias("n"), F.col("act").alias("p"), F.lit(False).alias("regulation"))
    regs = rows.select("act_no", F.posexplode("regulations").alias("n", "p")).withColumn("regulation", F.lit(True))
    return acts.unionByName(regs).select(F.struct("act_no", "n").alias("pos"), F.col("p.productId").alias("product_id"), F.col("p.name").alias("name"), F.col("p.customIdentifier").alias("custom_id"), "regulation")


def read_bucket_hits(spark: SparkSession, path: str, doc_type: str) -> DataFrame:
    """Search answers' nested hits (pos, alias, title, state, date_from)."""
    words = "struct<en:string>"
    source = f"struct<_source:struct<alias:{words},title:{words},state:{words},dateFrom:{words}>>"
    bucket = f"struct<{doc_type}:struct<{doc_type}_hits:struct<hits:struct<hits:array<{source}>>>>>"
    rows = spark.read.schema(f"aggregations struct<act:struct<buckets:array<{bucket}>>>").json(path, multiLine=True).withColumn("file_no", _place())
    buckets = rows.select("file_no", F.posexplode("aggregations.act.buckets").alias("b", "bucket"))
    hits = buckets.select("file_no", "b", F.posexplode(F.col(f"bucket.{doc_type}.{doc_type}_hits.hits.hits")).alias("h", "hit"))
    s = "hit._source"
    return hits.select(F.struct("file_no", "b", "h").alias("pos"), F.col(f"{s}.alias.en").alias("alias"), F.col(f"{s}.title.en").alias("title"), F.col(f"{s}.state.en").alias("state"), F.col(f"{s}.dateFrom.en").alias("date_from"))


def read_packages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of packages (pos, name, title, isbn, date_modified, total)."""
    one = "struct<name:string,title:string,`identifier-ISBN-print`:string,date_modified:string>"
    rows = spark.read.schema(f"result struct<count:long,results:array<{one}>>").json(path, multiLine=True).withColumn("file_no", _place())
    each = rows.select("file_no", F.col("result.count").alias("total"), F.posexplode("result.results").alias("n", "p"))
    return each.select(F.struct("file_no", "n").alias("pos"), F.col("p.name").alias("name"), F.col("p.title").alias("title"), F.col("p.identifier-ISBN-print").alias("isbn"), F.col("p.date_modified").alias("date_modified"), "total")


def read_xml_docs(spark: SparkSession, path: str, root: str) -> DataFrame:
    """XML documents (path below root, xml, title): the long title, else the short one, else any, else the file's stem.
    ``path`` is a folder, listed once; a pattern would make each file a path of its own, with a job that lists them."""
    rows = spark.read.text(path, wholetext=True).select(F.col("value").alias("xml"), F.split_part(F.col("_metadata.file_path"), F.lit(root.rstrip("/") + "/"), F.lit(-1)).alias("path"))
    found = lambda tag: strip(F.coalesce(F.xpath_string("xml", F.lit(f"//*[local-name()='{tag}']")), F.lit("")))
    stem = F.regexp_replace(F.substring_index("path", "/", -1), r"\.[^.]*$", "")
    return rows.withColumn("title", first_filled(found("LongTitle"), found("ShortTitle"), found("Title"), stem)).withColumn("pos", F.col("path"))


def read_xml_directory(spark: SparkSession, path: str) -> DataFrame:
    """Directory entries (pos, doc_id, title, is_group); letter groups start with two dashes."""
    rows = spark.read.format("xml").option("rowTag", "dir").schema("CIVIX_DOCUMENT_ID string, CIVIX_DOCUMENT_TITLE string").load(path)
    return rows.select(_place().alias("pos"), F.col("CIVIX_DOCUMENT_ID").alias("doc_id"), F.col("CIVIX_DOCUMENT_TITLE").alias("title"), F.col("CIVIX_DOCUMENT_TITLE").startswith("--").alias("is_group"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("url", "html")


def gate_binaries(spark: SparkSession, path: str, min_bytes: int = 200, magic: bytes | None = b"%PDF") -> DataFrame:
    """Files (path, length, reason): null for those of enough bytes that start as they should."""
    rows = spark.read.format("binaryFile").load(path)
    reason = F.when(F.col("length") < min_bytes, "too_small")
    if magic:
        reason = reason.when(F.substring("content", 1, len(magic)) != F.lit(bytearray(magic)), "wrong_type")
    return rows.select("path", "length", reason.alias("reason"))
