"""The corpus model derived from the given tables, in Spark and as SQL for comparison."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators import search, upsert
from folioflow.schemas import DOCUMENTS, VERSIONS
from folioflow.session import scratch_folder, table
from folioflow.sources import segments


def as_of() -> F.Column:
    """The time at which all queries look at the corpus."""
    return F.to_timestamp(F.lit("2024-01-31 00:00:00"))


BASE = "https://corpus.example.org/"
NAMES = {"ca": "Canada", "qc": "Quebec", "ab": "Alberta"}


def wall(c) -> F.Column:
    """A timestamp as text, alike in any session time zone."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


class Model:
    """Derived tables, each made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return table(self.spark, self.dir, name)

    @cached_property
    def corpus(self) -> DataFrame:
        d = self.raw("documents").join(self.raw("labels"), "doc_id", "left")
        jurisdiction = F.when(F.col("lang") == "en", "ca").when(F.col("lang") == "fr", "qc").when(F.col("lang") == "de", "ab").when(F.col("lang") == "es", "bc")
        kind = F.when(F.col("quality").isNull(), "regulation").when(F.col("quality") == 1, "legislation").otherwise("case_law")
        d = d.select(
            "doc_id", F.concat(F.lit(BASE), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("source_url"), F.left(F.split_part("text", F.lit("\n"), F.lit(1)), F.lit(80)).alias("title"),
            F.concat(F.upper("source"), F.lit(" "), F.col("doc_id").cast("string")).alias("citation"), jurisdiction.alias("jurisdiction_code"), F.col("source").alias("source_type"), kind.alias("document_type"),
            (~F.col("toxic").eqNullSafe(1)).alias("is_active"), F.col("text").alias("content_text"),
        )
        category = F.when(F.col("document_type") == "case_law", "Case Law").when(F.col("document_type") == "regulation", "Regulation").otherwise("Legislation")
        court = F.when(F.col("document_type") == "case_law", F.create_map(F.lit("court"), F.upper("source_type"))).otherwise(F.create_map().cast("map<string,string>"))
        html = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<p>"), "content_text", F.lit("</p>"))).otherwise(F.lit(""))
        return d.withColumns({"category": category, "metadata": court, "content_html": html})

    @cached_property
    def checked(self) -> DataFrame:
        e = self.raw("events").filter("event_id % 10 = 0 AND event_id % 100 <> 0")
        return e.select((F.col("event_id") / 10).cast("long").alias("doc_id"), F.col("ts").cast("timestamp").alias("last_checked_at"))

    @cached_property
    def docs(self) -> DataFrame:
        created = F.expr("TIMESTAMP '2024-01-01 00:00:00' + make_interval(0, 0, 0, CAST(doc_id % 28 AS INT))")
        updated = F.expr("created_at + make_interval(0, 0, 0, 0, CAST(doc_id % 5 AS INT))")
        d = self.corpus.join(self.checked, "doc_id", "left").withColumn("id", F.sha2("source_url", 256)).withColumn("target_id", F.lit(None).cast("string"))
        return d.withColumn("created_at", created).withColumn("updated_at", updated).select(*DOCUMENTS.names)

    @cached_property
    def batches(self) -> DataFrame:
        c = self.corpus
        two = c.filter("doc_id % 2 = 0").withColumn("content_text", F.when(F.col("doc_id") % 3 == 0, F.concat("content_text", F.lit(" amended"))).otherwise(F.col("content_text")))
        parts = [c.withColumn("seq", F.lit(1)), two.withColumn("seq", F.lit(2)), c.filter("doc_id % 6 = 0").withColumn("seq", F.lit(3))]
        return parts[0].unionByName(parts[1]).unionByName(parts[2]).drop("doc_id")

    @cached_property
    def upserted(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The three batches as one, into empty tables."""
        return upsert.upsert(self.empty(DOCUMENTS), self.empty(VERSIONS), self.batches, as_of())

    @cached_property
    def versions(self) -> DataFrame:
        return self.upserted[1]

    @cached_property
    def kept_versions(self) -> DataFrame:
        """The versions as a table in the shared folder, for queries that read them more than once."""
        at = scratch_folder(self.spark, "versions")
        self.versions.write.partitionBy("is_latest").parquet(at)
        return self.spark.read.schema(VERSIONS).parquet(at).select(*VERSIONS.names)

    @cached_property
    def some_versions(self) -> DataFrame:
        """Without those of every seventh document."""
        gone = self.corpus.filter("doc_id % 7 = 5").select(F.sha2("source_url", 256).alias("document_id"))
        return self.versions.join(gone, "document_id", "left_anti").select(*VERSIONS.names)

    @cached_property
    def some_docs(self) -> DataFrame:
        gone = self.corpus.filter("doc_id % 11 = 4").select("source_url")
        return self.docs.join(gone, "source_url", "left_anti").select(*DOCUMENTS.names)

    @cached_property
    def sync_log(self) -> DataFrame:
        at = F.col("ts").cast("timestamp")
        return self.raw("events").select(
            F.col("event_id").alias("id"), F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string")).alias("source_type"), F.when(F.col("event_id") % 3 == 0, "full").otherwise("incremental").alias("mode"),
            at.alias("started_at"), F.when(F.col("event_type") != "error", at + F.expr("INTERVAL 5 MINUTES")).alias("finished_at"), F.floor(F.abs("value")).cast("long").alias("docs_discovered"),
        )

    @cached_property
    def jobs(self) -> DataFrame:
        status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "running").otherwise("completed")
        at = F.col("ts").cast("timestamp")
        return self.raw("events").select(
            F.col("event_id").alias("id"), status.alias("status"), at.alias("started_at"), F.when(status != "running", at + F.expr("INTERVAL 90 SECONDS")).alias("finished_at"),
            (F.col("event_id") % 50).cast("int").alias("items_scraped"), (F.col("event_id") % 7).cast("int").alias("items_failed"), F.col("props").alias("logs"),
        )

    @cached_property
    def keys(self) -> DataFrame:
        own = self.docs.join(self.corpus.filter("doc_id % 4 = 0").select("source_url"), "source_url", "left_anti").select(F.col("source_url").alias("url"), F.col("created_at").alias("scraped_at"))
        test = self.raw("benchmark").select(F.concat(F.lit("https://www.example.com/gone/"), F.col("item_id").cast("string")).alias("url"), as_of().alias("scraped_at"))
        return own.unionByName(test)

    @cached_property
    def dim(self) -> DataFrame:
        codes = self.docs.select(F.col("jurisdiction_code").alias("code"))
        seeded = codes.filter(F.col("code").isin(*NAMES)).distinct().withColumn("name", F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv])[F.col("code")])
        return upsert.ensure_jurisdictions(seeded, codes)

    @cached_property
    def bad_urls(self) -> DataFrame:
        """Documents some of whose urls hold spaces and commas, and a few of which collide when repaired."""
        n = F.regexp_extract("source_url", r"(\d+)$", 1).cast("long")
        url = F.when(n % 10 == 3, F.concat("source_url", F.lit(", a b"))).when(n % 10 == 4, F.concat(F.regexp_replace("source_url", r"\d+$", ""), (n - 1).cast("string"), F.lit("%2C%20a b")))
        url = url.when(n % 20 == 5, F.concat(F.regexp_replace("source_url", r"\d+$", ""), (n - 2).cast("string"), F.lit("%2C%20a%20b")))
        return self.docs.withColumn("source_url", url.otherwise(F.col("source_url")))

    def stored(self, name: str, postings: DataFrame) -> DataFrame:
        """An index as a segment in the shared folder, so that a search reads its terms' row groups alone."""
        at = scratch_folder(self.spark, name)
        rows = segments.write_segment(postings, None, at)
        return segments.read_segments(self.spark, [{"folder": at, "rows": rows, "first": True}])

    @cached_property
    def title_index(self) -> DataFrame:
        return self.stored("title", search.build_title_index(self.docs))

    @cached_property
    def content_index(self) -> DataFrame:
        return self.stored("content", search.build_content_index(self.kept_versions))

    def empty(self, schema) -> DataFrame:
        return self.spark.createDataFrame([], schema)


SQL = """
WITH corpus AS (
  SELECT d.doc_id, 'https://corpus.example.org/' || source || '/' || d.doc_id AS source_url, left(split_part(text, chr(10), 1), 80) AS title, upper(source) || ' ' || d.doc_id AS citation,
    CASE lang WHEN 'en' THEN 'ca' WHEN 'fr' THEN 'qc' WHEN 'de' THEN 'ab' WHEN 'es' THEN 'bc' END AS jurisdiction_code, source AS source_type,
    CASE WHEN quality IS NULL THEN 'regulation' WHEN quality = 1 THEN 'legislation' ELSE 'case_law' END AS document_type, toxic IS DISTINCT FROM 1 AS is_active, text AS content_text,
    CASE WHEN d.doc_id % 2 = 0 THEN '<p>' || text || '</p>' ELSE '' END AS content_html
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
checked AS (SELECT event_id // 10 AS doc_id, ts AS last_checked_at FROM events WHERE event_id % 10 = 0 AND event_id % 100 <> 0),
docs AS (
  SELECT c.*, sha256(source_url) AS id, CASE document_type WHEN 'case_law' THEN 'Case Law' WHEN 'regulation' THEN 'Regulation' ELSE 'Legislation' END AS category,
    CASE WHEN document_type = 'case_law' THEN upper(source_type) END AS court, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c.doc_id % 28 AS INTEGER)) AS created_at,
    TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c.doc_id % 28 AS INTEGER)) + to_hours(c.doc_id % 5) AS updated_at, k.last_checked_at
  FROM corpus c LEFT JOIN checked k ON c.doc_id = k.doc_id),
batches AS (
  SELECT doc_id, source_url, 1 AS seq, content_text, content_html FROM corpus
  UNION ALL SELECT doc_id, source_url, 2, CASE WHEN doc_id % 3 = 0 THEN content_text || ' amended' ELSE content_text END, content_html FROM corpus WHERE doc_id % 2 = 0
  UNION ALL SELECT doc_id, source_url, 3, content_text, content_html FROM corpus WHERE doc_id % 6 = 0),
hashed AS (SELECT *, sha256(content_text) AS content_hash, lag(sha256(content_text)) OVER (PARTITION BY doc_id ORDER BY seq) AS before FROM batches),
changed AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS version_number FROM hashed WHERE content_hash IS DISTINCT FROM before),
versions AS (
  SELECT doc_id, sha256(source_url) AS document_id, sha256(sha256(source_url) || ':' || version_number) AS id, content_text, content_html, content_hash, version_number,
    version_number = max(version_number) OVER (PARTITION BY doc_id) AS is_latest FROM changed),
some_versions AS (SELECT * FROM versions WHERE doc_id % 7 <> 5),
some_docs AS (SELECT * FROM docs WHERE doc_id % 11 <> 4),
sync_log AS (SELECT event_id AS id, 'src' || (user_id % 20) AS source_type, CASE WHEN event_id % 3 = 0 THEN 'full' ELSE 'incremental' END AS mode, ts AS started_at,
  CASE WHEN event_type <> 'error' THEN ts + INTERVAL 5 MINUTE END AS finished_at, floor(abs(value))::BIGINT AS docs_discovered FROM events),
jobs AS (SELECT event_id AS id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' ELSE 'completed' END AS status, ts AS started_at,
  CASE WHEN event_type <> 'signup' THEN ts + INTERVAL 90 SECOND END AS finished_at, (event_id % 50)::INTEGER AS items_scraped, (event_id % 7)::INTEGER AS items_failed, props AS logs FROM events),
keys AS (SELECT source_url AS url, created_at AS scraped_at FROM docs WHERE doc_id % 4 <> 0 UNION ALL SELECT 'https://www.example.com/gone/' || item_id, TIMESTAMP '2024-01-31 00:00:00' FROM benchmark),
dim AS (SELECT DISTINCT jurisdiction_code AS code, CASE jurisdiction_code WHEN 'ca' THEN 'Canada' WHEN 'qc' THEN 'Quebec' WHEN 'ab' THEN 'Alberta' ELSE upper(jurisdiction_code) END AS name FROM docs WHERE jurisdiction_code <> '')
"""
