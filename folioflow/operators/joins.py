"""Filters, flags and joins between documents, versions, dimensions and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("completed", "failed", "running")


def filter_documents(docs: DataFrame, source_type: str | None = None, jurisdiction: str | None = None, document_type: str | None = None) -> DataFrame:
    """Equality filters; absent and empty ones are skipped."""
    for column, value in (("source_type", source_type), ("jurisdiction_code", jurisdiction), ("document_type", document_type)):
        if value:
            docs = docs.filter(F.col(column) == value)
    return docs


def filter_status(runs: DataFrame, status: str | None = None) -> DataFrame:
    return runs.filter(F.col("status") == status) if status in STATUSES else runs


def select_sources(config: DataFrame, source_type: str | None = None, source_types: list[str] | None = None) -> DataFrame:
    """Enabled sources; a single type goes before a list of types."""
    found = config.filter("enabled")
    if source_type:
        return found.filter(F.col("source_type") == source_type)
    return found.filter(F.col("source_type").isin(*source_types)) if source_types else found


def active_only(docs: DataFrame) -> DataFrame:
    return docs.filter("is_active")


def url_flags(docs: DataFrame) -> DataFrame:
    url = F.col("source_url")
    return docs.withColumns({"has_space": url.contains(" "), "has_comma": url.contains(","), "not_http": ~url.startswith("http")})


def is_generic_title(title: Column, words) -> Column:
    return F.lower(F.trim(title)).isin(*words)


def content_flags(versions: DataFrame) -> DataFrame:
    return versions.withColumns({"has_content": F.coalesce(F.col("content_text") != "", F.lit(False)), "has_html": F.coalesce(F.col("content_html") != "", F.lit(False))})


def apply_status(docs: DataFrame, changes: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """Sets is_active of listed urls and moves updated_at; the second table has the number of documents affected."""
    new = changes.groupBy("source_url").agg(F.max_by("is_active", "pos").alias("new_active"))
    joined = docs.join(new, "source_url", "left")
    hit = F.col("new_active").isNotNull()
    out = joined.withColumns({"is_active": F.coalesce("new_active", "is_active"), "updated_at": F.when(hit, as_of).otherwise(F.col("updated_at"))})
    return out.select(*docs.columns), joined.agg(F.count_if(hit).alias("affected"))


def known_keys(docs: DataFrame, source_type: str | None = None) -> DataFrame:
    return filter_documents(docs, source_type).select("source_url").distinct()


def by_url(docs: DataFrame, url: str) -> DataFrame:
    return docs.filter(F.col("source_url") == url)


def latest_of(versions: DataFrame) -> DataFrame:
    return versions.filter("is_latest")


def with_latest(docs: DataFrame, versions: DataFrame) -> DataFrame:
    """Documents with their latest version's columns, null where there is none."""
    v = latest_of(versions).select("document_id", F.col("id").alias("version_id"), "content_html", "content_text", "content_hash", "scraped_at", "version_number")
    return docs.join(v, docs["id"] == v["document_id"], "left").drop("document_id")


def with_jurisdiction(docs: DataFrame, dim: DataFrame) -> DataFrame:
    """With the jurisdiction's name, the code where it has none. The dimension is broadcast by its size."""
    d = dim.select(F.col("code").alias("jurisdiction_code"), F.col("name").alias("jurisdiction_name"))
    return docs.join(d, "jurisdiction_code", "left").withColumn("jurisdiction_name", F.coalesce("jurisdiction_name", "jurisdiction_code"))


def with_has_content(docs: DataFrame, versions: DataFrame) -> DataFrame:
    """A flag for a latest version with text."""
    filled = latest_of(versions).filter("content_text <> ''").select("document_id").distinct()
    rows = docs.select(F.struct("*").alias("row"), "id").join(filled, F.col("id") == F.col("document_id"), "left")
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c != "has_content"], F.col("document_id").isNotNull().alias("has_content"))


def docs_without_versions(docs: DataFrame, versions: DataFrame) -> DataFrame:
    return docs.join(versions.select(F.col("document_id").alias("id")), "id", "left_anti")


def orphan_versions(docs: DataFrame, versions: DataFrame) -> DataFrame:
    return versions.join(docs.select(F.col("id").alias("document_id")), "document_id", "left_anti")


def reconcile_keys(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Every url of either side with where it is: both, corpus or keys."""
    a = docs.select(F.col("source_url").alias("url")).distinct().withColumn("c", F.lit(True))
    b = keys.select("url").distinct().withColumn("k", F.lit(True))
    side = F.when(F.col("c") & F.col("k"), "both").when(F.col("c"), "corpus").otherwise("keys")
    return a.join(b, "url", "full").select("url", side.alias("side"))


def key_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("url").distinct().join(b.select("url"), "url", "left_anti")


def union_matches(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def stack_reports(*reports: DataFrame) -> DataFrame:
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def concat_lists(*lists: DataFrame) -> DataFrame:
    """Listings one after another: adds list_no, so that a limit takes the first ones first."""
    return stack_reports(*[x.withColumn("list_no", F.lit(i)) for i, x in enumerate(lists)])


def lookup_citations(docs: DataFrame, citations: DataFrame, versions: DataFrame) -> DataFrame:
    """Text by exact citation."""
    hit = docs.join(citations.select("citation").distinct(), "citation")
    return with_latest(hit, versions).select("citation", "source_url", "content_text")
