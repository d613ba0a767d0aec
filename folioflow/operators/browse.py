"""Pages, previews and samples; each has a total order, so pages don't overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.operators.joins import filter_documents, filter_status, latest_of, with_has_content, with_latest

MOST_PER_PAGE, MOST_PREVIEW = 100, 200_000


def page_facts(found: DataFrame, per_page: int) -> DataFrame:
    """One row: the total, and the pages it fills, 1 at least."""
    n = F.count(F.lit(1))
    return found.agg(n.alias("total"), F.greatest(F.lit(1), F.ceil(n / F.lit(min(per_page, MOST_PER_PAGE)))).cast("long").alias("total_pages"))


def _page(found: DataFrame, page: int, per_page: int) -> DataFrame:
    per_page = min(per_page, MOST_PER_PAGE)
    return found.offset((max(1, page) - 1) * per_page).limit(per_page)


def browse(docs: DataFrame, versions: DataFrame, page: int = 1, per_page: int = 50, **filters) -> tuple[DataFrame, DataFrame]:
    """(page, facts) of documents, last updated first. The content flag is joined to the page alone."""
    found = filter_documents(docs, **filters)
    rows = _page(found.orderBy(F.desc("updated_at"), "id"), page, per_page)
    return with_has_content(rows, versions), page_facts(found, per_page)


def browse_runs(jobs: DataFrame, page: int = 1, per_page: int = 50, status: str | None = None) -> tuple[DataFrame, DataFrame]:
    found = filter_status(jobs, status)
    return _page(found.orderBy(F.desc_nulls_last("started_at"), "id"), page, per_page), page_facts(found, per_page)


def recent_runs(jobs: DataFrame, n: int = 10) -> DataFrame:
    """The last runs with their whole seconds and the first 120 characters of their log."""
    rows = jobs.orderBy(F.desc_nulls_last("started_at"), "id").limit(n)
    return rows.select("id", "status", "started_at", F.timestamp_diff("SECOND", F.col("started_at"), F.col("finished_at")).alias("seconds"), "items_scraped", "items_failed", F.left("logs", F.lit(120)).alias("log_preview"))


def sync_history(sync_log: DataFrame, source_type: str | None = None, n: int = 20) -> DataFrame:
    found = sync_log.filter(F.col("source_type") == source_type) if source_type else sync_log
    return found.orderBy(F.desc("started_at"), "id").limit(min(n, MOST_PER_PAGE))


def content_preview(docs: DataFrame, versions: DataFrame, max_length: int = 5000) -> DataFrame:
    n = F.lit(min(max_length, MOST_PREVIEW))
    size = F.coalesce(F.length("content_text"), F.lit(0))
    return with_latest(docs.select("id", "title"), versions).select("id", "title", F.left(F.coalesce("content_text", F.lit("")), n).alias("preview"), size.alias("content_length"), (size > n).alias("truncated"))


def document_detail(docs: DataFrame, versions: DataFrame) -> DataFrame:
    """Documents with facts of the latest version but not its content."""
    facts = latest_of(versions).select(F.col("document_id").alias("id"), "version_number", "scraped_at", F.coalesce(F.col("content_text") != "", F.lit(False)).alias("has_content"), F.coalesce(F.col("content_html") != "", F.lit(False)).alias("has_html"), F.length("content_text").alias("content_length"))
    out = docs.join(facts, "id", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("has_content", "has_html")})


def shortest_contents(versions: DataFrame, under: int = 100, n: int = 5) -> DataFrame:
    size = F.length("content_text")
    return latest_of(versions).select("document_id", size.alias("content_length")).filter(F.col("content_length") < under).orderBy("content_length", "document_id").limit(n)


def duplicate_title_sample(docs: DataFrame, n: int = 10) -> DataFrame:
    groups = docs.groupBy("source_type", "title").agg(F.count(F.lit(1)).alias("documents")).filter("documents > 1")
    return groups.orderBy(F.desc("documents"), "source_type", "title").limit(n)


def shell_sample(shells: DataFrame, n: int = 15) -> DataFrame:
    return shells.orderBy("source_type", "created_at", "id").select("id", "source_type", "created_at").limit(n)
