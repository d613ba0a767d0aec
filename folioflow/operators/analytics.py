"""Statistics over the corpus, each one pass over its tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.operators.joins import latest_of, stack_reports, with_jurisdiction

#: Url fragments by host class, in order.
HOST_RULES = (
    ("canlii", ("canlii.org",)), ("justice_canada", ("laws-lois.justice",)), ("bc_laws", ("bclaws",)), ("alberta", ("kings-printer.alberta", "open.alberta")), ("manitoba", ("gov.mb.ca",)),
    ("newfoundland", ("assembly.nl.ca",)), ("nova_scotia", ("nslegislature", "novascotia")), ("new_brunswick", ("laws.gnb",)), ("ontario", ("ontario.ca",)),
)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Rounded half to even, 0 where the whole is 0."""
    return F.when(whole > 0, F.bround(part * 100.0 / whole, digits)).otherwise(F.lit(0.0))


def totals(docs: DataFrame, versions: DataFrame, jobs: DataFrame) -> DataFrame:
    return table_counts({"documents": docs, "document_versions": versions, "scrape_jobs": jobs})


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return stack_reports(*[t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, t in tables.items()])


def count_by_source(docs: DataFrame) -> DataFrame:
    return docs.filter("source_type IS NOT NULL").groupBy("source_type").agg(F.count(F.lit(1)).alias("documents"), F.max("updated_at").alias("last_updated"))


def count_by_jurisdiction(docs: DataFrame, dim: DataFrame) -> DataFrame:
    """Grouped before the dimension is joined, so that the join sees a row per code."""
    return with_jurisdiction(docs.filter("jurisdiction_code IS NOT NULL").groupBy("jurisdiction_code").agg(F.count(F.lit(1)).alias("documents")), dim)


def count_by_type(docs: DataFrame) -> DataFrame:
    return docs.filter("document_type IS NOT NULL").groupBy("document_type").agg(F.count(F.lit(1)).alias("documents"))


def count_by_court(docs: DataFrame) -> DataFrame:
    court = F.try_element_at("metadata", F.lit("court"))
    return docs.filter("document_type = 'case_law'").select(court.alias("court")).filter("court <> ''").groupBy("court").agg(F.count(F.lit(1)).alias("documents"))


def top_courts(docs: DataFrame, n: int = 12) -> DataFrame:
    return count_by_court(docs).orderBy(F.desc("documents"), "court").limit(n)


def freshness_summary(docs: DataFrame, as_of: Column) -> DataFrame:
    at = F.col("last_checked_at")
    counted = docs.filter("source_type IS NOT NULL").groupBy("source_type").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(at > as_of - F.expr("INTERVAL 24 HOURS")).alias("within_24h"), F.count_if(at > as_of - F.expr("INTERVAL 7 DAYS")).alias("within_7d"),
        F.count_if(at.isNull()).alias("never_checked"), F.min(at).alias("oldest"), F.max(at).alias("newest"),
    )
    return counted.withColumn("percent_24h", percent(F.col("within_24h"), F.col("total")))


def latest_sync(sync_log: DataFrame) -> DataFrame:
    """The last finished sync of each source."""
    columns = [c for c in sync_log.columns if c != "source_type"]
    best = sync_log.filter("finished_at IS NOT NULL").groupBy("source_type").agg(F.max_by(F.struct(*columns), F.struct("started_at", "id")).alias("s"))
    return best.select("source_type", "s.*")


def freshness(docs: DataFrame, sync_log: DataFrame, as_of: Column) -> DataFrame:
    last = latest_sync(sync_log).select("source_type", F.col("mode").alias("last_mode"), F.col("started_at").alias("last_started"))
    return freshness_summary(docs, as_of).join(last, "source_type", "left")


def distribution(docs: DataFrame, by: str) -> DataFrame:
    """Counts with null as a group of its own."""
    return docs.groupBy(by).agg(F.count(F.lit(1)).alias("documents"))


def content_stats(versions: DataFrame) -> DataFrame:
    text, html = F.coalesce(F.col("content_text") != "", F.lit(False)), F.coalesce(F.col("content_html") != "", F.lit(False))
    return versions.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(text).alias("with_text"), F.count_if(html).alias("with_html"), F.count_if(~text & ~html).alias("empty_shells"),
        F.sum(F.length("content_text")).alias("text_chars"), F.sum(F.length("content_html")).alias("html_chars"), F.count_if("is_latest").alias("latest"),
    )


def length_profile(docs: DataFrame, versions: DataFrame) -> DataFrame:
    """Text lengths of latest versions by source; only lengths are joined, never texts."""
    n = latest_of(versions).select("document_id", F.length("content_text").alias("n"))
    joined = n.join(docs.select(F.col("id").alias("document_id"), "source_type"), "document_id")
    return joined.groupBy("source_type").agg(F.count("n").alias("documents"), F.min("n").alias("shortest"), F.round(F.avg("n")).cast("long").alias("mean"), F.max("n").alias("longest"))


def stored_megabytes(versions: DataFrame) -> DataFrame:
    return versions.agg(F.round(F.sum(F.length("content_text")) / 1048576.0, 1).alias("text_mb"))


def _version_counts(versions: DataFrame) -> DataFrame:
    return versions.groupBy(F.col("document_id").alias("id")).agg(F.count(F.lit(1)).alias("versions"))


def version_coverage(docs: DataFrame, versions: DataFrame) -> DataFrame:
    """Documents and versions by source with versions per document in percent and a verdict."""
    joined = docs.select("id", "source_type").join(_version_counts(versions), "id", "left")
    out = joined.groupBy("source_type").agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("versions"), F.lit(0)).alias("versions"))
    rate = percent(F.col("versions"), F.col("documents"))
    return out.withColumn("rate", rate).withColumn("verdict", F.when(F.col("rate") > 90, "ok").when(F.col("rate") > 0, "warn").otherwise("bad"))


def version_presence(docs: DataFrame, versions: DataFrame, grain: str = "document") -> DataFrame:
    """By source, rows with and without a version, and the share without one in percent. Grain "version" counts a document once for each of its versions, as
    a plain left join does."""
    joined = docs.select("id", "source_type").join(_version_counts(versions), "id", "left")
    weight = F.greatest(F.coalesce("versions", F.lit(1)), F.lit(1)) if grain == "version" else F.lit(1)
    some = F.col("versions").isNotNull()
    out = joined.groupBy("source_type").agg(F.sum(weight).alias("total"), F.coalesce(F.sum(F.when(some, weight)), F.lit(0)).alias("with_version"), F.count_if(~some).alias("without_version"))
    return out.withColumn("rate", percent(F.col("without_version"), F.col("total")))


def version_stats(docs: DataFrame, versions: DataFrame, grain: str = "document") -> DataFrame:
    return version_presence(docs, versions, grain)


def missing_content(docs: DataFrame, versions: DataFrame) -> DataFrame:
    flags = versions.select("document_id", (F.coalesce(F.length("content_html"), F.lit(0)) == 0).alias("no_html"), (F.coalesce(F.length("content_text"), F.lit(0)) == 0).alias("no_text"))
    joined = flags.join(docs.select(F.col("id").alias("document_id"), "source_type"), "document_id")
    return joined.groupBy("source_type").agg(F.count(F.lit(1)).alias("versions"), F.count_if("no_html").alias("no_html"), F.count_if("no_text").alias("no_text"))


def versioned_documents(docs: DataFrame, versions: DataFrame) -> DataFrame:
    have = versions.agg(F.countDistinct("document_id").alias("versioned"))
    return docs.agg(F.count(F.lit(1)).alias("documents")).join(have).withColumn("gap", F.col("documents") - F.col("versioned"))


def ingestion_timeline(docs: DataFrame) -> DataFrame:
    day = F.to_date("created_at")
    return docs.groupBy("source_type").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("documents"))


def classify_hosts(urls: DataFrame, rules=HOST_RULES, column: str = "url") -> DataFrame:
    """Counts of urls by the first rule of which they hold a fragment."""
    kind = None
    for name, fragments in rules:
        hit = F.lit(False)
        for f in fragments:
            hit = hit | F.col(column).contains(f)
        kind = F.when(hit, name) if kind is None else kind.when(hit, name)
    return urls.select(kind.otherwise("other").alias("host_class")).groupBy("host_class").agg(F.count(F.lit(1)).alias("urls"))


def key_progress(keys: DataFrame, total: int) -> DataFrame:
    """Keys against an expected total; what remains is negative where there are more."""
    n = F.count(F.lit(1))
    rate = F.when(F.lit(total) > 0, F.round(n * 100.0 / F.lit(max(total, 1)), 2)).otherwise(F.lit(0.0))
    return keys.agg(n.alias("scraped"), (F.lit(total) - n).alias("remaining"), rate.alias("percentage"), F.min("scraped_at").alias("first_at"), F.max("scraped_at").alias("last_at"))


def coverage(docs: DataFrame, estimates: DataFrame) -> DataFrame:
    """By estimated source, documents against the estimate in percent, 100 at most."""
    n = docs.groupBy("source_type").agg(F.count(F.lit(1)).alias("n"))
    out = estimates.join(n, "source_type", "left").withColumn("documents", F.coalesce("n", F.lit(0)))
    share = F.when(F.col("estimate") > 0, F.least(F.lit(100.0), F.round(F.col("documents") * 100.0 / F.col("estimate"), 1))).otherwise(F.lit(0.0))
    return out.select("source_type", "documents", "estimate", share.alias("coverage"))


def category_totals(docs: DataFrame) -> DataFrame:
    """Federal, provincial and case-law totals."""
    bucket = F.when(F.col("document_type") == "case_law", "case_law").when(F.col("jurisdiction_code") == "ca", "federal").otherwise("provincial_territorial")
    return docs.groupBy(bucket.alias("category_bucket")).agg(F.count(F.lit(1)).alias("documents"), F.countDistinct("source_type").alias("sources"))


def distinct_counts(docs: DataFrame) -> DataFrame:
    court = F.when(F.col("document_type") == "case_law", F.try_element_at("metadata", F.lit("court")))
    return docs.agg(F.countDistinct("source_type").alias("sources"), F.countDistinct("jurisdiction_code").alias("jurisdictions"), F.countDistinct(court).alias("courts"))


def available_count(court_counts: DataFrame, limit: int | None = None) -> DataFrame:
    n = F.coalesce(F.sum("documents"), F.lit(0))
    return court_counts.agg((F.least(n, F.lit(limit)) if limit else n).alias("available"))
