"""Data-quality checks: rows (check_name, severity, problems), one pass per table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.operators.joins import docs_without_versions, is_generic_title, latest_of, orphan_versions, reconcile_keys, stack_reports, url_flags

#: Titles that say nothing without the act they belong to.
GENERIC_TITLES = ("general", "forms", "fees", "exemptions", "exemption", "administration", "procedures", "designation", "enforcement", "standards", "licensing", "inspection", "appeal", "board")


def _checks(df: DataFrame, checks: dict[str, tuple[str, Column]]) -> DataFrame:
    """Counts of several conditions in one pass, as rows."""
    one = df.agg(*[F.count_if(cond).alias(name) for name, (_, cond) in checks.items()])
    rows = F.array(*[F.struct(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), F.col(name).alias("problems")) for name, (severity, _) in checks.items()])
    return one.select(F.inline(rows))


def check_required(docs: DataFrame) -> DataFrame:
    gone = lambda c: F.coalesce(F.trim(F.col(c)) == "", F.lit(True))
    return _checks(docs, {
        "title": ("issue", gone("title")), "source_url": ("issue", gone("source_url")), "citation": ("warning", gone("citation")), "jurisdiction_code": ("warning", gone("jurisdiction_code")),
        "source_type": ("issue", gone("source_type")), "document_type": ("warning", gone("document_type")),
    })


def duplicates(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def _one(df: DataFrame, name: str, severity: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("problems")).select(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), "problems")


def check_duplicate_urls(docs: DataFrame) -> DataFrame:
    return _one(duplicates(docs, ["source_url"]), "duplicate_urls", "issue")


def check_orphans(docs: DataFrame, versions: DataFrame) -> DataFrame:
    return stack_reports(_one(orphan_versions(docs, versions), "orphan_versions", "issue"), _one(docs_without_versions(docs, versions), "empty_shells", "warning"))


def shells_by_source(docs: DataFrame, versions: DataFrame) -> DataFrame:
    return docs_without_versions(docs, versions).groupBy("source_type").agg(F.count(F.lit(1)).alias("documents"))


def check_urls(docs: DataFrame) -> DataFrame:
    return _checks(url_flags(docs), {"url_with_space": ("issue", F.col("has_space")), "url_with_comma": ("warning", F.col("has_comma")), "url_not_http": ("issue", F.col("not_http"))})


def commas_by_source(docs: DataFrame) -> DataFrame:
    return url_flags(docs).filter("has_comma").groupBy("source_type").agg(F.count(F.lit(1)).alias("documents"))


def check_titles(docs: DataFrame, words=GENERIC_TITLES) -> DataFrame:
    return _checks(docs, {"generic_titles": ("warning", is_generic_title(F.col("title"), words))})


def check_duplicate_titles(docs: DataFrame) -> DataFrame:
    """Groups of one title in one source, with the member urls of documents in them."""
    groups = duplicates(docs, ["source_type", "title"])
    return docs.join(groups, ["source_type", "title"]).select("source_type", "title", "rows", "source_url")


def check_content(versions: DataFrame, min_chars: int = 100) -> DataFrame:
    text, html = F.coalesce(F.length("content_text"), F.lit(0)), F.coalesce(F.length("content_html"), F.lit(0))
    return _checks(latest_of(versions), {"missing_text": ("issue", text == 0), "missing_html": ("warning", html == 0), "short_text": ("warning", (text > 0) & (text < min_chars))})


def check_duplicate_content(docs: DataFrame, versions: DataFrame, members: int = 3) -> DataFrame:
    """Latest contents that several documents share, with the first few members' urls."""
    joined = latest_of(versions).select("document_id", "content_hash").join(docs.select(F.col("id").alias("document_id"), "source_url"), "document_id")
    few = F.row_number().over(Window.partitionBy("content_hash").orderBy("source_url"))
    sizes = joined.groupBy("content_hash").agg(F.count(F.lit(1)).alias("documents")).filter("documents > 1")
    shown = joined.join(sizes.select("content_hash"), "content_hash", "left_semi").withColumn("n", few).filter(F.col("n") <= members)
    return shown.groupBy("content_hash").agg(F.array_join(F.sort_array(F.collect_list("source_url")), " ").alias("members")).join(sizes, "content_hash")


def check_schema(spark: SparkSession, tables: dict[str, DataFrame], expected: dict[str, list[str]]) -> DataFrame:
    """Missing and extra tables and missing columns."""
    have = [(t, c) for t, df in tables.items() for c in df.columns]
    want = [(t, c) for t, columns in expected.items() for c in columns]
    schema = "table_name string, column_name string"
    a, b = spark.createDataFrame(have, schema), spark.createDataFrame(want, schema)
    names = lambda df: df.select("table_name").distinct()
    kind = lambda df, k: df.withColumn("finding", F.lit(k))
    blank = F.lit(None).cast("string").alias("column_name")
    lost = names(b).join(names(a), "table_name", "left_anti")
    columns = b.join(a, ["table_name", "column_name"], "left_anti").join(lost, "table_name", "left_anti")
    extra = names(a).join(names(b), "table_name", "left_anti")
    return stack_reports(kind(lost.select("table_name", blank), "missing_table"), kind(columns.select("table_name", "column_name"), "missing_column"), kind(extra.select("table_name", blank), "extra_table"))


def check_keys(docs: DataFrame, keys: DataFrame) -> DataFrame:
    both = reconcile_keys(docs, keys)
    return _checks(both, {"missing_from_keys": ("warning", F.col("side") == "corpus"), "only_in_keys": ("warning", F.col("side") == "keys")})


def compare_snapshots(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two one-row snapshots (total_documents, total_versions): versions must not shrink; documents may, down to the
    versions there were (shells removed)."""
    b = before.select(F.col("total_documents").alias("docs_before"), F.col("total_versions").alias("versions_before"))
    both = after.select(F.col("total_documents").alias("docs_after"), F.col("total_versions").alias("versions_after")).join(b)
    versions = F.when(F.col("versions_after") >= F.col("versions_before"), "pass").otherwise("fail")
    docs = F.when((F.col("docs_after") >= F.col("docs_before")) | (F.col("docs_after") >= F.col("versions_before")), "pass").otherwise("fail")
    return both.select(F.inline(F.array(F.struct(F.lit("versions").alias("check_name"), versions.alias("verdict")), F.struct(F.lit("documents").alias("check_name"), docs.alias("verdict")))))


def shell_verdict(docs: DataFrame, versions: DataFrame, some: int = 100) -> DataFrame:
    n = F.count(F.lit(1))
    return docs_without_versions(docs, versions).agg(n.alias("shells"), F.when(n == 0, "pass").otherwise("warn").alias("verdict"), F.when(n == 0, "none").when(n < some, "perhaps newly listed").otherwise("run the repair").alias("note"))


def summarise(checks: DataFrame) -> DataFrame:
    """Totals by severity: checks, those with problems, and problems."""
    return checks.groupBy("severity").agg(F.count(F.lit(1)).alias("checks"), F.count_if(F.col("problems") > 0).alias("failing"), F.sum("problems").alias("problems"))


def check_constraints(docs: DataFrame, versions: DataFrame, dim: DataFrame) -> DataFrame:
    """What the schema promises: keys unique and present, references met, one latest version a document."""
    loose = docs.filter("jurisdiction_code IS NOT NULL").join(dim.select(F.col("code").alias("jurisdiction_code")), "jurisdiction_code", "left_anti")
    tops = versions.groupBy("document_id").agg(F.count_if("is_latest").alias("n")).filter("n <> 1")
    parts = [
        _one(duplicates(docs, ["source_url"]), "unique_source_url", "issue"), _one(duplicates(docs, ["id"]), "unique_document_id", "issue"), _one(loose, "jurisdiction_exists", "issue"),
        _one(orphan_versions(docs, versions), "document_exists", "issue"), _one(tops, "one_latest_version", "issue"), _checks(docs, {"title_not_null": ("issue", F.col("title").isNull()), "category_not_null": ("issue", F.col("category").isNull())}),
    ]
    return reduce(DataFrame.unionByName, parts)


def check_sources(config: DataFrame, expected: DataFrame) -> DataFrame:
    a, b = config.select("source_type").distinct(), expected.select("source_type").distinct()
    return stack_reports(b.join(a, "source_type", "left_anti").withColumn("finding", F.lit("missing")), a.join(b, "source_type", "left_anti").withColumn("finding", F.lit("unexpected")))


def quality_snapshot(docs: DataFrame, versions: DataFrame, jobs: DataFrame, checks: DataFrame, as_of: Column) -> DataFrame:
    """One row: totals, documents by source as a map, issues, warnings and the time."""
    by_source = docs.groupBy("source_type").agg(F.count(F.lit(1)).alias("n")).filter("source_type IS NOT NULL").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("source_type", "n")))).alias("by_source"))
    found = checks.agg(F.sum(F.when(F.col("severity") == "issue", F.col("problems"))).alias("issues"), F.sum(F.when(F.col("severity") == "warning", F.col("problems"))).alias("warnings"))
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    parts = [count(docs, "total_documents"), count(versions, "total_versions"), count(jobs, "total_jobs"), by_source, found]
    return reduce(DataFrame.join, parts).withColumn("taken_at", as_of)


def write_snapshot(snapshot: DataFrame, path: str) -> None:
    """A snapshot's row as a file of one JSON object, times in ISO form; a later snapshot adds a file of its own."""
    snapshot.write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ssXXX").json(path)
