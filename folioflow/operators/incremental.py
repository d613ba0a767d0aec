"""What to fetch next: key filters, freshness, budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.operators.ordering import number_rows

#: Estimates of listing sizes by source, and that of others.
ESTIMATES = {"justice_canada_xml": 5795, "bc_laws_api": 882, "alberta_kings_printer": 1415, "a2aj_case_law": 184565, "canlii_legacy": 1000}
DEFAULT_ESTIMATE = 1000


def add_keys(keys: DataFrame, new: DataFrame) -> DataFrame:
    """Insert-or-ignore of (url, scraped_at): known urls keep their time, of repeated new ones the earliest stays."""
    added = new.groupBy("url").agg(F.min("scraped_at").alias("scraped_at")).join(keys, "url", "left_anti")
    return keys.select("url", "scraped_at").unionByName(added)


def not_in_keys(listing: DataFrame, keys: DataFrame) -> DataFrame:
    return listing.join(keys.select(F.col("url").alias("source_url")), "source_url", "left_anti")


def fresh(docs: DataFrame, max_age: Column, as_of: Column) -> DataFrame:
    """Documents checked after as_of - max_age; one at just that time is neither fresh nor stale."""
    return docs.filter(F.col("last_checked_at") > as_of - max_age)


def fresh_keys(docs: DataFrame, urls: DataFrame, max_age: Column, as_of: Column) -> DataFrame:
    return fresh(docs, max_age, as_of).select("source_url").join(urls.select("source_url"), "source_url", "left_semi")


def not_fresh(listing: DataFrame, docs: DataFrame, max_age: Column, as_of: Column) -> DataFrame:
    return listing.join(fresh(docs, max_age, as_of).select("source_url"), "source_url", "left_anti")


def select_candidates(listing: DataFrame, docs: DataFrame, keys: DataFrame, mode: str, max_age: Column, as_of: Column) -> DataFrame:
    """Full mode skips known keys, incremental mode skips what is fresh."""
    if mode not in {"full", "incremental"}:
        raise ValueError(f"unknown mode {mode!r}")
    return not_in_keys(listing, keys) if mode == "full" else not_fresh(listing, docs, max_age, as_of)


def classify(listing: DataFrame, candidates: DataFrame, results: DataFrame) -> DataFrame:
    """Each listed url with its outcome: that of the upsert, failed for a candidate without one, else skipped_fresh."""
    chosen = candidates.select("source_url").distinct().withColumn("chosen", F.lit(True))
    done = results.groupBy("source_url").agg(F.max_by("outcome", "seq").alias("done"))
    joined = listing.join(chosen, "source_url", "left").join(done, "source_url", "left")
    return joined.select("source_type", "source_url", F.when(F.col("chosen").isNull(), "skipped_fresh").otherwise(F.coalesce("done", F.lit("failed"))).alias("outcome"))


def stale_queue(docs: DataFrame, max_age: Column, as_of: Column, source_type: str | None = None, limit: int | None = None) -> DataFrame:
    """Never checked or older than max_age, those first, then the oldest; no limit for 0 or None."""
    due = docs.filter(F.col("last_checked_at").isNull() | (F.col("last_checked_at") < as_of - max_age))
    if source_type:
        due = due.filter(F.col("source_type") == source_type)
    due = due.orderBy(F.col("last_checked_at").asc_nulls_first(), "id")
    return due.limit(limit) if limit else due


def restrict_to(listing: DataFrame, urls: DataFrame) -> DataFrame:
    return listing.join(urls.select("source_url"), "source_url", "left_semi")


def allocate_budget(sources: DataFrame, limit: int, mode: str) -> DataFrame:
    """Budgets of sources (source_type, pos, estimate): sequential gives none, equal an n-th with the rest to the first,
    proportional by log of the estimate (10 at least; null: 1000) with the rest to the last. Each gets 1 at least; a
    source alone has no budget of its own."""
    if mode == "sequential" or not limit:
        return sources.select("source_type", "pos", F.lit(None).cast("long").alias("budget"))
    everyone = Window.partitionBy()  # a handful of sources
    in_turn = Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    n, last = F.count(F.lit(1)).over(everyone), F.col("pos") == F.max("pos").over(everyone)
    if mode == "equal":
        each = F.greatest(F.lit(1), F.floor(F.lit(limit) / n))
        budget = each + F.when(F.col("pos") == F.min("pos").over(everyone), F.greatest(F.lit(0), F.lit(limit) - each * n)).otherwise(0)
        return sources.select("source_type", "pos", F.when(n > 1, budget).cast("long").alias("budget"))
    weight = F.ln(F.greatest(F.coalesce("estimate", F.lit(DEFAULT_ESTIMATE)), F.lit(10)).cast("double"))
    part = sources.withColumn("part", F.greatest(F.lit(1), F.floor(limit * weight / F.sum(weight).over(everyone))))
    rest = F.greatest(F.lit(1), F.lit(limit) - F.coalesce(F.sum("part").over(in_turn), F.lit(0)))
    return part.select("source_type", "pos", F.when(n > 1, F.when(last, rest).otherwise(F.col("part"))).cast("long").alias("budget"))


#: Where a budget applies: to what is listed, before known urls go (a repeated run lists the same rows again), or to what
#: is left of it.
STAGES = ("before", "after")


def select_within_budget(listing: DataFrame, budgets: DataFrame, limit: int | None = None) -> DataFrame:
    """Of a listing (source_type, pos, source_url), each source's first rows up to its budget (null: all of them), then the
    first ``limit`` in source order. Rows are numbered in ranges, so that a source may hold any share of the listing."""
    b = budgets.select("source_type", F.col("pos").alias("source_pos"), "budget")
    rows = number_rows(listing.select("source_type", "pos", "source_url"), ["source_type"], ["pos", "source_url"], "n")
    chosen = rows.join(b, "source_type").filter("budget IS NULL OR n <= budget").select("source_type", "source_pos", "n", "pos", "source_url")
    return chosen.orderBy("source_pos", "n").limit(limit) if limit else chosen


def budgeted_candidates(listing: DataFrame, budgets: DataFrame, docs: DataFrame, keys: DataFrame, mode: str, max_age: Column, as_of: Column, limit: int | None = None, budget_stage: str = "after") -> DataFrame:
    """Candidates of a listing within budgets, which apply after known or fresh urls are gone or before."""
    if budget_stage not in STAGES:
        raise ValueError(f"unknown stage {budget_stage!r}")
    pick = lambda rows: select_within_budget(rows, budgets, limit)
    left = lambda rows: select_candidates(rows, docs, keys, mode, max_age, as_of)
    return pick(left(listing)) if budget_stage == "after" else left(pick(listing))


def first_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row a key, the first in order (nulls first); tasks keep one row a key before any are shuffled."""
    least = F.min_by(F.struct("*"), F.struct(*[F.col(c) for c in order])).alias("row")
    return df.groupBy(*[F.col(c).alias(f"key{i}") for i, c in enumerate(key)]).agg(least).select("row.*")


def preview(listing: DataFrame, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """A dry run: the first n rows in order, and one row with the number of the others."""
    return listing.orderBy("pos", "source_url").limit(n), listing.agg(F.greatest(F.lit(0), F.count(F.lit(1)) - n).alias("remaining"))
