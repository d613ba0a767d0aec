"""Run and sync records, computed from row outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The log line of interrupted runs, and the outcomes counted as checked.
INTERRUPTED = "Interrupted: System restarted or script crashed"
CHECKED = ("new", "updated", "unchanged", "failed")


def counters() -> list[Column]:
    n = lambda *kinds: F.count_if(F.col("outcome").isin(*kinds))
    return [
        F.count(F.lit(1)).alias("docs_discovered"), n(*CHECKED).alias("docs_checked"), n("new").alias("docs_new"), n("updated").alias("docs_updated"),
        n("unchanged").alias("docs_unchanged"), n("failed").alias("docs_failed"), n("skipped_fresh").alias("docs_skipped_fresh"),
    ]


def run_counters(outcomes: DataFrame) -> DataFrame:
    """Counters by source in one pass."""
    return outcomes.groupBy("source_type").agg(*counters())


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Totals of a run and its success rate in percent of all rows discovered, skipped ones included (0 without rows)."""
    ok, bad = F.count_if(F.col("outcome").isin("new", "updated", "unchanged")), F.count_if(F.col("outcome") == "failed")
    n = F.count(F.lit(1))
    rate = F.when(n > 0, F.bround(ok * 100.0 / n, 1)).otherwise(F.lit(0.0))
    return outcomes.agg(ok.alias("succeeded"), bad.alias("failed"), F.count_if(F.col("outcome") == "skipped_fresh").alias("skipped"), rate.alias("success_rate"))


def run_record(outcomes: DataFrame, engine: str, started_at: Column, finished_at: Column) -> DataFrame:
    """One jobs row: failed if nothing succeeded while something failed, else completed."""
    ok, bad = F.count_if(F.col("outcome").isin("new", "updated", "unchanged")), F.count_if(F.col("outcome") == "failed")
    log = F.concat(F.lit(f"[{engine}] saved "), ok.cast("string"), F.lit(", failed "), bad.cast("string"))
    row = outcomes.agg(F.when((ok == 0) & (bad > 0), "failed").otherwise("completed").alias("status"), ok.cast("int").alias("items_scraped"), bad.cast("int").alias("items_failed"), log.alias("logs"))
    return row.select(F.sha2(F.concat_ws(":", F.lit(engine), started_at.cast("string")), 256).alias("id"), "status", started_at.alias("started_at"), finished_at.alias("finished_at"), "items_scraped", "items_failed", "logs")


def sync_record(outcomes: DataFrame, mode: str, trigger: str, started_at: Column, finished_at: Column, max_age_hours: int | None = None, dry_run: bool = False, error: str | None = None) -> DataFrame:
    """A sync-log row for each source of a run."""
    counted = run_counters(outcomes)
    return counted.select(
        F.sha2(F.concat_ws(":", "source_type", started_at.cast("string")), 256).alias("id"), "*", F.lit(mode).alias("mode"), F.lit(trigger).alias("trigger_source"), started_at.alias("started_at"),
        finished_at.alias("finished_at"), F.lit(max_age_hours).cast("int").alias("max_age_hours"), F.lit(error).cast("string").alias("error_message"), F.lit("dry-run" if dry_run else None).cast("string").alias("notes"),
    )


def close_interrupted(jobs: DataFrame, as_of: Column) -> DataFrame:
    """Runs still marked running become failed at ``as_of``."""
    open_ = F.col("status") == "running"
    return jobs.withColumns({"finished_at": F.when(open_, as_of).otherwise(F.col("finished_at")), "logs": F.when(open_, F.lit(INTERRUPTED)).otherwise(F.col("logs")), "status": F.when(open_, "failed").otherwise(F.col("status"))})
