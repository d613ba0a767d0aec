"""The data model: snapshot tables keyed by deterministic ids, and the defaults of absent columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, TS, I, L, B = T.StringType(), T.TimestampType(), T.IntegerType(), T.LongType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(*f) for f in fields])


JURISDICTIONS = _struct(("code", S, False), ("name", S, True))
DOCUMENTS = _struct(
    ("id", S, False), ("target_id", S, True), ("jurisdiction_code", S, True), ("category", S, False), ("title", S, False), ("citation", S, True), ("source_url", S, False),
    ("source_type", S, True), ("document_type", S, True), ("is_active", B, True), ("metadata", T.MapType(S, S), True), ("created_at", TS, True), ("updated_at", TS, True), ("last_checked_at", TS, True),
)
VERSIONS = _struct(("id", S, False), ("document_id", S, False), ("content_html", S, True), ("content_text", S, True), ("content_hash", S, True), ("scraped_at", TS, True), ("version_number", I, False), ("is_latest", B, False))
JOBS = _struct(("id", S, False), ("target_id", S, True), ("status", S, False), ("started_at", TS, True), ("finished_at", TS, True), ("items_scraped", I, True), ("items_failed", I, True), ("logs", S, True))
COUNTERS = ("docs_discovered", "docs_checked", "docs_new", "docs_updated", "docs_unchanged", "docs_failed", "docs_skipped_fresh")
SYNC_LOG = _struct(
    ("id", S, False), ("source_type", S, False), ("mode", S, True), ("trigger_source", S, True), ("started_at", TS, True), ("finished_at", TS, True), *((c, L, True) for c in COUNTERS),
    ("max_age_hours", I, True), ("error_message", S, True), ("notes", S, True),
)
KEYS = _struct(("url", S, False), ("scraped_at", TS, True))

#: What a column holds when a batch doesn't have it. A null in a present column stays null.
BATCH_DEFAULTS: dict[str, object] = {
    "target_id": None, "jurisdiction_code": "ab", "category": "Legislation", "title": None, "citation": None, "source_type": "canlii_legacy", "document_type": "legislation",
    "is_active": True, "content_html": None, "content_text": None,
}


def document_id(url: Column) -> Column:
    return F.sha2(url, 256)


def version_id(document: Column, number: Column) -> Column:
    return F.sha2(F.concat_ws(":", document, number), 256)


def conform(df: DataFrame, schema: T.StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """The columns of ``schema`` in its order; absent ones get their default, present ones keep their nulls, others go.
    (Rows written before a column existed are still read.)"""
    have = {c.lower() for c in df.columns}
    return df.select(*[(F.col(f.name) if f.name.lower() in have else F.lit((defaults or {}).get(f.name))).cast(f.dataType).alias(f.name) for f in schema.fields])
