"""Versioned upsert: the next snapshot of documents and versions as a function of the current one and a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.schemas import BATCH_DEFAULTS, DOCUMENTS, VERSIONS, document_id, version_id

METADATA = "map<string,string>"


def conform_batch(batch: DataFrame) -> DataFrame:
    """A batch with all columns the upsert reads, defaults for the absent ones."""
    have = set(batch.columns)
    for name, value in BATCH_DEFAULTS.items():
        if name not in have:
            batch = batch.withColumn(name, F.lit(value).cast("boolean" if name == "is_active" else "string"))
    if "metadata" not in have:
        batch = batch.withColumn("metadata", F.create_map().cast(METADATA))
    if "seq" not in have:
        batch = batch.withColumn("seq", F.lit(1).cast("long"))
    return batch


def acceptable(known_codes: DataFrame | None = None) -> Column:
    """Rows that can be written: a url, a title, a category and a text, and no empty jurisdiction. Unknown codes are
    added to the dimension by ``ensure_jurisdictions``, so they are fine; null is too."""
    return F.coalesce(F.col("source_url") != "", F.lit(False)) & F.col("title").isNotNull() & F.col("category").isNotNull() & F.col("content_text").isNotNull() & F.coalesce(F.col("jurisdiction_code") != "", F.lit(True))


def _latest(versions: DataFrame) -> DataFrame:
    """Hash and number of the latest version by document; were there several, the greatest number counts."""
    top = versions.filter("is_latest").groupBy("document_id").agg(F.max(F.struct("version_number", "content_hash")).alias("v"))
    return top.select(F.col("document_id").alias("old_document"), F.col("v.version_number").alias("old_number"), F.col("v.content_hash").alias("old_hash"))


def outcomes(docs: DataFrame, versions: DataFrame, batch: DataFrame) -> DataFrame:
    """Each batch row with its outcome: failed, new, updated or unchanged, its hash, the id of its document and, for rows
    that make a version, its number and whether it is the newest of its document.

    Rows of one url apply one after another by seq: a row makes a version when its hash differs from the row before,
    the first when it differs from the current latest one (an absent hash differs from all). What is known of a url is
    gathered by its urls alone, so that texts are shuffled once, by url.
    """
    batch = conform_batch(batch).withColumn("content_hash", F.sha2("content_text", 256)).withColumn("ok", acceptable())
    known = docs.select(F.col("source_url").alias("known_url"), F.col("id").alias("known_id"))
    urls = batch.select(F.col("source_url").alias("at_url")).filter("at_url IS NOT NULL").distinct()
    old = urls.join(known, F.col("at_url") == F.col("known_url"), "left").withColumn("document_id", F.coalesce("known_id", document_id(F.col("at_url"))))
    old = old.join(_latest(versions), F.col("document_id") == F.col("old_document"), "left").select("at_url", "known_id", "document_id", "old_number", "old_hash")
    good = batch.filter("ok").join(old, F.col("source_url") == F.col("at_url"), "left")
    in_turn = Window.partitionBy("source_url").orderBy("seq")
    first = F.row_number().over(in_turn) == 1
    before = F.when(first, F.col("old_hash")).otherwise(F.lag("content_hash").over(in_turn))
    good = good.withColumn("changed", ~F.col("content_hash").eqNullSafe(before)).withColumn("created", first & F.col("known_id").isNull())
    step, number = F.col("changed").cast("int"), F.coalesce("old_number", F.lit(0))
    good = good.withColumns({"steps": F.sum(step).over(in_turn.rowsBetween(Window.unboundedPreceding, 0)), "all_steps": F.sum(step).over(in_turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    good = good.withColumn("version_number", F.when(F.col("changed"), number + F.col("steps")).cast("int")).withColumn("newest", F.when(F.col("changed"), F.col("steps") == F.col("all_steps")))
    good = good.withColumn("last_row", F.lead("seq").over(in_turn).isNull())
    good = good.withColumn("outcome", F.when(F.col("created"), "new").when(F.col("changed"), "updated").otherwise("unchanged"))
    bad = batch.filter("NOT ok").withColumn("outcome", F.lit("failed"))
    return good.drop("ok", "at_url", "steps", "all_steps").unionByName(bad.drop("ok"), allowMissingColumns=True)


def upsert(docs: DataFrame, versions: DataFrame, batch: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, versions, outcomes) after the batch.

    Documents take the last row of their url, but keep id, target_id and created_at; updated_at and last_checked_at
    move even if nothing changed. Changes of the text alone make versions. Rows that fail leave both tables as they
    are. The batch's text is hashed once and only versions carry it on.
    """
    found = outcomes(docs, versions, batch)
    return *apply_outcomes(docs, versions, found, as_of), found


def apply_outcomes(docs: DataFrame, versions: DataFrame | None, found: DataFrame, as_of: Column, placed_by: Sequence[Column] = ()) -> tuple[DataFrame, DataFrame]:
    """(documents, versions) after a batch whose rows have their outcomes. Documents without a row in it stay, and so do
    versions; parts of the tables that hold all of the batch's documents do as well as whole ones. With ``placed_by``,
    functions of document_id, versions are dealt by these as they come and need no further shuffle to be written so.
    Without ``versions`` the new ones come alone."""
    good = found.filter("outcome <> 'failed'")
    keep = {"id", "target_id", "created_at", "source_url"}
    last = good.filter("last_row").select(*[F.col("document_id" if f.name == "id" else f.name).alias(f"new_{f.name}") for f in DOCUMENTS.fields if f.name not in {"created_at", "updated_at", "last_checked_at"}])
    merged = docs.join(last, docs["source_url"] == last["new_source_url"], "full")
    old, new = F.col("source_url").isNotNull(), F.col("new_source_url").isNotNull()

    def pick(name: str) -> Column:
        if name in {"updated_at", "last_checked_at"}:
            value = F.when(new, as_of).otherwise(F.col(name))
        elif name == "created_at":
            value = F.when(old, F.col(name)).otherwise(as_of)
        elif name in keep:
            value = F.when(old, F.col(name)).otherwise(F.col(f"new_{name}"))
        else:
            value = F.when(new, F.col(f"new_{name}")).otherwise(F.col(name))
        return value.alias(name)

    next_docs = merged.select(*[pick(f.name) for f in DOCUMENTS.fields])
    made = good.filter("changed")
    added = made.select(
        version_id(F.col("document_id"), F.col("version_number")).alias("id"), "document_id", "content_html", "content_text", "content_hash", as_of.alias("scraped_at"),
        "version_number", F.col("newest").alias("is_latest"),
    )
    if versions is None:
        return next_docs, added.repartition(*placed_by) if placed_by else added
    if placed_by:
        places = [f"_place{i}" for i in range(len(placed_by))]
        both = versions.select(*VERSIONS.names, F.lit(False).alias("_added")).unionByName(added.withColumn("_added", F.lit(True)))
        both = both.withColumns(dict(zip(places, placed_by, strict=True))).repartition(*places)
        renewed = F.max("_added").over(Window.partitionBy(*places, "document_id"))
        return next_docs, both.withColumn("is_latest", F.col("is_latest") & (F.col("_added") | ~renewed)).select(*VERSIONS.names)
    touched = made.filter("newest").select(F.col("document_id").alias("touched"))
    flipped = versions.join(touched, versions["document_id"] == F.col("touched"), "left").withColumn("is_latest", F.col("is_latest") & F.col("touched").isNull()).select(*VERSIONS.names)
    return next_docs, flipped.unionByName(added)


def ensure_jurisdictions(dim: DataFrame, codes: DataFrame) -> DataFrame:
    """The dimension with the batch's unknown non-empty codes, named by their upper case."""
    new = codes.select("code").filter("code IS NOT NULL AND code <> ''").distinct().join(dim, "code", "left_anti")
    return dim.select("code", "name").unionByName(new.select("code", F.upper("code").alias("name")))


def seed_jurisdictions(dim: DataFrame, seed: DataFrame) -> DataFrame:
    """The dimension with a seed whose names win."""
    both = dim.select("code", "name").join(seed.select("code", F.col("name").alias("seed_name")), "code", "full")
    return both.select("code", F.coalesce("seed_name", "name").alias("name"))


def upsert_targets(targets: DataFrame, batch: DataFrame) -> DataFrame:
    """Targets by url: new ones added, known ones with the batch's name and category."""
    new = batch.select(*[F.col(c).alias(f"new_{c}") for c in ("id", "url", "name", "category")])
    both = targets.select("id", "url", "name", "category").join(new, F.col("url") == F.col("new_url"), "full")
    old_first = [F.coalesce(c, f"new_{c}").alias(c) for c in ("id", "url")]
    return both.select(*old_first, *[F.coalesce(f"new_{c}", c).alias(c) for c in ("name", "category")])


def latest(versions: DataFrame) -> DataFrame:
    return versions.filter("is_latest")


def history(versions: DataFrame) -> DataFrame:
    """The change log: each version with the one before it and the change in length."""
    by = Window.partitionBy("document_id").orderBy("version_number")
    n = F.length("content_text")
    return versions.select("document_id", "version_number", F.lag("version_number").over(by).alias("previous_number"), (n - F.lag(n).over(by)).alias("length_change"), "is_latest")
