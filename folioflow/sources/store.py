"""Snapshots of documents and versions, loads and backfills."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators import search
from folioflow.operators import upsert as upserts
from folioflow.operators.joins import latest_of
from folioflow.schemas import DOCUMENTS, VERSIONS, conform, document_id, version_id
from folioflow.sources import segments

POINTER = "CURRENT"
#: Buckets of a new store; a store keeps the number it was made with.
BUCKETS = 64
#: Folders of a bucket of versions, from which on the next upsert that touches it writes it as one.
LAYERS = 8
TABLES = {"documents": DOCUMENTS, "versions": VERSIONS}
INDEXES = ("title", "content")


class Conflict(OSError):
    """Another writer committed a snapshot that this one's rows don't follow from."""


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of a key: 32 bits of its SHA-256, so that any engine finds the same one."""
    return F.pmod(F.conv(F.left(F.sha2(key, 256), F.lit(8)), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def places(key: str, buckets: int) -> list[Column]:
    """What deals rows to the tasks that write them: four a bucket."""
    return [bucket_of(F.col(key), buckets), F.pmod(F.xxhash64(key), F.lit(4))]


def layers_of(folders: str | list[str]) -> list[str]:
    """A bucket's folders, oldest first; a manifest names a single one as it is."""
    return [folders] if isinstance(folders, str) else folders


class Store:
    """A folder of snapshots of documents and versions in buckets, and a pointer to the current one.

    Documents lie in buckets of their url and versions in buckets of their document, parted by is_latest within it. Every
    commit writes its buckets below a new folder of its own name and a manifest that names the folders of each bucket;
    ``upsert`` writes for the buckets that the batch touches and takes all other folders over from the snapshot before.
    A touched bucket of documents is written again. One of versions gets a further folder, a layer, with the new versions
    alone: of a document's versions those in its newest layer with a latest one keep their mark, as a reader finds from
    ids. A bucket of LAYERS layers is written again as one.

    A snapshot counts once its pointer CURRENT.<number> exists, which is made with its whole content in one step that fails
    where there is one already. So of two writers that start from one snapshot a single one gets the next number. The
    other, if it has read and written buckets that the winner left alone, takes the winner's folders over and goes on to
    the number after; else it raises Conflict. No folder, manifest or pointer is ever overwritten: a reader sees one
    snapshot whole, the winner's rows stay, and what a dead writer leaves is named nowhere. A batch id that the current
    snapshot has is not applied again.

    With ``analyzer`` a new store also keeps the title and content index of its documents, as segments that the manifest
    names: an upsert adds one with the postings of its batch's documents, made from the batch alone, and ``merge_index``
    joins small ones. Index and tables belong to one snapshot.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, analyzer: str | None = None):
        self.spark, self.buckets, self.analyzer = spark, buckets, analyzer
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        where = self._path(path.rstrip("/"))
        self._fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.path = self._fs.makeQualified(where).toString()

    # --- snapshots

    def numbers(self) -> list[int]:
        found = self._fs.globStatus(self._path(f"{self.path}/{POINTER}.*")) or []
        return sorted(int(f.getPath().getName().rsplit(".", 1)[1]) for f in found)

    def manifest(self, number: int | None = None) -> dict | None:
        """The manifest of a snapshot, by default of the current one: snapshot, batch_id, buckets, written (the folder of
        this commit) and, by table, the folder of each bucket that has rows; of versions, its layers, oldest first."""
        numbers = self.numbers()
        if not numbers:
            return None
        return json.loads(self.spark.read.text(f"{self.path}/{POINTER}.{number or numbers[-1]}", wholetext=True).first()[0])

    def current(self) -> dict | None:
        """Number and batch id of the current snapshot."""
        now = self.manifest()
        return now and {"snapshot": now["snapshot"], "batch_id": now["batch_id"]}

    def _start(self) -> dict:
        return self.manifest() or {"snapshot": 0, "batch_id": None, "buckets": self.buckets, "analyzer": self.analyzer, "documents": {}, "versions": {}, "index": {k: [] for k in INDEXES}}

    def _table(self, manifest: dict, name: str, buckets: set[int] | None = None) -> DataFrame:
        """A table's rows. Of versions, a mark of the latest counts unless a later layer of the bucket has a latest one of
        the same document; ids alone are gathered to find these."""
        schema = TABLES[name]
        layers = [layers_of(f) for b, f in sorted(manifest[name].items()) if buckets is None or int(b) in buckets]
        if not layers:
            return self.spark.createDataFrame([], schema)

        def rows(k: int) -> DataFrame:
            folders = [f"{self.path}/{found[k]}" for found in layers if k < len(found)]
            return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*folders).select(*schema.names)

        every = [rows(k).withColumn("_layer", F.lit(k)) for k in range(max(map(len, layers)))]
        if len(every) == 1:
            return every[0].drop("_layer")
        renewed = reduce(DataFrame.unionByName, every[1:]).filter("is_latest").groupBy(F.col("document_id").alias("_renewed")).agg(F.max("_layer").alias("_since"))
        met = reduce(DataFrame.unionByName, every).join(renewed, F.col("document_id") == F.col("_renewed"), "left")
        return met.withColumn("is_latest", F.col("is_latest") & F.coalesce(F.col("_layer") >= F.col("_since"), F.lit(True))).select(*schema.names)

    def read(self, number: int | None = None) -> tuple[DataFrame, DataFrame]:
        """Documents and versions of a snapshot, by default of the current one."""
        now = self.manifest(number) or self._start()
        return self._table(now, "documents"), self._table(now, "versions")

    def index(self, kind: str, number: int | None = None) -> DataFrame:
        """The postings of ``title`` or ``content`` as of a snapshot, by default the current one."""
        return segments.read_segments(self.spark, self._segments(self.manifest(number) or self._start(), kind))

    def _segments(self, manifest: dict, kind: str) -> list[dict]:
        return [s | {"folder": f"{self.path}/{s['folder']}"} for s in manifest["index"][kind]]

    def outcomes(self, number: int | None = None, batch_id: int | None = None) -> DataFrame:
        """The batch of an upsert's snapshot with the outcome of each row: of the current snapshot, the one numbered so, or
        the one that applied a batch."""
        found = (self.manifest(k) for k in ([number] if number else reversed(self.numbers())))
        for m in found:
            if batch_id is None or m["batch_id"] == batch_id:
                return self.spark.read.parquet(f"{self.path}/{m['written']}/outcomes")
        raise KeyError(f"no snapshot of batch {batch_id}")

    def folders(self, number: int | None = None) -> DataFrame:
        """A row for each table and bucket of a snapshot: the folder last written for it and the snapshot that wrote it."""
        kept, out = self.numbers(), {}
        for k in kept:
            m = self.manifest(k)
            for table in TABLES:
                for b, f in m[table].items():
                    out.setdefault((table, int(b), layers_of(f)[-1]), k)
        now = self.manifest(number) or self._start()
        rows = [(t, int(b), layers_of(f)[-1], out[t, int(b), layers_of(f)[-1]]) for t in TABLES for b, f in now[t].items()]
        return self.spark.createDataFrame(rows, "table_name string, bucket int, folder string, since int")

    # --- commits

    def _write(self, df: DataFrame, folder: str, name: str, key: str, buckets: int, placed: bool = False) -> dict[str, str]:
        """Writes rows by bucket and names the folders that came to be. ``placed`` rows are dealt by ``places`` already."""
        at = f"{folder}/table={name}"
        rows = conform(df, TABLES[name]).withColumn("bucket", bucket_of(F.col(key), buckets))
        rows = rows if placed else rows.repartition(*places(key, buckets))
        rows.write.option("compression", "zstd").partitionBy("bucket", *(["is_latest"] if name == "versions" else [])).parquet(f"{self.path}/{at}")
        found = self._fs.globStatus(self._path(f"{self.path}/{at}/bucket=*")) or []
        return {f.getPath().getName().rsplit("=", 1)[1]: f"{at}/{f.getPath().getName()}" for f in found}

    def _publish(self, number: int, manifest: dict) -> bool:
        """Makes the pointer with its content; False where there is one. On local disks by a hard link to a finished file,
        elsewhere by a rename that doesn't replace, which HDFS does in one step. A store without either needs a lock."""
        body = json.dumps(manifest | {"snapshot": number})
        new, final = self._path(f"{self.path}/_{POINTER}.{uuid.uuid4().hex}"), self._path(f"{self.path}/{POINTER}.{number}")
        out = self._fs.create(new, False)
        out.write(bytearray(body.encode()))
        out.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                files, paths = self._jvm.java.nio.file.Files, self._jvm.java.nio.file.Paths
                files.createLink(paths.get(final.toUri()), paths.get(new.toUri()))
            else:
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
                none = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
                context.rename(new, final, none)
        except Py4JJavaError as failed:
            if "AlreadyExists" in failed.java_exception.getClass().getName():
                return False
            raise
        finally:
            self._fs.delete(new, False)
        return True

    def _segment(self, postings: DataFrame, replaced: DataFrame | None, written: str, kind: str) -> dict:
        folder = f"{written}/index-{kind}"
        return {"folder": folder, "rows": segments.write_segment(postings, replaced, f"{self.path}/{folder}"), "first": replaced is None, "numbered": True}

    def _commit(self, base: dict, changes: dict[str, dict[str, str | list[str] | None]], used: dict[str, set[str]], batch_id: int | None, written: str, index: Callable[[dict], dict]) -> bool:
        """Publishes ``base`` with the changed folders (None: a bucket without rows) and the index that ``index`` makes of the
        one before. ``used`` names the buckets that the changes follow from; they must be the same in every snapshot that
        came in between."""
        now = base
        while True:
            if batch_id is not None and now["batch_id"] is not None and batch_id <= now["batch_id"]:
                return False
            tables = {t: {b: f for b, f in (now[t] | changes[t]).items() if f} for t in TABLES}
            body = {"batch_id": batch_id if batch_id is not None else now["batch_id"], "buckets": now["buckets"], "analyzer": now["analyzer"], "written": written, "index": index(now["index"]), **tables}
            if self._publish(now["snapshot"] + 1, body):
                return True
            now = self.manifest()
            if now["buckets"] != base["buckets"] or any(now[t].get(b) != base[t].get(b) for t in TABLES for b in used[t]):
                raise Conflict(f"snapshot {now['snapshot']} of {self.path} was committed meanwhile")

    def write(self, docs: DataFrame, versions: DataFrame, batch_id: int | None = None) -> bool:
        """Commits whole tables: every bucket is replaced, so any other commit meanwhile is a conflict."""
        base = self._start()
        if batch_id is not None and base["batch_id"] is not None and batch_id <= base["batch_id"]:
            return False
        written, every = f"data/commit={uuid.uuid4().hex}", [str(b) for b in range(base["buckets"])]
        changes = {}
        for name, df, key in (("documents", docs, "source_url"), ("versions", versions, "document_id")):
            changes[name] = dict.fromkeys(every) | self._write(df, written, name, key, base["buckets"])
        changes["versions"] = {b: f and [f] for b, f in changes["versions"].items()}
        index = {k: [] for k in INDEXES}
        if base["analyzer"]:
            index = {"title": [self._segment(search.build_title_index(docs, base["analyzer"], numbered=True), None, written, "title")], "content": [self._segment(search.build_content_index(versions, base["analyzer"], numbered=True), None, written, "content")]}
        return self._commit(base, changes, {t: set(every) for t in TABLES}, batch_id, written, lambda _: index)

    def upsert(self, batch: DataFrame, as_of: Column, batch_id: int | None = None, land: bool = False) -> bool:
        """Commits the current tables after a batch and writes for the buckets that it touches alone: documents where the
        batch has a url, versions where a text changed, of which the new ones become a layer. Its rows with their outcomes are written first and tell which
        these are; ``outcomes`` reads them. At most a number for each bucket reaches the driver. ``land`` writes the batch
        before it is looked at, for one that is dear to make, or differs or counts when it is made again."""
        base = self._start()
        if batch_id is not None and base["batch_id"] is not None and batch_id <= base["batch_id"]:
            return False
        n, written = base["buckets"], f"data/commit={uuid.uuid4().hex}"
        landed = f"{self.path}/{written}/batch"
        if land:
            batch.write.option("compression", "zstd").parquet(landed)
            batch = self.spark.read.schema(batch.schema).parquet(landed)

        def buckets(df: DataFrame, key: str) -> set[int]:
            return {r[0] for r in df.select(bucket_of(F.col(key), n)).distinct().collect()}

        by_url = buckets(batch.filter("source_url IS NOT NULL"), "source_url")
        docs = self._table(base, "documents", by_url)
        ids = batch.select("source_url").distinct().join(docs.select("source_url", "id"), "source_url", "left").select(F.coalesce("id", document_id(F.col("source_url"))).alias("id"))
        by_id = buckets(ids.filter("id IS NOT NULL"), "id")
        at = f"{self.path}/{written}/outcomes"
        upserts.outcomes(docs, self._table(base, "versions", by_id), batch).write.option("compression", "zstd").parquet(at)
        found = self.spark.read.parquet(at)
        if land:
            self._fs.delete(self._path(landed), True)
        changed = buckets(found.filter("changed"), "document_id")
        before = {str(b): layers_of(base["versions"].get(str(b), [])) for b in changed}
        full = {int(b) for b, layers in before.items() if len(layers) >= LAYERS}
        next_docs, next_versions = upserts.apply_outcomes(docs, self._table(base, "versions", full) if full else None, found, as_of, places("document_id", n))
        changes = {"documents": self._write(next_docs, written, "documents", "source_url", n) if by_url else {}, "versions": self._write(next_versions, written, "versions", "document_id", n, placed=True) if changed else {}}
        changes["versions"] = {b: [f] if int(b) in full else before[b] + [f] for b, f in changes["versions"].items()}
        used = {"documents": {str(b) for b in by_url}, "versions": {str(b) for b in by_id}}
        added = self._batch_segments(found, base, written) if base["analyzer"] else {}
        return self._commit(base, changes, used, batch_id, written, lambda index: {k: s + added.get(k, []) for k, s in index.items()})

    def _batch_segments(self, found: DataFrame, base: dict, written: str) -> dict[str, list[dict]]:
        """Segments for a batch's rows with their outcomes: titles of all its documents, texts of those that changed, each
        from the row of its newest version."""
        last = found.filter("outcome <> 'failed' AND last_row").select(F.col("document_id").alias("id"), "title", "citation")
        changed = found.filter("newest").select("document_id", "content_text", F.lit(True).alias("is_latest"))
        made = {"title": (search.build_title_index(last, base["analyzer"], numbered=True), last.select(F.col("id").alias("doc"))), "content": (search.build_content_index(changed, base["analyzer"], numbered=True), changed.select(F.col("document_id").alias("doc")))}
        return {k: [self._segment(postings, replaced if base["index"][k] else None, written, k)] for k, (postings, replaced) in made.items()}

    def merge_index(self) -> bool:
        """Merges segments that are small beside the newer ones, as a commit of its own; False where none are due or another
        writer was faster."""
        base = self._start()
        at = {k: segments.due(s) for k, s in base["index"].items()}
        due = {k: n for k, n in at.items() if n < len(base["index"][k])}
        if not due:
            return False
        written, merged = f"data/commit={uuid.uuid4().hex}", {}
        for k, n in due.items():
            folder = f"{written}/index-{k}"
            rows = segments.merge_segments(self.spark, self._segments(base, k)[n:], f"{self.path}/{folder}")
            merged[k] = {"folder": folder, "rows": rows, "first": base["index"][k][n]["first"], "numbered": all(s.get("numbered") for s in base["index"][k][n:])}

        def index(now: dict) -> dict:
            if any(now[k][: len(base["index"][k])] != base["index"][k] for k in due):
                raise Conflict("the index was merged meanwhile")
            return {k: s[: due[k]] + [merged[k]] + s[len(base["index"][k]) :] if k in due else s for k, s in now.items()}

        try:
            return self._commit(base, {t: {} for t in TABLES}, {t: set() for t in TABLES}, None, written, index)
        except Conflict:
            return False

    def expire(self, keep: int = 2) -> int:
        """Deletes pointers but the last ``keep`` and the folders that none of those names; how many folders went. A folder
        that no pointer names yet may be a running writer's and stays."""
        numbers = self.numbers()
        named = lambda ks: {f for k in ks for m in [self.manifest(k)] for f in [*m["documents"].values(), *(f for layers in m["versions"].values() for f in layers_of(layers)), f"{m['written']}/outcomes", *(x["folder"] for s in m["index"].values() for x in s)]}
        old, stay = numbers[:-keep], named(numbers[-keep:])
        gone = named(old) - stay
        for k in old:
            self._fs.delete(self._path(f"{self.path}/{POINTER}.{k}"), False)
        return sum(bool(self._fs.delete(self._path(f"{self.path}/{f}"), True)) for f in sorted(gone))


def write_snapshot(docs: DataFrame, versions: DataFrame, path: str) -> bool:
    return Store(docs.sparkSession, path).write(docs, versions)


def load_tables(sources: dict[str, DataFrame], targets: dict[str, DataFrame], keys: dict[str, list[str]], required: dict[str, list[str]] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Table by table, in the order of ``sources``: rows whose key the target hasn't got, nested values as JSON text.

    Rows without a required value are skipped. The second result counts by table what was read, skipped and added.
    """
    out, report = {}, None
    for name, source in sources.items():
        flat = source.select(*[F.to_json(f.name).alias(f.name) if f.dataType.typeName() in {"struct", "array", "map"} else F.col(f.name) for f in source.schema.fields])
        good = flat.dropna(subset=(required or {}).get(name, keys[name]))
        new = good.dropDuplicates(keys[name]).join(targets[name].select(*keys[name]), keys[name], "left_anti")
        out[name] = targets[name].unionByName(new, allowMissingColumns=True).select(*targets[name].columns)
        counts = flat.agg(F.count(F.lit(1)).alias("rows_read")).join(good.agg(F.count(F.lit(1)).alias("rows_good"))).join(new.agg(F.count(F.lit(1)).alias("added")))
        row = counts.select(F.lit(name).alias("table_name"), "rows_read", (F.col("rows_read") - F.col("rows_good")).alias("skipped"), "added")
        report = row if report is None else report.unionByName(row)
    return out, report


def upgrade_flat_corpus(df: DataFrame, source_type: str = "canlii_legacy") -> tuple[DataFrame, DataFrame]:
    """Flat rows as documents with one version each; their hash is unknown, so the next upsert makes a new one."""
    one = df.dropDuplicates(["source_url"])
    docs = one.select(document_id(F.col("source_url")).alias("id"), F.lit("ab").alias("jurisdiction_code"), F.lit("Legislation").alias("category"), "title", "citation", "source_url", F.lit(source_type).alias("source_type"), F.lit("legislation").alias("document_type"), F.lit(True).alias("is_active"), F.col("scraped_at").alias("created_at"), F.col("last_updated").alias("updated_at"))
    versions = one.select(version_id(document_id(F.col("source_url")), F.lit(1)).alias("id"), document_id(F.col("source_url")).alias("document_id"), "content_html", "content_text", F.lit(None).cast("string").alias("content_hash"), "scraped_at", F.lit(1).alias("version_number"), F.lit(True).alias("is_latest"))
    return conform(docs, DOCUMENTS), conform(versions, VERSIONS)


def backfill_checked(docs: DataFrame, versions: DataFrame) -> DataFrame:
    """last_checked_at, where it is null, from the latest version's time or else updated_at."""
    at = latest_of(versions).groupBy(F.col("document_id").alias("id")).agg(F.max("scraped_at").alias("_at"))
    return docs.join(at, "id", "left").withColumn("last_checked_at", F.coalesce("last_checked_at", "_at", "updated_at")).select(*docs.columns)


def backfill_report(docs: DataFrame, sync_log: DataFrame) -> DataFrame:
    def item(df: DataFrame, name: str, column: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("total"), F.count(column).alias("filled"), F.count_if(F.col(column).isNull()).alias("missing")).select(F.lit(name).alias("item"), "total", "filled", "missing")

    return item(docs, "documents.last_checked_at", "last_checked_at").unionByName(item(sync_log, "source_sync_log.finished_at", "finished_at"))


def read_keys(spark: SparkSession, path: str, at: Column) -> DataFrame:
    """A legacy JSON array of urls as keys first seen at ``at``."""
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<string>")).alias("url"))
    return rows.distinct().select("url", at.alias("scraped_at"))
