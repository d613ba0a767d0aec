"""Operator 11, WARC archives: a writer with revisit records and a splittable reader."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.llm.common import Scratch, open_store, qualified

#: Fixed values of the format.
VERSION, BREAK, MAGIC = b"WARC/1.1", b"\r\n", b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"
#: Bytes read at a time and inflated at a time; the longest header that is taken for one.
CHUNK, PIECE, MOST_HEADER = 1 << 18, 1 << 13, 1 << 20
#: Bytes of a range, and of an archive after which a task begins another.
SPLIT, ARCHIVE = 64 << 20, 1 << 30
#: Payloads shorter than this are always written whole.
LEAST_REPEATED = 100
RECORDS = "path string, position long, length long, complete boolean, record_type string, record_id string, target_uri string, refers_to string, declared_digest string, payload_bytes long, payload_digest string"


# --- writing


def _line(text: str) -> bytes:
    """A header value on one line: blanks and control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in text).encode("utf-8", "surrogatepass")


def member(row: dict, date: str) -> bytes:
    """A record as a gzip member of its own: an HTTP response with the payload, or a revisit without it."""
    payload = row["payload"] or b""
    http = BREAK.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % row["payload_bytes"], b"", b""])
    block = http if row["record_type"] == "revisit" else http + payload
    head = [VERSION, b"WARC-Type: " + row["record_type"].encode(), b"WARC-Record-ID: <" + _line(row["record_id"]) + b">", b"WARC-Date: " + date.encode(), b"WARC-Payload-Digest: sha256:" + row["payload_digest"].encode()]
    if row["target_uri"] is not None:
        head.append(b"WARC-Target-URI: " + _line(row["target_uri"]))
    if row["record_type"] == "revisit":
        head += [b"WARC-Profile: " + PROFILE.encode(), b"WARC-Refers-To: <" + _line(row["refers_to"]) + b">"]
    head += [b"Content-Type: " + HTTP.encode(), b"Content-Length: %d" % len(block), b"", b""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(BREAK.join(head)) + packer.compress(block) + packer.compress(BREAK + BREAK) + packer.flush()


def write_archives(records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE) -> DataFrame:
    """Writes records (record_id, record_type, target_uri, refers_to, payload, payload_bytes, payload_digest) below
    ``folder``, a shared one, and returns the archives (path, bytes, records).

    A task writes files of its own name, so that a repeated or speculative attempt disturbs no other. Only what a finished
    attempt lists counts; write the listing before it is read twice, since it is made anew with each run.
    """

    folder = qualified(records.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        store.create_dir(root)
        out, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"{TaskContext.get().partitionId():06d}-{len(done):04d}-{uuid.uuid4().hex}.warc.gz"
                    out, n, size = store.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                data = member(row, date)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", size, n))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size, n))
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate((pa.string(), pa.int64(), pa.int64()))], ["path", "bytes", "records"])

    columns = ("record_id", "record_type", "target_uri", "refers_to", "payload", "payload_bytes", "payload_digest")
    return records.select(*columns).mapInArrow(write, "path string, bytes long, records long")


def page_records(pages: DataFrame) -> DataFrame:
    """The records of pages (page_id, url, html), to be written.

    Of pages with equal payloads of LEAST_REPEATED bytes or more, that with the smallest page_id is the response and the
    others revisit it; all others are responses. A null html is an empty payload. Null page_ids come last, and of rows with
    the response's own page_id that of the smallest url (nulls first) is the response. Rows alike in all three columns are
    counted before they meet, so a repeated page may hold any share of the rows. Record ids name the page and the copy.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumns({"digest": F.sha2("payload", 256), "n": F.octet_length("payload").cast("long")})
    by_id = rows.filter(F.col("n") >= LEAST_REPEATED).groupBy("digest", "page_id").agg(F.count(F.lit(1)).alias("here"))
    first = F.min(F.struct(F.col("page_id").isNull().alias("last"), "page_id", "here"))
    groups = by_id.groupBy("digest").agg(first.alias("f"), F.sum("here").alias("rows")).filter("rows > 1").select("digest", F.col("f.page_id").alias("first_id"), F.col("f.here").alias("firsts"))
    met = rows.join(groups, "digest", "left")
    tied = F.coalesce((F.col("firsts") > 1) & F.col("page_id").eqNullSafe(F.col("first_id")), F.lit(False))
    alone = met.filter(~tied).withColumn("revisit", F.col("firsts").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))).withColumn("copy", F.lit(0).cast("long"))
    # Rows of the response's page_id with its payload: the first is the response, the others are copies of it.
    same = met.filter(tied).groupBy("digest", "page_id", "url", "first_id", "n").agg(F.first("payload").alias("payload"), F.count(F.lit(1)).alias("copies"))
    before = F.coalesce(F.sum("copies").over(Window.partitionBy("digest", "page_id").orderBy("url").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    copies = same.withColumn("before", before).withColumn("copy", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("copies") - 1))).withColumn("revisit", F.col("copy") > 0)
    columns = ("page_id", "url", "payload", "digest", "n", "first_id", "revisit", "copy")
    both = alone.select(*columns).unionByName(copies.select(*columns))
    return both.select(
        record_id(F.col("page_id"), F.col("copy")).alias("record_id"), F.when(F.col("revisit"), "revisit").otherwise("response").alias("record_type"), F.col("url").alias("target_uri"),
        F.when(F.col("revisit"), record_id(F.col("first_id"), F.lit(0))).alias("refers_to"), F.when(~F.col("revisit"), F.col("payload")).alias("payload"), F.col("n").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
    )


def record_id(page_id: Column, copy: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(F.url_encode(page_id.cast("string")), F.lit("")), F.lit(":"), copy.cast("string"))


def page_of(record: Column, kind: str) -> Column:
    """The page_id that a record id of ``record_id`` names; null for the id of a page without one."""
    return F.nullif(F.url_decode(F.split_part(record, F.lit(":"), F.lit(3))), F.lit("")).cast(kind)


# --- reading


class Held:
    """An open archive and the bytes of it that were read last."""

    def __init__(self, file, size: int):
        self.file, self.size, self.base, self.bytes = file, size, 0, b""

    def offset(self, at: int) -> int:
        """Where ``at`` stands in ``bytes``, with at least a magic's length behind it unless the archive ends there."""
        if not 0 <= at - self.base <= len(self.bytes) - len(MAGIC):
            self.file.seek(at)
            self.base, self.bytes = at, self.file.read(min(CHUNK, self.size - at))
        return at - self.base

    def magic(self, at: int, end: int) -> int | None:
        """The first place of the gzip magic from ``at`` on and before ``end``."""
        while at < min(end, self.size - len(MAGIC) + 1):
            off = self.offset(at)
            hit = self.bytes.find(MAGIC, off)
            if hit >= 0:
                return self.base + hit if self.base + hit < end else None
            at = max(at + 1, self.base + len(self.bytes) - len(MAGIC) + 1)
        return None


class Inflater:
    """The inflated bytes of the gzip member that begins at ``at``, a bounded piece at a time."""

    def __init__(self, source: Held, at: int):
        self.source, self.at = source, at
        self.unpacker, self.held, self.waiting = zlib.decompressobj(31), b"", b""

    @property
    def end(self) -> int:
        """Where the member ends, once ``unpacker.eof``."""
        return self.at - len(self.unpacker.unused_data)

    def more(self) -> bool:
        """Adds a piece to ``held``; False at the member's end. Raises zlib.error or EOFError where it is broken."""
        while not self.unpacker.eof:
            if not self.waiting:
                if self.at >= self.source.size:
                    raise EOFError
                off = self.source.offset(self.at)
                self.waiting = self.source.bytes[off : off + PIECE]
                self.at += len(self.waiting)
            piece = self.unpacker.decompress(self.waiting, CHUNK)
            self.waiting = self.unpacker.unconsumed_tail
            if piece:
                self.held += piece
                return True
        return False

    def take(self, n: int) -> bytes:
        out, self.held = self.held[:n], self.held[n:]
        return out

    def until(self, mark: bytes, most: int) -> bytes | None:
        """The bytes before ``mark``, which is skipped; None where it doesn't come within ``most`` bytes."""
        seen = 0
        while (at := self.held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.held)
            if seen > most or not self.more():
                return None
        out = self.take(at)
        self.take(len(mark))
        return out


def header(stream: Inflater) -> dict[str, str] | None:
    """A record's header, or None where the stream has none: it must open with the format's name and hold a type, an id
    and a length."""
    while len(stream.held) < 7 and stream.more():
        pass
    if not stream.held.startswith(b"WARC/1."):
        return None
    raw = stream.until(BREAK * 2, MOST_HEADER)
    if raw is None:
        return None
    pairs = (x.partition(":") for x in raw.decode("utf-8", "replace").split("\r\n")[1:])
    found = {k.strip().lower(): v.strip() for k, _, v in pairs}
    return found if found.get("warc-type") and found.get("warc-record-id") and (n := found.get("content-length", "")).isascii() and n.isdigit() else None


def _body(stream: Inflater, head: dict[str, str], keep: bool) -> dict:
    """The payload of a record whose header was read: the block without its HTTP header where it has one."""
    left, digest, size, kept = int(head["content-length"]), hashlib.sha256(), 0, []
    if head.get("content-type", "").lower().startswith("application/http"):
        before = len(stream.held)
        while before < min(left, MOST_HEADER) and BREAK * 2 not in stream.held[:left] and stream.more():
            before = len(stream.held)
        at = stream.held[:left].find(BREAK * 2)
        left -= len(stream.take(at + 4)) if at >= 0 else 0
    while left:
        if not stream.held and not stream.more():
            raise EOFError
        piece = stream.take(left)
        left, size = left - len(piece), size + len(piece)
        digest.update(piece)
        if keep:
            kept.append(piece)
    while len(stream.held) < 4 and stream.more():
        pass
    if stream.take(4) != BREAK * 2:
        raise EOFError
    return {"payload_bytes": size, "payload_digest": digest.hexdigest(), "payload": b"".join(kept)}


def _name(value: str | None) -> str | None:
    return value and value.strip("<>")


def _facts(position: int, head: dict[str, str]) -> dict:
    return {"position": position, "record_type": head["warc-type"], "record_id": _name(head["warc-record-id"]), "target_uri": head.get("warc-target-uri"), "refers_to": _name(head.get("warc-refers-to")), "declared_digest": head.get("warc-payload-digest")}


def scan(file, size: int, start: int, end: int, keep: bool = False) -> Iterator[dict]:
    """The records of members that begin in [start, end), read on past ``end`` where they are longer.

    Bytes are searched for the gzip magic, and a place counts as a member when a record's header can be decoded there. A
    member that breaks later on gives a row that isn't complete, without payload, and the search goes on behind its magic.
    """
    source = Held(file, size)
    at = source.magic(start, end)
    while at is not None:
        stream, found, head = Inflater(source, at), False, None
        try:
            while head := header(stream):
                row = _facts(at, head) | _body(stream, head, keep)
                while not stream.held and stream.more():
                    pass
                head, found = None, True
                yield row | {"length": stream.end - at if stream.unpacker.eof else None, "complete": True}
            behind = stream.end if found and stream.unpacker.eof else at + 1
        except (zlib.error, EOFError):
            if head:
                yield _facts(at, head) | {"length": None, "complete": False, "payload_bytes": None, "payload_digest": None, "payload": None}
            behind = at + 1
        at = source.magic(behind, end)


def find_archives(spark: SparkSession, path: str) -> DataFrame:
    """Archives (path, bytes) at a path or pattern, empty ones left out; no content is read."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"))


def read_archives(archives: DataFrame, split: int = SPLIT, payloads: bool = False) -> DataFrame:
    """The records of archives (path, bytes): path, position and length of their member, complete, record_type,
    record_id, target_uri, refers_to, declared_digest, payload_bytes, payload_digest (SHA-256 of the payload read) and, with
    ``payloads``, payload.

    Archives are cut into ranges of ``split`` bytes and a record belongs to the range in which its member begins. A range
    may begin within a member whose payload itself holds archive bytes; so first all ranges but an archive's last are
    walked for where their last member ends, and a range is read from the furthest of those before it. Members without a
    record's header, zero bytes and anything else between members are passed over. Each range is a task of its own. Without ``payloads`` memory is bounded
    whatever a record's length. Archives of no bytes have no records.
    """
    ranges = archives.filter("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split).cast("long"))).alias("start"))
    ranges = ranges.withColumn("end", F.least(F.col("start") + split, F.col("bytes")))
    tasks = archives.agg(F.sum(F.ceil(F.col("bytes") / split))).first()[0] or 1

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, object]]:
        for batch in batches:
            for r in batch.to_pylist():
                store, path = open_store(r["path"])
                with store.open_input_file(path) as file:
                    yield r, file

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, file in each(batches):
            last = max((x["position"] + x["length"] for x in scan(file, r["bytes"], r["start"], r["end"]) if x["length"]), default=0)
            yield pa.RecordBatch.from_arrays([pa.array([r["path"]]), pa.array([r["start"]], pa.int64()), pa.array([last], pa.int64())], ["path", "start", "last"])

    kinds = {"position": pa.int64(), "length": pa.int64(), "complete": pa.bool_(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    columns = [c.split()[0] for c in RECORDS.split(", ")][1:] + (["payload"] if payloads else [])

    def made(path: str, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), *(pa.array([x[c] for x in rows], kinds.get(c, pa.string())) for c in columns)], ["path", *columns])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, file in each(batches):
            rows, held = [], 0
            for x in scan(file, r["bytes"], max(r["start"], r["floor"]), r["end"], payloads):
                rows.append(x)
                held += 500 + len(x["payload"] or b"")
                if held > 4 * CHUNK:
                    yield made(r["path"], rows)
                    rows, held = [], 0
            if rows:
                yield made(r["path"], rows)

    walked = ranges.filter("end < bytes").repartition(tasks).mapInArrow(walk, "path string, start long, last long")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    floors = ranges.join(walked, ["path", "start"], "left").withColumn("floor", F.coalesce(F.max("last").over(before), F.lit(0)))
    dealt = floors.filter("floor < end").select("path", "bytes", "start", "end", "floor").repartition(tasks)
    return dealt.mapInArrow(read, RECORDS + (", payload binary" if payloads else ""))


def resolve(records: DataFrame) -> DataFrame:
    """Records with the payload facts of revisits taken from the record they refer to; null where that isn't there, isn't
    complete, or has another digest than the revisit declares. ``records`` is read twice, so write it first."""
    facts = records.filter("record_type = 'response' AND complete").select(F.col("record_id").alias("of"), F.col("payload_bytes").alias("b"), F.col("payload_digest").alias("d"))
    responses = records.filter("record_type <> 'revisit'")
    met = records.filter("record_type = 'revisit'").join(facts, (F.col("refers_to") == F.col("of")) & (F.col("declared_digest") == F.concat(F.lit("sha256:"), F.col("d"))), "left")
    return responses.unionByName(met.withColumns({"payload_bytes": F.col("b"), "payload_digest": F.col("d")}).select(*records.columns))


def archive_pages(pages: DataFrame, split: int = SPLIT) -> DataFrame:
    """Writes pages (page_id, url, html) as archives in the shared folder and reads them back: page_id, payload_bytes,
    payload_digest, record_type and refers_to (a page_id), all from the archives. No pages give no rows; see
    ``page_records`` for nulls, ties and repeated rows. Other columns are not read."""
    own = Scratch(pages.sparkSession, "warc")
    kind = pages.schema["page_id"].dataType.simpleString()
    archives = own.table(write_archives(page_records(pages), f"{own.root}/work/archives"))
    records = own.table(read_archives(archives.select("path", "bytes"), split))
    found = resolve(records)
    result = own.keep(found.select(page_of(F.col("record_id"), kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of(F.col("refers_to"), kind).alias("refers_to")))
    own.clear()
    return result


ORACLE = """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to FROM f"""
