import gzip
import hashlib
import io
import random
import zlib

import pytest

from folioflow.llm import warc
from folioflow.llm.common import shared_dir

COLUMNS = "page_id long, url string, html string"


def want(rows):
    """Rows of (page_id, bytes, digest, type, refers_to) by plain loops."""
    firsts, out = {}, []
    for i, u, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        data = (h or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        again = len(data) >= 100 and digest in firsts
        firsts.setdefault(digest, i)
        out.append((i, len(data), digest, "revisit" if again else "response", firsts[digest] if again else None))
    return sorted(out, key=str)


def got(df):
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()], key=str)


def test_pages_and_back(spark):
    rng = random.Random(5)
    texts = ["", None, "short", "é" * 50, "é" * 49, "x" * 99, "x" * 100, "".join(map(chr, rng.choices(range(32, 3000), k=400_000))), "WARC/1.1\r\n\r\n" * 40]
    rows = [(i, rng.choice([None, f"http://a/{i}", "http://b/ ä\r\nx"]), rng.choice(texts)) for i in range(150)] + [(7, "u", "again" * 40)] * 4 + [(7, "v", "again" * 40), (3, "w", "again" * 40)]
    rows += [(None, "n", "again" * 40), (None, "n", "none" * 40), (None, "n", "none" * 40), (-5, "m", "x" * 100)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], COLUMNS + ", payload string, n int").repartition(4)
    assert got(warc.archive_pages(df)) == want(rows)
    assert got(warc.archive_pages(df, split=3000)) == want(rows)
    assert warc.archive_pages(df.limit(0)).collect() == []


def record(payload, kind="response", name="urn:x", head=b""):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    return b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Record-ID: <%s>\r\n%sContent-Type: application/http\r\nContent-Length: %d\r\n\r\n" % (kind.encode(), name.encode(), head, len(block)) + block + b"\r\n\r\n"


def scanned(data, cuts):
    ends = [*cuts, len(data)]
    return [x for a, b in zip([0, *cuts], ends, strict=True) for x in warc.scan(io.BytesIO(data), len(data), a, b, keep=True)]


def test_every_cut_gives_each_record_once():
    payloads = [b"", b"\x1f\x8b\x08" * 30, bytes(random.Random(1).randbytes(900)), b"\r\n\r\n" * 9, b"plain " * 50]
    data = b"junk" + b"".join(gzip.compress(record(p, name=f"urn:{i}")) for i, p in enumerate(payloads)) + bytes(12) + gzip.compress(b"no record")
    for cut in range(1, len(data)):
        found = scanned(data, [cut])
        assert [(x["record_id"], x["payload"], x["complete"]) for x in found] == [(f"urn:{i}", p, True) for i, p in enumerate(payloads)]


def test_broken_members_and_members_of_many_records():
    one, two = gzip.compress(record(b"a" * 5000, name="urn:1")), gzip.compress(record(b"b", name="urn:2") + record(b"c", name="urn:3"))
    noise = bytes(random.Random(2).randbytes(4000))
    cut = zlib.compressobj(0, zlib.DEFLATED, 31)
    stored = cut.compress(record(noise, name="urn:0")) + cut.flush()
    found = scanned(stored[:2000] + one + two + one[:-9], [1500])
    assert [(x["record_id"], x["complete"]) for x in found] == [("urn:0", False), ("urn:1", True), ("urn:2", True), ("urn:3", True), ("urn:1", False)]
    assert [x["payload_bytes"] for x in found] == [None, 5000, 1, 1, None]


def test_an_archive_within_a_payload_is_not_read_as_records(spark):
    inner = b"".join(gzip.compress(record(b"in", name=f"urn:in{i}")) for i in range(40))
    pack = zlib.compressobj(0, zlib.DEFLATED, 31)
    data = pack.compress(record(inner, name="urn:out")) + pack.flush() + gzip.compress(record(b"last", name="urn:last"))
    store, root = warc.open_store(f"{shared_dir(spark)}/nested")
    store.create_dir(root)
    for name in ("a b.warc.gz", "empty.warc.gz"):
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            out.write(data if name[0] == "a" else b"")
    archives = spark.createDataFrame([(f"{shared_dir(spark)}/nested/a b.warc.gz", len(data)), (f"{shared_dir(spark)}/nested/empty.warc.gz", 0)], "path string, bytes long")
    for split in (100, 700, 1 << 20):
        rows = warc.read_archives(archives, split, payloads=True).collect()
        assert sorted((r.record_id, bytes(r.payload)) for r in rows) == [("urn:last", b"last"), ("urn:out", inner)]
    found = warc.find_archives(spark, f"{shared_dir(spark)}/nested/*.gz")
    assert [r.bytes for r in found.collect()] == [len(data)] and warc.read_archives(found).count() == 2


def test_archives_are_plain_gzip_and_roll_over(spark):
    df = spark.createDataFrame([(i, "u", str(i) * 3000) for i in range(20)], COLUMNS).coalesce(1)
    archives = warc.write_archives(warc.page_records(df), f"{shared_dir(spark)}/rolled", archive_bytes=500).collect()
    assert len(archives) > 1 and sum(a.records for a in archives) == 20
    store, _ = warc.open_store(archives[0].path)
    for a in archives:
        with store.open_input_file(warc.open_store(a.path)[1]) as f:
            raw = f.read()
        assert len(raw) == a.bytes and gzip.decompress(raw).count(b"WARC/1.1") == a.records


def test_revisits_of_missing_records_are_null(spark):
    rows = [("p", 0, 9, True, "revisit", "a", None, "gone", "sha256:x", 0, "e"), ("p", 9, 9, True, "response", "b", None, None, "sha256:y", 3, "y"), ("p", 18, 9, True, "revisit", "c", None, "b", "sha256:y", 0, "e"), ("p", 27, 9, True, "revisit", "d", None, "b", "sha256:z", 0, "e")]
    found = {r.record_id: (r.payload_bytes, r.payload_digest) for r in warc.resolve(spark.createDataFrame(rows, warc.RECORDS)).collect()}
    assert found == {"a": (None, None), "b": (3, "y"), "c": (3, "y"), "d": (None, None)}


@pytest.mark.parametrize("uri", ["/tmp/x y", "file:/tmp/x", "file:///tmp/x"])
def test_local_paths(uri):
    store, path = warc.open_store(uri)
    assert store.type_name == "local" and path in ("/tmp/x", "/tmp/x y")
