import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from folioflow.operators.upsert import upsert
from folioflow.schemas import DOCUMENTS, VERSIONS
from folioflow.sources import profiles, readers, store
from folioflow.streaming import ingest

AT = dt.datetime(2024, 1, 31)


def test_json_readers(spark, tmp_path):
    (tmp_path / "acts.json").write_text(json.dumps([{"act": {"productId": "1", "name": "A", "customIdentifier": "c"}, "regulations": [{"productId": "2", "name": "R"}]}, {"act": {"productId": "3", "name": "B"}, "regulations": None}]))
    got = readers.read_act_tree(spark, str(tmp_path / "acts.json")).orderBy("pos").collect()
    assert [(r.product_id, r.name, r.custom_id, r.regulation) for r in got] == [("1", "A", "c", False), ("2", "R", None, True), ("3", "B", None, False)]
    hit = {"_source": {"alias": {"en": "statute/1"}, "title": {"en": "T"}, "state": {"en": "c"}}}
    (tmp_path / "hits.json").write_text(json.dumps({"aggregations": {"act": {"buckets": [{"statute": {"statute_hits": {"hits": {"hits": [hit, hit]}}}}, {}]}}}))
    got = readers.read_bucket_hits(spark, str(tmp_path / "hits.json"), "statute").collect()
    assert [(r.alias, r.title, r.state, r.date_from) for r in got] == [("statute/1", "T", "c", None)] * 2
    (tmp_path / "packages.json").write_text(json.dumps({"result": {"count": 9, "results": [{"name": "n", "title": "t", "identifier-ISBN-print": "978"}]}}))
    assert [(r.name, r.isbn, r.total) for r in readers.read_packages(spark, str(tmp_path / "packages.json")).collect()] == [("n", "978", 9)]


def test_xml_and_binary_readers(spark, tmp_path):
    d = tmp_path / "eng" / "acts"
    d.mkdir(parents=True)
    (d / "A-1.xml").write_text('<Statute xmlns="urn:x"><ShortTitle> Short </ShortTitle><Body><LongTitle>Long <i>t</i></LongTitle></Body></Statute>')
    (d / "B-2.xml").write_text("<Statute><Body/></Statute>")
    got = {r.path: r.title for r in readers.read_xml_docs(spark, str(d), str(tmp_path)).collect()}
    assert got == {"eng/acts/A-1.xml": "Long t", "eng/acts/B-2.xml": "B-2"}
    (tmp_path / "dir.xml").write_text("<root><dir><CIVIX_DOCUMENT_ID>1</CIVIX_DOCUMENT_ID><CIVIX_DOCUMENT_TITLE>-- A --</CIVIX_DOCUMENT_TITLE></dir><dir><CIVIX_DOCUMENT_ID>2</CIVIX_DOCUMENT_ID><CIVIX_DOCUMENT_TITLE>Act</CIVIX_DOCUMENT_TITLE></dir></root>")
    assert [(r.doc_id, r.title, r.is_group) for r in readers.read_xml_directory(spark, str(tmp_path / "dir.xml")).collect()] == [("1", "-- A --", True), ("2", "Act", False)]
    b = tmp_path / "bin"
    b.mkdir()
    for name, body in (("a", b"%PDF" + b"x" * 300), ("b", b"%PDF"), ("c", b"<htm" + b"x" * 300)):
        (b / name).write_bytes(body)
    assert {r.path[-1]: r.reason for r in readers.gate_binaries(spark, str(b)).collect()} == {"a": None, "b": "too_small", "c": "wrong_type"}


def small(spark, n=3, text="x"):
    return spark.createDataFrame([(f"u{i}", i, f"{text}{i}", "T", "c") for i in range(n)], "source_url string, seq long, content_text string, title string, category string")


def test_store_and_stream(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "store"))
    assert s.read()[0].count() == 0 and s.current() is None
    now = F.lit(AT)
    landed = tmp_path / "landed"
    small(spark).coalesce(1).write.parquet(str(landed))
    reports = []
    run = lambda: ingest.stream_upsert(ingest.stream_records(spark, str(landed), small(spark).schema, 1), s, now, str(tmp_path / "ck"), lambda n, r: reports.append((n, r.agg(F.sum("docs_new")).first()[0]))).awaitTermination()
    run()
    assert s.read()[1].count() == 3
    small(spark, 4, "y").coalesce(1).write.mode("append").parquet(str(landed))
    run()
    docs, versions = s.read()
    assert docs.count() == 4 and sorted((r.content_text, r.is_latest) for r in versions.collect()) == [("x0", False), ("x1", False), ("x2", False), ("y0", True), ("y1", True), ("y2", True), ("y3", True)]
    assert [n for n, _ in reports] == [0, 1] and s.current() == {"snapshot": 2, "batch_id": 1}
    assert s.write(docs.limit(0), versions.limit(0), 1) is False and s.read()[0].count() == 4
    whole = upsert(spark.createDataFrame([], DOCUMENTS), spark.createDataFrame([], VERSIONS), small(spark).unionByName(small(spark, 4, "y").withColumn("seq", F.col("seq") + 10)), now)[1]
    assert sorted((r.id, r.is_latest) for r in whole.collect()) == sorted((r.id, r.is_latest) for r in versions.collect())


def test_unseen(spark, tmp_path):
    landed, got = tmp_path / "landed", []
    for k in range(2):
        small(spark, 3 + k).coalesce(1).write.mode("append").parquet(str(landed))
        q = ingest.stream_unseen(ingest.stream_records(spark, str(landed), small(spark).schema), str(tmp_path / "keys"), F.lit(AT), str(tmp_path / "ck"), lambda df, n: got.append(sorted(r.source_url for r in df.collect())))
        q.awaitTermination()
    assert got == [["u0", "u1", "u2"], ["u3"]]


def test_loads_and_backfills(spark, tmp_path):
    src = spark.createDataFrame([("a", {"k": "v"}), ("a", None), ("b", None), (None, None)], "url string, meta map<string,string>")
    target = spark.createDataFrame([("b", "old", 1)], "url string, meta string, extra int")
    out, report = store.load_tables({"t": src}, {"t": target}, {"t": ["url"]})
    assert {r.url for r in out["t"].collect()} == {"a", "b"} and tuple(report.first()) == ("t", 4, 1, 1)
    flat = spark.createDataFrame([("u", "T", "C", "<p>", "x", AT, AT)], "source_url string, title string, citation string, content_html string, content_text string, scraped_at timestamp, last_updated timestamp")
    docs, versions = store.upgrade_flat_corpus(flat)
    assert versions.first().content_hash is None and docs.first().last_checked_at is None
    filled = store.backfill_checked(docs, versions)
    assert filled.first().last_checked_at == AT
    sync = spark.createDataFrame([(None,)], "finished_at timestamp")
    assert {tuple(r) for r in store.backfill_report(filled, sync).collect()} == {("documents.last_checked_at", 1, 1, 0), ("source_sync_log.finished_at", 1, 0, 1)}
    (tmp_path / "k.json").write_text('["a", "b", "a"]')
    assert store.read_keys(spark, str(tmp_path / "k.json"), F.lit(AT)).count() == 2


def test_profiles(spark):
    profiles.register_profile("x", {"gate": 1}, lambda df: df.limit(1))
    assert profiles.profile("x") == {"gate": 1} and "x" in profiles.names() and profiles.normalize("x", spark.range(5)).count() == 1


def test_a_writer_that_dies_leaves_the_former_snapshot(spark, tmp_path, monkeypatch):
    docs, versions = spark.createDataFrame([], DOCUMENTS), spark.createDataFrame([], VERSIONS)
    own = store.Store(spark, str(tmp_path / "s"))
    assert own.write(docs, versions, 0) and own.current()["snapshot"] == 1
    half = store.Store(spark, own.path)

    def dies(*_):
        raise RuntimeError("dies before the pointer is made")

    monkeypatch.setattr(half, "_publish", dies)
    with pytest.raises(RuntimeError):
        half.write(docs, versions, 1)
    assert own.current() == {"snapshot": 1, "batch_id": 0}
    assert own.write(docs, versions, 1) and own.current() == {"snapshot": 2, "batch_id": 1}
    assert not own.write(docs, versions, 1) and own.read()[0].count() == 0


def state(own, number=None):
    docs, versions = own.read(number)
    return sorted((r.id, r.title) for r in docs.collect()), sorted((r.document_id, r.version_number, r.is_latest, r.content_text) for r in versions.collect())


def test_of_two_writers_the_second_raises_and_the_first_ones_rows_stay(spark, tmp_path, monkeypatch):
    now = F.lit(AT)
    own = store.Store(spark, str(tmp_path / "s"), buckets=8)
    own.upsert(small(spark, 6), now)
    slow, first, seen = store.Store(spark, own.path), store.Store(spark, own.path), own.manifest()
    monkeypatch.setattr(slow, "_start", lambda: seen)  # it has looked before the other commits
    first.upsert(small(spark, 6, "first"), now)
    after = state(own)
    for late in (lambda: slow.upsert(small(spark, 2, "late"), now), lambda: slow.write(*own.read(1))):
        with pytest.raises(store.Conflict):
            late()
    assert own.current()["snapshot"] == 2 and state(own) == after
    assert all(t.startswith("first") for _, _, latest, t in after[1] if latest) and len(after[1]) == 12


def test_writers_of_other_buckets_both_commit(spark, tmp_path, monkeypatch):
    now = F.lit(AT)
    own = store.Store(spark, str(tmp_path / "s"), buckets=64)
    own.upsert(small(spark, 4), now)
    other = store.Store(spark, own.path)
    seen = own.manifest()
    monkeypatch.setattr(other, "_start", lambda: seen)
    own.upsert(small(spark, 1, "mine"), now)
    other.upsert(small(spark, 2, "theirs").filter("seq = 1"), now)
    assert own.current()["snapshot"] == 3
    assert {t for _, _, latest, t in state(own)[1] if latest} == {"mine0", "theirs1", "x2", "x3"}
    assert len(state(own, 1)[1]) == 4


def test_a_batch_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    import os

    now = F.lit(AT)
    own = store.Store(spark, str(tmp_path / "s"), buckets=32)
    own.upsert(small(spark, 60), now, 1)
    before = {(r.table_name, r.bucket): r.folder for r in own.folders().collect()}
    batch = small(spark, 2, "new").unionByName(small(spark, 5).filter("seq = 4"))
    assert own.upsert(batch, now, 2) and not own.upsert(batch, now, 2)
    after = {(r.table_name, r.bucket): (r.folder, r.since) for r in own.folders().collect()}
    moved = {k for k, (f, since) in after.items() if before.get(k) != f}
    assert {t for t, _ in moved} == {"documents", "versions"} and len([k for k in moved if k[0] == "versions"]) <= 2 and len([k for k in moved if k[0] == "documents"]) <= 3
    assert all((since == 2) == (k in moved) for k, (_, since) in after.items())
    written = [os.path.join(d, f) for d, _, fs in os.walk(own.path.removeprefix("file:") + "/" + own.manifest()["written"]) for f in fs if f.endswith(".parquet")]
    everything = [os.path.join(d, f) for d, _, fs in os.walk(own.path.removeprefix("file:")) for f in fs if f.endswith(".parquet")]
    assert 0 < len(written) < len(everything) / 3
    whole = upsert(*upsert(spark.createDataFrame([], DOCUMENTS), spark.createDataFrame([], VERSIONS), small(spark, 60), now)[:2], batch, now)
    assert state(own)[1] == sorted((r.document_id, r.version_number, r.is_latest, r.content_text) for r in whole[1].collect())
    assert sorted(tuple(r) for r in own.outcomes().groupBy("outcome").count().collect()) == [("unchanged", 1), ("updated", 2)]


def test_old_snapshots_go_and_shared_folders_stay(spark, tmp_path):
    now = F.lit(AT)
    own = store.Store(spark, str(tmp_path / "s"), buckets=16)
    for k in range(4):
        own.upsert(small(spark, 30 if not k else 1, f"t{k}"), now, k)
    want = state(own)
    assert own.expire(keep=2) > 0 and own.numbers() == [3, 4] and state(own) == want and own.expire(keep=2) == 0


def test_rows_that_cannot_be_written(spark, tmp_path):
    own = store.Store(spark, str(tmp_path / "s"), buckets=4)
    rows = [("u0", 0, "x", "T", "c"), (None, 1, "x", "T", "c"), ("u2", 2, None, "T", "c"), ("", 3, "x", "T", "c")]
    batch = spark.createDataFrame(rows, "source_url string, seq long, content_text string, title string, category string")
    assert own.upsert(batch.limit(0), F.lit(AT)) and own.read()[0].count() == 0
    own.upsert(batch, F.lit(AT))
    assert own.read()[0].count() == 1 and own.outcomes().filter("outcome = 'failed'").count() == 3
