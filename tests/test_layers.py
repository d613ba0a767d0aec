"""Layers of versions: an upsert leaves former versions where they are, and reads the same as whole tables."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from folioflow.operators.upsert import upsert
from folioflow.schemas import DOCUMENTS, VERSIONS
from folioflow.sources import store

AT = dt.datetime(2024, 1, 31)


def batch(spark, n, text, step=1):
    return spark.createDataFrame([(f"u{i}", i, f"{text}{i}", "T", "c") for i in range(0, n, step)], "source_url string, seq long, content_text string, title string, category string")


def facts(versions):
    return sorted((r.document_id, r.version_number, r.is_latest, r.content_text) for r in versions.collect())


def rows_written(spark, own):
    return spark.read.parquet(*glob.glob(own.path.removeprefix("file:") + "/" + own.manifest()["written"] + "/table=versions/*/*")).count()


@pytest.mark.parametrize("most", [1, 2, 8])
def test_upserts_write_their_new_versions_alone(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(store, "LAYERS", most)
    own = store.Store(spark, str(tmp_path / "s"), buckets=4)
    docs, versions = spark.createDataFrame([], DOCUMENTS), spark.createDataFrame([], VERSIONS)
    steps = [batch(spark, 12, "a"), batch(spark, 12, "b", 2), batch(spark, 12, "b", 3), batch(spark, 14, "c", 6).unionByName(batch(spark, 14, "d", 6).withColumn("seq", F.col("seq") + 99))]
    written, kept = [], []
    for k, rows in enumerate(steps):
        own.upsert(rows, F.lit(AT), k)
        docs, versions, _ = upsert(docs, versions, rows, F.lit(AT))
        kept.append(facts(own.read()[1]))
        assert kept[-1] == facts(versions)
        written.append(rows_written(spark, own))
    assert facts(own.read(2)[1]) == kept[1]
    if most == 8:
        assert written == [12, 6, 2, 6]
    assert max(len(f) for f in own.manifest()["versions"].values()) <= most
    assert own.expire(keep=1) > 0 and facts(own.read()[1]) == kept[-1]


def test_a_whole_table_replaces_all_layers(spark, tmp_path):
    own = store.Store(spark, str(tmp_path / "s"), buckets=2)
    own.upsert(batch(spark, 4, "a"), F.lit(AT))
    own.upsert(batch(spark, 4, "b", 2), F.lit(AT))
    kept = [own.read()[k].localCheckpoint() for k in (0, 1)]
    own.write(*kept)
    assert {len(f) for f in own.manifest()["versions"].values()} == {1} and facts(own.read()[1]) == facts(kept[1])
