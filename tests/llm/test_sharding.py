import zlib
from collections import Counter, defaultdict

import pytest

from folioflow.llm.sharding import assign_shards, numbered_shards


def reference_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 16, 1000])
def test_assign_matches_the_published_loop(spark, shards):
    ids = [0, 1, 2, 77, -1, -5, 2**63 - 1, -(2**63), *range(1000, 1200)]
    got = {r.k: r.shard for r in assign_shards(spark.createDataFrame([(i,) for i in ids], "k long"), "k", shards).collect()}
    assert got == {i: reference_jump(i % 2**64, shards) for i in ids}


def test_other_keys_and_clashing_column(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, shard int")
    rows = assign_shards(df, "k", 8).collect()
    assert len({r.shard for r in rows if r.k == "a"}) == 1 and all(0 <= r.shard < 8 for r in rows)
    assert [r.shard for r in rows if r.k is None] == [reference_jump(0, 8)]


def test_numbered(spark):
    texts = [(i, f"text é {i % 7}" * (i % 5)) for i in range(300)] + [(7, "same")] * 50 + [(None, "x"), (900, None), (901, "")]
    docs = spark.createDataFrame([(i, t, "extra", 1) for i, t in texts], "doc_id long, text string, shard string, copies int")
    rows = numbered_shards(docs, 16, rows_per_bucket=5).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    slots = defaultdict(list)
    for r in rows:
        assert r.law == "key" and r.shard == reference_jump((r.doc_id or 0) % 2**64, 16)
        assert r.grown_shard == reference_jump((r.doc_id or 0) % 2**64, 17)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty(spark):
    assert numbered_shards(spark.createDataFrame([], "doc_id long, text string")).collect() == []
