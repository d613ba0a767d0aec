import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from folioflow.operators import incremental
from folioflow.operators import ordering
from folioflow.operators.incremental import allocate_budget, select_within_budget
from folioflow.operators.repair import normalize_urls, url_changes
from folioflow.sources.readers import read_act_tree
from folioflow.operators.upsert import ensure_jurisdictions, upsert
from folioflow.schemas import DOCUMENTS, VERSIONS


def start(spark):
    return spark.createDataFrame([], DOCUMENTS), spark.createDataFrame([], VERSIONS)


def at(day):
    return F.to_timestamp(F.lit(f"2024-01-{day:02d} 00:00:00"))


def batch(spark, *rows):
    """(url, seq, text) or with further values."""
    full = [(u, s, t, *(r or ("T", "Legislation", "ca", "<p>"))) for u, s, t, *r in ((*x[:3], *( [x[3]] if len(x) > 3 else [])) for x in rows) for r in [r[0] if r else None]]
    return spark.createDataFrame(full, "source_url string, seq long, content_text string, title string, category string, jurisdiction_code string, content_html string")


def apply(spark, state, day, *rows):
    docs, versions, out = upsert(*state, batch(spark, *rows), at(day))
    return (docs.cache(), versions.cache()), {(r.source_url, r.seq): r.outcome for r in out.collect()}


def shape(state):
    return sorted((r.version_number, r.content_text, r.is_latest) for r in state[1].collect())


def test_sequences(spark):
    state, out = apply(spark, start(spark), 1, ("u", 1, "A"))
    assert out == {("u", 1): "new"} and shape(state) == [(1, "A", True)]
    state, out = apply(spark, state, 2, ("u", 1, "A", ("T2", "Other", "zz", "<div>")))
    doc = state[0].first()
    assert out == {("u", 1): "unchanged"} and shape(state) == [(1, "A", True)]
    assert (doc.title, doc.category, doc.created_at, doc.updated_at, doc.last_checked_at) == ("T2", "Other", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2))
    state, out = apply(spark, state, 3, ("u", 1, "B"), ("u", 2, "A"), ("u", 3, "A"), ("v", 1, ""))
    assert out == {("u", 1): "updated", ("u", 2): "updated", ("u", 3): "unchanged", ("v", 1): "new"}
    assert shape(state) == [(1, "", True), (1, "A", False), (2, "B", False), (3, "A", True)]
    assert state[1].filter("content_text = ''").first().content_hash == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_failures_leave_tables_alone(spark):
    state, _ = apply(spark, start(spark), 1, ("u", 1, "A"))
    bad = [(None, 1, "x"), ("", 2, "x"), ("u", 3, None), ("u", 4, "Z", (None, "c", "ca", "")), ("u", 5, "Z", ("t", None, "ca", "")), ("w", 6, "Z", ("t", "c", "", "")), ("ok", 7, "fine", ("t", "c", None, None))]
    after, out = apply(spark, state, 2, *bad)
    assert [out[(u, s)] for u, s, *_ in bad] == ["failed"] * 6 + ["new"]
    assert {r.source_url for r in after[0].collect()} == {"u", "ok"} and after[0].filter("source_url = 'u'").first().updated_at == dt.datetime(2024, 1, 1)


def test_unknown_hash_makes_a_version(spark):
    docs, versions = apply(spark, start(spark), 1, ("u", 1, "A"))[0]
    state, out = apply(spark, (docs, versions.withColumn("content_hash", F.lit(None).cast("string"))), 2, ("u", 1, "A"))
    assert out == {("u", 1): "updated"} and [n for n, *_ in shape(state)] == [1, 2]


def test_batch_split_equals_whole_and_twice_is_unchanged(spark):
    rows = [(f"u{i % 7}", i, f"text {i * i % 5}") for i in range(40)]
    whole, _ = apply(spark, start(spark), 1, *rows)
    split = start(spark)
    for k in range(0, 40, 13):
        split, _ = apply(spark, split, 1, *rows[k : k + 13])
    assert shape(whole) == shape(split)
    last = {u: (u, s, t) for u, s, t in rows}
    again, out = apply(spark, whole, 2, *last.values())
    assert set(out.values()) == {"unchanged"} and shape(again) == shape(whole)
    tops = again[1].groupBy("document_id").agg(F.count_if("is_latest").alias("n"), F.max("version_number").alias("m"), F.count(F.lit(1)).alias("k")).collect()
    assert all(r.n == 1 and r.m == r.k for r in tops)


def test_defaults_of_absent_columns(spark):
    b = spark.createDataFrame([("u", "T", "x")], "source_url string, title string, content_text string")
    docs, _, _ = upsert(*start(spark), b, at(1))
    r = docs.first()
    assert (r.jurisdiction_code, r.category, r.source_type, r.document_type, r.is_active, r.metadata) == ("ab", "Legislation", "canlii_legacy", "legislation", True, {})


def test_dimension(spark):
    dim = spark.createDataFrame([("ca", "Canada")], "code string, name string")
    codes = spark.createDataFrame([("zz",), ("",), (None,), ("ca",), ("zz",)], "code string")
    assert {tuple(r) for r in ensure_jurisdictions(dim, codes).collect()} == {("ca", "Canada"), ("zz", "ZZ")}


def test_budgets(spark):
    src = spark.createDataFrame([("a", 0, 184565), ("b", 1, 882), ("c", 2, 1415)], "source_type string, pos long, estimate long")
    take = lambda df: [r.budget for r in df.orderBy("pos").collect()]
    assert take(allocate_budget(src, 100, "equal")) == [34, 33, 33] and take(allocate_budget(src, 10, "proportional")) == [4, 2, 4] and take(allocate_budget(src, 10, "sequential")) == [None] * 3
    listing = spark.createDataFrame([(s, i, f"{s}{i}") for s in "abc" for i in range(5)], "source_type string, pos long, source_url string")
    got = select_within_budget(listing, allocate_budget(src, 10, "proportional"), 7).collect()
    assert sorted(r.source_url for r in got) == ["a0", "a1", "a2", "a3", "b0", "b1", "c0"]


def test_url_collisions(spark):
    docs = spark.createDataFrame([("1", "http://h/a b"), ("2", "http://h/a%20b"), ("3", "http://h/c d"), ("4", "http://h/c%20d x"), ("5", "http://h/e,f"), ("6", "http://h/e, f"), ("7", "http://h/c d%20x")], "id string, source_url string")
    changes = {r.id: (r.new_url, r.applied) for r in url_changes(docs).collect()}
    assert changes["1"] == ("http://h/a%20b", False) and changes["3"] == ("http://h/c%20d", True) and changes["4"][1] and not changes["7"][1] and "2" not in changes
    assert normalize_urls(normalize_urls(docs)).filter("source_url LIKE '% %'").count() == 2


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_carry_forward_is_the_same_in_ranges(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.choice(["a", "a", "a", "b", None]), pos, rng.choice([None, None, None, f"v{pos}"])) for pos in rng.sample(range(-60, 200), 150)] + [("a", None, "first"), ("c", 5, None)]
    names = "list string, pos int, part string, group int, key int, row int, place int, here int, carried int, _range int"
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6, 7) for r in rows], names)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        plain = ordering.carry_forward(df, "part", ["list"], "pos", "carried").collect()
        nested = df.select("*", F.struct(F.lit("f").alias("file"), F.struct("pos").alias("no")).alias("at"))
        deep = ordering.carry_forward(nested, "part", ["list"], "at", "carried").collect()
        numbered = ordering.number_rows(df, ["list"], ["pos"], "n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    last, count = {}, {}
    got, same, n = ({(r.list, r.pos): r for r in x} for x in (plain, deep, numbered))
    for name, pos, value in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        last[name], count[name] = value or last.get(name), count.get(name, 0) + 1
        r = got[name, pos]
        assert r.carried == same[name, pos].carried == last[name] and n[name, pos].n == count[name]
        assert (r.part, r.group, r.key, r.row, r.place, r.here, r._range) == (value, 1, 2, 3, 4, 5, 7)
    assert len(plain) == len(deep) == len(numbered) == len(rows)


def test_no_listing_goes_to_one_task(spark, tmp_path):
    (tmp_path / "acts.json").write_text('[{"act": {"productId": "1", "name": "A"}, "regulations": [{"productId": "2", "name": "R"}]}, {"act": {"productId": "3", "name": "B"}}]')
    rows = read_act_tree(spark, str(tmp_path)).withColumn("act", F.when(~F.col("regulation"), F.col("name"))).withColumn("all", F.lit(1))
    out = ordering.carry_forward(rows, "act", ["all"], "pos", "parent")
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.name, r.parent) for r in out.collect()) == [("A", "A"), ("B", "B"), ("R", "A")]
    windows = [x for x in select_within_budget(rows.select(F.lit("s").alias("source_type"), F.col("pos"), F.col("name").alias("source_url")), spark.createDataFrame([("s", 1, None)], "source_type string, pos int, budget long"))._jdf.queryExecution().executedPlan().toString().split("\n") if "Window" in x]
    assert all("row_number" not in w for w in windows)


def test_first_wins_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([("a", 2, 5, "x"), ("a", 1, 6, "y"), (None, 3, 7, "z"), (None, None, 8, "w")], "k string, pos int, _first int, key0 string")
    assert sorted(tuple(r) for r in incremental.first_wins(df, ["k"], ["pos"]).fillna("-", "k").fillna(-1, "pos").collect()) == [("-", -1, 8, "w"), ("a", 1, 6, "y")]
