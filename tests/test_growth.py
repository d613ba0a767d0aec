"""What grows with the tables: plans without needless shuffles, bounded tasks, and the same results."""

import re

import pytest
from pyspark.sql import functions as F

from folioflow.functions.stemmer import STOP_WORDS, stem
from folioflow.operators import ordering, search, upsert
from folioflow.schemas import DOCUMENTS, VERSIONS
from folioflow.sources import segments


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


TEXTS = ["The acts of the land", "act land ACT", "of the", "", "straße 12 the acts"]


def texts(spark):
    rows = [(f"d{i}", t, True) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "document_id string, content_text string, is_latest boolean")


@pytest.mark.parametrize("run", [1, 3, 1 << 20])
@pytest.mark.parametrize("analyzer", ["simple", "english"])
def test_index_without_a_shuffle(spark, tmp_path, monkeypatch, analyzer, run):
    """Postings by plain loops, whatever a run holds; no posting is shuffled on its way into a segment."""
    monkeypatch.setattr(search, "RUN", run)
    want = {}
    for i, text in enumerate(TEXTS):
        for at, w in enumerate(re.findall(r"\w+", text.lower()), 1):
            if analyzer == "simple" or w not in STOP_WORDS:
                want.setdefault((w if analyzer == "simple" else stem(w), f"d{i}"), []).append(at)
    index = search.build_content_index(texts(spark), analyzer)
    assert "Exchange" not in plan_of(index)
    assert segments.write_segment(index, None, str(tmp_path / "s")) == len(want)
    got = segments.read_segments(spark, [{"folder": str(tmp_path / "s"), "rows": len(want), "first": True}])
    assert {(r.term, r.doc): r.positions for r in got.collect()} == want


def test_matching_shuffles_no_postings(spark, tmp_path):
    """Of an index that isn't small, only counts by term and candidates' postings are shuffled."""
    rows = [(f"w{i % 7}", f"d{i // 7}", "D", [i % 7 + 1]) for i in range(7 * 400)] + [("rare", "d5", "D", [9])]
    segments.write_segment(spark.createDataFrame(rows, segments.POSTINGS), None, str(tmp_path / "s"))
    index = segments.read_segments(spark, [{"folder": str(tmp_path / "s"), "rows": len(rows), "first": True}])
    queries = spark.createDataFrame([(1, "rare w1 w2"), (2, "w0 absent"), (3, "w6")], "query_id int, text string")
    search.query_terms(queries).write.parquet(str(tmp_path / "terms"))
    terms = spark.read.parquet(str(tmp_path / "terms"))
    found = search.match_many(index, terms)
    assert {(r.query_id, r.doc) for r in found.collect()} == {(1, "d5")} | {(3, f"d{i}") for i in range(400)}
    assert "SortMergeJoin" not in plan_of(found)


def test_first_rows_without_one_task(spark):
    """Nulls first, rows alike counted, as a plain sort does; no exchange takes all rows to one partition."""
    rows = [(None if i % 9 == 0 else i % 5, f"u{i % 40}", {"k": "v"}) for i in range(200)] + [(1, "u1", None)] * 30
    df = spark.createDataFrame(rows, "seq int, source_url string, metadata map<string,string>").repartition(7)
    order = sorted((r[:2] for r in rows), key=lambda r: (-1 if r[0] is None else r[0], r[1]))
    for n in (0, 1, 23, 60, 75, 229, 230, 500):
        got = ordering.first_rows(df, ["seq", "source_url"], n)
        assert sorted(((-1 if r[0] is None else r[0], r[1]) for r in got.collect())) == [(-1 if a is None else a, b) for a, b in order[:n]]
    some = df.filter("source_url <> 'u1'")
    assert "TakeOrdered" not in plan_of(ordering.first_rows(some, ["seq", "source_url"], 60)) and "SinglePartition" not in plan_of(ordering.first_rows(some, ["seq", "source_url"], 60)).split("Union")[0]


def test_upsert_shuffles_texts_once(spark, tmp_path):
    """One exchange alone carries texts on their way to outcomes, and one to the versions that a store writes."""
    c = "source_url string, title string, category string, jurisdiction_code string, content_text string, content_html string, seq int"
    spark.createDataFrame([("u1", "t", "c", "ca", "one", "", 1), ("u1", "t", "c", "ca", "two", "", 2), ("u2", "t", "c", "ca", "x", "", 1)], c).write.parquet(str(tmp_path / "b"))
    batch = spark.read.parquet(str(tmp_path / "b"))
    docs, versions, _ = upsert.upsert(spark.createDataFrame([], DOCUMENTS), spark.createDataFrame([], VERSIONS), batch, F.current_timestamp())
    for name, df in (("docs", docs), ("versions", versions)):
        df.write.parquet(str(tmp_path / name))
    docs, versions = (spark.read.schema(s).parquet(str(tmp_path / n)) for n, s in (("docs", DOCUMENTS), ("versions", VERSIONS)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = upsert.outcomes(docs, versions, batch.withColumn("content_text", F.concat("content_text", F.lit("!"))))
        assert sum("content_text" in x.toString() for x in exchanges(found)) == 1
        assert {(r.source_url, r.seq, r.version_number, r.newest) for r in found.collect()} == {("u1", 1, 3, False), ("u1", 2, 4, True), ("u2", 1, 2, True)}
        found.write.parquet(str(tmp_path / "found"))
        found = spark.read.parquet(str(tmp_path / "found"))
        by = [F.pmod(F.xxhash64("document_id"), F.lit(3))]
        dealt = upsert.apply_outcomes(docs, versions, found, F.current_timestamp(), by)[1]
        assert sum("content_text" in x.toString() for x in exchanges(dealt)) == 1
        plain = upsert.apply_outcomes(docs, versions, found, F.current_timestamp())[1]
        facts = lambda df: sorted((r.id, r.version_number, r.is_latest, r.content_text) for r in df.collect())
        assert facts(dealt) == facts(plain) and sum(r[2] for r in facts(dealt)) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df) -> list:
    """The outputs of a plan's shuffles, before it runs."""
    out = []

    def walk(node):
        if node.nodeName() == "Exchange":
            out.append(node.output())
        below = node.children()
        for i in range(below.size()):
            walk(below.apply(i))
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.initialPlan())

    walk(df._jdf.queryExecution().executedPlan())
    return out
