"""Postings of a few terms without Python, and ranks without a row for each hit."""

import random

from folioflow.operators import search


def test_postings_of_a_few_terms(spark):
    rng = random.Random(3)
    rows = [(f"d{i}", " ".join(rng.choice(["the", "and", "That", "x", "y."]) for _ in range(rng.randrange(0, 60))), rng.choice(["The 1", "S 2", None, ""])) for i in range(60)] + [("n", None, None)]
    docs = spark.createDataFrame(rows, "id string, title string, citation string")
    terms = ["the", "that", "2", "absent", "the"]
    flat = lambda df: sorted((r.term, r.doc, r.weight, list(r.positions)) for r in df.collect())
    whole, some = search.build_title_index(docs), search.build_title_index(docs, terms=terms)
    assert "InArrow" not in some._jdf.queryExecution().executedPlan().toString()
    assert flat(some) == [p for p in flat(whole) if p[0] in terms] and flat(some)
    assert flat(search.build_title_index(docs, "english", ["x"])) == [p for p in flat(search.build_title_index(docs, "english")) if p[0] == "x"]
    assert search.build_title_index(docs, terms=[]).collect() == []
    ranks = lambda df: sorted((r.doc, round(r["rank"], 9)) for r in df.collect())
    for asked in (["the", "that"], ["the", "that", "2"], ["and"]):
        assert ranks(search.cover_density(search.build_title_index(docs, terms=asked), asked)) == ranks(search.cover_density(whole, asked)) != []


def test_ranks_without_a_window_over_hits(spark):
    index = spark.createDataFrame([("a", "d", "A", [1, 5]), ("b", "d", "A", [2]), ("b", "d", "B", [9])], "term string, doc string, weight string, positions array<int>")
    found = search.cover_density(index, ["a", "b"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    want = 2 / 2 + (2 / 2) / (1 + 2) + (2 / 3.5) / (1 + 3)
    assert [(r.doc, round(r["rank"], 9)) for r in found.collect()] == [("d", round(want, 9))]
