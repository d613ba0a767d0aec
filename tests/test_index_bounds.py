"""An index run's memory, and texts that are taken to words once."""

import re
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from folioflow.operators import search


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_run_takes_few_bytes_a_word_for_any_number_of_batches():
    rng = np.random.default_rng(1)
    words = pa.array([[f"w{x}" for x in rng.integers(0, 5000, 400)] for _ in range(4000)])
    batch = pa.RecordBatch.from_arrays([pa.array([f"d{i}" for i in range(4000)]), pa.array(["D"] * 4000), words, pa.array([0] * 4000, pa.int32())], ["doc", "weight", "words", "shift"])

    def peak(n: int) -> int:
        tracemalloc.start()
        for _ in search._runs("simple")(iter([batch] * n)):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    two, six = peak(2), peak(6)
    assert two < 48 * search.RUN and six < 1.1 * two


def test_a_text_is_taken_to_words_once(spark, tmp_path):
    rows = [("d1", "One two. ONE", True), ("d2", "", True), ("d3", "...", True), ("d4", "gone", False)]
    spark.createDataFrame(rows, "document_id string, content_text string, is_latest boolean").write.parquet(str(tmp_path / "v"))
    index = search.build_content_index(spark.read.parquet(str(tmp_path / "v")))
    assert len(re.findall("regexp_extract_all", plan_of(index))) == 1
    assert {(r.term, r.doc, tuple(r.positions)) for r in index.collect()} == {("one", "d1", (1, 3)), ("two", "d1", (2,))}
    spark.createDataFrame([("d1", "A b", "C 1")], "id string, title string, citation string").write.parquet(str(tmp_path / "d"))
    index = search.build_title_index(spark.read.parquet(str(tmp_path / "d")))
    assert len(re.findall("regexp_extract_all", plan_of(index))) == 2
    assert {(r.term, r.weight, tuple(r.positions)) for r in index.collect()} == {("a", "A", (1,)), ("b", "A", (2,)), ("c", "B", (3,)), ("1", "B", (4,))}
