import duck

from folioflow.plans.listings import ORACLE, QUERIES


def test_gate_of_odd_pages(spark, tmp_path):
    """Null pages, shared and null urls, and white space of other scripts agree with the SQL, row by row."""
    long = "word " * 200
    rows = [("a", None), ("b", long), ("b", "<p>" + long), ("b", "x"), (None, long), (None, "<i>" * 300), ("c", "<p>" + "\u00a0\u3000" * 300), ("d", "\x0b \x85" * 200 + "y" * 49), ("e", "\u2003" * 600 + "z" * 50), ("f", "")]
    spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duck.connect(tmp_path / "none")
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    duck.compare(con, spark, QUERIES["gate_content"], ORACLE["gate_content"], str(tmp_path))
    assert QUERIES["gate_content"](spark, str(tmp_path)).count() == len(rows)
