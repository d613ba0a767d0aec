"""XML goes to Python some rows at a time, and whole."""

from folioflow.functions.markup import xml_text
from folioflow.operators import extract


def test_xml_without_batches_of_columns(spark):
    xml = ["<A><Text>x</Text>tail</A>", "<A>", None, "", "<A><Heading>é  ü</Heading>" + "<Text>w</Text>" * 3000 + "</A>"] * 60
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xml)], "pos int, xml string")
    for profile in ("federal", "flat"):
        got = extract.xml_to_text(df, profile)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" not in plan and "BatchEvalPython" in plan
        assert {r.pos: r.content_text for r in got.collect()} == {i: None if x is None else xml_text(x, profile) for i, x in enumerate(xml)}
