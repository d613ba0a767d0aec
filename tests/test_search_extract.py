import random
import re

import pytest
from pyspark.sql import functions as F

from folioflow.functions.markup import choose, xml_text
from folioflow.functions.stemmer import stem
from folioflow.operators import extract, search


def test_search(spark):
    docs = spark.createDataFrame([("1", "Land titles act", "LTA 1", "s", "ca", "legislation"), ("2", "Water act", "land", "s", "ca", "legislation"), ("3", "Other", "x", "s", "qc", "regulation")], "id string, title string, citation string, source_type string, jurisdiction_code string, document_type string").selectExpr("*", "id AS source_url")
    versions = spark.createDataFrame([("1", "titles of nothing", True), ("2", "the land was titled", False), ("2", "water only", True), ("3", "a land with titles. " + "z " * 40 + "land again", True)], "document_id string, content_text string, is_latest boolean")
    ti, ci = search.build_title_index(docs), search.build_content_index(versions)
    assert {r.doc for r in search.match(ti, ["land"]).collect()} == {"1", "2"} and {r.doc for r in search.matches(ti, ci, ["land", "titles"]).collect()} == {"1", "3"}
    rows, facts = search.search(docs, versions, ti, ci, "Land titles")
    got = {r.id: r for r in rows.collect()}
    assert facts.first().total == 2 and got["1"].relevance == pytest.approx(4.0) and got["3"].relevance == pytest.approx(0.1) and got["1"].snippet is None
    assert got["3"].snippet.startswith("a <mark>land</mark> with <mark>titles</mark>") and " ... " in got["3"].snippet and got["3"].snippet.count("<mark>") == 3
    assert search.search(docs, versions, ti, ci, "land titles", document_type="regulation")[1].first().total == 1
    assert search.search(docs, versions, ti, ci, " ")[1].first().total == 0 and search.parse_query("the of", "english") == []
    en = search.build_title_index(docs, "english")
    assert {r.doc for r in search.match(en, search.parse_query("titled lands", "english")).collect()} == {"1"}
    refreshed = search.refresh_index(ti, docs.filter("id = '1'").selectExpr("id AS doc"), search.build_title_index(docs.filter("id = '3'")).limit(0))
    assert {r.doc for r in search.match(refreshed, ["land"]).collect()} == {"2"}


def test_search_reads_whole_texts(spark):
    docs = spark.createDataFrame([("1", "Long", "L 1", "s", "ca", "legislation")], "id string, title string, citation string, source_type string, jurisdiction_code string, document_type string").selectExpr("*", "id AS source_url")
    text = "word " * 100_100 + "lastword"
    versions = spark.createDataFrame([("1", text, True)], "document_id string, content_text string, is_latest boolean")
    ti, ci = search.build_title_index(docs), search.build_content_index(versions)
    assert len(text) > 500_000 and {r.doc for r in search.match(ci, ["lastword"]).collect()} == {"1"}
    assert ci.filter("term = 'word'").selectExpr("size(positions)").first()[0] == 100_100
    rows, facts = search.search(docs, versions, ti, ci, "lastword")
    assert facts.first().total == 1 and rows.first().snippet.endswith("<mark>lastword</mark>")


def brute_density(entries, n):
    """Every stretch that holds all the terms and no shorter one that does."""
    total = 0.0
    for i in range(len(entries)):
        for j in range(i, len(entries)):
            span = entries[i : j + 1]
            if len({t for _, t, _ in span}) == n and len({t for _, t, _ in span[1:]}) < n and len({t for _, t, _ in span[:-1]}) < n:
                foreign = max(0, span[-1][0] - span[0][0] - (len(span) - 1))
                total += len(span) / sum(1 / w for _, _, w in span) / (1 + foreign)
    return total


def test_density(spark):
    rng, weights = random.Random(3), {"A": 1.0, "B": 0.4}
    cases = [[(1, "a", "A"), (2, "b", "A")], [(1, "a", "A"), (4, "b", "A")], [(1, "a", "A"), (2, "b", "A"), (3, "a", "A"), (9, "b", "A")], [(1, "a", "A"), (2, "b", "B")], [(1, "a", "A")]]
    cases += [sorted((p, rng.choice("abcde"[: rng.randint(1, 5)]), rng.choice("AB")) for p in rng.sample(range(60), rng.randint(1, 25))) for _ in range(60)]
    held = {}
    for doc, entries in enumerate(cases):
        for p, t, w in entries:
            held.setdefault((t, str(doc), w), []).append(p)
    index = spark.createDataFrame([(*k, sorted(v)) for k, v in held.items()], "term string, doc string, weight string, positions array<int>")
    for terms in (["a"], ["a", "b"], ["c", "a", "b"], ["a", "b", "c", "d"], list("abcde")):
        got = search.cover_density(index, terms)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
        found = {r.doc: r.rank for r in got.collect()}
        want = {}
        for doc, entries in enumerate(cases):
            own = [(p, t, weights[w]) for p, t, w in entries if t in terms]
            if {t for _, t, _ in own} == set(terms):
                want[str(doc)] = brute_density(own, len(terms))
        assert found == {d: pytest.approx(x) for d, x in want.items()} and want
    assert search.cover_density(index, ["a", "zz"]).collect() == [] and search.cover_density(index, []).collect() == []


def brute_snippet(text, terms):
    words = list(re.finditer(r"[^\W_]+", text))
    hit = [i for i, w in enumerate(words) if w.group().lower() in terms]
    stretches = []
    for i in hit:
        inside = [j for j in hit if i <= j < i + 35]
        stretches.append((len({words[j].group().lower() for j in inside}), len(inside), i - inside[-1] - 1, -i, i, inside[-1] + 1))

    def extent(begin, end, low, high):
        size = max(end - begin, min(15, high - low))
        first = max(low, min(begin - (size - (end - begin)) // 2, high - size))
        return first, first + size

    if not stretches:
        return None
    *_, b, e = max(stretches)
    one = extent(b, e, 0, len(words))
    out = [one]
    if rest := [s for s in stretches if s[4] >= one[1] or s[5] <= one[0]]:
        *_, b, e = max(rest)
        out.append(extent(b, e, one[1], len(words)) if b >= one[1] else extent(b, e, 0, one[0]))
    shown = []
    for a, b in sorted(out):
        piece = ""
        for k in range(a, b):
            word = words[k].group()
            piece += (f"<mark>{word}</mark>" if k in hit else word) + (text[words[k].end() : words[k + 1].start()] if k + 1 < b else "")
        shown.append(piece)
    return " ... ".join(shown)


def test_best_fragments(spark):
    rng = random.Random(11)
    cases = [("plain land", ["land"]), ("Land, titles & LAND!", ["land", "titles"]), ("nothing here", ["land"]), ("", ["land"])]
    cases.append(("land " * 10 + "w " * 60 + "land titles water end.", ["land", "titles", "water"]))
    for _ in range(40):
        text = "".join(rng.choice(["land", "Titles", "water", *["w%d" % rng.randint(0, 9)] * rng.randint(1, 40)]) + rng.choice([" ", ", ", ". ", "\n", " - "]) for _ in range(rng.randint(1, 300)))
        cases.append((text, sorted(rng.sample(["land", "titles", "water", "w1"], rng.randint(1, 4)))))
    page = spark.createDataFrame([(i, "d", t) for i, (t, _) in enumerate(cases)], "query_id int, id string, content_text string")
    terms = spark.createDataFrame([(i, len(ts), k, t) for i, (_, ts) in enumerate(cases) for k, t in enumerate(ts)], "query_id int, size int, no int, term string")
    got = search.headline(page, terms)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    found = {r.query_id: r.snippet for r in got.collect()}
    for i, (text, ts) in enumerate(cases):
        want = brute_snippet(text, set(ts))
        assert found.get(i) == want
        if want:
            sizes = [len(re.findall(r"[^\W_]+", re.sub("</?mark>", "", f))) for f in want.split(" ... ")]
            assert len(sizes) <= 2 and max(sizes) <= 35


def test_many_queries_are_as_each_alone(spark):
    docs = spark.createDataFrame([(str(i), f"Act {i} on {'land' if i % 2 else 'water'} titles", f"c {i}", "s", "ca", "legislation", f"u{i}") for i in range(30)], "id string, title string, citation string, source_type string, jurisdiction_code string, document_type string, source_url string")
    versions = spark.createDataFrame([(str(i), f"the {'water' if i % 3 else 'land'} text {i} titles", True) for i in range(30)], "document_id string, content_text string, is_latest boolean")
    ti, ci = search.build_title_index(docs), search.build_content_index(versions)
    texts = ["land titles", "titles water the", "nowhere land", None, "LAND land titles"]
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id int, text string")
    for page, alone in ((1, (1, 2)), (2, (0,))):
        rows, facts = search.search_many(docs, versions, ti, ci, queries, page, 4)
        got = {}
        for r in rows.orderBy("query_id", "place").collect():
            got.setdefault(r.query_id, []).append((r.id, round(r.relevance, 9), r.in_content, r.snippet))
        totals = {r.query_id: (r.total, r.total_pages) for r in facts.collect()}
        assert got.get(0) == got.get(4) and totals[0] == totals[4] and 3 not in totals
        for i in alone:
            one, its = search.search(docs, versions, ti, ci, texts[i], page, 4)
            want = [(r.id, round(r.relevance, 9), r.in_content, r.snippet) for r in one.orderBy(F.desc("relevance"), "id").collect()]
            assert got.get(i, []) == want and totals.get(i, (0, 1)) == tuple(its.first())
    assert search.search_many(docs, versions, ti, ci, queries.limit(0))[0].collect() == []


def test_the_store_keeps_its_index(spark, tmp_path):
    from folioflow.sources import segments, store

    at = F.lit("2024-01-31").cast("timestamp")
    own = store.Store(spark, str(tmp_path / "s"), buckets=4, analyzer="simple")
    batch = lambda rows: spark.createDataFrame([(u, k, t, f"Title {t[:5]}", "c") for k, (u, t) in enumerate(rows)], "source_url string, seq long, content_text string, title string, category string")
    flat = lambda df: sorted((r.term, r.doc, r.weight, tuple(r.positions)) for r in df.collect())
    batches = [[(f"u{i}", f"word{i} land and water") for i in range(20)], [("u3", "new land"), ("u3", "newer land"), ("u30", "first water")], [("u4", ""), ("u5", "word5 land and water")], [("u6", "x" * 10)], [("u6", "y")]]
    for rows in batches:
        own.upsert(batch(rows), at)
        docs, versions = own.read()
        assert flat(own.index("content")) == flat(search.build_content_index(versions)) and flat(own.index("title")) == flat(search.build_title_index(docs))
    before = [s["folder"] for s in own.manifest()["index"]["content"]]
    assert own.merge_index() and not own.merge_index()
    after = [s["folder"] for s in own.manifest()["index"]["content"]]
    assert len(after) < len(before) and after[0] == before[0]
    assert flat(own.index("content")) == flat(search.build_content_index(versions)) and flat(own.index("title")) == flat(search.build_title_index(docs))
    assert flat(own.index("content", 1)) == flat(search.build_content_index(own.read(1)[1]))
    plan = own.index("content").filter(F.col("term").isin("land", "water"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [In(term, [land,water])") == len(after)
    rows, facts = search.search(*own.read(), own.index("title"), own.index("content"), "newer land")
    assert facts.first().total == 1 and rows.first().snippet == "<mark>newer</mark> <mark>land</mark>"
    own.write(docs.limit(3), versions.limit(0))
    assert own.index("content").count() == 0 and own.index("title").select("doc").distinct().count() == 3
    assert segments.due([{"rows": 100}, {"rows": 3}, {"rows": 2}]) == 1 and segments.due([{"rows": 100}, {"rows": 9}]) == 2 and segments.due([]) == 0


@pytest.mark.parametrize("word,root", [("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("agreed", "agre"), ("plastered", "plaster"), ("motoring", "motor"), ("hopping", "hop"), ("filing", "file"), ("happy", "happi"), ("relational", "relat"), ("conditional", "condit"), ("electrical", "electr"), ("adjustment", "adjust"), ("adoption", "adopt"), ("probate", "probat"), ("rate", "rate"), ("controll", "control"), ("regulations", "regul"), ("generalizations", "gener")])
def test_stemmer(word, root):
    assert stem(word) == root


def test_markup():
    html = '<html><head><style>x</style></head><body><nav>no</nav><div class="a content-area b">Hi <b>you</b><br>there &amp; <script>bad()</script></div><article>art</article></body></html>'
    node, selector = choose(html, ["script", "style", "nav"], ["div#none", "div.*content-area", "article"])
    assert (selector, node.text()) == ("div.*content-area", "Hi youthere & ") and node.html().endswith("there &amp; </div>")
    assert choose("<p>x", [], ["article"])[1] == "" and choose("<div>" * 5000 + "deep", [], ["article"])[0].text() == "deep"
    xml = '<S xmlns="u"><LongTitle>L</LongTitle><Heading>H</Heading><Section><MarginalNote>M</MarginalNote><Label>1</Label><Text>T <i>x</i> tail</Text></Section></S>'
    assert xml_text(xml, "federal") == "\n= L\n\n- H\n\n[M]\n\n- 1\nT\ntail" and xml_text(xml, "flat") == "L\nH\nM\n1\nT\nx\ntail" and xml_text("<a>", "flat") is None


def test_extract(spark):
    pages = spark.createDataFrame([("u", "<html><body><main> a \n\n b</main></body></html>", "quebec"), ("v", None, "any")], "url string, html string, profile string")
    got = {r.url: r for r in extract.extract_pages(pages).collect()}
    assert (got["u"].content_text, got["u"].selector, got["v"].content_text) == ("a\nb", "main", None)
    rows = spark.createDataFrame([("quebec", "x" * 499, "y" * 60), ("quebec", "x" * 500, "y" * 49), ("quebec", "x" * 500, "y" * 50), ("case_law", None, "z"), ("case_law", None, None), ("new", None, None)], "profile string, html string, content_text string")
    assert [r.reason for r in extract.gate_content(rows).collect()] == ["raw_too_short", "text_too_short", None, None, "text_too_short", None]
    t = spark.createDataFrame([('<title>T | CanLII </title><h1 class="canlii">Head <b>x</b></h1>',), ("<title>Only | CanLII</title>",)], "html string")
    assert [r.title for r in extract.extract_title(t).collect()] == ["Head x", "Only"]
    b = spark.createDataFrame([(403, "A Captcha"), (200, "captcha"), (200, "Access Denied"), (None, None)], "status_code int, html string")
    assert [r.is_blocked for r in extract.flag_block_pages(b).collect()] == [True, False, True, False]
    e = spark.createDataFrame([("Page NOT found",), ("ok",), (None,)], "html string")
    assert [r.is_error for r in extract.flag_error_pages(e).collect()] == [True, False, False]
    x = spark.createDataFrame([("<a>" + "t" * 200,), ("<HTML>" + "t" * 200,), ("s",)], "xml string")
    assert [r.is_error for r in extract.flag_xml_errors(x).collect()] == [False, True, True]
    c = spark.createDataFrame([("None", " fr "), ("en", "fr"), (None, None)], "unofficial_text_en string, unofficial_text_fr string")
    assert [r.content_text for r in extract.case_text(c).collect()] == ["fr", "en", ""]
    m = spark.createDataFrame([({"a": "1", "b": "2"},), (None,)], "metadata map<string,string>")
    assert [r.metadata for r in extract.enrich_metadata(m, {"b": "3"}).collect()] == [{"a": "1", "b": "3"}, {"b": "3"}]
    p = spark.createDataFrame([("C", "<p>"), ("", "<p>"), (None, "<p>")], "chapter string, content_html string")
    assert [r.content_html for r in extract.prepend_chapter(p).collect()] == ["<h2>C</h2><p>", "<p>", "<p>"]
