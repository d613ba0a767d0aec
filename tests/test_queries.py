import re
from html.parser import HTMLParser

import duck
import pytest

from folioflow.functions.stemmer import STOP_WORDS, stem
from folioflow.plans.listings import ORACLE, QUERIES


class Text(HTMLParser):
    """The texts of a page in order, those of scripts and styles left out."""

    def __init__(self):
        super().__init__()
        self.parts, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style") and self.hidden > 0

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


@pytest.fixture(scope="module")
def con():
    return duck.connect()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, con, name):
    duck.compare(con, spark, QUERIES[name], ORACLE[name])


def test_english_search_by_plain_loops(spark, con):
    """The ids of the page and the total, by stemming every word of every document."""
    rows = con.execute("SELECT sha256('https://corpus.example.org/' || source || '/' || doc_id), left(split_part(text, chr(10), 1), 80) || ' ' || upper(source) || ' ' || doc_id, text FROM documents").fetchall()
    words = lambda t: {stem(w) for w in re.findall(r"[^\W_]+", t.lower()) if w not in STOP_WORDS}
    terms = words("the tion of ers")
    want = {i for i, title, text in rows if terms <= words(title) or terms <= words(text)}
    got = QUERIES["search_english"](spark, duck.DATA).collect()
    assert terms and {r.total for r in got} <= {len(want)} and len(got) == min(20, len(want)) and {r.id for r in got} <= want


def test_extraction_by_another_parser(spark, con):
    """The letters of an extracted text stand in the page's own text, in order, and no page is lost."""
    pages = dict(con.execute("SELECT url, html FROM pages").fetchall())
    got = QUERIES["extract_pages"](spark, duck.DATA).collect()
    assert {r.url for r in got} == set(pages)
    for r in got:
        plain = Text()
        plain.feed(pages[r.url])
        every = iter(re.sub(r"\W", "", "".join(plain.parts)))
        assert all(c in every for c in re.sub(r"\W", "", r.content_text or ""))


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
