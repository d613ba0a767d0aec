"""Content of landed pages: container choice, gates, labels, metadata."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.markup import choose, xml_text
from folioflow.functions.text import clean_lines, filled, strip, strip_markup

_CHROME = ["script", "style", "nav", "header", "footer"]
#: Fixed values by source: elements dropped, then containers in order of preference.
PROFILES: dict[str, dict[str, list[str]]] = {
    "alberta": {"unwanted": [], "selectors": ["div#content", "div.content", "div.*WordSection", "body"]},
    "manitoba": {"unwanted": _CHROME, "selectors": ["div#content", "div.content", "div#main-content", "article", "body"]},
    "new_brunswick": {"unwanted": _CHROME, "selectors": ["div.*document-content", "div.*legisdoc", "div#docContent", "div.*content-area", "article", "main", "body"]},
    "nova_scotia": {"unwanted": _CHROME, "selectors": ["body"]},
    "newfoundland": {"unwanted": ["style", "script"], "selectors": ["body"]},
    "quebec": {"unwanted": [*_CHROME, ".*HistoricalNote"], "selectors": ["div.*LegislativeDocument", "main", "div#content", "div.content", "body"]},
    "decisions": {"unwanted": [*_CHROME, "noscript"], "selectors": ["div.*documentcontent", "div.*decision-content", "div.*document-content", "div#decision", "div#document", "article", "div[role=main]", "body"]},
    "statutes": {
        "unwanted": [*_CHROME, ".d-print-none", "#canlii-header", "#canlii-breadcrumbs", "#canlii-login", "#canlii-lang-toggler", ".collectionScopeLink"],
        "selectors": ["div#originalDocument", "div.canliidocumentcontent", "div#mainContent", "div.canliiContent"],
    },
    "any": {"unwanted": _CHROME, "selectors": ["article", "main", "body"]},
}
#: Fixed values by source: least size of the page and of the text, in characters.
THRESHOLDS = {"alberta": (200, 100), "manitoba": (200, 50), "newfoundland": (200, 50), "nova_scotia": (200, 50), "new_brunswick": (300, 50), "quebec": (500, 50), "ontario": (50, 30), "yukon": (200, 50), "pei": (200, 50), "saskatchewan": (200, 50), "nwt": (200, 50), "nunavut": (0, 50), "case_law": (0, 1)}
#: Phrases of error pages, and of pages that block a crawler.
ERROR_PHRASES = ("page not found", "page you were looking for")
BLOCK_PHRASES = ("Verify you are human", "Checking if the site connection is secure", "hcaptcha-container", "g-recaptcha", "Cloudflare", "DataDome", "Access Denied")


def extract_pages(pages: DataFrame, profiles: dict[str, dict[str, list[str]]] | None = None) -> DataFrame:
    """Pages (url, html, profile) with content_html, content_text (lines cleaned) and the selector that matched. One
    job for all sources: the profiles go along with the code. A null page has no content."""
    table = profiles or PROFILES
    schema = "url string, profile string, content_html string, raw_text string, selector string"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for url, html, profile in zip(part["url"], part["html"], part["profile"], strict=True):
                if html is None:
                    rows.append((url, profile, None, None, None))
                    continue
                rules = table.get(profile, table["any"])
                node, selector = choose(html, rules["unwanted"], rules["selectors"])
                rows.append((url, profile, node.html(), node.text(), selector))
            yield pd.DataFrame(rows, columns=["url", "profile", "content_html", "raw_text", "selector"])

    return pages.select("url", "html", "profile").mapInPandas(run, schema).select("url", "profile", "content_html", clean_lines(F.col("raw_text")).alias("content_text"), "selector")


def strip_pages(pages: DataFrame) -> DataFrame:
    """The text of pages by patterns alone, without Python."""
    return pages.select("url", strip_markup(F.col("html")).alias("content_text"))


def extract_title(df: DataFrame, suffix: str = "CanLII", html: str = "html") -> DataFrame:
    """The page's marked heading, else its title element, without the site's name at the end."""
    heading = F.regexp_extract(html, r"(?is)<h1[^>]*class=\"canlii\"[^>]*>(.*?)</h1>", 1)
    title = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    text = strip_markup(F.coalesce(filled(heading), title))
    return df.withColumn("title", F.regexp_replace(text, rf"\s*\|\s*{suffix}\s*$", ""))


def xml_to_text(df: DataFrame, profile: str = "federal") -> DataFrame:
    """Adds content_text from a column xml. Rows go to Python some at a time, so that memory follows a document's size and
    not that of a batch of columns."""

    @F.udf("string", useArrow=False)
    def text(x: str | None) -> str | None:
        return None if x is None else xml_text(x, profile)

    return df.withColumn("content_text", text("xml"))


def flag_error_pages(df: DataFrame, html: str = "html") -> DataFrame:
    low, hit = F.lower(html), F.lit(False)
    for p in ERROR_PHRASES:
        hit = hit | low.contains(p)
    return df.withColumn("is_error", F.coalesce(hit, F.lit(False)))


def flag_xml_errors(df: DataFrame, xml: str = "xml", least: int = 100) -> DataFrame:
    """A source of XML that answers with little, or with a web page."""
    return df.withColumn("is_error", F.coalesce((F.length(xml) < least) | F.lower(F.substring(xml, 1, 500)).contains("<html"), F.lit(True)))


def flag_block_pages(df: DataFrame, html: str = "html", status: str = "status_code") -> DataFrame:
    """Refused answers that speak of a challenge, and pages with a blocker's phrases."""
    refused = (F.col(status) == 403) & F.lower(F.left(html, F.lit(2000))).rlike("captcha|challenge")
    phrase = F.lit(False)
    for p in BLOCK_PHRASES:
        phrase = phrase | F.col(html).contains(p)
    return df.withColumn("is_blocked", F.coalesce(refused, F.lit(False)) | F.coalesce(phrase, F.lit(False)))


def gate_content(df: DataFrame, thresholds: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Adds reason: raw_too_short, text_too_short or null for accepted rows of (profile, html, content_text)."""
    table = thresholds or THRESHOLDS
    raw_min, text_min = F.lit(0), F.lit(0)
    for name, (raw, text) in table.items():
        raw_min, text_min = F.when(F.col("profile") == name, raw).otherwise(raw_min), F.when(F.col("profile") == name, text).otherwise(text_min)
    short = lambda c, n: F.coalesce(F.length(c), F.lit(0)) < n
    return df.withColumn("reason", F.when(short("html", raw_min), "raw_too_short").when(short("content_text", text_min), "text_too_short"))


def choose_content(df: DataFrame, candidates: list[str], min_len: int = 50) -> DataFrame:
    """The first candidate column with enough characters."""
    return df.withColumn("content_text", F.coalesce(*[F.when(F.length(c) >= min_len, F.col(c)) for c in candidates]))


def case_text(df: DataFrame) -> DataFrame:
    clean = lambda c: F.when(F.trim(F.coalesce(c, F.lit(""))) == "None", "").otherwise(F.coalesce(strip(F.col(c)), F.lit("")))
    return df.withColumn("content_text", F.coalesce(filled(clean("unofficial_text_en")), clean("unofficial_text_fr")))


def enrich_metadata(df: DataFrame, provenance: dict[str, str | Column]) -> DataFrame:
    """Metadata with further keys, which win over earlier ones."""
    new = F.create_map(*[x for k, v in provenance.items() for x in (F.lit(k), v if isinstance(v, Column) else F.lit(v))])
    old = F.map_filter(F.coalesce("metadata", F.create_map().cast("map<string,string>")), lambda k, _: ~F.array_contains(F.map_keys(new), k))
    return df.withColumn("metadata", F.map_concat(old, new))


def prepend_chapter(df: DataFrame) -> DataFrame:
    return df.withColumn("content_html", F.when(F.coalesce(F.col("chapter") != "", F.lit(False)), F.concat(F.lit("<h2>"), "chapter", F.lit("</h2>"), "content_html")).otherwise(F.col("content_html")))
