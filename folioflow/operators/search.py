"""Ranked full-text search over postings (term, doc, weight, positions), for one query or many at once."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.functions.stemmer import STOP_WORDS, stem
from folioflow.operators.browse import MOST_PER_PAGE, browse
from folioflow.operators.joins import filter_documents, latest_of
from folioflow.session import scratch_folder

WORD = r"[\p{L}\p{N}]+"
#: Weights of title and citation, and of the labels from the weakest to the strongest.
LABELS = {"D": 0.1, "C": 0.2, "B": 0.4, "A": 1.0}
_WORD = re.compile(r"[^\W_]+")
#: Words of a snippet's fragments, and how many fragments it has.
MOST_WORDS, LEAST_WORDS, FRAGMENTS = 35, 15, 2
#: Words that are sorted at once when an index is made, and postings that leave Python at once.
RUN, OUT_ROWS = 1 << 20, 1 << 16


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def parse_query(text: str, analyzer: str = "simple") -> list[str]:
    """The distinct terms of a query, all of which must match; an empty list matches nothing."""
    words = [w for w in _WORD.findall(text.lower()) if analyzer == "simple" or w not in STOP_WORDS]
    return sorted({w if analyzer == "simple" else stem(w) for w in words})


def _analyzed(words: DataFrame, analyzer: str) -> DataFrame:
    """Terms of rows (..., word): stop words dropped and the rest stemmed. Python sees each distinct word once, and the
    vocabulary is joined back, by broadcast if it is small."""
    if analyzer == "simple":
        return words.withColumnRenamed("word", "term")

    @F.pandas_udf("string")
    def stemmed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda w: None if w in STOP_WORDS else stem(w))

    vocabulary = words.select("word").distinct().withColumn("term", stemmed("word")).filter("term IS NOT NULL")
    return words.join(vocabulary, "word").drop("word")


def _runs(analyzer: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Turns rows (doc, weight, words, shift and others) into postings over whole columns, in runs of about RUN words that
    are sorted by term; memory follows RUN and not the batch. Words are stemmed once a run, and kept for the next ones. Any
    other columns go with the row's postings."""
    def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ends = np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False))
        begin = 0
        while begin < len(ends):
            end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + RUN, "right")))
            yield batch.slice(begin, end - begin)
            begin = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(1 << 16)(lambda w: None if w in STOP_WORDS else stem(w))
        for part in (p for batch in batches for p in pieces(batch)):
            lists, shift = part.column(2), part.column(3).to_numpy(zero_copy_only=False)
            coded = lists.flatten().dictionary_encode()
            words = coded.dictionary.to_pylist()
            terms = words if analyzer == "simple" else [known(w) for w in words]
            names = sorted({t for t in terms if t is not None})
            at = {t: i for i, t in enumerate(names)}
            code = np.array([at.get(t, -1) for t in terms], dtype=np.int32)[coded.indices.to_numpy(zero_copy_only=False)]
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(lists), dtype=np.int32), size)
            position = np.arange(1, len(row) + 1, dtype=np.int32)
            position += np.repeat((shift - np.cumsum(size) + size).astype(np.int32), size)
            if analyzer != "simple":
                row, code, position = row[code >= 0], code[code >= 0], position[code >= 0]
            key = code.astype(np.int64)
            key *= len(lists)
            key += row
            del coded, code, row
            order = np.argsort(key, kind="stable")
            key, position = key[order], position[order]
            del order
            begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
            ends = np.r_[begin, len(key)]
            for k in range(0, len(begin), OUT_ROWS):
                cut = ends[k : k + OUT_ROWS + 1]
                who, what = pa.array(key[cut[:-1]] % len(lists)), pa.array(key[cut[:-1]] // len(lists))
                places = pa.ListArray.from_arrays(pa.array((cut - cut[0]).astype(np.int32)), pa.array(position[cut[0] : cut[-1]]))
                found = {"term": pa.array(names, pa.string()).take(what), "doc": part.column(0).take(who), "weight": part.column(1).take(who), "positions": places}
                yield pa.RecordBatch.from_pydict(found | {name: part.column(4 + i).take(who) for i, name in enumerate(part.schema.names[4:])})

    return run


def _postings(df: DataFrame, analyzer: str, numbered: bool = False) -> DataFrame:
    """Of rows (doc, weight, words, shift): positions from shift + 1 on. A text's words become postings within its task, so
    that no row is made or shuffled for a single position. A filter on words would take each text to words once more.
    ``numbered`` adds the column row, a number of the row that they come from."""
    number = [F.monotonically_increasing_id().alias("row")] if numbered else []
    words = df.select("doc", "weight", "words", "shift", *number)
    return words.mapInArrow(_runs(analyzer), "term string, doc string, weight string, positions array<int>" + ", row long" * numbered)


def _postings_of(df: DataFrame, terms: Sequence[str]) -> DataFrame:
    """The postings of a few terms of the simple analyzer, of rows as in ``_postings``: hits are picked from each text's
    words in one pass, without Python."""
    every = F.transform("words", lambda w, i: F.struct(w.alias("term"), (i + 1 + F.col("shift")).alias("position")))
    hits = df.select("doc", "weight", F.filter(every, lambda h: h["term"].isin(*terms)).alias("hits"))
    each = hits.select("doc", "weight", "hits", F.explode(F.array(*[F.lit(t) for t in sorted(set(terms))])).alias("term"))
    positions = F.transform(F.filter("hits", lambda h: h["term"] == F.col("term")), lambda h: h["position"])
    return each.select("term", "doc", "weight", positions.alias("positions")).filter(F.size("positions") > 0)


def build_title_index(docs: DataFrame, analyzer: str = "simple", terms: Sequence[str] | None = None, numbered: bool = False) -> DataFrame:
    """Titles with weight A; citations with weight B, their positions going on after the title's. With ``terms``, the
    postings of these alone; ``numbered``, which goes without, adds a number (row) of each title and citation."""
    words = docs.select(F.col("id").alias("doc"), tokens(F.col("title")).alias("title"), tokens(F.col("citation")).alias("citation"))
    parts = F.array(F.struct(F.lit("A").alias("weight"), F.col("title").alias("words"), F.lit(0).alias("shift")), F.struct(F.lit("B").alias("weight"), F.col("citation").alias("words"), F.size("title").alias("shift")))
    rows = words.select("doc", F.inline(parts))
    if terms and analyzer == "simple":
        return _postings_of(rows, terms)
    index = _postings(rows, analyzer, numbered)
    return index if terms is None else index.filter(F.col("term").isin(*terms))


def build_content_index(versions: DataFrame, analyzer: str = "simple", numbered: bool = False) -> DataFrame:
    """Latest versions with text, whole texts. ``numbered`` adds a number (row) of each."""
    texts = latest_of(versions).filter("content_text <> ''").select(F.col("document_id").alias("doc"), F.lit("D").alias("weight"), tokens(F.col("content_text")).alias("words"), F.lit(0).alias("shift"))
    return _postings(texts, analyzer, numbered)


def refresh_index(index: DataFrame, changed: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """The index with the postings of the changed documents (doc) replaced by rebuilt ones."""
    return index.join(changed.select("doc").distinct(), "doc", "left_anti").unionByName(rebuilt)


# --- matching


def one_query(spark: SparkSession, text: str) -> DataFrame:
    return spark.createDataFrame([(0, text)], "query_id int, text string")


def query_terms(queries: DataFrame, analyzer: str = "simple") -> DataFrame:
    """The terms of queries (query_id, text): query_id, term, no (0, 1, ... within the query) and size, the number of its
    distinct terms. A query without terms has no rows and matches nothing."""
    words = queries.select("query_id", F.explode(tokens(F.col("text"))).alias("word"))
    terms = _analyzed(words, analyzer).groupBy("query_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))
    return terms.select("query_id", F.size("terms").alias("size"), F.posexplode("terms").alias("no", "term"))


def _written(rows: DataFrame, name: str) -> DataFrame:
    """Rows in the shared folder: made once, and of a size that Spark knows."""
    at = scratch_folder(rows.sparkSession, name)
    rows.write.parquet(at)
    return rows.sparkSession.read.schema(rows.schema).parquet(at)


def match_many(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(query_id, doc) where a document holds all terms of a query (see ``query_terms``).

    A query's candidates are the documents of its rarest term alone; each of its other terms is then looked up for
    those. So a frequent word costs a look-up for each candidate, and not a row for each document that holds it. Rarest
    terms and candidates are written, so that Spark knows their size: the index meets few of them without a shuffle."""
    wanted = index.join(terms.select("term").distinct(), "term", "left_semi").select("term", "doc")
    held = wanted.groupBy("term").agg(F.count(F.lit(1)).alias("holders"))
    known = terms.join(held, "term").groupBy("query_id", "size").agg(F.min_by("term", F.struct("holders", "term")).alias("term"), F.count(F.lit(1)).alias("known"))
    rarest = _written(known.filter("known = size").select("query_id", "term"), "rarest")
    candidates = _written(rarest.join(index.select("term", "doc"), "term").select("query_id", "doc").distinct(), "candidates")
    asked = wanted.join(candidates, "doc").join(terms, ["query_id", "term"])
    return asked.groupBy("query_id", "doc", "size").agg(F.countDistinct("term").alias("n")).filter("n = size").select("query_id", "doc")


def match(index: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Documents that hold all the terms."""
    if not terms:
        return index.select("doc").limit(0)
    return index.filter(F.col("term").isin(*terms)).groupBy("doc").agg(F.countDistinct("term").alias("n")).filter(F.col("n") == len(terms)).select("doc")


def matches(title_index: DataFrame, content_index: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Documents whose title and citation hold all terms, or whose text does; terms split between them don't count."""
    return match(title_index, terms).union(match(content_index, terms)).distinct()


# --- ranks


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def density(entries: Column, size: Column) -> Column:
    """Cover density of ``entries``, a document's hits in order: array of struct(position, no, inverse), with 1 / weight of
    the hit; ``size`` terms are numbered from 0.

    A cover ends at a hit and begins at the earliest of the terms' last hits up to there; it counts if it begins later
    than the one before. Each adds the harmonic mean of its weights, less the more foreign words it holds. The fold keeps
    each term's last hit with its place among the hits (-1 while there is none) and the sum of 1 / weight before it.
    """

    def step(state: Column, e: Column) -> Column:
        here = F.struct((state["at"] + 1).alias("at"), e["position"].alias("position"), state["upto"].alias("before"))
        return _let(F.transform(state["last"], lambda x, k: F.when(k == e["no"], here).otherwise(x)), lambda last: _let(F.array_min(last), lambda first: after(state, e, last, first)))

    def after(state: Column, e: Column, last: Column, first: Column) -> Column:
        at, upto, found = state["at"] + 1, state["upto"] + e["inverse"], first["at"] > state["begin"]
        hits = at - first["at"] + 1
        foreign = F.greatest(F.lit(0), (e["position"] - first["position"]) - (hits - 1))
        score = F.when(found, hits / (upto - first["before"]) / (1 + foreign)).otherwise(0.0)
        return F.struct(last.alias("last"), F.greatest(state["begin"], first["at"]).alias("begin"), at.alias("at"), upto.alias("upto"), (state["total"] + score).alias("total"))

    none = F.struct(F.lit(-1).alias("at"), F.lit(0).alias("position"), F.lit(0.0).alias("before"))
    start = F.struct(F.array_repeat(none, size).alias("last"), F.lit(-1).alias("begin"), F.lit(-1).alias("at"), F.lit(0.0).alias("upto"), F.lit(0.0).alias("total"))
    return F.aggregate(entries, start, step, lambda state: state["total"])


def cover_density_many(index: DataFrame, terms: DataFrame, labels: dict[str, float] | None = None) -> DataFrame:
    """(query_id, doc, rank) of the documents that match queries of any number of terms; positions are gathered for those
    alone, a row a posting."""
    inverse = F.create_map(*[F.lit(x) for label, w in (labels or LABELS).items() for x in (label, 1.0 / w)])
    found = match_many(index, terms).join(terms, "query_id").join(index, ["term", "doc"])
    each = found.select("query_id", "doc", "size", "no", "positions", inverse[F.col("weight")].alias("inverse"))
    hits = F.transform("positions", lambda p: F.struct(p.alias("position"), F.col("no"), F.col("inverse")))
    entries = each.select("query_id", "doc", "size", hits.alias("hits")).groupBy("query_id", "doc", "size").agg(F.sort_array(F.flatten(F.collect_list("hits"))).alias("entries"))
    return entries.select("query_id", "doc", density(F.col("entries"), F.col("size")).alias("rank"))


def cover_density(index: DataFrame, terms: Sequence[str], labels: dict[str, float] | None = None) -> DataFrame:
    """(doc, rank) of the documents that hold all the terms, whose postings are read, or made, once."""
    rows = [(0, len(set(terms)), i, t) for i, t in enumerate(sorted(set(terms)))]
    asked = index.sparkSession.createDataFrame(rows, "query_id int, size int, no int, term string")
    held = _written(index.filter(F.col("term").isin(*terms)) if terms else index.limit(0), "held")
    return cover_density_many(held, asked, labels).select("doc", "rank")


def ranked_many(docs: DataFrame, title_index: DataFrame, content_index: DataFrame, terms: DataFrame, **filters) -> DataFrame:
    """(query_id, id, relevance, in_content): four times the title's density, and a tenth for a match in the text, to nine
    digits, so that ties don't hang on the order in which scores were added."""
    titles = cover_density_many(title_index, terms)
    texts = match_many(content_index, terms).withColumn("bonus", F.lit(0.1))
    both = titles.join(texts, ["query_id", "doc"], "full").withColumnRenamed("doc", "id")
    found = both.join(filter_documents(docs, **filters).select("id"), "id")
    relevance = F.round(F.coalesce("rank", F.lit(0.0)) * 4.0 + F.coalesce("bonus", F.lit(0.0)), 9)
    return found.select("query_id", "id", relevance.alias("relevance"), F.col("bonus").isNotNull().alias("in_content"))


# --- snippets


def _extent(begin: Column, end: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """A fragment around the words [begin, end): LEAST_WORDS at least where [low, high) has so many, evenly on both sides."""
    size = F.greatest(end - begin, F.least(F.lit(LEAST_WORDS), high - low))
    first = F.greatest(low, F.least(begin - F.floor((size - (end - begin)) / 2).cast("int"), high - size))
    return first, first + size


def _best(stretches: DataFrame, by: list[str]) -> DataFrame:
    """The best stretch of each row: most distinct terms, then most hits, then fewest words, then the earliest."""
    top = F.max(F.struct("distinct", "hits", (F.col("begin") - F.col("end")).alias("short"), (-F.col("begin")).alias("early"), "begin", "end")).alias("top")
    return stretches.groupBy(*by).agg(top).select(*by, "top.begin", "top.end")


def headline(page: DataFrame, terms: DataFrame, analyzer: str = "simple") -> DataFrame:
    """Snippets (query_id, id, snippet) of rows (query_id, id, content_text) for their queries' terms.

    From each hit on, the hits within MOST_WORDS words make a stretch. The best one is the first fragment and the best of
    those that don't meet it the second; both are widened to LEAST_WORDS words, then shown in the order of the text with
    their hits marked and `` ... `` between. Texts are taken whole. Rows without a hit have no snippet.
    """
    by = ["query_id", "id"]
    piece = rf"({WORD})([^\p{{L}}\p{{N}}]*)"
    texts = page.select(*by, F.regexp_extract_all("content_text", F.lit(piece), F.lit(0)).alias("pieces"))
    words = texts.select(*by, F.posexplode("pieces").alias("at", "piece")).select(*by, "at", F.explode(tokens(F.col("piece"))).alias("word"))
    hits = _analyzed(words, analyzer).join(terms.select("query_id", "term", "no"), ["query_id", "term"]).select(*by, "at", "no")
    near = Window.partitionBy(*by).orderBy("at").rangeBetween(0, MOST_WORDS - 1)
    stretches = hits.select(*by, F.col("at").alias("begin"), (F.max("at").over(near) + 1).alias("end"), F.size(F.collect_set("no").over(near)).alias("distinct"), F.count(F.lit(1)).over(near).alias("hits"))
    sized = texts.select(*by, F.size("pieces").alias("words"))
    low, high = _extent(F.col("begin"), F.col("end"), F.lit(0), F.col("words"))
    first = _best(stretches, by).join(sized, by).select(*by, "words", low.alias("low"), high.alias("high"))
    others = stretches.join(first, by).filter((F.col("begin") >= F.col("high")) | (F.col("end") <= F.col("low")))
    second = _best(others, by).join(first, by)
    after = F.col("begin") >= F.col("high")
    low2, high2 = _extent(F.col("begin"), F.col("end"), F.when(after, F.col("high")).otherwise(0), F.when(after, F.col("words")).otherwise(F.col("low")))
    fragments = first.select(*by, "low", "high").unionByName(second.select(*by, low2.alias("low"), high2.alias("high")))
    chosen = fragments.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("fragments"))
    marks = hits.groupBy(*by).agg(F.collect_set("at").alias("marks"))

    def shown(f: Column) -> Column:
        inside = F.filter("marks", lambda at: (at >= f["low"]) & (at < f["high"]))

        def one(p: Column, k: Column) -> Column:
            word = F.regexp_extract(p, WORD, 0)
            marked = F.when(F.array_contains(inside, k + f["low"]), F.concat(F.lit("<mark>"), word, F.lit("</mark>"))).otherwise(word)
            return F.when(k + f["low"] + 1 == f["high"], marked).otherwise(F.concat(marked, F.substring(p, F.char_length(word) + 1, F.char_length(p))))

        return F.array_join(F.transform(F.slice("pieces", f["low"] + 1, f["high"] - f["low"]), one), "")

    met = chosen.join(marks, by).join(texts, by)
    return met.select(*by, F.array_join(F.transform("fragments", shown), " ... ").alias("snippet"))


# --- pages


def search_many(docs: DataFrame, versions: DataFrame, title_index: DataFrame, content_index: DataFrame, queries: DataFrame, page: int = 1, per_page: int = 20, analyzer: str = "simple", **filters) -> tuple[DataFrame, DataFrame]:
    """Pages of many queries (query_id, text) at once: (rows, facts).

    Rows have query_id, place (from 1), id, title, citation, source_url, relevance, in_content, has_content and snippet
    (null unless the text matches), best first, ties by id. Facts have a row for each query that has terms: total and
    total_pages. Matches with their relevance are written once, for totals and pages. Each task keeps the best rows of each
    query before any are shuffled; texts are read for the pages' rows alone, which are written too, so that Spark knows
    their size when it joins them.
    """
    per_page = min(per_page, MOST_PER_PAGE)
    terms = _written(query_terms(queries, analyzer), "terms")
    spark, at = docs.sparkSession, scratch_folder(docs.sparkSession, "pages")
    ranked = ranked_many(docs, title_index, content_index, terms, **filters)
    ranked.write.parquet(f"{at}/found")
    found = spark.read.schema(ranked.schema).parquet(f"{at}/found")
    best = Window.partitionBy("query_id").orderBy(F.desc("relevance"), "id")
    last = max(1, page) * per_page
    kept = found.withColumn("place", F.row_number().over(best)).filter((F.col("place") <= last) & (F.col("place") > last - per_page))
    kept.write.parquet(f"{at}/rows")
    rows = spark.read.schema(kept.schema).parquet(f"{at}/rows")
    latest = latest_of(versions).select(F.col("document_id").alias("id"), "content_text").join(rows.select("id").distinct(), "id")
    texts = latest.groupBy("id").agg(F.first("content_text").alias("content_text"))
    snippets = headline(rows.filter("in_content").select("query_id", "id").join(texts, "id"), terms, analyzer)
    shown = docs.select("id", "title", "citation", "source_url").join(rows, "id").join(texts.select("id", (F.col("content_text") != "").alias("has_content")), "id", "left")
    shown = shown.withColumn("has_content", F.coalesce("has_content", F.lit(False))).join(snippets, ["query_id", "id"], "left")
    counts = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("total"))
    facts = terms.select("query_id").distinct().join(counts, "query_id", "left").select("query_id", F.coalesce("total", F.lit(0)).alias("total"))
    return shown, facts.withColumn("total_pages", F.greatest(F.lit(1), F.ceil(F.col("total") / per_page)).cast("long"))


def search(docs: DataFrame, versions: DataFrame, title_index: DataFrame, content_index: DataFrame, text: str, page: int = 1, per_page: int = 20, analyzer: str = "simple", **filters) -> tuple[DataFrame, DataFrame]:
    """(page, facts) of one query. The indexes are read for its terms alone."""
    wanted = F.col("term").isin(*parse_query(text, analyzer)) if parse_query(text, analyzer) else F.lit(False)
    rows, facts = search_many(docs, versions, title_index.filter(wanted), content_index.filter(wanted), one_query(docs.sparkSession, text), page, per_page, analyzer, **filters)
    return rows.drop("query_id", "place"), facts.agg(F.coalesce(F.max("total"), F.lit(0)).alias("total"), F.coalesce(F.max("total_pages"), F.lit(1)).alias("total_pages"))


def browse_or_search(docs: DataFrame, versions: DataFrame, title_index: DataFrame, content_index: DataFrame, text: str | None, page: int = 1, per_page: int = 20, analyzer: str = "simple", **filters) -> tuple[DataFrame, DataFrame]:
    """(page, facts): a blank text browses, any other searches."""
    if not (text or "").strip():
        return browse(docs, versions, page, per_page, **filters)
    return search(docs, versions, title_index, content_index, text, page, per_page, analyzer, **filters)
