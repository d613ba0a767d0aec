"""Operator 9, benchmark decontamination by winnowing (Schleimer, Wilkerson and Aiken, 2003), in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import ASCII_LOWER, ASCII_UPPER, Scratch, listed

#: All ASCII characters but digits and letters part words.
SEPARATORS = "".join(chr(c) for c in [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def words(text: Column) -> Column:
    """Lower-cases A-Z and gives the words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` in order; none for null."""
    plain = F.translate(F.coalesce(text, F.lit("")), SEPARATORS + ASCII_UPPER, " " * len(SEPARATORS) + ASCII_LOWER)
    return F.array_remove(F.split(plain, " "), "")


def _places(count: Column) -> Column:
    """0, 1, ... count - 1, or nothing."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def _gram_hashes(row: str, k: int) -> Column:
    """The hash of every k consecutive words of the array column ``row``."""
    return F.transform(_places(F.size(row) - k + 1), lambda i: F.xxhash64(*[F.get(F.col(row), i + d) for d in range(k)]))


def with_fingerprints(df: DataFrame, k: int, span: int, short: list[int], whole_short: bool = False) -> DataFrame:
    """Adds ``prints`` to rows with an array ``ws`` of words: the smallest k-gram hash of every window of
    span - k + 1 neighbouring k-grams, so that two texts sharing ``span`` words in a row share a print. Spans shorter
    than that have no such guarantee; for each length in ``short`` every gram of that length is added instead (for
    items, ``whole_short``: only that of items of just this length)."""
    width = span - k + 1
    df = df.withColumn("hs", _gram_hashes("ws", k))
    least = F.transform(_places(F.size("hs") - width + 1), lambda i: F.least(*[F.get(F.col("hs"), i + d) for d in range(width)]) if width > 1 else F.get(F.col("hs"), i))
    prints = F.array_distinct(least)
    for n in short:
        extra = _gram_hashes("ws", n)
        prints = F.concat(prints, F.when(F.size("ws") == n, extra).otherwise(F.array().cast("array<bigint>")) if whole_short else F.array_distinct(extra))
    return df.withColumn("prints", prints).drop("hs")


def _grams(n: int) -> Column:
    """Every n consecutive words of ``ws``, joined by spaces, which no word holds."""
    return F.transform(_places(F.size("ws") - n + 1), lambda i: F.array_join(F.slice("ws", i + 1, n), " "))


def _windows(df: DataFrame, keys: list[str], lengths: list[int], whole_short: bool, span: int) -> DataFrame:
    """Rows (keys, pos, len, gram): the word windows of the given lengths."""
    out = None
    for n in lengths:
        own = df.filter(F.size("ws") == n) if whole_short and n < span else df
        part = own.select(*keys, F.posexplode(_grams(n)).alias("pos", "gram")).withColumn("len", F.lit(n))
        out = part if out is None else out.unionByName(part)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = 10, k: int = 5, scratch: Scratch | None = None) -> DataFrame:
    """Which words of documents (doc_id, text) lie in a window of a benchmark item (item_id, text).

    A window is ``span`` consecutive item words, or the whole item when it has fewer. Returns per document row doc_id,
    text_md5, n_words, n_hit (words inside an occurrence of a window), item_ids (sorted as strings, each once) and
    contaminated. Winnowed fingerprints of both sides are joined; the windows of the documents that share one are then
    compared word by word, so nothing depends on hashes being unlike. Null texts and texts without words have no
    windows and no hits; items without words hit nothing; repeated items count once by item_id, and a null item_id is
    left out of item_ids though its words hit. Repeated document rows each get their row. Only doc_id and text are
    read, so other columns may have any name.

    The documents' fingerprints meet those of the benchmark by a join that Spark broadcasts only if the latter's file
    is below its threshold. Nothing is ever paired within the documents, so passages that many of them share are as
    cheap as others.
    """
    if not 1 <= k <= span:
        raise ValueError("k must be between 1 and span")
    own = scratch or Scratch(docs.sparkSession, "decontamination")
    items = own.table(benchmark.select("item_id", words(F.col("text")).alias("ws")).filter(F.size("ws") > 0))
    short = sorted(r.n for r in items.select(F.size("ws").alias("n")).filter(F.col("n") < span).distinct().collect())
    lengths = [span, *short]
    item_prints = own.table(with_fingerprints(items, k, span, short, whole_short=True).select(F.explode("prints").alias("print")).distinct())
    item_windows = own.table(_windows(items, ["item_id"], lengths, True, span).groupBy("gram").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    window_hashes = own.table(item_windows.select(F.xxhash64("gram").alias("hash")).distinct())

    base = docs.select("doc_id", F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_md5"), words(F.col("text")).alias("ws"))
    printed = own.table(with_fingerprints(base, k, span, short).select("doc_id", "text_md5", F.size("ws").alias("n_words"), "prints"))
    suspects = own.table(printed.select("doc_id", "text_md5", F.explode("prints").alias("print")).join(item_prints, "print", "left_semi").select("doc_id", "text_md5").distinct())

    same = lambda a, b: a.doc_id.eqNullSafe(b.doc_id) & (a.text_md5 == b.text_md5)
    texts = docs.select("doc_id", "text", F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_md5"))
    texts = texts.join(listed(suspects), same(texts, suspects), "left_semi").dropDuplicates(["doc_id", "text_md5"]).select("doc_id", "text_md5", words(F.col("text")).alias("ws"))
    windows = _windows(texts, ["doc_id", "text_md5"], lengths, False, span).withColumn("hash", F.xxhash64("gram"))
    hits = windows.join(window_hashes, "hash", "left_semi").join(item_windows, "gram")

    def cover(at: Column, x: Column) -> Column:
        end = x["pos"] + x["len"]
        return F.struct(F.greatest(at["end"], end).alias("end"), (at["n"] + F.greatest(F.lit(0), end - F.greatest(at["end"], x["pos"]))).alias("n"))

    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    found = hits.groupBy("doc_id", "text_md5").agg(F.sort_array(F.collect_set(F.struct("pos", "len"))).alias("spans"), F.flatten(F.collect_set("items")).alias("ids"))
    found = own.table(found.select("doc_id", "text_md5", F.aggregate("spans", start, cover)["n"].cast("long").alias("n_hit"), F.array_sort(F.array_distinct(F.transform("ids", lambda x: x.cast("string")))).alias("item_ids")))
    none = F.array().cast("array<string>")
    joined = printed.select(F.col("doc_id"), F.col("text_md5"), F.col("n_words").cast("long").alias("n_words")).alias("d").join(found.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.text_md5") == F.col("f.text_md5")), "left")
    result = own.keep(joined.select("d.doc_id", "d.text_md5", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("item_ids", none).alias("item_ids"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))
    own.clear()
    return result


def decontaminate(docs: DataFrame, benchmark: DataFrame, span: int = 10, k: int = 5) -> DataFrame:
    """The documents, all columns, without a word inside a window of a benchmark item. Texts without words, null texts
    and null doc_ids are judged as any other row: by their text. Of repeated rows all go or all stay. Columns may have any
    name. An empty table gives an empty one; an empty benchmark takes nothing away."""
    own = Scratch(docs.sparkSession, "contaminated")
    found = contamination(docs, benchmark, span, k, own).filter("contaminated").select("doc_id", "text_md5").distinct()
    found = own.keep(found)
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_md5"))
    hit = rows["doc_id"].eqNullSafe(found["doc_id"]) & (rows["text_md5"] == found["text_md5"])
    return rows.join(listed(found), hit, "left_anti").select("row.*")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``contamination``."""
    ids = F.col("item_ids")
    return found.select("doc_id", "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
bl AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(ws, i + 1, i + n), ' ') AS gram FROM (SELECT item_id, ws, n, unnest(range(len(ws) - n + 1)) AS i FROM bl)),
ns AS (SELECT DISTINCT n FROM bl),
dw AS (SELECT doc_id, n, i, array_to_string(list_slice(ws, i + 1, i + n), ' ') AS gram FROM (SELECT doc_id, ws, n, unnest(range(len(ws) - n + 1)) AS i FROM d, ns WHERE len(ws) >= n)),
h AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.gram = bw.gram AND dw.n = bw.n),
p AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM (SELECT DISTINCT doc_id, i, n FROM h)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(p.n_hit, 0)::BIGINT AS n_hit, coalesce(t.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""
