"""Operator 3, language identification by compression with zstandard raw-content dictionaries."""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import zip_longest

import pandas as pd
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Row counts by language are broadcast up to this many languages, so that no text is shuffled by language.
FEW_LANGUAGES = 10_000
_APART = regex.compile(r"[^\p{L}\p{M}]+")


def letters(text: str) -> str:
    """The text's letters in lower case, all else as single spaces, with a space at both ends: what is compressed."""
    return f" {_APART.sub(' ', text.lower()).strip()} "


def held_out(doc_id: str = "doc_id"):
    """Rows that nothing is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def _pieces(text: str, seed: int, piece: int, most: int) -> list[bytes]:
    """Up to ``most`` pieces of the whole letter string, at places that the seed chooses and in its order."""
    raw = letters(text).encode("utf-8", "surrogatepass")
    n = -(-len(raw) // piece)
    return [raw[i * piece : (i + 1) * piece] for i in random.Random(seed).sample(range(n), min(n, most))]


def train(docs: DataFrame, dictionary_bytes: int = 131_072, sample_rows: int = 400) -> dict[str, bytes]:
    """A raw-content dictionary for each non-null language of documents (doc_id, text, lang) that aren't held out.

    A bounded sample of rows with letters is read: at most ``sample_rows`` a language, by a hash of doc_id and text.
    Rows of equal text count once. Each row's whole letter string is cut into pieces of a 512th of the dictionary (64
    bytes at least), and up to a 32nd of the dictionary is taken of them, at places chosen by a hash of the text. One
    rule fills every dictionary: the first piece of each row, then the second of each, until it is full. Shorter
    samples make shorter dictionaries; a language whose texts have no letters is not learned. Languages with more rows
    come first.
    """
    known = docs.filter(F.col("lang").isNotNull() & ~held_out() & F.col("text").rlike(r"\p{L}"))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    piece = max(64, dictionary_bytes // 512)
    most = max(1, dictionary_bytes // 32 // piece)

    @F.pandas_udf("array<binary>")
    def cut(texts: pd.Series, seeds: pd.Series) -> pd.Series:
        return pd.Series([_pieces(t, s, piece, most) for t, s in zip(texts, seeds, strict=True)], dtype=object)

    hashed = known.select("lang", "text", F.xxhash64(F.lit("lang"), "doc_id", "text").alias("by"), F.xxhash64("text").alias("same"))
    # Twice as many rows as needed pass before the limit, so that the window sees few.
    some = hashed.join(F.broadcast(counts) if counts.count() <= FEW_LANGUAGES else counts, "lang").filter(F.pmod("by", "n") < 2 * sample_rows)
    once = some.select("lang", "n", "by", "same", cut("text", "same").alias("pieces")).groupBy("lang", "n", "same").agg(F.min("by").alias("by"), F.first("pieces").alias("pieces"))
    order = Window.partitionBy("lang").orderBy("by", "same")
    rows = once.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= sample_rows).collect()
    rows.sort(key=lambda r: (-r.n, r.lang, r.at))
    found: dict[str, list[list[bytes]]] = {}
    for r in rows:
        found.setdefault(r.lang, []).append(r.pieces)
    turns = {lang: [p for turn in zip_longest(*lists) for p in turn if p] for lang, lists in found.items()}
    return {lang: b"".join(dict.fromkeys(map(bytes, parts)))[:dictionary_bytes] for lang, parts in turns.items()}


class Classifier:
    """Sizes of a text under each language's dictionary, in pieces so that the dictionary and not the text's own past
    decides, however long it is."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = 5, piece: int = 16_384):
        self.piece = piece
        self.langs = list(dictionaries)
        self.makers = []
        for lang in self.langs:
            known = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=level)
            self.makers.append(zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        raw = letters(text).encode("utf-8", "surrogatepass")
        parts = [raw[i : i + self.piece] for i in range(0, len(raw), self.piece)]
        return [sum(len(c.compress(p)) for p in parts) for c in self.makers]

    def __call__(self, text: str | None) -> tuple[str, float]:
        """The language of the smallest size (ties: the one with more rows to learn from) and the margin to the next, 0 to 1."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        rest = min((s for i, s in enumerate(sizes) if i != best), default=None)
        return self.langs[best], 1.0 if rest is None else 1.0 - sizes[best] / rest


def identify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = 0.02) -> DataFrame:
    """Adds to documents (doc_id, text): lang_best (the learned language of the smallest encoding; 'und' for null and
    texts without letters), score (how much smaller than the next, 0 to 1) and lang (lang_best, or 'und' where the
    score is under ``min_margin``). Whole texts are read, by the text alone; map-side, no shuffle. Where two languages'
    encodings are of one size, the one with more rows to learn from is best, with a score of 0. Repeated rows each get
    their row and equal texts equal answers. Without dictionaries all are 'und'; an empty table gives an empty one. Columns
    of these names are replaced."""

    @F.pandas_udf("lang string, score double")
    def guess(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classify = Classifier(dictionaries)
        for texts in parts:
            yield pd.DataFrame([classify(t) for t in texts], columns=["lang", "score"])

    kept = [c for c in docs.columns if c.lower() not in {"lang_best", "lang", "score"}]
    found = docs.select(*[docs[c] for c in kept], guess(docs["text"]).alias("__guess"))
    best, score = F.col("__guess.lang"), F.col("__guess.score")
    return found.select(*kept, best.alias("lang_best"), score.alias("score"), F.when(score < min_margin, UNKNOWN).otherwise(best).alias("lang"))
