"""Operator 4, token counts by a map-side lookup in two tiers."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Fixed value: the pre-token pattern of the byte-level vocabulary.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Characters that every Unicode version since long ago puts in the same class; texts with others are encoded whole.
SETTLED = regex.compile(r"[\u0000-՗֐-״ؠ-يऄ-हก-ฮ‐-‧‰-⁞€　-ゖァ-ヺ一-龥가-힣]*+")

_workers: dict[str, Counted] = {}


class Counted:
    """A worker's tokenizer and its cache of pre-token lengths, kept from task to task and bounded."""

    def __init__(self, path: str, frequent: dict[str, int], most: int = 400_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.frequent, self.most = frequent, most
        self.known = dict(frequent)

    def encoded(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def plain(self, text: str) -> bool:
        return SETTLED.fullmatch(text) is not None and not any(s in text for s in self.special)

    def counts(self, texts: list[str | None], group: int = 1 << 20) -> list[int]:
        """Token counts of whole texts, in groups of about ``group`` characters."""
        out, held, size = [], [], 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= group:
                out += self._group(held)
                held, size = [], 0
        return out + self._group(held)

    def _group(self, texts: list[str]) -> list[int]:
        out, split, missing = [0] * len(texts), {}, set()
        for i, text in enumerate(texts):
            if self.plain(text):
                split[i] = PATTERN.findall(text)
                missing.update(split[i])
            else:
                out[i] = self.encoded([text])[0]
        if len(self.known) > self.most:
            self.known = dict(self.frequent)
        missing = list(missing.difference(self.known))
        if missing:
            self.known.update(zip(missing, self.encoded(missing), strict=True))
        get = self.known.__getitem__
        for i, parts in split.items():
            out[i] = sum(map(get, parts))
        return out


def worker(path: str, frequent: dict[str, int]) -> Counted:
    if path not in _workers:
        _workers[path] = Counted(path, frequent)
    return _workers[path]


def frequent_lengths(docs: DataFrame, path: str, entries: int = 16_384, longest: int = 64) -> dict[str, int]:
    """Token counts of the ``entries`` most frequent pre-tokens of all documents.

    Each task counts the pieces between blanks of its whole texts, cuts each distinct piece into pre-tokens once, and
    sends its most frequent ones, 4 x ``entries`` at most; they are added up by pre-token, and no text is shuffled.
    Pieces above ``longest`` characters are cut where they stand. A task holds 60 x ``entries`` pieces and as many
    pre-tokens at most and forgets the rarest ones beyond that, so a count may fall short of the true one, as it does
    where blanks follow each other. It only says what is looked up first: no result depends on it."""
    most = 20 * entries

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: Counter[str] = Counter()
        seen: Counter[str] = Counter()

        def settle() -> None:
            for piece, n in pieces.items():
                for token in PATTERN.findall(piece):
                    seen[token] += n
            pieces.clear()
            if len(seen) > 3 * most:
                kept = seen.most_common(most)
                seen.clear()
                seen.update(dict(kept))

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    first, *others = text.split(" ")
                    seen.update(PATTERN.findall(first))
                    pieces.update([" " + p for p in others if len(p) < longest])
                    for piece in others:
                        if len(piece) >= longest:
                            seen.update(PATTERN.findall(" " + piece))
                if len(pieces) > most or len(seen) > 3 * most:
                    settle()
        settle()
        top = seen.most_common(4 * entries)
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["token", "n"])

    counted = docs.select("text").mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = [r.token for r in counted.orderBy(F.desc("n"), "token").limit(entries).collect()]
    return dict(zip(top, Counted(path, {}).encoded(top), strict=True)) if top else {}


def count_tokens(docs: DataFrame, path: str, limit: int = 512, **options) -> DataFrame:
    """Counts the tokens of each whole text of documents (doc_id, text): doc_id, n_bytes (UTF-8), n_tokens and
    over_limit (more than ``limit``).

    Null counts as the empty text, 0 tokens. Counts are those of the tokenizer file at ``path``, without special tokens
    added; special strings inside texts are single tokens, as the library has it. A pre-token's count doesn't depend on
    its neighbours, so texts are cut into pre-tokens and looked up: first in a broadcast table of frequent ones, then in
    the worker's cache, which encodes what it misses. Texts with special strings, or with characters on whose class
    Unicode versions differ, are encoded whole. No pre-token is shuffled. Only doc_id and text are read; an empty table
    gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, **options))

    @F.pandas_udf("long")
    def counted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = worker(path, shared.value)
        for texts in parts:
            yield pd.Series(own.counts(texts.to_list()), dtype="int64")

    found = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), counted(F.col("text")).alias("n_tokens"))
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
