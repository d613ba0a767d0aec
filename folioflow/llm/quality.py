"""Operator 7, quality classifier: a generalised additive model with pairwise interactions (Lou et al., 2013)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import Scratch

SPACE, LOWER, UPPER, DIGIT, HIGH, STOP, MARK = range(7)
NAMES = (
    "log_bytes", "log_words", "mean_word", "upper", "digit", "mark", "stop", "high", "top_mark", "mark_kinds", "marked_words",
    "bare_marks", "short_words", "long_words", "new_words", "new_lines", "line_words", "double_marks", "upper_starts",
)


def _byte_kinds() -> np.ndarray:
    kind = np.full(256, MARK, np.uint8)
    kind[[9, 10, 11, 12, 13, 32]] = SPACE
    kind[ord("a") : ord("z") + 1], kind[ord("A") : ord("Z") + 1], kind[ord("0") : ord("9") + 1] = LOWER, UPPER, DIGIT
    kind[128:], kind[[ord("."), ord(",")]] = HIGH, STOP
    return kind


_KIND = _byte_kinds()


def features(text: str | None) -> np.ndarray:
    """The features of a whole text; all 0 for null and empty texts."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(len(NAMES))
    if not raw:
        return out
    data = np.frombuffer(raw, np.uint8)
    kind = _KIND[data]
    by_byte, by_kind = np.bincount(data, minlength=256), np.bincount(kind, minlength=7)
    marks = by_byte[_KIND == MARK]
    n, solid = len(data), max(1, len(data) - by_kind[SPACE])
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    count = max(1, len(words))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], kind == SPACE, [True]]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2] - 1
    first, last = kind[starts] if len(starts) else kind[:0], kind[ends] if len(ends) else kind[:0]
    out[:] = (
        np.log1p(n), np.log1p(len(words)), solid / count, by_kind[UPPER] / solid, by_kind[DIGIT] / solid, by_kind[MARK] / solid, by_kind[STOP] / count,
        by_kind[HIGH] / solid, marks.max(initial=0) / count, np.count_nonzero(marks), np.count_nonzero(last == MARK) / count,
        np.count_nonzero((last == MARK) & (ends == starts)) / count, np.count_nonzero(lengths <= 3) / count, np.count_nonzero(lengths >= 15) / count,
        len(set(words)) / count, len(set(lines)) / max(1, len(lines)), count / max(1, len(lines)),
        np.count_nonzero((kind[1:] == MARK) & (data[1:] == data[:-1])) / count, np.count_nonzero(first == UPPER) / count,
    )
    return out


def feature_matrix(texts) -> np.ndarray:
    return np.stack([features(t) for t in texts]) if len(texts) else np.zeros((0, len(NAMES)))


@dataclass
class Model:
    """Lookup tables: bin edges and one value a bin for each feature, coarse edges and a grid for each pair."""

    base: float
    edges: list[np.ndarray]
    values: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    grids: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        """The chance of label 1 by row: bin lookups and additions over whole columns."""
        total = np.full(len(x), self.base)
        for j, (e, v) in enumerate(zip(self.edges, self.values, strict=True)):
            total += v[np.searchsorted(e, x[:, j], side="right")]
        if self.pairs:
            wide = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.coarse)]
            for (a, b), g in zip(self.pairs, self.grids, strict=True):
                total += g[wide[a], wide[b]]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -35.0, 35.0)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int, calm: float) -> np.ndarray:
    """Newton steps of a shallow tree over the bins of one feature: splits taken greedily by gain."""
    parts = [(0, len(grad))]
    for _ in range(leaves - 1):
        best = (1e-9, None, 0)
        for k, (lo, hi) in enumerate(parts):
            g, h = np.cumsum(grad[lo:hi]), np.cumsum(hess[lo:hi])
            if hi - lo < 2:
                continue
            gain = g[:-1] ** 2 / (h[:-1] + calm) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + calm) - g[-1] ** 2 / (h[-1] + calm)
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (gain[at], k, lo + at + 1)
        if best[1] is None:
            break
        lo, hi = parts[best[1]]
        parts[best[1] : best[1] + 1] = [(lo, best[2]), (best[2], hi)]
    step = np.empty(len(grad))
    for lo, hi in parts:
        step[lo:hi] = grad[lo:hi].sum() / (hess[lo:hi].sum() + calm)
    return step


def _quadrants(grad: np.ndarray, hess: np.ndarray, calm: float) -> tuple[float, np.ndarray]:
    """The best cross-shaped cut of a grid of bins, its gain and the Newton step of each quadrant."""
    g, h = grad.cumsum(0).cumsum(1), hess.cumsum(0).cumsum(1)

    def corners(s):
        a = s[:-1, :-1]
        b, c = s[:-1, -1:] - a, s[-1:, :-1] - a
        return a, b, c, s[-1, -1] - a - b - c

    if min(grad.shape) < 2:
        return 0.0, np.zeros_like(grad)
    gs, hs = corners(g), corners(h)
    gain = sum(x**2 / (y + calm) for x, y in zip(gs, hs, strict=True)) - g[-1, -1] ** 2 / (h[-1, -1] + calm)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    step = np.empty_like(grad)
    spans = ((slice(None, i + 1), slice(None, j + 1)), (slice(None, i + 1), slice(j + 1, None)), (slice(i + 1, None), slice(None, j + 1)), (slice(i + 1, None), slice(j + 1, None)))
    for (r, c), x, y in zip(spans, gs, hs, strict=True):
        step[r, c] = x[i, j] / (y[i, j] + calm)
    return float(gain[i, j]), step


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 80, pair_rounds: int = 30, pairs: int = 8, rate: float = 0.15, bins: int = 48, wide: int = 8, leaves: int = 4, calm: float = 2.0) -> Model:
    """Cyclic boosting: in each round every feature in turn gets one shallow tree added to its table, so that no
    feature hides another; then the pairs that gain most on what is left get theirs. With rows of one class alone, or
    none, the score is that class's share, or 0.5."""
    width = x.shape[1]
    share = float(y.mean()) if len(y) else 0.5
    model = Model(float(np.log((share * len(y) + 0.5) / ((1 - share) * len(y) + 0.5))), [np.empty(0)] * width, [np.zeros(1)] * width, [np.empty(0)] * width, [], [])
    if len(y) < 2 or share in (0.0, 1.0):
        return model
    model.edges, model.coarse = [_edges(c, bins) for c in x.T], [_edges(c, wide) for c in x.T]
    model.values = [np.zeros(len(e) + 1) for e in model.edges]
    at = [np.searchsorted(e, c, side="right") for e, c in zip(model.edges, x.T, strict=True)]
    total = np.full(len(y), model.base)

    def slopes():
        p = 1.0 / (1.0 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(width):
            grad, hess = slopes()
            n = len(model.values[j])
            step = rate * _tree(np.bincount(at[j], grad, n), np.bincount(at[j], hess, n), leaves, calm)
            model.values[j] = model.values[j] + step
            total += step[at[j]]
    low = [np.searchsorted(e, c, side="right") for e, c in zip(model.coarse, x.T, strict=True)]
    size = [len(e) + 1 for e in model.coarse]

    def grid(a, b, weight):
        return np.bincount(low[a] * size[b] + low[b], weight, size[a] * size[b]).reshape(size[a], size[b])

    grad, hess = slopes()
    gains = sorted(((_quadrants(grid(a, b, grad), grid(a, b, hess), calm)[0], a, b) for a in range(width) for b in range(a)), reverse=True)
    model.pairs = [(a, b) for gain, a, b in gains[:pairs] if gain > 0]
    model.grids = [np.zeros((size[a], size[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(model.pairs):
            grad, hess = slopes()
            step = rate * _quadrants(grid(a, b, grad), grid(a, b, hess), calm)[1]
            model.grids[k] = model.grids[k] + step
            total += step[low[a], low[b]]
    return model


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = feature_matrix(batch.column(1).to_pylist())
        ends = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.float64()), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], ["y", "x"])


def held_out(doc_id: str = "doc_id"):
    """Rows that no label is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000) -> Model:
    """Fits on documents (doc_id, text) with a non-null quality in labels (doc_id, quality), never on held-out ids.

    At most about ``most_rows`` labelled ids are used, chosen by a hash of doc_id. An id's quality is the mean of its
    labels, 1 from 0.5 on. Only features and labels of these rows go to the driver, where the model is fitted.
    """
    own = Scratch(docs.sparkSession, "quality")
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    known = own.table(known)
    n = known.count()
    if n > most_rows:
        known = own.table(known.filter(F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(n)) < most_rows))
    rows = docs.select("doc_id", "text").join(known, "doc_id").select("y", "text").mapInArrow(_measure, "y double, x array<double>").toPandas()
    own.clear()
    x, y = np.stack(rows["x"].to_list()) if len(rows) else np.zeros((0, len(NAMES))), rows["y"].to_numpy(float)
    order = np.lexsort((*x.T[::-1], y))  # tasks end in any order; float sums shall not depend on it
    return fit(x[order], y[order])


def score_of(text: Column, model: Model) -> Column:
    """The score of each whole text, 0 to 1; null texts score as empty ones."""

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(model.score(feature_matrix(texts.to_list())))

    return scored(text)


def with_score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """Adds ``score_of`` the text. Map-side; a column of that name is replaced, others are kept whatever they are called.
    Rows with equal texts get equal scores; an empty table gives an empty one."""
    return docs.withColumn(column, score_of(F.col("text"), model))


def assess(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Scores every document: doc_id, held_out, score and predicted (1 from 0.5 on). Only doc_id, text and quality are
    read; repeated rows each get their row; an empty table gives an empty result."""
    scored = with_score(docs.select("doc_id", "text"), train(docs, labels, **options))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents, all columns, that the classifier predicts as label 1: a score of 0.5 stays. Null texts are judged as
    empty ones; of repeated rows all go or all stay; columns may have any name; an empty table gives an empty one."""
    return docs.filter(score_of(F.col("text"), train(docs, labels, **options)) >= 0.5)
