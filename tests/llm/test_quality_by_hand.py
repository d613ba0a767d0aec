"""The additive model recomputed with plain Python numbers and loops."""

import bisect
import math
import random

import numpy as np
import pytest

from folioflow.llm import quality


def rows(n=60, seed=3):
    rng = random.Random(seed)
    x = [[rng.choice([0.0, 0.5, rng.random()]), rng.randrange(4) * 1.0, rng.gauss(0, 1)] for _ in range(n)]
    y = [float(a + (b > 1) * c > 0.4) for a, b, c in x]
    return x, y


def test_one_round_of_trees_by_hand():
    """A feature's first tree is the stump that gains most over all cuts of its bins; later features see its step."""
    x, y = rows()
    calm, rate, bins = 2.0, 0.15, 6
    model = quality.fit(np.array(x), np.array(y), rounds=1, pair_rounds=0, pairs=0, rate=rate, bins=bins, leaves=2, calm=calm)
    total = [model.base] * len(x)
    assert model.base == pytest.approx(math.log((sum(y) + 0.5) / (len(y) - sum(y) + 0.5)))
    for j in range(3):
        column = sorted(r[j] for r in x)
        at_rank = lambda q: column[int(q)] + (q - int(q)) * (column[min(int(q) + 1, len(column) - 1)] - column[int(q)])  # noqa: E731, B023
        edges = sorted({at_rank(k / bins * (len(column) - 1)) for k in range(1, bins)})
        assert model.edges[j].tolist() == pytest.approx(edges)
        where = [bisect.bisect_right(model.edges[j].tolist(), r[j]) for r in x]
        p = [1 / (1 + math.exp(-t)) for t in total]
        g, h = [a - b for a, b in zip(y, p, strict=True)], [b * (1 - b) for b in p]
        n = len(edges) + 1

        def step(side):
            return sum(g[i] for i in side) / (sum(h[i] for i in side) + calm)  # noqa: B023

        def gain(side):
            return sum(g[i] for i in side) ** 2 / (sum(h[i] for i in side) + calm)  # noqa: B023

        sides = [([i for i, w in enumerate(where) if w < cut], [i for i, w in enumerate(where) if w >= cut]) for cut in range(1, n)]
        cut = max(range(1, n), key=lambda c: (gain(sides[c - 1][0]) + gain(sides[c - 1][1]), -c))  # noqa: B023
        want = [rate * step(sides[cut - 1][0])] * cut + [rate * step(sides[cut - 1][1])] * (n - cut)
        assert model.values[j].tolist() == pytest.approx(want)
        total = [t + want[w] for t, w in zip(total, where, strict=True)]


def test_scores_bin_by_bin():
    x, y = rows(200, 5)
    model = quality.fit(np.array(x), np.array(y), rounds=10, pair_rounds=5, pairs=2)
    assert model.pairs
    fresh = [*rows(40, 9)[0], [-99.0, 99.0, 0.0], [model.edges[0][0], model.edges[1][0], model.edges[2][0]]]
    got = model.score(np.array(fresh))
    for r, s in zip(fresh, got, strict=True):
        total = model.base + sum(v[bisect.bisect_right(e.tolist(), r[j])] for j, (e, v) in enumerate(zip(model.edges, model.values, strict=True)))
        wide = [bisect.bisect_right(e.tolist(), r[j]) for j, e in enumerate(model.coarse)]
        total += sum(g[wide[a]][wide[b]] for (a, b), g in zip(model.pairs, model.grids, strict=True))
        assert s == pytest.approx(1 / (1 + math.exp(-total)))


def test_a_score_of_one_half_is_kept(spark):
    """Without labels every score is one half: predicted 1, and kept."""
    docs = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert [(r.score, r.predicted) for r in quality.assess(docs, labels).collect()] == [(0.5, 1)] * 3
    assert quality.keep_good(docs, labels).count() == 3


def test_conflicting_labels_of_one_id_take_their_mean(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, q) for k in range(30) for q in ((1, 0, 0) if k % 2 else (1, 1, 0))], "doc_id long, quality int")
    plain = spark.createDataFrame([(k, int(k % 2 == 0)) for k in range(30)], "doc_id long, quality int")
    assert quality.train(docs, labels).score(quality.feature_matrix(["text 1", "x"])).tolist() == quality.train(docs, plain).score(quality.feature_matrix(["text 1", "x"])).tolist()
