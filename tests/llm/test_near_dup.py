import random
import re

import numpy as np
import pandas as pd

from folioflow.llm import near_dup
from folioflow.llm.near_dup import keep_one, near_duplicates, shingles


def grams(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [(i, grams(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets)


def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, n = [], 0
    for _ in range(40):
        base = [word() for _ in range(rng.choice([3, 6, 30, 200]))]
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((n, " ".join(copy)))
            n += 1
    chain = [word() for _ in range(150)]  # a chain of copies, each near the next alone
    for k in range(12):
        rows.append((n, " ".join(chain)))
        n += 1
        chain[k * 12] = word()
        chain[k * 12 + 6] = word()
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "A b"), (n + 4, "a\x0bB"), (n + 5, "b a"), (n + 6, "É x y"), (n + 7, "é x y"), (n + 8, "long " * 50000), (n + 9, "LONG " * 6)]
    rng.shuffle(rows)
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, cls string, n int").repartition(5)
    got = near_duplicates(docs).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)
    kept = keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [r[0] for r in brute(rows) if r[3]]


def test_large_buckets_go_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "FEW_PAIRS", 0)
    monkeypatch.setattr(near_dup, "BLOCK", 3)
    monkeypatch.setattr(near_dup, "STAR_ROUNDS", 1)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in near_duplicates(docs).collect()) == brute(rows)


def test_block_comparison():
    rng = random.Random(5)
    texts = [" ".join(rng.choice("ab") + str(k) for k in range(40)) for _ in range(60)]
    sets = [shingles(t).view(np.int64) for t in texts]
    block = pd.DataFrame({"cls": [bytes([i]) for i in range(60)], "component": [bytes([i]) for i in range(60)], "grams": sets})
    for percent in (2, 10, 75):
        got = {(a[0], b[0]) for a, b in near_dup._compare(percent)(block, block).itertuples(index=False)}
        s = [set(x.tolist()) for x in sets]
        assert got == {(i, j) for i in range(60) for j in range(60) if i != j and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j])}


def test_estimates_of_small_sets():
    rng = np.random.default_rng(6)
    got = []
    for _ in range(3000):
        four = rng.integers(0, 2**64, 4, np.uint64)
        a, b = (near_dup._planes(near_dup.minima(x)).reshape(near_dup.BITS, -1) for x in (four, four[:3]))
        unlike = np.bitwise_count(np.bitwise_or.reduce(a ^ b, axis=0).view(np.uint64)).sum()
        got.append(((1 - unlike / near_dup.MINIMA) - 0.25) / 0.75)
    assert abs(np.mean(got) - 0.75) < 0.005 and np.std(got) < 0.04


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (3, "q r s t u v"), (1, "q r s t u v"), (None, "a b c d e f g"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(near_duplicates(docs).collect(), key=str)
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(1, 1, True), (2, 1, False), (3, 1, False), (None, None, True), (9, 9, True)} and len(got) == 7
    # One row of each group of texts: unlike texts of one doc_id are groups of their own, a null id is no shield.
    assert sorted((r.doc_id, r.text or "") for r in keep_one(docs).collect()) == [(1, "a b c d e f g"), (1, "q r s t u v"), (9, "")]


def test_keep_one_takes_extra_columns_of_clashing_names_and_repeated_rows(spark):
    rows = [(5, "a b c d e f g", "x", {"k": 1}), (5, "a b c d e f g", "y", {"k": 2}), (None, "a b c d e f g", "z", None), (None, "u v w", "z", None), (None, "u v w", "z", None), (7, " ", "t", None), (8, None, "t", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, key map<string,int>")
    found = keep_one(docs)
    assert found.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in found.collect()), key=str)
    assert got == sorted([(5, "a b c d e f g"), (None, "u v w"), (7, " "), (8, None)], key=str)
    assert sorted(map(str, found.collect())) == sorted(map(str, keep_one(docs.repartition(3)).collect()))
    assert keep_one(docs.limit(0)).collect() == []


def test_empty_and_shingles(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert len(shingles("a b c d e f")) == 2 and len(shingles("a a a a a a a")) == 1 and len(shingles("a b")) == 1 and len(shingles(" ")) == 0
