import hashlib
import re

from folioflow.llm.decontamination import contamination, decontaminate, digest


def ws(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, ids = ws(text), set(), set()
        for item_id, t in items:
            v = ws(t)
            n = min(10, len(v))
            windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    ids.add(str(item_id))
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_matches_brute_force(spark):
    passage = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    items = [(1, passage), (2, "one two three"), (3, "Été là"), (4, ""), (5, None), (10, "one two three"), (6, " ".join("ab" for _ in range(14))), (7, "x" * 5000 + " y z a b c d e f g h")]
    docs = [
        (1, f"before {passage.upper()} after"), (2, "beta gamma delta epsilon zeta eta theta iota kappa lambda!"), (3, "beta gamma delta epsilon zeta eta theta iota kappa"),
        (4, "x One-two/three one two threes"), (5, None), (6, ""), (7, "--- ..."), (8, "ÉTÉ là été là"), (9, "ab " * 25), (9, "ab " * 25), (10, "word " * 3000 + passage),
        (11, "x" * 5000 + " y z a b c d e f g h"), (12, "clean text of more than ten words that is not in any item at all"),
    ]
    d = spark.createDataFrame([(a, b, 1, "p") for a, b in docs], "doc_id long, text string, n_words int, prints string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((tuple(r) for r in digest(contamination(d, b)).collect()), key=str) == brute(docs, items)
    left = decontaminate(d, b)
    assert left.columns == d.columns and sorted(r.doc_id for r in left.collect()) == [3, 5, 6, 7, 8, 12]


def test_empty(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in digest(contamination(d, none)).collect()] == [(1, 2, 0, 0)]
    assert contamination(d.limit(0), none).collect() == []
