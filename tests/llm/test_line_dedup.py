import random
import re

import numpy as np

from folioflow.llm.line_dedup import dedup_lines, dedup_report, matched_lines, tokens


def words(line):
    return set(re.findall(r"[^\x20\x09-\x0D]+", line.translate({c: c + 32 for c in range(65, 91)})))


def brute(rows):
    lines = sorted((i, k, words(line)) for i, t in rows if t is not None and i is not None for k, line in enumerate(t.split("\n")))
    out = set()
    for x, (i, k, a) in enumerate(lines):
        if any(a and b and 100 * len(a & b) >= 75 * len(a | b) for _, _, b in lines[:x]):
            out.add((i, k))
    return out


def corpus():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 6)))
    pool = [[word() for _ in range(rng.choice([1, 2, 3, 8, 40]))] for _ in range(40)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(0, 8)):
            line = list(rng.choice(pool)) if rng.random() < 0.7 else [word() for _ in range(rng.randint(1, 12))]
            for _ in range(rng.randint(0, 4)):
                line[rng.randrange(len(line))] = word()
            lines.append(rng.choice([" ", "  ", "\t"]).join(line))
        rows.append((i * 3 - 20, "\n".join(lines)))
    rows += [(1000, None), (1001, ""), (1002, "\n\n"), (1003, "Été x\nété x\nÉTÉ X"), (1004, "w " * 30000 + "\nW\n w"), (1005, " ".join(f"t{k}" for k in range(4000)) + "\n" + " ".join(f"t{k}" for k in range(500, 4000)))]
    rng.shuffle(rows)
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, line int, tokens string").repartition(6)
    want = brute(rows)
    assert {(r.doc_id, r.line) for r in matched_lines(docs).collect()} == want
    report = {r.doc_id: r for r in dedup_report(docs).collect()}
    for i, t in rows:
        gone = sorted(k for d, k in want if d == i)
        n = 0 if t is None else len(t.split("\n"))
        assert (report[i].n_lines, report[i].n_removed, report[i].n_kept, report[i].removed_lines) == (n, len(gone), n - len(gone), ",".join(map(str, gone)))
    left = dedup_lines(docs)
    assert left.columns == docs.columns
    for r in left.collect():
        t = dict(rows)[r.doc_id]
        assert r.text == (t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (r.doc_id, k) not in want))


def test_large_groups_go_through_blocks_and_rounds(spark):
    rng = random.Random(3)
    base = [f"v{k}" for k in range(20)]
    rows = []
    for i in range(150):
        line = list(base)
        for k in rng.sample(range(20), rng.choice([2, 3, 4])):
            line[k] = f"x{rng.randrange(12)}"
        rows.append((i, " ".join(line)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {(r.doc_id, r.line) for r in matched_lines(docs, few=1, cell=16).collect()} == brute(rows)


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (2, "b a")], "doc_id long, text string")
    assert {(r.doc_id, r.line) for r in matched_lines(docs).collect()} == {(2, 0), (2**63 - 1, 0)}
    assert matched_lines(docs.limit(0)).collect() == [] and dedup_lines(docs.limit(0)).collect() == [] and dedup_report(docs.limit(0)).collect() == []
    assert sorted((str(r.doc_id), r.text) for r in dedup_lines(docs).collect()) == [("1", "a b"), ("1", "a b"), ("2", ""), ("None", "")]


def test_unlike_texts_of_one_id_lose_only_what_is_matched(spark):
    rows = [(0, "the x y z w", 1), (1, "the x y z w", 2), (1, "other words stand here now", 3), (1, "other words stand here now\n\nmore of it", 4), (1, None, 5)]
    left = {r.row: (r.doc_id, r.text) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, row int").repartition(3)).collect()}
    assert left[1] == (0, "the x y z w") and left[2] == (1, "") and left[5] == (1, None)
    assert sorted([left[3][1], left[4][1]]) in (["", "other words stand here now\n\nmore of it"], ["\nmore of it", "other words stand here now"])
    report = sorted((r.doc_id, r.n_lines, r.n_removed, r.n_kept) for r in dedup_report(spark.createDataFrame(rows, "doc_id long, text string, row int")).collect())
    assert report in ([(0, 1, 0, 1), (1, 0, 0, 0), (1, 1, 0, 1), (1, 1, 1, 0), (1, 3, 1, 2)], [(0, 1, 0, 1), (1, 0, 0, 0), (1, 1, 1, 0), (1, 1, 1, 0), (1, 3, 0, 3)])


def test_rows_without_an_id(spark):
    rows = [(5, "one two three", "x")] + [(None, "four five six\n \none two three", "x")] * 3 + [(None, "four five six\n \none two three", "y"), (None, "lone line here", None), (None, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(4)
    left = [(r.doc_id, r.text) for r in dedup_lines(docs).collect()]
    assert sorted(left, key=str) == sorted([(5, "one two three"), (None, "lone line here"), (None, None), (None, "four five six\n ")] + [(None, " ")] * 3, key=str)
    report = sorted((str(r.doc_id), r.n_lines, r.n_removed, r.removed_lines) for r in dedup_report(docs).collect())
    assert report == sorted([("5", 1, 0, ""), ("None", 3, 1, "2"), ("None", 1, 0, ""), ("None", 0, 0, "")] + [("None", 3, 2, "0,2")] * 3)


def test_token_hashes():
    texts = ["Ab c\n\nab", "", "ab", "x\ry\n"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    starts = np.cumsum([0, *map(len, texts)])[:-1]
    hashed, line, first = tokens(data, starts)
    assert line.tolist() == [0, 0, 2, 4, 5, 5] and first.tolist() == [0, 3, 4, 5]
    assert hashed[0] == hashed[2] == hashed[3] and len(set(hashed.tolist())) == 4
