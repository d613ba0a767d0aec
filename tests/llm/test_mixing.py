from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from folioflow.llm.mixing import apply_mix, draw_counts, mix, permute, water_fill


def test_water_fill():
    assert water_fill([100, 100, 100], [3, 1, 2], 1.5, 2) == pytest.approx([200, 250 / 3, 500 / 3])
    assert water_fill([10], [3], 1.5, 2) == [15]
    assert water_fill([], [], 1.5, 2) == []
    assert sum(water_fill([1, 1000, 5, 0], [3, 1, 2, 3], 1.5, 2)) == pytest.approx(1509)


def test_draws_meet_quotas():
    quotas = [1000, 1, 0, 333]
    drawn = draw_counts(quotas, 16, 1)
    assert [sum(c) for c in zip(*drawn)] == quotas and all(n >= 0 for row in drawn for n in row)
    assert max(map(sum, drawn)) - min(map(sum, drawn)) <= 1


@pytest.mark.parametrize("n", [1, 2, 3, 17, 100, 5000])
def test_permutation(spark, n):
    import math

    side = math.isqrt(n - 1) + 1
    df = spark.range(n).select(permute(F.col("id"), F.lit(n).cast("long"), F.lit(side).cast("long"), F.lit(1)).alias("p"))
    got = [r.p for r in df.collect()]
    assert sorted(got) == list(range(n)) and (n < 10 or got != sorted(got))


def corpus(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 90)), f"s{i % 3}" if i % 3 else "hot") for i in range(3000)]
    rows += [(5000, None, "s1"), (5001, "a b c", None), (5001, "a b c", None), (5002, "x " * 20000, "s2"), (5003, "", "zero"), (None, "q r", "é")]
    return rows, spark.createDataFrame([(*r, 9, 9) for r in rows], "doc_id long, text string, source string, block int, no int")


def test_mix(spark):
    rows, docs = corpus(spark)
    got = mix(docs, block=16, rows_per_bucket=50).collect()
    assert sorted((r.doc_id or -1, r["size"]) for r in got) == sorted((i or -1, len((t or "").split())) for i, t, _ in rows)
    total, taken = defaultdict(int), defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        total[r.source] += r["size"]
        taken[r.source] += r.taken
    order = sorted((s for s in total if s is not None)) + [None]
    want = dict(zip(order, water_fill([total[s] for s in order], [[3, 1, 2][i % 3] for i in range(len(order))], 1.5, 2), strict=True))
    for r in got:
        assert r.source_size == total[r.source] and r.target == pytest.approx(want[r.source])
    for s in order:
        assert abs(taken[s] - want[s]) <= max(32, 0.03 * want[s])
    again = mix(docs.repartition(7), block=16, rows_per_bucket=50).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_apply(spark):
    _, docs = corpus(spark)
    out = apply_mix(docs, block=16)
    assert out.columns == docs.columns
    sizes = [len(r.text.split()) for r in out.collect()]
    assert min(sizes) > 0 and abs(sum(sizes) / (1.5 * sum(len((r.text or "").split()) for r in docs.collect())) - 1) < 0.15


def test_empty(spark):
    assert mix(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []


def spark_hash(*values):
    """xxhash64 as Spark chains it: each value's hash is the next one's seed; ints are hashed as 4 bytes, longs as 8."""
    seed = 42
    for v, size in values:
        seed = xxhash.xxh64(v.to_bytes(size, "little", signed=True), seed=seed).intdigest()
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def plain_permutation(i, n, side, seed, no, turn):
    """A four-round Feistel network over side x side places, walked on until it comes below n."""
    while True:
        a, b = i % side, i // side
        for k in range(4):
            a, b = b, (a + spark_hash((seed, 4), (no, 4), (turn, 8), (k, 4), (b, 8)) % side) % side
        i = a + b * side
        if i < n:
            return i


def test_taken_by_brute_force(spark):
    """The same draws, and permutations written anew, walked slot by slot and word by word in plain Python."""
    rows = [(i, " ".join("w" * (i * 7 % 41)), ["a", "b", None][i % 3]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    block, seed, shards = 16, 10, 64
    own = {(i, s): len(t.split()) for i, t, s in rows}
    names = ["a", "b", None]
    sizes = [sum(n for (_, s), n in own.items() if s == name) for name in names]
    targets = water_fill(sizes, [3, 1, 2], 1.5, 2)
    blocks = [-(-s // block) for s in sizes]
    quotas = [min(2 * b, round(t * b / s)) for t, b, s in zip(targets, blocks, sizes, strict=True)]
    slots = [sum(c[i] for c in draw_counts(quotas, shards, seed)) for i in range(3)]
    assert slots == quotas
    uses = defaultdict(int)
    for no in range(3):
        side = next(k for k in range(1, 10_000) if k * k >= blocks[no])
        for t in range(slots[no]):
            uses[no, plain_permutation(t % blocks[no], blocks[no], side, seed, no, t // blocks[no])] += 1
    order = docs.select("doc_id", "source", F.xxhash64("doc_id", F.size(F.array_remove(F.split("text", " "), "")).cast("long"), F.lit(0).cast("long")).alias("h"))
    placed = sorted(order.collect(), key=lambda r: (names.index(r.source), r.h % max(1, 20 // 5000), r.doc_id))
    at, want = [0, 0, 0], {}
    for r in placed:
        no, n = names.index(r.source), own[r.doc_id, r.source]
        want[r.doc_id] = sum(uses[no, (at[no] + w) // block] for w in range(n))
        at[no] += n
    assert {r.doc_id: r.taken for r in mix(docs, block=block).collect()} == want


def test_apply_takes_rows_alike_and_clashing_names(spark):
    rows = [(1, "a b c", "s", 1, "x")] * 4 + [(None, "d e f g", None, 2, "y"), (2, None, "s", 3, "z"), (3, "  ", "s", 3, "z"), (4, "w " * 50_000, "t", 4, "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, times int, row string")
    out = apply_mix(docs, block=4)
    assert out.columns == docs.columns
    got = [tuple(r) for r in out.collect()]
    assert set(got) <= set(rows) and all(got.count(r) <= 2 * rows.count(r) for r in set(got)) and not {2, 3} & {r[0] for r in got}
    assert apply_mix(docs.limit(0)).collect() == []
