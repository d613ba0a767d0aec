from collections import defaultdict

from test_mixing import plain_permutation

from folioflow.llm.mixing import draw_counts, mix, water_fill


def test_draws_reach_the_result(spark):
    """Which output shards take words of a document, by the draws walked slot by slot; another number of shards, and so
    other draws, takes the same words to other shards."""
    rows = [(i, "w " * 16, "ab"[i % 2]) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = water_fill([640, 640], [3, 1], 1.5, 2)
    quotas = [min(80, round(t / 16)) for t in targets]
    want, took = defaultdict(list), []
    for shards in (64, 8):
        first, by_block = [0, 0], defaultdict(list)
        for shard, counts in enumerate(draw_counts(quotas, shards, 10)):
            for no, n in enumerate(counts):
                for t in range(first[no], first[no] + n):
                    by_block[no, plain_permutation(t % 40, 40, 7, 10, no, t // 40)].append(shard)
                first[no] += n
        got = mix(docs, block=16, shards=shards).collect()
        want = sorted((no, min(s), max(s)) for (no, _), s in by_block.items())
        assert sorted(("ab".index(r.source), r.first_shard, r.last_shard) for r in got if r.taken) == want
        assert all((r.first_shard is None) == (r.taken == 0) for r in got)
        took.append({r.doc_id: r.taken for r in got})
    assert took[0] == took[1]
