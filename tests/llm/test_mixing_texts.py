"""The written mix: shards of blocks in order, with the documents' own words."""

import re
from collections import Counter, defaultdict

from test_mixing import plain_permutation

from folioflow.llm.mixing import draw_counts, mix_shards, root, water_fill

SPACE = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def pieces(rows):
    return sorted(((r.shard, r.place, r["at"], r.doc_id, r.source, r["hash"], r.copy, r.begin, r.words, r.text) for r in rows), key=lambda r: r[:3])


def corpus(spark):
    rows = [(i, " \n" * (i % 2) + "".join(f"w{i}.{j}" + (" ", "\n\n", "\t ")[j % 3] for j in range(i * 7 % 41)), "ab"[i % 2]) for i in range(80)]
    rows += [(None, "x y  z", None), (None, "x y  z", None), (None, "p q r", None), (7, "", "a"), (8, None, "b"), (9, "one " * 300, "b"), (81, "same id", "a"), (81, "idem id", "a")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_shards_hold_what_the_draws_take(spark):
    """Each shard's places once, in whole blocks of as many slots a source as the draws say, with the documents' words."""
    rows, docs = corpus(spark)
    mixed, report = (f.collect() for f in mix_shards(docs, block=16, shards=5))
    names, texts = ["a", "b", None], defaultdict(list)
    for i, t, s in rows:
        texts[i, s].append(SPACE.findall(t or ""))
    sizes = [sum(len(t) for (_, x), found in texts.items() if x == s for t in found) for s in names]
    targets = water_fill(sizes, [3, 1, 2], 1.5, 2)
    blocks = [-(-s // 16) for s in sizes]
    quotas = [min(2 * b, round(t * b / s)) for t, b, s in zip(targets, blocks, sizes, strict=True)]
    slots, took = defaultdict(list), Counter()
    for shard, place, *piece in pieces(mixed):
        slots[shard, place].append(piece)
    for shard, counts in enumerate(draw_counts(quotas, 5, 10)):
        assert sorted(p for s, p in slots if s == shard) == list(range(sum(counts)))
        assert Counter(found[0][2] for (s, _), found in slots.items() if s == shard) == Counter(dict(zip(names, counts, strict=True)))
    for found in slots.values():
        assert len({x[2] for x in found}) == 1 and found[0][0] == 0 and sum(x[6] for x in found) <= 16
        assert all(a[0] + a[6] == b[0] for a, b in zip(found, found[1:]))
        for _, doc, source, _, _, begin, n, text in found:
            took[source] += n
            assert any("".join(t[begin : begin + n]) == text and len(t[begin : begin + n]) == n for t in texts[doc, source])
    assert len(report) == len(rows) and all(sum(r.taken for r in report if r.source == s) == took[s] for s in names)


def test_places_by_permutations_walked_in_python(spark):
    """Two sources, a block a document: which block lies at which place of which shard, and no source in one stretch."""
    rows = [(i, f"d{i} " * 16, "ab"[i % 2]) for i in range(80)]
    mixed = mix_shards(spark.createDataFrame(rows, "doc_id long, text string, source string"), block=16, shards=3)[0].collect()
    quotas = [min(80, round(t / 16)) for t in water_fill([640, 640], [3, 1], 1.5, 2)]
    want, first, block_of = {}, [0, 0], {}
    for shard, counts in enumerate(draw_counts(quotas, 3, 10)):
        room, before = sum(counts), 0
        for no, n in enumerate(counts):
            for t in range(n):
                slot = first[no] + t
                want[shard, plain_permutation(before + t, room, root(room), 10, -1, shard)] = no, plain_permutation(slot % 40, 40, 7, 10, no, slot // 40)
            first[no] += n
            before += n
    assert len(mixed) == len(want) == 120
    for r in mixed:
        no, block = want[r.shard, r.place]
        assert r.text == f"d{r.doc_id} " * 16 and r.source == "ab"[no] and r["at"] == r.begin == 0
        assert block_of.setdefault((no, block), r.doc_id) == r.doc_id
    assert len(set(block_of.values())) == len(block_of)
    runs = [r.source for r in sorted(mixed, key=lambda r: (r.shard, r.place)) if r.shard == 0]
    assert sum(a != b for a, b in zip(runs, runs[1:])) > 4


def test_pieces_are_the_texts_whatever_the_order(spark):
    """With a share that takes each block twice, the pieces of a document are its text, white space and all."""
    rows, docs = corpus(spark)
    mixed, report = mix_shards(docs, share=2.0, block=16, shards=3)
    found, whole = pieces(mixed.collect()), defaultdict(dict)
    for *_, doc, source, hashed, copy, begin, n, text in found:
        assert whole[doc, source, hashed, copy].setdefault(begin, (n, text)) == (n, text)
    got = Counter((doc, "".join(p[b][1] for b in sorted(p)), source) for (doc, source, *_), p in whole.items())
    assert got == Counter(r for r in rows if (r[1] or "").strip())
    assert all(r.taken == 2 * r["size"] for r in report.collect())
    assert pieces(mix_shards(docs.repartition(3, "text"), share=2.0, block=16, shards=3)[0].collect()) == found
