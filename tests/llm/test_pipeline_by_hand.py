"""Each stage of the pipeline against plain Python over what the stage before kept."""

import random
import re

import corpus_pipeline
import xxhash

from folioflow.llm import mixing, quality
from folioflow.session import table

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, hash int, shard int, copy int"
VOCABULARY = "the of and to in that is was he for it with as his on be at by had river stone light winter garden bread house night morning letter field".split()


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def one_of_each_group(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    first = {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0)):
        if sets[i]:
            first.setdefault(find(i), i)
    return [r for i, r in enumerate(rows) if not sets[i] or first[find(i)] == i]


def uncontaminated(rows, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    asked = {}
    for words in map(split, items):
        if words:
            n = min(10, len(words))
            asked.setdefault(n, set()).update(windows(words, n))
    return [r for r in rows if not any(windows(split(r[1]), n) & w for n, w in asked.items())]


def chained(*values):
    """Spark's xxhash64 of longs and texts in turn; nulls leave the hash as it is."""
    seed = 42
    for v in values:
        if v is not None:
            seed = xxhash.xxh64(v.encode() if isinstance(v, str) else v.to_bytes(8, "little", signed=True), seed=seed).intdigest()
    return seed


def jump(key, shards):
    key, b, j = key % 2**64, -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_stages_by_hand(spark, tmp_path):
    rng = random.Random(21)
    say = lambda n: " ".join(rng.choice(VOCABULARY) + rng.choice("abcdefg") for _ in range(n))
    items = [say(20), say(4), "", None]
    docs, labels = [], []
    for i in range(240):
        text = say(rng.choice([1, 4, 20, 60]))
        bad = i % 5 == 0
        docs.append((i, text.upper().replace(" ", "!! ") if bad else text, "en", rng.choice(["s0", "s1", None]), i, "r", 1, 2, 3))
        labels.append((i, int(not bad), 0))
    good = [d for d in docs if d[0] % 5 and len(d[1]) > 150]
    docs += [(1000 + k, good[0][1] + f" tail{k}", "en", "s1", 1, "r", 1, 2, 3) for k in range(9)] + [good[1], good[1], good[2]]
    docs += [(None, good[3][1], None, None, None, None, None, None, None), (None, say(30), "en", "s0", 1, "x", 1, 1, 1), (2000, f"{say(10)} {items[0]} {say(10)}", "en", "s2", 1, "r", 1, 2, 3), (2001, f"{say(3)} {items[1]}", "en", "s2", 1, "r", 1, 2, 3)]
    docs += [(2002, None, None, None, None, None, None, None, None), (2003, "", "en", "s1", 0, "r", 1, 2, 3), (2004, say(30_000), "de", "s1", 5, "r", 1, 2, 3)]
    spark.createDataFrame(docs, COLUMNS).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels + labels[:40], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    sf, names = str(tmp_path), [c.split()[0] for c in COLUMNS.split(", ")]
    plain = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    now = table(spark, sf, "documents")
    model = quality.train(now, table(spark, sf, "labels"))

    def by_hand(k, rows):
        if k == 0:
            return [r for r in rows if model.score(quality.feature_matrix([r[1]]))[0] >= 0.5]
        if k == 1:
            return one_of_each_group(rows)
        if k == 2:
            return uncontaminated(rows, items)
        if k == 3:
            taken = {}
            for r in mixing.mix(now).collect():
                if r["size"]:
                    taken.setdefault((r.doc_id, r.source, r["size"]), []).append(r.taken)
            out = []
            for r in rows:
                n = len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
                if n:
                    times = taken[r[0], r[3], n]
                    out += [r] * int(sum(times) / len(times) / n + chained("mix", r[0], r[1]) % (1 << 20) / (1 << 20))
            return out
        return [(*r[:7], jump(r[0] or 0, 16), r[8]) for r in rows]

    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        want = by_hand(k, [tuple(r) for r in now.collect()])
        out = stage(spark, now, sf)
        assert out.columns == names and plain(out) == sorted(want, key=str), corpus_pipeline.STAGES[k][0]
        out.write.parquet(f"{sf}/stage{k}")
        now = spark.read.parquet(f"{sf}/stage{k}")
    assert plain(corpus_pipeline.run(spark, sf)) == plain(now)
