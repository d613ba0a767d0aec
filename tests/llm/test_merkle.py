import hashlib
import random
import zlib

from folioflow.llm import merkle

H = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()


def brute(rows):
    """Trees level by level; (doc_id, leaf) -> everything else, by plain lists."""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda d, s, g, n, t: H(*map(enc, (d, s, g, n, t)))

    def tree(nodes):
        ways, level, at = [[] for _ in nodes], nodes, list(range(len(nodes)))
        while len(level) > 1:
            for k, i in enumerate(at):
                run = level[i & ~1 : (i & ~1) + 2]
                ways[k].append((i & 1, run[1 - (i & 1)] if len(run) == 2 else None))
            level, at = [H(*level[i : i + 2]) for i in range(0, len(level), 2)], [i // 2 for i in at]
        return level[0], ways

    langs = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    made = []
    for g in langs:
        own = sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        made.append((own, *tree([leaf(*r) for r in own])))
    root, tops = tree([m[1] for m in made])
    out = []
    for (own, sub, ways), top in zip(made, tops, strict=True):
        for r, way in zip(own, ways, strict=True):
            d, s, g, n, t = r
            h = leaf(d, s, g, n + 1 if n is not None and d is not None and zlib.crc32(str(d).encode()) % 7 == 0 else n, t)
            for right, sibling in way + top:
                h = H(h) if sibling is None else H(sibling, h) if right else H(h, sibling)
            out.append((d, leaf(*r), sub, root, H(*[x for _, x in way + top if x]), h, h == root))
    return sorted(out, key=str)


COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def got(df):
    return sorted([(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()], key=str)


def rows(n, seed=1):
    rng = random.Random(seed)
    return [(i, rng.choice(["a", None, ""]), rng.choice(["en"] * 6 + ["fr", None, "", "é", "+"]), rng.choice([None, 5, 2**63 - 1]), rng.choice(["", None, "x" * 50_000, "é 😀"])) for i in range(n)]


def test_against_plain_lists(spark):
    data = rows(700) + [(None, "s", "en", 1, "t"), (None, None, None, None, None)] + [(3, "again", "en", 7, "t")] * 5 + [(9, "s", "alone", 2, "t")]
    docs = spark.createDataFrame([(*r, 0, "c") for r in data], COLUMNS + ", pos int, tree string").repartition(5)
    assert got(merkle.tampered(docs)) == brute(data)


def test_small_blocks_make_many_rounds(spark):
    data = rows(300, 2)
    df = spark.createDataFrame(data, COLUMNS).repartition(3)
    found = merkle.verify(merkle.manifest(df, bits=2))
    want = {(d, leaf): (sub, root, proof) for d, leaf, sub, root, proof, _, _ in brute(data)}
    for r in found.collect():
        assert want[r.doc_id, r.leaf] == (r.subroot, r.root, r.proof_sha256) and r.verified and r.folded_root == r.root


def test_one_row_and_none(spark):
    one = [(5, None, "en", 3, "t")]
    df = spark.createDataFrame(one, COLUMNS)
    assert got(merkle.tampered(df)) == brute(one)
    assert merkle.tampered(df.limit(0)).collect() == []


def test_appender_of_any_length():
    for n in range(1, 40):
        own = merkle.Appender()
        leaves = [H(str(i)) for i in range(n)]
        for x in leaves:
            own.append(x)
        root = own.close((n - 1).bit_length())
        assert all(merkle.fold(x, bytes(w)) == root for x, w in zip(leaves, own.witnesses, strict=True))
