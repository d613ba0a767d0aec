"""Operator 5, near-duplicate detection by b-bit MinHash (Li and Koenig, 2010)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import Scratch, components, listed

WORDS = 5
ROWS, BANDS = 4, 28
#: Minima in all: those of the bands and more for a sharper estimate.
MINIMA = 256
#: Signatures keep two low bits of each minimum, as two bit planes of 64-bit words.
BITS = 2
PLANE_WORDS = -(-MINIMA // 64)
#: Pairs estimated this far under the threshold are not confirmed: five standard deviations at a similarity of 0.75.
MARGIN = 0.17
#: Rounds of comparing a bucket's members with one of them before the members of unlike components meet. The first
#: finds nearly all links (23094 against 88 and 42 in the next two on a table with groups of thousands of variants).
STAR_ROUNDS = 1
#: Buckets with more pairs to compare across components than this are compared in blocks of about BLOCK x BLOCK.
FEW_PAIRS, BLOCK = 1024, 512
SIGNATURE = "doc_id long, key long, hash long, n_shingles long, cls binary, bands array<long>, planes array<long>"
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(text: str | None, width: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's word shingles: A-Z lower-cased, words parted by ASCII white
    space; with fewer words than ``width`` the whole sequence is one shingle; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space alone
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(n, width)
    mixed = np.full(n - width + 1, width, np.uint64)
    for d in range(width):
        mixed = mixed * _P + hashed[d : n - width + 1 + d]
    mixed ^= mixed >> np.uint64(29)
    mixed *= _Q
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _hash_family(seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    low, high, plus = (rng.integers(0, 2**32, (MINIMA, 1), np.uint32) for _ in range(3))
    return low | np.uint32(1), high | np.uint32(1), plus


_FAMILY = _hash_family()


def minima(hashes: np.ndarray, step: int = 512) -> np.ndarray:
    """The minimum of each hash function of the family over the shingles."""
    a, c, b = _FAMILY
    low, high = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    best = np.full(MINIMA, 2**32 - 1, np.uint32)
    for i in range(0, len(hashes), step):
        v = a * low[i : i + step]
        v += c * high[i : i + step]
        v += b
        np.minimum(best, v.min(axis=1), out=best)
    return best


def _bands(best: np.ndarray) -> np.ndarray:
    """One 64-bit key of each band's minima and number."""
    key = np.arange(BANDS, dtype=np.uint64) * _Q + np.uint64(1)
    for column in best[: ROWS * BANDS].reshape(BANDS, ROWS).T.astype(np.uint64):
        key = (key ^ column) * _P
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def _mixed(best: np.ndarray) -> np.ndarray:
    """Minima through a 32-bit finaliser: the low bits of the linear hashes hang together, those of its results don't."""
    v = best ^ (best >> np.uint32(16))
    v *= np.uint32(0x85EBCA6B)
    v ^= v >> np.uint32(13)
    v *= np.uint32(0xC2B2AE35)
    return v ^ (v >> np.uint32(16))


def _planes(best: np.ndarray) -> np.ndarray:
    """BITS x PLANE_WORDS words: the low bits of the mixed minima, plane by plane."""
    best = _mixed(best)
    bits = np.zeros((BITS, PLANE_WORDS * 64), np.uint8)
    for p in range(BITS):
        bits[p, : len(best)] = (best >> np.uint32(p)) & np.uint32(1)
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64).ravel()


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64), pa.int64()))


def _class(hashes: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none = np.empty(0, np.int64)
    for batch in batches:
        n, cls, bands, planes = [], [], [], []
        for text in batch.column(1):
            found = shingles(text.as_py())
            n.append(len(found))
            cls.append(_class(found))
            best = minima(found) if len(found) else None
            bands.append(none if best is None else _bands(best))
            planes.append(none if best is None else _planes(best))
        made = [pa.array(n, pa.int64()), pa.array(cls, pa.binary()), _lists(bands), _lists(planes)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), *made], ["doc_id", "key", "hash", "n_shingles", "cls", "bands", "planes"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(t.as_py()) for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array([_class(x) for x in found], pa.binary()), _lists([x.view(np.int64) for x in found])], ["cls", "grams"])


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures: of unlike minima one in 2^BITS agrees in its low bits by chance."""
    apart = None
    for w in range(PLANE_WORDS):
        unlike = None
        for p in range(BITS):
            x = a[p * PLANE_WORDS + w].bitwiseXOR(b[p * PLANE_WORDS + w])
            unlike = x if unlike is None else unlike.bitwiseOR(x)
        apart = F.bit_count(unlike) if apart is None else apart + F.bit_count(unlike)
    chance = 1.0 / 2**BITS
    return ((1.0 - apart / float(MINIMA)) - chance) / (1.0 - chance)


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    """No pair whose sizes differ more can reach the threshold."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _sets_of(own: Scratch, docs: DataFrame, needed: DataFrame) -> DataFrame:
    """The full shingle sets (cls, grams) of the needed classes (cls, key). The needed ones grow with the corpus, so
    texts meet them in a shuffle at every size."""
    keys = needed.select("key").distinct().hint("merge")
    texts = docs.select(_key().alias("key"), "text").join(keys, "key", "left_semi").select("text")
    sets = texts.mapInArrow(_sets, "cls binary, grams array<long>").join(needed.select("cls"), "cls", "left_semi")
    return own.table(sets.groupBy("cls").agg(F.first("grams").alias("grams")))


def _key() -> Column:
    """What a row's text is found by: its doc_id, or a hash of the text where there is none."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))


def _needed(classes: DataFrame, pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct().join(classes.select("cls", "key"), "cls")


def _confirm(own: Scratch, sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full shingle sets reach the threshold."""
    half = pairs.join(sets.select(F.col("cls").alias("b"), F.col("grams").alias("gb")), "b")
    both = half.join(sets.select(F.col("cls").alias("a"), F.col("grams").alias("ga")), "a")
    common = both.select("a", "b", F.size(F.array_intersect("ga", "gb")).alias("both"), (F.size("ga") + F.size("gb")).alias("sum"))
    return own.table(common.filter(F.col("both") * 100 >= (F.col("sum") - F.col("both")) * percent).select("a", "b"))


def _compare(percent: int):
    def compare(asking: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        """For each asking class and component among the others, one link at the threshold if there is any."""
        a, b = [], []
        if len(asking) and len(others):
            size = others["grams"].map(len).to_numpy()
            owner, grams = np.repeat(np.arange(len(others)), size), np.concatenate(others["grams"].to_list())
            component = others["component"].to_numpy()
            for cls, own, mine in zip(asking["cls"], asking["component"], asking["grams"], strict=True):
                mine = np.sort(mine)  # the sets are in unsigned order
                at = np.minimum(np.searchsorted(mine, grams), len(mine) - 1)
                both = np.bincount(owner[mine[at] == grams], minlength=len(others))
                hit = np.flatnonzero(both * 100 >= (size + len(mine) - both) * percent)
                for k in {component[i]: i for i in hit if component[i] != own}.values():
                    a.append(cls)
                    b.append(others["cls"].iloc[k])
        return pd.DataFrame({"a": a, "b": b})

    return compare


def _across_blocks(own: Scratch, sets: DataFrame, shaped: DataFrame, percent: int) -> DataFrame:
    """Links across components in large buckets: the members outside a bucket's main component ask all its members,
    in blocks of about BLOCK by BLOCK, and only links come back."""
    blocks = lambda c: F.ceil(F.col(c) / F.lit(BLOCK)).cast("int")
    dealt = lambda c: F.pmod(F.xxhash64(F.lit(c), "cls"), blocks(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), blocks(c) - 1))
    asking = shaped.filter("component <> main").select("band", "cls", "component", dealt("odd").alias("bx"), every("k").alias("by")).join(sets, "cls")
    asking = own.table(asking)
    others = shaped.select("band", "cls", "component", every("odd").alias("bx"), dealt("k").alias("by")).join(sets, "cls")
    others = own.table(others)
    by = ("band", "bx", "by")
    links = own.table(asking.groupBy(*by).cogroup(others.groupBy(*by)).applyInPandas(_compare(percent), "a binary, b binary"))
    own.drop(asking, others)
    return links


def linked_classes(own: Scratch, docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signed rows (doc_id, key, hash, n_shingles, cls) of documents (doc_id, text), their classes (cls, id, key, place) and
    the links (a, b) between classes whose shingle sets have a similarity of ``percent`` in 100 or more: enough of them to join
    the classes of each group. Rows without words have a null cls; id is a class's smallest doc_id, null if it has none;
    place (none, doc_id, hash, key) says where its first row is.

    Documents with equal sets form a class, found by a grouping with map-side reduction, and go on as one. Class pairs
    come from bands of minima, and no bucket is paired in full: in STAR_ROUNDS rounds the members of a bucket meet one
    of them, another in each round, and only buckets that the links so confirmed leave in several components go on;
    then the members that are left meet across components: in small buckets by a join that only pairs with near packed
    signatures pass, in large ones block by block, where only links leave a task. A pair inside one component is never looked at, since it changes none. Candidates are confirmed on their full
    sets. A pair at the threshold shares no band with a chance of 2.4e-5, and is estimated too low with one of 3e-7 if
    minima are independent.
    """
    signed = own.table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _key().alias("key"), F.xxhash64("text").alias("hash")).mapInArrow(_sign, SIGNATURE))
    sets = signed.filter("cls IS NOT NULL")
    classes = own.table(sets.groupBy("cls").agg(F.min("doc_id").alias("id"), F.min("key").alias("key"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash", "key")).alias("place"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("planes").alias("planes")))

    postings = classes.select(F.explode("bands").alias("band"), "cls")
    full = postings.groupBy("band").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("band")
    members = own.table(postings.join(full, "band"))
    sketches = classes.select("cls", "n", "planes")
    least = 1.0 - ((100 - percent) / 100.0 + MARGIN)
    near = lambda na, nb, pa, pb: _sizes_fit(F.col(na), F.col(nb), percent) & (estimate(F.col(pa), F.col(pb)) >= least)
    sketch = lambda c: sketches.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("planes").alias(f"p{c}"))

    open_, links, seen = members.withColumn("component", F.col("cls")), None, None
    for turn in range(STAR_ROUNDS):
        heads = open_.groupBy("band").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "band", "cls").alias("by"), F.col("cls").alias("a"), F.col("component").alias("at"))).alias("head")).select("band", "head.a", "head.at")
        pairs = open_.join(heads, "band").filter("component <> at").select(F.least("a", "cls").alias("a"), F.greatest("a", "cls").alias("b")).distinct()
        if seen is not None:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        likely = own.table(pairs.join(sketch("b"), "b").join(sketch("a"), "a").filter(near("na", "nb", "pa", "pb")).select("a", "b"))
        needed = own.table(_needed(classes, likely))
        grams = _sets_of(own, docs, needed)
        found = _confirm(own, grams, likely, percent)
        own.drop(needed, grams)
        links, seen = (found, likely) if turn == 0 else (links.union(found), seen.union(likely))
        groups = components(own, links)
        labelled = open_.select("band", "cls").join(groups.withColumnRenamed("id", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        labelled = own.table(labelled)
        split = labelled.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("band")
        open_ = own.table(labelled.join(split, "band"))
        own.drop(labelled)

    parts = open_.groupBy("band", "component").agg(F.count(F.lit(1)).alias("rows"))
    shape = parts.groupBy("band").agg(F.max(F.struct("rows", "component")).alias("most"), F.sum("rows").alias("k")).select("band", F.col("most.component").alias("main"), "k", (F.col("k") - F.col("most.rows")).alias("odd"))
    shaped = own.table(open_.join(shape, "band"))
    few = F.col("k") * F.col("odd") <= FEW_PAIRS
    small = shaped.filter(few).join(sketches, "cls")
    x, y = small.alias("x"), small.alias("y")
    across = (F.col("x.band") == F.col("y.band")) & (F.col("x.component") < F.col("y.component")) & near("x.n", "y.n", "x.planes", "y.planes")
    more = x.join(y, across).select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")).distinct()
    more = own.table(more.join(seen, ["a", "b"], "left_anti"))
    large = shaped.filter(~few)
    needed = own.table(_needed(classes, more).union(large.select("cls").distinct().join(classes.select("cls", "key"), "cls")).distinct())
    grams = _sets_of(own, docs, needed)
    links = links.union(_confirm(own, grams, more, percent)).union(_across_blocks(own, grams, large, percent))
    own.drop(needed, grams)
    return signed, classes, links


def near_duplicates(docs: DataFrame, percent: int = 75, scratch: Scratch | None = None) -> DataFrame:
    """Groups of documents (doc_id, text) linked by a shingle similarity of ``percent`` in 100 or more.

    Returns per row doc_id, n_shingles, component_id (the smallest doc_id reachable) and kept. Texts without words and
    null texts are linked with nothing: their component is their own. Rows with a null doc_id link others but get a null
    component and count as kept. Repeated rows are copies of each other; rows of one doc_id with unlike texts are one
    document with two sets, and their groups are one. Only doc_id and text are read, so other columns may have any name.
    An empty table gives an empty result. See ``linked_classes`` for the method.
    """
    own = scratch or Scratch(docs.sparkSession, "near-dup")
    signed, classes, links = linked_classes(own, docs, percent)

    # Classes of one doc_id belong together whatever their sets are.
    ids = signed.filter("cls IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "cls").distinct()
    repeated = ids.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).filter("a <> b").select("doc_id", "a")
    links = links.union(repeated.join(ids, "doc_id").filter("a <> cls").select("a", F.col("cls").alias("b")))

    groups = components(own, links).withColumnRenamed("id", "cls")
    named = classes.select("cls", "id").join(groups, "cls")
    smallest = named.groupBy("component").agg(F.min("id").alias("smallest"))
    moved = own.table(named.join(smallest, "component").select("cls", "smallest"))
    named = own.table(classes.select("cls", "id").join(moved, "cls", "left").select("cls", F.coalesce("smallest", "id").alias("component_id")))
    out = signed.select("doc_id", "n_shingles", "cls").join(named, "cls", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
    result = own.keep(out.withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))))
    own.clear()
    return result


def keep_one(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The documents, all columns, with one row of each group of near-duplicate texts: that of the smallest doc_id (rows
    without one come last), among rows of that doc_id the one whose text has the smallest hash, and among rows alike in
    both the one whose columns have. Rows without words or text are linked with nothing and all stay. Unlike texts of one
    doc_id are documents of their own here. Columns may have any name; an empty table gives an empty one.

    The decision is made on ids and hashes. Texts meet it in one shuffle join by (key, hash), at every size.
    """
    own = Scratch(docs.sparkSession, "keep-one")
    signed, classes, links = linked_classes(own, docs, percent)
    groups = components(own, links).withColumnRenamed("id", "cls")
    named = classes.select("cls", "place").join(groups, "cls", "left")
    stay = own.keep(named.groupBy(F.coalesce("component", "cls")).agg(F.min("place").alias("place")).select("place.key", "place.hash"))
    alike = signed.filter("cls IS NOT NULL").groupBy("key", "hash").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    alike = own.keep(alike.join(stay, ["key", "hash"], "left_semi").select("key", "hash"))
    own.clear()

    rows = docs.select(F.struct("*").alias("row"), _key().alias("key"), F.xxhash64("text").alias("hash"), F.coalesce("text", F.lit("")).rlike("[^\\x20\\x09-\\x0D]").alias("words"))
    kept = rows.filter("words").join(stay.hint("merge"), ["key", "hash"], "left_semi")
    if alike.limit(1).count():
        several = listed(alike)
        first = kept.join(several, ["key", "hash"], "left_semi").groupBy("key", "hash").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
        kept = kept.join(several, ["key", "hash"], "left_anti").select("row").unionByName(first.select("row"))
    return kept.select("row").unionByName(rows.filter("NOT words").select("row")).select("row.*")


#: Every two documents with a shingle in common are compared, and links are followed from every document.
ORACLE = r"""WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  sets AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) AS shingle FROM words WHERE len(w) > 0),
  sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
  pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
  links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * pairs.both >= 75 * (x.n + y.n - pairs.both)),
  ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
  reach AS (SELECT doc_id AS start, doc_id AS reached FROM sizes UNION SELECT start, b FROM reach JOIN ways ON reached = a),
  groups AS (SELECT start, min(reached) AS component FROM reach GROUP BY start)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component, d.doc_id) AS component_id, coalesce(component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN groups g ON g.start = d.doc_id"""
