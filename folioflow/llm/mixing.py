"""Operator 10, mixing sources to target weights, in DataFrame functions alone."""

from __future__ import annotations

import math
import operator
import random
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.common import Scratch, repeated, space_words

#: Slots that one row of the slot plan grows into before the second step of its expansion, and slots of a task.
CHUNK, TASK_SLOTS = 4096, 65_536
#: Characters between words and of words.
SPACE, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def water_fill(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Targets by weight that add up to share x all sizes; none is above most x its size, the excess goes by weight to
    the others until none is above. If all are full they stay full."""
    left, open_ = share * sum(sizes), list(range(len(sizes)))
    target = [0.0] * len(sizes)
    while open_:
        level = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if level * weights[i] >= most * sizes[i]]
        if not full:
            for i in open_:
                target[i] = level * weights[i]
            break
        for i in full:
            target[i] = most * sizes[i]
            left -= target[i]
        open_ = [i for i in open_ if i not in set(full)]
    return target


def draw_counts(quotas: Sequence[int], shards: int, seed: int) -> list[list[int]]:
    """Slots by output shard and source: each shard of equal size draws a multinomial over what the sources have left,
    as a chain of binomials. The last shard takes the rest, so that every source gets just its quota."""
    rng, left = random.Random(seed), list(quotas)
    out = []
    for shard in range(shards):
        room = math.ceil(sum(left) / (shards - shard))
        weight, row = sum(left), [0] * len(left)
        for i, quota in enumerate(list(left)):
            if room > 0 and quota > 0:
                row[i] = min(quota, rng.binomialvariate(room, min(1.0, quota / weight)))
            weight -= quota
            room -= row[i]
        for i, quota in enumerate(left):  # what a capped draw left open
            extra = min(room, quota - row[i])
            row[i] += extra
            room -= extra
        left = [a - b for a, b in zip(left, row, strict=True)]
        out.append(row)
    return out


def permute(i: Column, n: Column, side: Column, *seeds: Column) -> Column:
    """A pseudorandom permutation of 0 to n - 1: a four-round Feistel network over side x side places (side is the
    root of n, rounded up), walked on until it comes back below n."""

    def once(x: Column) -> Column:
        a, b = x % side, F.floor(x / side).cast("long")
        for turn in range(4):
            a, b = b, (a + F.pmod(F.xxhash64(*seeds, F.lit(turn), b), side)) % side
        return a + b * side

    def walk(x: Column, _: Column) -> Column:
        return F.when((x >= n) | (x < 0), once(F.when(x < 0, -x - 1).otherwise(x))).otherwise(x)

    # At most 2 * side - 1 places lie at n or above. Up to 272 places 34 steps pass them all; beyond, each step stays
    # above n with a chance under an eighth.
    return F.aggregate(F.sequence(F.lit(1), F.lit(34)), (-i - 1).cast("long"), walk)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The report of ``mix_shards``: what the written mix took of each document."""
    return mix_shards(docs, **options)[1]


def mix_shards(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: int = 2, block: int = 128,
    shards: int = 64, seed: int = 10, rows_per_bucket: int = 5000, scratch: Scratch | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Mixes documents (doc_id, text, source) to target weights in blocks of ``block`` words, and writes the mix.

    Sources in code-point order, null last, take the ``weights`` in turn; targets share ``share`` times all words and
    stop at ``most`` times their source (``water_fill``). A source's documents, in an order given by hashes, form one
    stream of words cut into blocks. Each of ``shards`` output shards draws its slots by source; slot t of a source
    with n blocks takes block perm(t mod n) of a new permutation for each pass t div n. So every block is used as often
    as any other or once more, and never above ``most`` times. A permutation of each shard puts its slots in order, so that
    its sources are mingled.

    The mix is written as rows shard, place (of the slot in its shard, from 0), at (of the row's first word in the block), doc_id,
    source, hash (of the document's text), copy, begin (of that word in the document), words and text, cut from the document
    with the white space that follows each word (and what leads the first one). In the order of place and at they are the shard,
    and all pieces of a document together are its text. Each file is sorted so, shard by shard: there are as many files as
    tasks, and a filter on shard can skip the pages of others.

    The report, read from the written rows, has per document row doc_id, source, size (words; null text: 0), source_size, target,
    taken (words of it in the mix, repeats counted) and first_shard and last_shard, the least and the greatest output shard
    with words of it (null where nothing is taken). Documents without words take nothing. Repeated rows each have
    their own place; rows of one doc_id and source are told apart by a 64-bit hash of their texts. Only doc_id, text and source are read. The result depends on the rows and the seed alone, not on their order
    or partitions. An empty table gives an empty result.

    One row per source goes to the driver (name, count, total), and from there ``shards`` rows per source of drawn
    slots come back as a table; no row of documents does. Running sums are made per (source, bucket) with buckets by hash, so
    that a source may hold any share of the rows. Texts are shuffled once, by document, to meet their spans, and leave that task as
    pieces; a document's text is taken to words once.
    """
    own = scratch or Scratch(docs.sparkSession, "mixing")
    spans, sources = _spans(docs, weights, share, most, block, shards, seed, rows_per_bucket, own)
    names = F.broadcast(sources.select("no", "name"))
    texts = docs.select("doc_id", "source", "text", F.xxhash64("text").alias("hash")).filter("text IS NOT NULL")
    texts = texts.join(names, F.col("source").eqNullSafe(F.col("name"))).select("doc_id", "no", "source", "text", "hash")
    alike = Window.partitionBy("doc_id", "no", "hash").orderBy("hash")
    number = F.row_number().over(alike) - 1 if spans.filter("copy > 0").limit(1).count() else F.lit(0)
    texts = texts.withColumn("copy", number.cast("long"))
    wanted = spans.filter(F.size("spans") > 0).select(*[F.col(c).alias(f"s_{c}") for c in ("doc_id", "no", "hash", "copy")], "spans")
    on = texts["doc_id"].eqNullSafe(F.col("s_doc_id")) & (texts["no"] == F.col("s_no")) & (texts["hash"] == F.col("s_hash")) & (texts["copy"] == F.col("s_copy"))

    def cut(words: Column) -> Column:
        text = lambda s: F.array_join(F.slice(words, s["begin"].cast("int") + 1, s["words"].cast("int")), "")
        return F.transform("spans", lambda s: F.struct(s["at"].alias("at"), s["begin"].alias("begin"), s["words"].alias("words"), s["places"].alias("places"), text(s).alias("text")))

    whole = F.regexp_extract_all("text", F.lit(f"{SPACE}*{WORD}+{SPACE}*"), F.lit(0))
    pieces = texts.join(wanted.hint("merge"), on).select("doc_id", "source", "hash", "copy", F.explode(F.transform(F.array(whole), cut)[0]).alias("p"))
    pieces = pieces.select("doc_id", "source", "hash", "copy", "p.at", "p.begin", "p.words", "p.text", F.explode("p.places").alias("to"))
    pieces = pieces.select("to.shard", "to.place", "at", "doc_id", "source", "hash", "copy", "begin", "words", "text")
    mixed = own.keep(pieces.sortWithinPartitions("shard", "place", "at"))

    key = ["doc_id", "source", "hash", "copy"]
    taken = mixed.groupBy(*[F.col(c).alias(f"m_{c}") for c in key]).agg(F.sum("words").alias("taken"), F.min("shard").alias("first_shard"), F.max("shard").alias("last_shard"))
    every = spans.drop("spans").join(F.broadcast(sources), "no").withColumnRenamed("name", "source")
    same = reduce(operator.and_, [every[c].eqNullSafe(F.col(f"m_{c}")) for c in key])
    report = every.join(taken.hint("merge"), same, "left").select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "first_shard", "last_shard")
    report = own.keep(report)
    own.clear()
    return mixed, report


def _spans(docs: DataFrame, weights: Sequence[float], share: float, most: int, block: int, shards: int, seed: int, rows_per_bucket: int, own: Scratch) -> tuple[DataFrame, DataFrame]:
    """(spans, sources): every document row (doc_id, no, size, hash, copy) with what the mix takes of it, an array of
    struct(at, begin, words, places) with the (shard, place) of each use; and the sources by their number."""
    spark = docs.sparkSession
    rows = own.table(docs.select("doc_id", "source", F.size(space_words(F.col("text"))).cast("long").alias("size"), F.xxhash64("text").alias("hash")))
    totals = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    totals.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [r["size"] for r in totals]
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, most)
    blocks = [-(-s // block) for s in sizes]
    quotas = [min(most * b, round(t * b / s)) if s else 0 for t, b, s in zip(targets, blocks, sizes, strict=True)]

    names = [{"no": i, "name": r.source, "source_size": sizes[i], "target": float(targets[i]), "buckets": max(1, r.n // rows_per_bucket)} for i, r in enumerate(totals)]
    sources = own.table(spark.createDataFrame(names, "no int, name string, source_size long, target double, buckets long"))
    placed = _places(rows, sources, own)

    plan, first = [], [0] * len(sizes)
    for shard, counts in enumerate(draw_counts(quotas, shards, seed)):
        room, before = sum(counts), 0
        for i, n in enumerate(counts):
            if n:
                plan.append({"no": i, "shard": shard, "first": first[i], "slots": n, "blocks": blocks[i], "side": root(blocks[i]), "before": before, "room": room, "room_side": root(room)})
                first[i] += n
                before += n
    tasks = 1 + sum(quotas) // TASK_SLOTS
    plan = own.table(spark.createDataFrame(plan, "no int, shard int, first long, slots long, blocks long, side long, before long, room long, room_side long"))
    end = F.col("first") + F.col("slots") - 1
    chunks = plan.withColumn("from", F.explode(F.sequence("first", end, F.lit(CHUNK).cast("long")))).withColumn("to", F.least(F.col("from") + CHUNK - 1, end))
    slots = chunks.repartition(tasks, "no", "from").select("no", "shard", "blocks", "side", "room", "room_side", (F.col("before") - F.col("first")).alias("before"), F.explode(F.sequence("from", "to")).alias("slot"))
    passes = F.floor(F.col("slot") / F.col("blocks")).cast("long")
    slots = slots.withColumn("block", permute(F.col("slot") % F.col("blocks"), F.col("blocks"), F.col("side"), F.lit(seed), F.col("no"), passes))
    slots = slots.withColumn("place", permute(F.col("before") + F.col("slot"), F.col("room"), F.col("room_side"), F.lit(seed), F.lit(-1), F.col("shard").cast("long")))
    uses = slots.groupBy("no", "block").agg(F.sort_array(F.collect_list(F.struct("shard", "place"))).alias("places"))

    start, stop = F.col("start"), F.col("start") + F.col("size")
    covered = F.when(F.col("size") > 0, F.sequence(F.floor(start / block), F.floor((stop - 1) / block)))
    parts = placed.withColumn("block", F.explode_outer(covered)).withColumn("from", F.greatest(start, F.col("block") * block)).withColumn("words", F.least(stop, (F.col("block") + 1) * block) - F.col("from"))
    # The planner takes rows grown from the literal plan for few, so the join is told not to broadcast them.
    parts = parts.alias("p").join(uses.hint("merge").alias("u"), (F.col("p.no") == F.col("u.no")) & (F.col("p.block") == F.col("u.block")), "left")
    span = F.when(F.col("places").isNotNull(), F.struct((F.col("from") - F.col("p.block") * block).alias("at"), (F.col("from") - start).alias("begin"), "words", "places"))
    return own.table(parts.groupBy("doc_id", "p.no", "size", "hash", "copy").agg(F.collect_list(span).alias("spans"))), sources


def root(n: int) -> int:
    """The square root, rounded up."""
    return math.isqrt(n - 1) + 1


def _places(rows: DataFrame, sources: DataFrame, own: Scratch) -> DataFrame:
    """Every document row with its source's number and the place in the source's stream where its words start. Of rows
    alike in doc_id, source and text each has its number (copy)."""
    same = rows.groupBy("doc_id", "source", "size", "hash").agg(F.count(F.lit(1)).alias("rows"))
    each = repeated(same, "rows", "copy")
    each = each.join(sources, F.col("source").eqNullSafe(F.col("name"))).select("doc_id", "no", "size", "hash", "copy", F.pmod(F.xxhash64("doc_id", "size", "hash", "copy"), F.col("buckets")).alias("bucket"))
    each = own.table(each)
    return own.table(rows.sparkSession.sql("""
        WITH totals AS (SELECT no, bucket, sum(size) AS n FROM {each} GROUP BY no, bucket),
        starts AS (SELECT no, bucket, sum(n) OVER (PARTITION BY no ORDER BY bucket) - n AS base FROM totals),
        ranked AS (SELECT *, sum(size) OVER (PARTITION BY no, bucket ORDER BY doc_id, size, hash, copy ROWS UNBOUNDED PRECEDING) - size AS before FROM {each})
        SELECT r.doc_id, r.no, r.size, r.hash, r.copy, s.base + r.before AS start FROM ranked r JOIN starts s ON r.no = s.no AND r.bucket = s.bucket""", each=each))


def documents_taken(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: int = 2, block: int = 128, shards: int = 64, seed: int = 10, rows_per_bucket: int = 5000) -> DataFrame:
    """(doc_id, source, size, taken) of the mix by its spans, without writing its texts."""
    own = Scratch(docs.sparkSession, "mixing")
    spans, sources = _spans(docs, weights, share, most, block, shards, seed, rows_per_bucket, own)
    words = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"] * F.size(s["places"]))
    result = own.keep(spans.join(F.broadcast(sources), "no").select("doc_id", F.col("name").alias("source"), "size", words.alias("taken")))
    own.clear()
    return result


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The documents, all columns, each as often as the mix takes it: taken / size times, the fraction settled by a
    hash of doc_id and text so that the words kept come near the words taken.

    Documents without words or text are left out, as are those that the mix doesn't take. Rows alike in doc_id, source
    and size share the mean of what they take; rows alike in their texts too share the draw. A null doc_id or source is
    a value like any other. Columns may have any name; an empty table gives an empty one. Texts meet what they take in
    one shuffle join at every size.
    """
    taken = documents_taken(docs, **options).filter("size > 0").groupBy("doc_id", "source", "size").agg((F.sum("taken") / F.count(F.lit(1)) / F.first("size")).alias("times"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source", F.size(space_words(F.col("text"))).cast("long").alias("size"), F.xxhash64(F.lit("mix"), "doc_id", "text").alias("hash"))
    on = rows["doc_id"].eqNullSafe(taken["doc_id"]) & rows["source"].eqNullSafe(taken["source"]) & (rows["size"] == taken["size"])
    luck = F.pmod("hash", F.lit(1 << 20)) / float(1 << 20)
    drawn = rows.join(taken.hint("merge"), on).select("row", F.floor(F.col("times") + luck).cast("long").alias("times"))
    return repeated(drawn, "times", "copy").select("row.*")
