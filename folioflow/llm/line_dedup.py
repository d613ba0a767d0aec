"""Operator 1, line dedup by an exact set-similarity join (prefix, positional, length and bitmap filters)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import BROADCAST_ROWS, Scratch, repeated

#: Counts by token hash are kept in 2^SKETCH_BITS buckets: a fixed size whatever the vocabulary.
SKETCH_BITS = 23
#: A sketch travels in SLICES parts; the tasks' parts are added up FAN at a time.
SLICES, FAN = 64, 64
MOST = 2**32 - 1
#: What a null doc_id counts as: it comes last.
NO_ID = 2**63 - 1
#: Postings of a token that meet in one place; those of more frequent ones are dealt to blocks of this size.
CELL = 4096
#: Postings of a group, and those that a task packs together.
GROUP_POSTINGS, PACKED = 1 << 18, 1 << 19
#: Nearest partners that a posting names in a round; every further round asks for FAR times as many.
FEW, FAR = 4, 128
#: Texts are worked on together up to about this many bytes; a longer text alone.
WORK_BYTES = 1 << 17
LINE = "doc_id long, hash long, line int, s1 long, s2 long, n int, b1 long, b2 long, tokens binary, places binary"
PAIR = "doc_id long, hash long, line int, d2 long, h2 long, l2 int"
#: A line's place: rows are ordered by doc_id, rows of one doc_id by their text's hash.
PLACE, OTHER = ["doc_id", "hash", "line"], ["d2", "h2", "l2"]
#: A posting: a set's line, size and bitmap under one of its prefix tokens, with the token's place in the set.
POSTING = np.dtype([("key", "<u4"), ("n", "<u2"), ("place", "u1"), ("asks", "u1"), ("doc_id", "<i8"), ("hash", "<i8"), ("line", "<i4"), ("b1", "<u8"), ("b2", "<u8")])

_R = np.uint64(0x9E3779B97F4A7C15)
_R_INVERSE = np.uint64(pow(int(_R), -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(10, (n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        ones = np.full(size, _R, np.uint64), np.full(size, _R_INVERSE, np.uint64)
        for p in ones:
            p[0] = 1
            np.multiply.accumulate(p, out=p)
        _powers[size] = ones
    return _powers[size]


def _mix(x: np.ndarray, by: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(by)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def tokens(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end (bytes, and where each starts): the 64-bit hash of each word, A-Z lower-cased, the
    number of its line over all texts, and the number of each text's first line. Words are parted by ASCII white space,
    lines by line feeds. Hashes come from one running sum of byte x power, so no word is handled alone."""
    n = len(data)
    heads = np.zeros(n + 1, bool)
    heads[starts[starts < n]] = True
    breaks = np.flatnonzero(data == 10)
    first_line = np.searchsorted(breaks, starts) + np.arange(len(starts))
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64), first_line
    low = _LOWER[data]
    solid = ~_IS_SPACE[low]
    begin = np.flatnonzero(solid & (heads[:-1] | np.r_[True, ~solid[:-1]]))
    end = np.flatnonzero(solid & (heads[1:] | np.r_[~solid[1:], True])) + 1
    power, inverse = _power_tables(n)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    hashed = _mix((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64) * _R, 0xBF58476D1CE4E5B9)
    text = np.searchsorted(starts, begin, side="right") - 1
    return hashed, np.searchsorted(breaks, begin) + text, first_line


def _chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices (from, to, bytes, starts) of a text column, of about WORK_BYTES each; nulls are empty."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + WORK_BYTES, side="right")) - 1)
        yield at, to, raw[offsets[at] : offsets[to]], offsets[at:to] - offsets[at]
        at = to


def _sliced(seen: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's counts by bucket, slice by slice: the buckets seen and their counts, up to MOST."""
    width = len(seen) // SLICES
    for s in range(SLICES):
        own = seen[s * width : (s + 1) * width]
        at = np.flatnonzero(own)
        if len(at):
            n = np.minimum(own[at], MOST).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([at.astype(np.int32).tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())], ["slice", "at", "n"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(1 << SKETCH_BITS, np.int64)
    for batch in batches:
        for _, _, data, starts in _chunks(batch.column(0)):
            np.add.at(seen, (tokens(data, starts)[0] >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
    yield from _sliced(seen)


def _count_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(1 << SKETCH_BITS, np.int64)
    for batch in batches:
        np.add.at(seen, _flat(batch.column(0), np.uint32)[0] >> np.uint32(32 - SKETCH_BITS), 1)
    yield from _sliced(seen)


def _add(part: pd.DataFrame) -> pd.DataFrame:
    own = np.zeros((1 << SKETCH_BITS) // SLICES, np.int64)
    for at, n in zip(part["at"], part["n"], strict=True):
        own[np.frombuffer(at, np.int32)] += np.frombuffer(n, np.uint32)
    at = np.flatnonzero(own)
    n = np.minimum(own[at], MOST).astype(np.uint32)
    return pd.DataFrame({"task": [part["task"].iloc[0]], "slice": [part["slice"].iloc[0]], "at": [at.astype(np.int32).tobytes()], "n": [n.tobytes()]})


def sketch(df: DataFrame, count, least: int = 2) -> np.ndarray:
    """A level for each bucket of token hashes, from counts over all rows of ``df``: 0 for buckets counted less than
    ``least`` times, then by eighths of powers of two (1 at least). Tasks' counts are added up in a tree, FAN of a slice at a time, so that no
    group grows with the number of tasks. Levels take 8 MB at any corpus size."""
    tasks = df.rdd.getNumPartitions()
    counted = df.mapInArrow(count, "slice int, at binary, n binary").select(F.spark_partition_id().alias("task"), "slice", "at", "n")
    while True:
        counted = counted.withColumn("task", F.floor(F.col("task") / FAN).cast("int")).groupBy("slice", "task").applyInPandas(_add, "task int, slice int, at binary, n binary")
        tasks = -(-tasks // FAN)
        if tasks <= 1:
            break
    levels, width = np.zeros(1 << SKETCH_BITS, np.uint8), (1 << SKETCH_BITS) // SLICES
    for r in counted.collect():  # SLICES rows
        n = np.frombuffer(r.n, np.uint32)
        levels[r.slice * width + np.frombuffer(r.at, np.int32)] = np.where(n < least, 0, np.minimum(255, np.log2(np.maximum(n, 2)) * 8))
    return levels


def _flat(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary column laid end to end, and how many each row has."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if column.buffers()[2] is not None else np.empty(0, np.uint8)
    return np.frombuffer(data.tobytes(), kind), np.diff(offsets) // np.dtype(kind).itemsize


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    ends = np.r_[0, np.cumsum(counts * values.dtype.itemsize)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(values.tobytes())])


def _ordered(hashed: np.ndarray, line: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Puts tokens in order of line, level and hash. The order within a level goes by the low bits of the hash."""
    low = hashed & np.uint64((1 << 35) - 1)
    if not len(line) or int(line[-1]) < 1 << 21:  # lines come in ascending order
        key = (line.astype(np.uint64) << np.uint64(43)) | (level.astype(np.uint64) << np.uint64(35)) | low
        order = np.argsort(key)
        key, name = key[order], hashed[order]
        if not ((key[1:] == key[:-1]) & (name[1:] != name[:-1])).any():
            return order
    return np.lexsort((hashed, low, level, line))


def _lines(levels, percent: int):
    """Lines with words as sets: sums of token hashes that name the set, its size, a 128-bit bitmap, and the tokens of
    its prefix that some other line may hold (32 bits of their hashes), with their places (255 at most). A set too small
    to match any other than its equal has no prefix."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level_of = levels.value
        for batch in batches:
            for at, to, data, starts in _chunks(batch.column(2)):
                hashed, line, first_line = tokens(data, starts)
                level = level_of[(hashed >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                order = _ordered(hashed, line, level)
                hashed, line, level = hashed[order], line[order], level[order]
                once = np.r_[True, (hashed[1:] != hashed[:-1]) | (line[1:] != line[:-1])][: len(hashed)]
                hashed, line, level = hashed[once], line[once], level[once]
                begin = np.flatnonzero(np.r_[True, line[1:] != line[:-1]][: len(line)])
                size = np.diff(np.r_[begin, len(line)])
                own = line[begin]
                if not len(own):
                    continue
                place = np.arange(len(line)) - np.repeat(begin, size)
                prefix = np.where(size * 100 >= (size + 1) * percent, size - -(-size * percent // 100) + 1, 0)
                keep = (place < np.repeat(prefix, size)) & (level > 0)
                counts = np.add.reduceat(keep.astype(np.int64), begin)
                bit, high = np.uint64(1) << (hashed & np.uint64(63)), (hashed & np.uint64(64)) == 0
                bits = [np.bitwise_xor.reduceat(np.where(side, bit, np.uint64(0)), begin).view(np.int64) for side in (high, ~high)]
                text = np.searchsorted(first_line, own, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(at, to - at).take(pa.array(text)) for i in (0, 1)), pa.array((own - first_line[text]).astype(np.int32)),
                        pa.array(np.add.reduceat(_mix(hashed, 0xD6E8FEB86659FD93), begin).view(np.int64)), pa.array(np.add.reduceat(_mix(hashed, 0xA0761D6478BD642F), begin).view(np.int64)), pa.array(size.astype(np.int32)),
                        *map(pa.array, bits), _binary((hashed[keep] >> np.uint64(32)).astype(np.uint32), counts), _binary(np.minimum(place[keep], 255).astype(np.uint8), counts),
                    ],
                    ["doc_id", "hash", "line", "s1", "s2", "n", "b1", "b2", "tokens", "places"],
                )

    return lines


def _packed(held, asked, groups: int, cell: int):
    """Postings of classes (doc_id, hash, line, n, b1, b2, tokens, places, asks), packed by group. Tokens that a single class
    holds join nothing and are dropped. A token with more than ``cell`` postings has its classes dealt to blocks, and a class
    goes to each pair of blocks with its own in it."""

    def dealt(rows: list[np.ndarray]) -> pa.RecordBatch:
        rec, group = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
        order = np.argsort(group, kind="stable")
        rec, group = rec[order], group[order]
        begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]][: len(group)])
        # Byte planes: the high bytes of numbers are mostly alike and pack well.
        blobs = [r.view(np.uint8).reshape(len(r), -1).T.tobytes() for r in np.split(rec, begin[1:])] if len(rec) else []
        return pa.RecordBatch.from_arrays([pa.array(group[begin].astype(np.int32)), pa.array(blobs, pa.binary())], ["part", "data"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, waiting = [], 0
        for batch in batches:
            token, counts = _flat(batch.column(6), np.uint32)
            level = held.value[token >> np.uint32(32 - SKETCH_BITS)]
            owner = np.repeat(np.arange(len(counts)), counts)
            place = _flat(batch.column(7), np.uint8)[0]
            shared = level > 0
            if asked is not None:
                shared &= asked.value[token >> np.uint32(32 - SKETCH_BITS)] > 0
            token, owner, place = token[shared], owner[shared], place[shared]
            cells = np.ceil(np.exp2((level[shared].astype(np.float64) + 1) / 8) / cell).astype(np.int64)
            doc, text, line = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2))
            many = np.repeat(np.arange(len(token)), cells)
            token, owner, place, cells = token[many], owner[many], place[many], cells[many]
            other = np.arange(len(many)) - np.searchsorted(many, many)
            block = (_mix((doc[owner] ^ text[owner]).view(np.uint64) * _R + line[owner].astype(np.uint64), 0xBF58476D1CE4E5B9) % cells.astype(np.uint64)).astype(np.int64)
            pair = np.minimum(block, other).astype(np.uint64) * np.uint64(0x9E3779B1) + np.maximum(block, other).astype(np.uint64)
            name = _mix((token.astype(np.uint64) << np.uint64(32)) ^ _mix(pair, 0x94D049BB133111EB), 0xBF58476D1CE4E5B9)
            rec = np.empty(len(many), POSTING)
            rec["key"], rec["place"] = name >> np.uint64(32), place
            rec["n"] = np.minimum(batch.column(3).to_numpy(zero_copy_only=False), 65535)[owner]
            rec["doc_id"], rec["hash"], rec["line"] = doc[owner], text[owner], line[owner]
            rec["b1"], rec["b2"] = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64)[owner] for i in (4, 5))
            rec["asks"] = batch.column(8).to_numpy(zero_copy_only=False)[owner]
            rows.append((rec, (name & np.uint64(0xFFFFFFFF)) % np.uint64(groups)))
            waiting += len(rec)
            if waiting >= PACKED:
                yield dealt(rows)
                rows, waiting = [], 0
        if waiting:
            yield dealt(rows)

    return pack


def _meet(percent: int, few: int):
    """Pairs of a group's postings that pass the filters which no matching pair fails: the same token, sizes near enough,
    enough tokens left after the common one (the first common token passes this), and bitmaps that leave room for the
    overlap needed. The later line asks; of its pairs under a token the ``few`` of the nearest bitmaps go on, and
    ``more`` says whether there were others."""

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        rec = np.concatenate([np.frombuffer(b, np.uint8).reshape(POSTING.itemsize, -1).T.copy().view(POSTING).ravel() for b in part["data"]])
        rec = rec[np.argsort((rec["key"].astype(np.uint64) << np.uint64(16)) | rec["n"], kind="stable")]
        key, n, b1, b2 = (np.ascontiguousarray(rec[c]) for c in ("key", "n", "b1", "b2"))
        n = n.astype(np.int64)
        rest = n - rec["place"]
        doc, text, line = (np.ascontiguousarray(rec[c]) for c in PLACE)
        asks = rec["asks"] != 0
        more, place = np.zeros(len(rec), bool), np.empty(len(rec), np.int64)
        place[np.lexsort((line, text, doc))] = np.arange(len(rec))
        kept = np.empty((3, 0), np.int64)
        found, waiting = [], 0

        def nearest(pairs: np.ndarray) -> np.ndarray:
            asker, other, apart = pairs
            if len(rec) < 1 << 24:
                order = np.argsort((asker << 40) | (apart << 32) | place[other])
            else:
                order = np.lexsort((place[other], apart, asker))
            asker = asker[order]
            rank = np.arange(len(asker)) - np.searchsorted(asker, asker)
            more[asker[rank >= few]] = True
            return pairs[:, order[rank < few]]

        x, step = np.arange(len(rec)), 0
        while len(x):
            step += 1
            x = x[x + step < len(rec)]
            y = x + step  # sizes ascend, so the first that is too large ends a row's search
            near = (key[x] == key[y]) & (n[x] * 100 >= n[y] * percent)
            x, y = x[near], y[near]
            both = n[x] + n[y]
            apart = (np.bitwise_count(b1[x] ^ b1[y]) + np.bitwise_count(b2[x] ^ b2[y])).astype(np.int64)
            hit = ((both - apart) * (100 + percent) >= 2 * both * percent) & (np.minimum(rest[x], rest[y]) * (100 + percent) >= both * percent)
            if hit.any():
                a, b, apart = x[hit], y[hit], apart[hit]
                later = place[a] > place[b]
                asker, other = np.where(later, a, b), np.where(later, b, a)
                ok = asks[asker] & ((doc[a] != doc[b]) | (text[a] != text[b]) | (line[a] != line[b]))
                found.append(np.stack([asker[ok], other[ok], apart[ok]]))
                waiting += len(asker)
                if waiting > PACKED:
                    kept, found, waiting = nearest(np.concatenate([kept, *found], 1)), [], 0
        asker, other, apart = nearest(np.concatenate([kept, *found], 1))
        return pd.DataFrame({"doc_id": doc[asker], "hash": text[asker], "line": line[asker], "d2": doc[other], "h2": text[other], "l2": line[other], "apart": apart, "more": more[asker]})

    return meet


def _candidates(own: Scratch, classes: DataFrame, held, asked, postings: int, percent: int, few: int, cell: int) -> DataFrame:
    """Pairs (doc_id, hash, line, d2, h2, l2, apart, more) that may match, each once: an asking class and an earlier one."""
    groups = max(2 * classes.sparkSession.sparkContext.defaultParallelism, -(-postings // GROUP_POSTINGS))
    packed = classes.select(*PLACE, "n", "b1", "b2", "tokens", "places", "asks").filter(F.octet_length("tokens") > 0).mapInArrow(_packed(held, asked, groups, cell), "part int, data binary")
    met = packed.groupBy("part").applyInPandas(_meet(percent, few), f"{PAIR}, apart long, more boolean")
    return own.table(met.groupBy(*PLACE, *OTHER).agg(F.min("apart").alias("apart"), F.max("more").alias("more")))


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The token sets of the wanted lines (line, d2, h2, l2) of each text (doc_id, hash, text, wanted)."""
    for batch in batches:
        wanted = batch.column(3).flatten()
        counts = np.diff(batch.column(3).offsets.to_numpy())
        number, picked, at = wanted.field("line").to_pylist(), [], 0
        for text, n in zip(batch.column(2), counts.tolist(), strict=True):
            lines = text.as_py().encode("utf-8", "surrogatepass").split(b"\n")
            picked += [lines[k] if k < len(lines) else b"" for k in number[at : at + n]]
            at += n
        starts = np.cumsum([0, *map(len, picked)])
        cut = 0
        ends, parts = [0], []
        while cut < len(picked):  # about WORK_BYTES at a time
            to = max(cut + 1, int(np.searchsorted(starts, starts[cut] + WORK_BYTES, side="right")) - 1)
            hashed, line, _ = tokens(np.frombuffer(b"".join(picked[cut:to]), np.uint8), starts[cut:to] - starts[cut])
            order = np.lexsort((hashed, line))
            hashed, line = hashed[order], line[order]
            once = np.r_[True, (hashed[1:] != hashed[:-1]) | (line[1:] != line[:-1])][: len(hashed)]
            parts.append(hashed[once].view(np.int64))
            ends += (ends[-1] + np.searchsorted(line[once], np.arange(1, to - cut + 1))).tolist()
            cut = to
        sets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *parts]), pa.int64()))
        owner = pa.array(np.repeat(np.arange(len(counts)), counts))
        yield pa.RecordBatch.from_arrays([*(batch.column(i).take(owner) for i in (0, 1)), *(wanted.field(c) for c in ("line", *OTHER)), sets], [*PLACE, *OTHER, "tokens"])


def _verify(own: Scratch, docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The lines (doc_id, hash, line) of pairs whose token sets reach the threshold. The later lines' sets meet those of
    the others, each of these once, in a join that adaptive execution splits where many ask one. The lists of lines are
    counted first and broadcast to the texts (doc_id, hash, text) up to BROADCAST_ROWS pairs; beyond, texts are shuffled."""
    few = pairs.count() <= BROADCAST_ROWS

    def sets(lines: DataFrame) -> DataFrame:
        needed = lines.groupBy("doc_id", "hash").agg(F.collect_list(F.struct("line", *OTHER)).alias("wanted"))
        needed = F.broadcast(needed) if few else needed.hint("merge")
        return docs.join(needed, ["doc_id", "hash"]).select("doc_id", "hash", "text", "wanted").mapInArrow(_wanted, f"{PAIR}, tokens array<long>")

    others = pairs.select(*[F.col(o).alias(p) for o, p in zip(OTHER, PLACE, strict=True)], *OTHER).distinct()
    other = sets(others).select(*OTHER, F.col("tokens").alias("t2"))
    both = sets(pairs.select(*PLACE, *OTHER)).join(other, OTHER)
    common, total = F.size(F.array_intersect("tokens", "t2")), F.size("tokens") + F.size("t2")
    return own.table(both.filter(common * 100 >= (total - common) * percent).select(*PLACE).distinct())


def unlike_texts(docs: DataFrame) -> bool:
    """Whether some doc_id has rows of unlike texts."""
    hashed = F.xxhash64("text")
    ids = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").groupBy("doc_id").agg(F.min(hashed).alias("low"), F.max(hashed).alias("high"))
    return ids.filter("low <> high").limit(1).count() > 0


def _texts(docs: DataFrame, unlike: bool, *more: str) -> DataFrame:
    """(doc_id, hash, text, more columns) of documents with a text: null ids count as the greatest, and their hashes differ
    from those of rows with an id, which are 0 where a doc_id tells its text already."""
    id_ = F.col("doc_id").cast("long")
    hashed = F.when(id_.isNull(), F.xxhash64("text", F.lit("no id"))).otherwise(F.xxhash64("text") if unlike else F.lit(0).cast("long"))
    return docs.filter("text IS NOT NULL").select(F.coalesce(id_, F.lit(NO_ID)).alias("doc_id"), hashed.alias("hash"), "text", *more)


def matched_lines(docs: DataFrame, percent: int = 75, scratch: Scratch | None = None, few: int = FEW, cell: int = CELL, unlike: bool | None = None) -> DataFrame:
    """The lines (doc_id, hash, line) of documents (doc_id, text) that an earlier line matches: one whose token set has a
    Jaccard similarity of ``percent`` in 100 or more, earlier by doc_id (null last), the hash of its text and then line
    number (from 0).

    Lines without words match nothing. Lines of equal sets form a class that stands at its earliest line; its other
    lines are matched. Classes meet over the tokens of their prefixes, rarest first. A class first asks the earlier one of
    the nearest bitmap, then, if that fails, the others found near it, and classes that met more than were named ask
    again for FAR times as many until none is left. So a large group of near copies costs a few pairs each and not one
    for each two of them. Candidates are verified on their full token sets. Rows alike in doc_id and text count as one
    place, unlike texts of one doc_id (or of none) as places of their own; null texts are left out, and only doc_id and
    text are read. ``hash`` tells the texts of one doc_id apart, see ``_texts``; it is needed only where such texts are ``unlike``, which
    is looked up unless given. An empty table gives an empty result.
    """
    own = scratch or Scratch(docs.sparkSession, "line-dedup")
    context = docs.sparkSession.sparkContext
    docs = _texts(docs, unlike_texts(docs) if unlike is None else unlike)
    levels = context.broadcast(sketch(docs.select("text"), _count_words))
    lines = own.table(docs.mapInArrow(_lines(levels, percent), LINE))
    firsts = [F.first(c).alias(c) for c in ("b1", "b2", "tokens", "places")]
    sets = lines.groupBy("s1", "s2", "n").agg(F.min(F.struct(*PLACE)).alias("at"), F.count(F.lit(1)).alias("lines"), *firsts)
    classes = own.table(sets.select("s1", "s2", "n", "at.*", "lines", "b1", "b2", "tokens", "places"))

    # Copies: the lines of a class other than its first.
    repeated = classes.filter("lines > 1").select("s1", "s2", "n", F.col("doc_id").alias("d"), F.col("hash").alias("h"), F.col("line").alias("l"))
    copies = own.table(lines.select(*PLACE, "s1", "s2", "n").join(repeated, ["s1", "s2", "n"]).filter("doc_id <> d OR hash <> h OR line <> l").select(*PLACE))
    own.drop(lines)

    held = context.broadcast(sketch(classes.select("tokens"), _count_postings))
    postings = classes.agg(F.sum(F.octet_length("places"))).first()[0] or 0
    asking, asked, found, tried = classes.withColumn("asks", F.lit(True)), None, None, None
    while True:
        pairs = _candidates(own, asking, held, asked, postings, percent, few, cell)
        near = pairs.groupBy(*PLACE).agg(F.min(F.struct("apart", *OTHER)).alias("near")).select(*PLACE, *[f"near.{c}" for c in OTHER])
        new = pairs if tried is None else pairs.join(tried.hint("merge"), [*PLACE, *OTHER], "left_anti")
        first = own.table(near if tried is None else near.join(tried.hint("merge"), [*PLACE, *OTHER], "left_anti"))
        hit = _verify(own, docs, first, percent)
        rest = own.table(new.join(hit, PLACE, "left_anti").join(first, [*PLACE, *OTHER], "left_anti").select(*PLACE, *OTHER))
        hit = hit.union(_verify(own, docs, rest, percent))
        found = hit if found is None else found.union(hit)
        open_ = own.table(pairs.filter("more").select(*PLACE).distinct().join(hit, PLACE, "left_anti").withColumn("asks", F.lit(True)))
        if not open_.limit(1).count():
            break
        tried, few = pairs.select(*PLACE, *OTHER), few * FAR
        asking = own.table(classes.join(open_, PLACE, "left").withColumn("asks", F.coalesce("asks", F.lit(False))))
        asked = context.broadcast(sketch(asking.filter("asks").select("tokens"), _count_postings, least=1))

    result = own.keep(copies.union(found).distinct())
    own.clear()
    return result


def _worded(text: str) -> Column:
    """The numbers of a text's lines that hold words."""
    return F.filter(F.transform(F.split(text, "\n"), lambda line, i: F.when(line.rlike(r"[^\x20\x09-\x0D]"), i)), lambda i: i.isNotNull())


def dedup_report(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Per row of documents: doc_id, n_lines (0 for null texts), n_removed, n_kept and removed_lines, the numbers joined by
    commas. Rows alike in doc_id and text have alike reports, but of rows without a doc_id each is a document of its
    own: the first of equal texts keeps what no earlier line matches, the others lose all lines with words."""
    unlike = unlike_texts(docs)
    found = matched_lines(docs, percent, unlike=unlike).groupBy("doc_id", "hash").agg(F.sort_array(F.collect_set("line")).alias("lines"))
    texts = _texts(docs, unlike)
    worded = F.when(F.col("doc_id") == NO_ID, _worded("text"))
    places = texts.select("doc_id", "hash", F.size(F.split("text", "\n")).cast("long").alias("n_lines"), worded.alias("worded")).groupBy("doc_id", "hash").agg(F.first("n_lines").alias("n_lines"), F.first("worded").alias("worded"), F.count(F.lit(1)).alias("copies"))
    rows = repeated(places.join(found, ["doc_id", "hash"], "left"), "copies", "copy")
    lines = F.when((F.col("copy") > 0) & (F.col("doc_id") == NO_ID), F.col("worded")).otherwise(F.coalesce("lines", F.array().cast("array<int>")))
    rows = rows.select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "n_lines", lines.alias("lines"))
    empty = docs.filter("text IS NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_lines"), F.array().cast("array<int>").alias("lines"))
    n = F.size("lines").cast("long")
    return rows.unionByName(empty).select("doc_id", "n_lines", n.alias("n_removed"), (F.col("n_lines") - n).alias("n_kept"), F.array_join("lines", ",").alias("removed_lines"))


def dedup_lines(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The documents, all columns, without the lines that earlier ones match. Null texts stay as they are, and rows alike in
    doc_id and text lose the same lines. Rows without a doc_id are documents of their own: of equal texts the first keeps
    what no earlier line matches, the others lose all lines with words. Columns may have any name."""
    unlike = unlike_texts(docs)
    removed = matched_lines(docs, percent, unlike=unlike).groupBy("doc_id", "hash").agg(F.collect_set("line").alias("lines"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    texts = _texts(rows, unlike, "row")
    named = texts.filter(F.col("doc_id") != NO_ID).select("*", F.lit(False).alias("again"))
    # Rows alike in all columns are counted before any shuffle; of the others with one text that of the smallest hash is first.
    alike = texts.filter(F.col("doc_id") == NO_ID).groupBy("doc_id", "hash", F.xxhash64(F.to_json("row")).alias("whole")).agg(F.first("text").alias("text"), F.first("row").alias("row"), F.count(F.lit(1)).alias("copies"))
    first = alike.groupBy("hash").agg(F.min("whole").alias("least"))
    nameless = repeated(alike.join(first, "hash"), "copies", "copy").select("doc_id", "hash", "text", "row", ((F.col("whole") != F.col("least")) | (F.col("copy") > 0)).alias("again"))
    met = named.unionByName(nameless).join(removed.hint("merge"), ["doc_id", "hash"], "left")
    gone = F.when(F.col("again"), _worded("text")).otherwise(F.coalesce("lines", F.array().cast("array<int>")))
    split = met.select("row", F.split("text", "\n").alias("parts"), gone.alias("gone"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    left = split.select("row", F.array_join(F.transform(stay, lambda i: F.col("parts")[i]), "\n").alias("text"))
    columns = [F.col("text").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
    return left.select(*columns).unionByName(rows.filter("text IS NULL").select("row.*"))


#: The same join over distinct word sets: two sets as alike share a word among the rarest n - ceil(3 n / 4) + 1 of each.
ORACLE = r"""WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
  lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS i FROM split WHERE doc_id IS NOT NULL),
  sets AS (SELECT doc_id, i, list_sort(list_distinct(regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'))) AS words FROM lines),
  classes AS (SELECT words, min(doc_id::HUGEINT * 4294967296 + i) AS head, row_number() OVER () AS c FROM sets WHERE len(words) > 0 GROUP BY words),
  members AS (SELECT c, unnest(words) AS word, len(words) AS n FROM classes),
  rarity AS (SELECT word, count(*) AS holders FROM members GROUP BY word),
  ranked AS (SELECT c, word, n, row_number() OVER (PARTITION BY c ORDER BY holders, word) AS rank FROM members JOIN rarity USING (word)),
  prefixes AS (SELECT c, word, n FROM ranked WHERE rank <= n - ceil(3 * n / 4.0) + 1),
  candidates AS (SELECT DISTINCT a.c AS a, b.c AS b FROM prefixes a JOIN prefixes b ON a.word = b.word AND a.c < b.c AND 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n)),
  compared AS (SELECT a, b, len(list_intersect(x.words, y.words)) AS same, len(x.words) + len(y.words) AS total FROM candidates JOIN classes x ON x.c = a JOIN classes y ON y.c = b),
  links AS (SELECT a, b FROM compared WHERE 100 * same >= 75 * (total - same)),
  ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links UNION ALL SELECT c, c FROM classes),
  firsts AS (SELECT a AS c, min(head) AS first FROM ways JOIN classes ON c = b GROUP BY a),
  removed AS (SELECT doc_id, count(*) AS n, string_agg(i::VARCHAR, ',' ORDER BY i) AS gone FROM sets JOIN classes USING (words) JOIN firsts USING (c) WHERE first < doc_id::HUGEINT * 4294967296 + i GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_removed, (coalesce(len(string_split(text, chr(10))), 0) - coalesce(n, 0))::BIGINT AS n_kept, coalesce(gone, '') AS removed_lines
FROM documents d LEFT JOIN removed r ON r.doc_id = d.doc_id"""
