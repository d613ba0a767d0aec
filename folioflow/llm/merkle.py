"""Operator 13, a Merkle manifest of a dataset with an inclusion witness for every row."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import Scratch, repeated

#: A block holds 2^BLOCK_BITS consecutive nodes of a tree and is appended to in one task.
BLOCK_BITS = 12
#: A step of a witness: which side the sibling stands on, and its 32 bytes (zeros where a node has none).
ALONE, LEFT, RIGHT = b"\x00", b"\x01", b"\x02"
STEP = 33
#: Rows of a range when leaves are put in order.
RANGE_ROWS = 50_000


def hashed(*inputs: str) -> str:
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


class Appender:
    """Aligned append of nodes to a binary tree.

    ``open`` holds the completed subtrees that still wait for a sibling, as (height, digest, first, end), heights falling
    to the right. A new node joins the last one as long as both are of one height, and each such completion extends the
    witnesses of all nodes below either side. ``close`` completes what is left with runs of one node.
    """

    def __init__(self) -> None:
        self.open: list[tuple[int, str, int, int]] = []
        self.witnesses: list[bytearray] = []

    def append(self, digest: str) -> None:
        at = len(self.witnesses)
        self.witnesses.append(bytearray())
        self._join(0, digest, at, at + 1)

    def _extend(self, first: int, end: int, step: bytes) -> None:
        for w in self.witnesses[first:end]:
            w += step

    def _join(self, height: int, digest: str, first: int, end: int) -> None:
        while self.open and self.open[-1][0] == height:
            _, left, start, _ = self.open.pop()
            self._extend(start, first, RIGHT + bytes.fromhex(digest))
            self._extend(first, end, LEFT + bytes.fromhex(left))
            height, digest, first = height + 1, hashed(left, digest), start
        self.open.append((height, digest, first, end))

    def close(self, height: int) -> str:
        """The root at ``height``; open subtrees below it are raised alone until they meet a sibling."""
        while self.open[-1][0] < height:
            low, digest, first, end = self.open.pop()
            self._extend(first, end, ALONE + bytes(32))
            self._join(low + 1, hashed(digest), first, end)
        return self.open[-1][1]


def steps(witness: bytes) -> Iterator[tuple[bytes, str]]:
    for at in range(0, len(witness), STEP):
        yield witness[at : at + 1], witness[at + 1 : at + STEP].hex()


def fold(leaf: str, witness: bytes) -> str:
    """The root that a leaf and its witness lead to."""
    for side, sibling in steps(witness):
        leaf = hashed(leaf) if side == ALONE else hashed(sibling, leaf) if side == LEFT else hashed(leaf, sibling)
    return leaf


def proof(witness: bytes) -> str:
    """The digest of a witness's siblings in order."""
    return hashed(*[s for side, s in steps(witness) if side != ALONE])


def field(value: Column) -> Column:
    """A value as text that no neighbour can run into: its UTF-8 byte count, a colon and itself, or - for null."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _blocks(nodes: DataFrame, bits: int) -> DataFrame:
    """Nodes (tree, pos, n: nodes of the tree, digest) with their block, their witness within it and, in the block's
    first row, the block's root."""

    def appended(part: pa.Table) -> pa.Table:
        part = part.sort_by("pos")
        own = Appender()
        for digest in part.column("digest").to_pylist():
            own.append(digest)
        n = part.column("n")[0].as_py()
        root = own.close(min(bits, (n - 1).bit_length()))
        columns = [part.column("tree"), part.column("pos"), part.column("block"), part.column("n"), pa.array([bytes(w) for w in own.witnesses], pa.binary()), pa.array([root] + [None] * (len(part) - 1), pa.string())]
        return pa.table(columns, ["tree", "pos", "block", "n", "witness", "root"])

    grouped = nodes.select("tree", "pos", F.shiftright("pos", bits).alias("block"), "n", "digest").groupBy("tree", "block")
    return grouped.applyInArrow(appended, "tree string, pos long, block long, n long, witness binary, root string")


def grow(own: Scratch, nodes: DataFrame, bits: int = BLOCK_BITS) -> tuple[DataFrame, DataFrame]:
    """Trees over nodes (tree, pos 0.., n, digest). First the nodes with their witnesses within their blocks (tree, pos,
    block, witness); second, a row for each block (tree, block, above, root): the rest of the way, and the tree's root.

    A block is appended to by one task and its root is a node of the next round, until a round has one block a tree; a
    block's own witness in that round, and so on upwards, extends those of its nodes.
    """
    rounds = []
    while True:
        level = own.table(_blocks(nodes, bits))
        rounds.append(level)
        nodes = level.filter("root IS NOT NULL").select("tree", F.col("block").alias("pos"), F.shiftright(F.col("n") + (1 << bits) - 1, bits).alias("n"), F.col("root").alias("digest"))
        if not nodes.filter("n > 1").limit(1).count():
            break
    up = nodes.select("tree", F.col("pos").alias("block"), F.lit(b"").alias("above"), F.col("digest").alias("root"))
    for level in reversed(rounds[1:]):
        joined = level.select("tree", "block", "pos", "witness").join(up, ["tree", "block"])
        up = joined.select("tree", F.col("pos").alias("block"), F.concat("witness", "above").alias("above"), "root")
    return rounds[0].select("tree", "pos", "block", "witness"), up


def _numbered(own: Scratch, groups: DataFrame, order: list[str], ranges: int) -> DataFrame:
    """Rows of ``groups`` (tree, order columns, copies, ...), each ``copies`` times, with pos, their place in their tree,
    and n, its rows. Rows are sorted in ranges, so that a tree may hold any share of them."""
    ranged = groups.repartitionByRange(ranges, "tree", *order).sortWithinPartitions("tree", *order)
    placed = own.table(repeated(ranged, "copies", "copy").drop("copies", "copy").select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")))
    return placed.sparkSession.sql(
        """WITH runs AS (SELECT tree, part, min(place) AS first, count(*) AS rows FROM {placed} GROUP BY tree, part),
        starts AS (SELECT tree, part, first, sum(rows) OVER (PARTITION BY tree ORDER BY part) - rows AS start, sum(rows) OVER (PARTITION BY tree) AS n FROM runs)
        SELECT p.*, p.place - s.first + s.start AS pos, s.n FROM {placed} p JOIN starts s ON p.tree = s.tree AND p.part = s.part""",
        placed=placed,
    ).drop("part", "place")


def manifest(docs: DataFrame, claimed: Column | None = None, bits: int = BLOCK_BITS) -> DataFrame:
    """A row for each row of documents (doc_id, source, lang, n_chars, text): doc_id, leaf, claimed, subroot, root and
    witness, which leads from the leaf to the root.

    Each lang has a tree over its leaves by doc_id; the trees' roots, by lang (null first, then bytewise), are the leaves
    of the last tree. ``claimed`` is a leaf to be checked against the witness, by default the row's own. Null doc_ids come
    first and rows of one doc_id by leaf; equal rows are leaves of their own, counted before any shuffle. An empty table
    has no rows and no root. Other columns are not read.

    Leaves are ordered in ranges, blocks of 2^bits leaves are appended to in one task each, and their roots go on upwards
    in the same way, so no task or driver holds a tree. One digest, the root, is collected.
    """
    own = Scratch(docs.sparkSession, "merkle")
    tree = F.coalesce(F.concat(F.lit("+"), F.col("lang").cast("string")), F.lit("")).alias("tree")
    leaves = docs.select(tree, "doc_id", leaf(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]).alias("digest"), (F.lit(None).cast("string") if claimed is None else claimed).alias("claimed"))
    groups = leaves.groupBy("tree", "doc_id", "digest", "claimed").agg(F.count(F.lit(1)).alias("copies"))
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // RANGE_ROWS))
    rows = own.table(_numbered(own, groups, ["doc_id", "digest", "claimed"], ranges))
    within, blocks = grow(own, rows.select("tree", "pos", "n", "digest"), bits)
    blocks = own.table(blocks)
    trees = blocks.filter("block = 0").select("tree", F.col("root").alias("digest"))
    tops = trees.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest", F.lit(1).cast("long").alias("copies"))
    tops = own.table(_numbered(own, tops, ["name"], max(1, -(-trees.count() // RANGE_ROWS))))
    top_within, top_blocks = grow(own, tops.select("tree", "pos", "n", "digest"), bits)
    top_blocks = own.table(top_blocks)
    first = top_blocks.select("root").first()
    ways = tops.select("name", "pos").join(top_within.select("pos", "block", "witness"), "pos").join(top_blocks.select("block", F.col("above").alias("rest")), "block")
    ways = ways.select(F.col("name").alias("tree"), F.concat("witness", "rest").alias("way"))
    above = blocks.join(ways, "tree").select("tree", "block", F.concat("above", "way").alias("above"), F.col("root").alias("subroot"))
    full = rows.join(within, ["tree", "pos"]).join(above, ["tree", "block"])
    result = own.keep(full.select("doc_id", F.col("digest").alias("leaf"), F.coalesce("claimed", "digest").alias("claimed"), "subroot", F.lit(first.root if first else None).cast("string").alias("root"), F.concat("witness", "above").alias("witness")))
    own.clear()
    return result


def verify(rows: DataFrame) -> DataFrame:
    """Rows of a manifest with proof_sha256, folded_root (from claimed and witness) and verified."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ways, claims, roots = (batch.column(c).to_pylist() for c in ("witness", "claimed", "root"))
            ends = [fold(c, w) for c, w in zip(claims, ways, strict=True)]
            columns = [*(batch.column(c) for c in ("doc_id", "leaf", "subroot", "root")), pa.array([proof(w) for w in ways], pa.string()), pa.array(ends, pa.string()), pa.array([a == b for a, b in zip(ends, roots, strict=True)], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return rows.select("doc_id", "leaf", "claimed", "subroot", "root", "witness").mapInArrow(folded, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def tampered(docs: DataFrame) -> DataFrame:
    """The manifest of documents, verified against leaves in which a row whose unsigned crc32(doc_id) is a multiple of 7
    has one more n_chars. Null doc_ids and null n_chars stay as they are."""
    more = F.col("n_chars").cast("decimal(20,0)") + F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, 1).otherwise(0)
    forged = leaf(F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text"))
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    return verify(manifest(docs, F.when(hit, forged)))


_FIELDS = ["doc_id::VARCHAR", "source", "lang", "{n}", "text"]
_LEAF = "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in _FIELDS) + ")"
#: Levels by a recursive join, proofs and folds by a second one. DuckDB has no crc32, so it is computed bit by bit.
ORACLE = f"""WITH RECURSIVE crc AS (SELECT doc_id, doc_id::VARCHAR AS s, 1 AS i, 4294967295::BIGINT AS c FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT doc_id, s, i + 1, list_reduce([xor(c, ord(substr(s, i, 1))::BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a // 2, CASE WHEN a % 2 = 1 THEN 3988292384 ELSE 0 END)) FROM crc WHERE i <= length(s)),
forged AS (SELECT doc_id FROM crc WHERE i = length(s) + 1 AND xor(c, 4294967295) % 7 = 0),
leaves AS (SELECT lang, doc_id, {_LEAF.format(n="n_chars::VARCHAR")} AS leaf, CASE WHEN doc_id IN (FROM forged) THEN {_LEAF.format(n="(n_chars + 1)::VARCHAR")} END AS other FROM documents),
placed AS (SELECT *, coalesce('+' || lang, '') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
up AS (SELECT tree, 0 AS level, pos, n, leaf AS h FROM placed
  UNION ALL SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY tree, level, pos // 2, n),
subs AS (SELECT tree, level AS height, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
tops AS (SELECT 0 AS level, pos, n, h FROM subs UNION ALL SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 2, n),
steps AS (SELECT u.tree, u.pos AS at, u.level, u.n > 1 AS more, s.h AS sibling FROM up u LEFT JOIN up s ON s.tree = u.tree AND s.level = u.level AND s.pos = xor(u.pos, 1::BIGINT)),
topsteps AS (SELECT u.pos AS at, u.level, u.n > 1 AS more, s.h AS sibling FROM tops u LEFT JOIN tops s ON s.level = u.level AND s.pos = xor(u.pos, 1::BIGINT)),
walk AS (SELECT doc_id, leaf, tree, pos, 0 AS level, coalesce(other, leaf) AS h, '' AS way FROM placed
  UNION ALL SELECT doc_id, leaf, w.tree, pos // 2, w.level + 1, sha256(CASE WHEN pos % 2 = 1 THEN sibling || h ELSE h || coalesce(sibling, '') END), way || coalesce(sibling, '') FROM walk w JOIN steps s ON s.tree = w.tree AND s.at = w.pos AND s.level = w.level WHERE s.more),
climb AS (SELECT w.doc_id, w.leaf, s.h AS subroot, s.pos, 0 AS level, w.h, w.way FROM walk w JOIN subs s ON s.tree = w.tree AND s.height = w.level
  UNION ALL SELECT doc_id, leaf, subroot, pos // 2, c.level + 1, sha256(CASE WHEN pos % 2 = 1 THEN sibling || h ELSE h || coalesce(sibling, '') END), way || coalesce(sibling, '') FROM climb c JOIN topsteps s ON s.at = c.pos AND s.level = c.level WHERE s.more)
SELECT doc_id, leaf, subroot, t.h AS root, sha256(way) AS proof_sha256, c.h AS folded_root, c.h = t.h AS verified FROM climb c JOIN tops t ON t.n = 1 AND t.level = c.level"""
