"""Operator 8, near-duplicate embeddings by HNSW graphs per shard."""

from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyarrow.fs import FileType
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import Scratch, components, open_store, qualified
from folioflow.llm.hnsw import Graph

#: Bytes of the single-precision vectors of a shard's graph, but for the unevenness of hashing: memory decides how many
#: shards there are (131,072 vectors of 64 components each).
SHARD_BYTES = 1 << 25
#: Blocks in which the vectors of a shard ask.
BLOCKS = 4
FIRST_BEAM, LAST_BEAM = 16, 256
#: An audit compares this many queries with brute force: all links, and this many nearest points of each.
AUDITED, NEAREST = 64, 8
LINK_RECALL, NEAREST_RECALL = 0.999, 0.9
#: Single-precision similarities this far under the threshold are still verified in double precision.
SLACK = 1e-4
#: Similarities computed at once by brute force.
TILE = 1 << 22


def _prepare(single: bool):
    kind = np.float32 if single else np.float64

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, groups, vectors = [], [], []
            for vector, label in zip(batch.column(1), batch.column(2), strict=True):
                key = group = raw = None
                values = vector.as_py()
                if values and label.is_valid and None not in values:
                    v = np.asarray(values, kind) + kind(0)
                    if np.isfinite(v).all() and v.any():
                        group, raw = f"{label.as_py()}\x00{len(v)}", v.tobytes()
                        key = xxhash.xxh3_128_digest(group.encode() + b"\x00" + raw)
                keys.append(key)
                groups.append(group)
                vectors.append(raw)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(groups, pa.string()), pa.array(vectors, pa.binary())], ["vec_id", "cls", "grp", "vec"])

    return prepare


def _unit(raw: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first so that no square overflows."""
    x = raw.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _stack(column: pd.Series, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def _graph_file(folder: str, grp: str, shard: int) -> str:
    return f"{folder}/{hashlib.sha256(grp.encode()).hexdigest()}-{shard}"


def _build(kind, folder: str):
    """Builds a shard's graph and writes it below the shared ``folder``. A repeated attempt makes the same bytes and puts
    them there by a rename, so readers see a whole file."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("cls", kind="stable")
        part = part.iloc[np.random.default_rng(8).permutation(len(part))]
        raw = _stack(part["vec"], kind)
        layers, layer = [], Graph(_unit(raw)).bottom
        while layer is not None:
            layers.append(layer.links)
            layer = layer.upper
        out = io.BytesIO()
        np.savez(out, raw=raw, keys=_stack(part["cls"], np.uint8), copies=part["copies"].to_numpy(np.int64), **{f"links{i}": a for i, a in enumerate(layers)})
        grp, shard = part["grp"].iloc[0], part["shard"].iloc[0]
        store, path = open_store(_graph_file(folder, grp, shard))
        store.create_dir(path.rsplit("/", 1)[0])
        new = f"{path}.{uuid.uuid4().hex}"
        with store.open_output_stream(new, compression=None) as file:
            file.write(out.getbuffer())
        store.move(new, path)
        return pd.DataFrame({"grp": [grp], "shard": [shard]})

    return build


def _load(folder: str, grp: str, shard: int):
    """A shard's graph, points, classes and copies, or None for a shard without vectors."""
    store, path = open_store(_graph_file(folder, grp, shard))
    if store.get_file_info(path).type != FileType.File:
        return None
    with store.open_input_file(path) as file:
        data = np.load(io.BytesIO(file.read()))
    links = [data[f"links{i}"] for i in range(sum(n.startswith("links") for n in data.files))]
    x = _unit(data["raw"])
    return Graph.restored(x, links), x, data["keys"], data["copies"]


def links_of(graph: Graph, x: np.ndarray, q: np.ndarray, threshold: float, served: dict | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The (query, point) pairs found with a cosine of ``threshold`` or more in double precision, part by part, so that
    a dense group's pairs are never held together.

    The beam starts at FIRST_BEAM and doubles until an audit passes: brute force over some of the queries, of whose links
    the graph must find LINK_RECALL and of whose NEAREST points, however far, NEAREST_RECALL. A query whose beam holds
    nothing but links is asked again with a wider one. Beyond LAST_BEAM a query is compared with the whole shard, which
    bounds its cost and is exact. ``served`` counts the queries answered by graph and by scan.
    """
    low = np.float32(threshold - SLACK)
    served = {} if served is None else served

    def scan(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        served["scan"] = served.get("scan", 0) + len(rows)
        step = max(1, TILE // len(x))
        for i in range(0, len(rows), step):
            r, c = np.nonzero(q[rows[i : i + step]] @ x.T >= threshold)
            yield rows[i : i + step][r], c

    def passes(rows: np.ndarray, beam: int) -> bool:
        links, found, near, reached = 0, 0, 0, 0
        k, step = min(NEAREST, len(x)), max(1, TILE // len(x))
        for i in range(0, len(rows), step):
            at = rows[i : i + step]
            exact = q[at] @ x.T
            ids, sims = graph.search(q[at], beam)
            got = np.where(ids >= 0, np.take_along_axis(exact, np.maximum(ids, 0), 1), -np.inf)
            full = ((ids >= 0) & (sims >= low)).all(1)  # these will be asked again whatever the beam
            true = (exact >= threshold).sum(1)
            links, found = links + int(true.sum()), found + int(np.where(full, true, (got >= threshold).sum(1)).sum())
            least = np.partition(exact, len(x) - k, axis=1)[:, len(x) - k, None]
            near, reached = near + k * len(at), reached + int(np.minimum(k, (got >= least).sum(1)).sum())
        return found >= LINK_RECALL * links and reached >= NEAREST_RECALL * near

    everyone = np.arange(len(q))
    audited, beam = everyone[:: max(1, len(q) // AUDITED)], FIRST_BEAM
    while beam <= LAST_BEAM and beam < len(x) and not passes(audited, beam):
        beam *= 2
    while len(everyone) and beam <= LAST_BEAM and beam < len(x):
        again = []
        for i in range(0, len(everyone), 256):
            at = everyone[i : i + 256]
            ids, sims = graph.search(q[at], beam)
            near = (ids >= 0) & (sims >= low)
            full = near.all(1)
            again.append(at[full])
            r, c = np.nonzero(near & ~full[:, None])
            r, c = at[r], ids[r, c]
            true = np.einsum("nd,nd->n", q[r], x[c]) >= threshold
            yield r[true], c[true]
        served["graph"] = served.get("graph", 0) + len(everyone) - sum(map(len, again))
        everyone, beam = np.concatenate(again), beam * 2
    yield from scan(everyone)


def joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` (the smallest node that each node reaches) after adding the edges a - b."""
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        if not apart.any():
            return root
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]


def _search(kind, threshold: float, folder: str):
    def search(queries: pd.DataFrame) -> pd.DataFrame:
        loaded = _load(folder, queries["grp"].iloc[0], queries["shard"].iloc[0])
        if loaded is None:
            return pd.DataFrame({"a": [], "b": [], "n": []})
        graph, x, keys, copies = loaded
        points = [k.tobytes() for k in keys]
        place = {k: i for i, k in enumerate(points)}
        own = queries["cls"].to_list()
        inside = queries["shard"].iloc[0] == queries["from"].iloc[0]
        node = np.array([place.get(k, len(points) + i) for i, k in enumerate(own)], np.int64)
        name = points + own
        weight = queries["copies"].to_numpy(np.int64)
        root = np.arange(len(name))
        asked, met = np.zeros(len(own), np.int64), np.zeros(len(points), np.int64)
        for a, b in links_of(graph, x, _unit(_stack(queries["vec"], kind)), threshold):
            other = node[a] != b
            a, b = a[other], b[other]
            np.add.at(asked, a, copies[b])
            if not inside:  # inside a shard each side asks for itself
                np.add.at(met, b, weight[a])
            root = joined(root, node[a], b)
        edge, met_at = np.flatnonzero(root != np.arange(len(root))), np.flatnonzero(met)
        # A query that is a point has that point's node; name[node] and own are the same class.
        return pd.DataFrame({
            "a": [*own, *(points[i] for i in met_at), *(name[i] for i in edge)],
            "b": [None] * (len(own) + len(met_at)) + [name[i] for i in root[edge]],
            "n": np.concatenate([asked, met[met_at], np.zeros(len(edge), np.int64)]),
        })

    return search


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, shard_bytes: int = SHARD_BYTES, scratch: Scratch | None = None) -> DataFrame:
    """Links vectors (vec_id, embedding, label) of equal non-null label with a cosine of ``threshold`` or more.

    Returns per row vec_id, n_links (other vectors linked directly), component_id (the smallest vec_id reachable) and
    kept. Null, empty and zero vectors, those with null or non-finite components and those without a label link with
    nothing; vectors of unlike lengths don't either. Repeated rows link with each other. Rows of one vec_id with unlike
    vectors count as vectors of their own; a null vec_id links others and has its own count, its component is that of the
    ids it reaches and it counts as kept. Other columns are not read; an empty table gives an empty result.

    Equal vectors form a class and go on as one with a count. Each label's classes are dealt by hash to shards of about
    ``shard_bytes`` of single-precision components; a task builds a shard's graph. The classes of a shard ask its own
    graph and those of the shards after it, in BLOCKS blocks, so that every two shards meet once. Graphs lie as files in the
    shared folder and tasks read the one they ask, so only the asking vectors are shuffled. A task returns a count for each query and a spanning forest of the links it found, never the pairs, so
    that a dense group gives as many rows as it has vectors. Every shard searches with a beam widened by audits
    (``links_of``); all links returned are verified in double precision.
    """
    own = scratch or Scratch(vectors.sparkSession, "embedding-dup")
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    single = element == "float"
    kind = np.float32 if single else np.float64
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    rows = own.table(vectors.select("vec_id", "embedding", "label").mapInArrow(_prepare(single), f"vec_id {id_type}, cls binary, grp string, vec binary"))
    classes = rows.filter("cls IS NOT NULL").groupBy("cls").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("grp").alias("grp"), F.first("vec").alias("vec"))
    classes = own.table(classes)
    bytes_ = F.octet_length(F.first("vec")) * F.lit(4 / np.dtype(kind).itemsize) * F.count(F.lit(1))
    sizes = own.table(classes.groupBy("grp").agg(F.ceil(bytes_ / F.lit(shard_bytes)).cast("int").alias("shards")))
    hashed = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "cls"), n).cast("int")
    placed = own.table(classes.join(sizes, "grp").select("cls", "copies", "grp", "shards", "vec", hashed(1, F.col("shards")).alias("shard"), hashed(2, F.lit(BLOCKS)).alias("block")))

    folder = qualified(vectors.sparkSession, f"{own.root}/work/graphs")
    own.table(placed.groupBy("grp", "shard").applyInPandas(_build(kind, folder), "grp string, shard int"))
    asked = placed.select("grp", F.col("shard").alias("from"), "block", "cls", "copies", "vec", F.explode(F.sequence(F.col("shard"), F.col("shards") - 1)).alias("shard"))
    found = own.table(asked.groupBy("grp", "from", "block", "shard").applyInPandas(_search(kind, threshold, folder), "a binary, b binary, n long"))

    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("others"))
    groups = components(own, found.filter("b IS NOT NULL").select("a", "b")).withColumnRenamed("id", "cls")
    named = classes.select("cls", "id", "copies").join(groups, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    smallest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = own.table(named.join(smallest, "component").join(counts, "cls", "left").select("cls", "component_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    out = rows.select("vec_id", "cls").join(named, "cls", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    result = own.keep(out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
    own.clear()
    return result


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
c AS (SELECT a, least(a, min(b)) AS c FROM r GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c.c, vec_id)::BIGINT AS component_id, coalesce(c.c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON vec_id = n.a LEFT JOIN c ON vec_id = c.a
"""
