import numpy as np
import pyarrow.parquet as pq
import pytest

from folioflow.llm.embedding_dup import links_of, near_duplicates
from folioflow.llm.hnsw import Graph


def pairs(graph, x, q, served=None):
    parts = list(links_of(graph, x, q, 0.98, served))
    return np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts])


def brute(rows):
    def usable(v, label):
        return label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)

    ids = list(range(len(rows)))
    parent, links = dict(zip(ids, ids, strict=True)), [0] * len(rows)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in ids:
        for j in ids[:i]:
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            if usable(a, la) and usable(b, lb) and la == lb and len(a) == len(b):
                a, b = np.float64(np.float32(a)), np.float64(np.float32(b))
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
                    links[i] += 1
                    links[j] += 1
                    parent[root(i)] = root(j)
    out = []
    for i in ids:
        members = [rows[k][0] for k in ids if root(k) == root(i)]
        out.append((rows[i][0], links[i], min(members), rows[i][0] == min(members)))
    return sorted(out)


@pytest.mark.parametrize("shard_bytes", [40 * 64, 1 << 25])
def test_matches_brute_force(spark, shard_bytes):
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for label in (0, 1, None):
        for _ in range(30):
            base = rng.normal(size=16)
            for _ in range(int(rng.integers(1, 9))):
                rows.append((n, [float(x) for x in base + rng.normal(size=16) * rng.choice([0, 0.05, 0.15])], label))
                n += 1
    rows += [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [1.0, None], 0), (n + 3, [float("nan")] * 16, 0), (n + 4, [float("inf")] * 16, 0), (n + 5, [], 0), (n + 6, [1.0, 2.0], 1), (n + 7, [2.0, 4.0], 1)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, cls int").repartition(5)
    got = sorted(tuple(r) for r in near_duplicates(df, shard_bytes=shard_bytes).collect())
    assert got == brute(rows)


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_recall_of_the_graph_alone():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(300, 32))
    x = np.concatenate([base, base[rng.integers(0, 300, 900)] + rng.normal(size=(900, 32)) * 0.1])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = x[rng.permutation(len(x))]
    graph, true = Graph(x), x @ x.T >= 0.98
    ids, sims = graph.search(x, 64)
    assert ((sims >= 0.98).sum() / true.sum()) >= 0.99
    a, b = pairs(graph, x, x)
    assert len(a) >= 0.999 * true.sum() and true[a, b].all()


def test_dense_group_goes_beyond_the_beam():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1, 32)) + rng.normal(size=(900, 32)) * 0.01
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, _ = pairs(Graph(x), x, x)
    assert len(a) == 900 * 900


def test_the_graph_serves_the_labels_of_the_given_table():
    """The largest labels of the smallest tables hold about 60 vectors; even these are answered by the graph."""
    rows = pq.read_table("/root/testdata/sf0.01/embeddings.parquet").to_pylist()
    for label in {r["label"] for r in rows} - {None}:
        x = np.unique([r["embedding"] for r in rows if r["label"] == label], axis=0).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        served = {}
        a, b = pairs(Graph(x), x, x, served)
        true = x @ x.T >= 0.98
        assert set(zip(a.tolist(), b.tolist(), strict=True)) == set(zip(*map(np.ndarray.tolist, np.nonzero(true)), strict=True))
        assert served["graph"] == len(x) and not served.get("scan")


def test_audit_widens_the_beam_where_links_are_rare():
    """Queries of another shard, nearly none of them linked: the audit goes by the nearest points, so a graph that finds
    nothing is not trusted."""
    rng = np.random.default_rng(6)
    x, q = (rng.normal(size=(n, 16)) for n in (1500, 400))
    q[:3] = x[:3] + rng.normal(size=(3, 16)) * 0.01
    x, q = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, q))

    class Blind(Graph):
        def search(self, queries, beam):
            return np.zeros((len(queries), beam), np.int32), np.full((len(queries), beam), -1.0, np.float32)

    served = {}
    a, b = pairs(Blind(x), x, q, served)
    assert served.get("scan") == len(q) and set(zip(a.tolist(), b.tolist(), strict=True)) >= {(0, 0), (1, 1), (2, 2)}


def test_null_ids_and_pairs_at_the_threshold(spark):
    at = lambda c: [float(c), float(np.sqrt(1 - c * c))]
    rows = [(1, [1.0, 0.0], 1), (2, at(0.9801), 1), (3, at(-0.5), 1), (None, [3.0, 0.0], 1), (5, at(0.9799), 2), (6, [1.0, 0.0], 2), (7, [2.0, 0.0], None)]
    got = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert found == {1: (2, 1, True), 2: (2, 1, False), 3: (0, 3, True), None: (2, 1, True), 5: (0, 5, True), 6: (0, 6, True), 7: (0, 7, True)}
