"""Embedding links against all pairs, and the graph's recall."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sensormart.llm import vectors
from sensormart.llm.oracles import VECTORS

from test_minhash import brute_components


def _check(table):
    rows = [(r.vec_id, r.embedding, r.label) for r in table.select("vec_id", "embedding", "label").collect()]
    ok = [
        label is not None and e is not None and len(e) > 0 and all(x is not None and np.isfinite(x) for x in e) and any(e)
        for _, e, label in rows
    ]
    links = []
    for i, (_, e, label) in enumerate(rows):
        for j in range(i):
            if ok[i] and ok[j] and rows[j][2] == label and len(rows[j][1]) == len(e):
                a, b = np.array(e, float), np.array(rows[j][1], float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
                    links.append((j, i))
    counts = np.bincount(np.array(links, int).ravel(), minlength=len(rows)) if links else np.zeros(len(rows), int)
    group, smallest = brute_components(range(len(rows)), links), {}
    for i, g in group.items():
        ids = [x for x in (smallest.get(g), rows[i][0]) if x is not None]
        smallest[g] = min(ids) if ids else None
    expected = [(rows[i][0], int(counts[i]), smallest[g], rows[i][0] == smallest[g]) for i, g in group.items()]
    assert sorted(map(tuple, vectors.near_vectors(table).collect()), key=str) == sorted(expected, key=str)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 8))
    rows = [(i, (base[i % 6] + rng.normal(size=8) * rng.choice([0.0, 0.05, 0.2])).tolist(), i % 2) for i in range(80)]
    rows += [(100, None, 1), (101, [0.0] * 8, 1), (102, [float("nan")] * 8, 1), (103, [1.0, None] * 4, 1), (104, [], 1)]
    rows += [(105, base[0].tolist(), None), (106, [float("inf")] * 8, 0), (107, base[0][:4].tolist(), 0)]
    rows += [(None, base[1].tolist(), 1), (3, rows[3][1], 1), (108, (base[0] * 1e30).tolist(), 0), (None, None, None)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, node int")
    _check(table)
    _check(table.limit(0))


def test_graph_finds_close_vectors():
    rng = np.random.default_rng(3)
    data = rng.normal(size=(1500, 32))
    near = np.repeat(rng.normal(size=(1, 32)), 200, axis=0) + rng.normal(size=(200, 32)) * 0.02
    pairs = data[:300] + rng.normal(size=(300, 32)) * 0.02
    exact = vectors._unit(np.concatenate([data, near, pairs]))
    graph = vectors.build_graph(exact.astype(np.float32))
    again = vectors.Graph.unpack(graph.vectors, graph.pack(), graph.entry)
    truth = exact @ exact.T >= 0.98
    np.fill_diagonal(truth, False)
    for g in (graph, again):
        found = vectors.linked(g, exact, exact, True)
        assert not (found & ~truth).any() and found.sum() >= 0.99 * truth.sum()
    queries = exact[::5]
    found = vectors.linked(graph, exact, queries, False)
    wanted = queries @ exact.T >= 0.98
    assert not (found & ~wanted).any() and found.sum() >= 0.97 * wanted.sum()


@pytest.mark.parametrize("seed", range(4))
def test_roots(seed):
    rng = np.random.default_rng(seed)
    adjacent = rng.random((30, 20)) < 0.04
    links = [(i, 30 + j) for i, j in np.argwhere(adjacent)]
    group = brute_components(range(50), links)
    left, right = vectors.roots(adjacent)
    assert all(left[i] == (group[i] if adjacent[i].any() else -1) for i in range(30))
    assert all(right[j] == (group[30 + j] if adjacent[:, j].any() else -1) for j in range(20))


def _turned(*degrees):
    """Unit vectors in one plane; 10 degrees apart are linked, 20 are not."""
    return [[float(np.cos(np.radians(d))), float(np.sin(np.radians(d))), 0.0] for d in degrees]


def test_pairs_paths_and_stars(spark):
    """Components without a triangle, each under a label of its own, and together."""
    star = [[0.0, 0.0, 1.0]] + [[0.17 * np.cos(a), 0.17 * np.sin(a), 1.0] for a in np.radians([0, 120, 240])]
    shapes = [_turned(0, 10), _turned(0, 10, 20), _turned(*range(0, 70, 10)), [[float(x) for x in v] for v in star]]
    shapes.append(_turned(0, 10, 45, 55, 90, 100, 110, 150))
    rows = [(vector, label) for label, shape in enumerate(shapes) for vector in shape]
    rows = [(i, vector, label) for i, (vector, label) in enumerate(rows)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    _check(table)
    frame = table.toPandas()  # noqa: F841, read by name
    expected = duckdb.sql(VECTORS.replace("embeddings", "frame")).df()
    got = vectors.near_vectors(table).toPandas()
    columns = sorted(expected.columns)
    assert sorted(map(tuple, got[columns].values.tolist())) == sorted(map(tuple, expected[columns].values.tolist()))


class _Narrow:
    """Answers exactly, but below a beam of 96 knows nothing outside the first ``hot`` vectors."""

    def __init__(self, exact, hot):
        self.exact, self.hot = exact, hot

    def search(self, queries, beam, own=None):
        cosines = queries @ self.exact.T.astype(np.float32)
        if beam < 96:
            cosines[:, self.hot :] = -1
        ids = np.argsort(-cosines, axis=1, kind="stable")[:, :beam]
        return ids, np.take_along_axis(cosines, ids, axis=1)


@pytest.mark.parametrize("share", [0.33, 0.9])
def test_hot_cluster_does_not_hide_lost_links(share):
    rng = np.random.default_rng(8)
    hot = int(600 * share)
    centre = rng.normal(size=(1, 32))
    data = np.concatenate([centre + rng.normal(size=(hot, 32)) * 0.02, rng.normal(size=(600 - hot, 32))])
    exact, queries = vectors._unit(data), vectors._unit(data + rng.normal(size=data.shape) * 0.005)
    found = vectors.linked(_Narrow(exact, hot), exact, queries, False)
    assert (found == (queries @ exact.T >= vectors.COSINE)).all()


def test_pairs_of_one_label_spread(spark, monkeypatch):
    """Ten shards of one label: every pair once, dealt over many tasks, links as by brute force."""
    monkeypatch.setattr(vectors, "SHARD", 20)
    rng = np.random.default_rng(12)
    base = rng.normal(size=(90, 16))
    data = np.concatenate([base, base + rng.normal(size=base.shape) * 0.03, base[:15]])
    rows = [(i, v.tolist(), 1) for i, v in enumerate(data)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    _check(table)
    shards = spark.createDataFrame(
        [(1, 16, n, b"", b"", b"", b"", 0) for n in range(10)],
        "label int, size int, shard long, nodes binary, copies binary, vectors binary, graph binary, entry long",
    )
    keys = ["label", "size", "shard", "other_shard"]
    dealt = vectors._sides(shards).repartition(16, *keys).withColumn("task", F.spark_partition_id()).collect()
    pairs = {(r.shard, r.other_shard): r.task for r in dealt}
    assert set(pairs) == {(i, j) for i in range(10) for j in range(i, 10)} and len(dealt) == 100
    assert len(set(pairs.values())) > 10


def test_a_wide_cluster_needs_no_wide_beam():
    """Members of a cluster wider than the beam find all of it, without beams of its size."""
    rng = np.random.default_rng(9)
    near = rng.normal(size=(1, 32)) + rng.normal(size=(500, 32)) * 0.02
    exact = vectors._unit(np.concatenate([near, rng.normal(size=(300, 32))]))
    graph = vectors.build_graph(exact.astype(np.float32))
    beams, search = [], graph.search
    graph.search = lambda queries, beam, own=None: beams.append(beam) or search(queries, beam, own)
    truth = exact @ exact.T >= vectors.COSINE
    np.fill_diagonal(truth, False)
    assert (vectors.linked(graph, exact, exact, True) == truth).all()
    assert max(beams) < 200
