"""Embedding near-duplicates over navigable small-world graphs of shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormart.llm.components import connected_components
from sensormart.session import materialise

COSINE = 0.98
#: Vectors in one shard, about; graph and vectors of a shard are one row.
SHARD = 8192
#: Links of a vector on each layer (twice as many on the lowest), and the beam while building.
DEGREE, BUILD_BEAM = 16, 48
#: The first beam of a search; audited queries of each block, and what they must find.
BEAM, AUDIT, RECALL = 48, 64, 0.98
_BATCH, _STEP = 256, 4
#: Single precision may lie below the threshold by so much.
_SLACK = 1e-4


# -- graph -------------------------------------------------------------------
class Graph:
    """A hierarchical graph: layers of neighbour lists, -1 where a list ends."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray], entry: int) -> None:
        self.vectors, self.layers, self.entry = vectors, layers, entry

    def search(self, queries: np.ndarray, beam: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The best ``beam`` vectors of each query (-1 where there are fewer) and their cosines."""
        start = np.full((len(queries), 1), self.entry)
        for layer in range(len(self.layers) - 1, 0, -1):
            start = self.walk(queries, start, 1, layer)[0]
        if own is not None:
            start = np.column_stack([start, own])
        return self.walk(queries, start, beam, 0)

    def walk(self, queries: np.ndarray, start: np.ndarray, beam: int, layer: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search on one layer, for all queries at once."""
        q, links = len(queries), self.layers[layer]
        rows = np.arange(q)[:, None]
        ids = np.full((q, max(beam, start.shape[1])), -1)
        cosines = np.full(ids.shape, -np.inf, np.float32)
        seen = np.zeros((q, len(self.vectors) + 1), bool)
        seen[:, -1] = True  # where -1 points
        for column in range(start.shape[1]):
            fresh = ~seen[rows[:, 0], start[:, column]]
            seen[rows[:, 0], start[:, column]] = True
            ids[fresh, column] = start[fresh, column]
            cosines[fresh, column] = np.einsum("qd,qd->q", queries[fresh], self.vectors[start[fresh, column]])
        done = ids < 0
        step = min(_STEP, ids.shape[1])
        while True:
            waiting = np.where(done, -np.inf, cosines)
            active = np.flatnonzero(np.isfinite(waiting).any(axis=1))
            if not len(active):
                break
            best = np.argpartition(-waiting[active], step - 1, axis=1)[:, :step]
            here = rows[: len(active)]
            chosen = np.where(np.isfinite(waiting[active][here, best]), ids[active][here, best], -1)
            done[active[:, None], best] = True
            near = np.where(chosen[:, :, None] >= 0, links[chosen], -1).reshape(len(active), -1)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[active[:, None], near]] = -1
            seen[active[:, None], near] = True
            width = int((near >= 0).sum(axis=1).max(initial=0))
            if not width:
                continue
            near = -np.sort(-near, axis=1)[:, :width]
            found = np.einsum("qd,qwd->qw", queries[active], self.vectors[near])
            found[near < 0] = -np.inf
            all_ids = np.concatenate([ids[active], near], axis=1)
            all_cosines = np.concatenate([cosines[active], found], axis=1)
            all_done = np.concatenate([done[active], near < 0], axis=1)
            keep = np.argpartition(-all_cosines, ids.shape[1] - 1, axis=1)[:, : ids.shape[1]]
            ids[active], cosines[active], done[active] = all_ids[here, keep], all_cosines[here, keep], all_done[here, keep]
        ids[~np.isfinite(cosines)] = -1
        return ids, cosines

    # -- bytes
    def pack(self) -> bytes:
        return b"".join(layer.astype("<i4").tobytes() for layer in self.layers)

    @classmethod
    def unpack(cls, vectors: np.ndarray, data: bytes, entry: int) -> Graph:
        lists, layers, n = np.frombuffer(data, "<i4"), [], len(vectors)
        at, degree = 0, 2 * DEGREE
        while at < len(lists):
            layers.append(lists[at : at + n * degree].reshape(n, degree))
            at, degree = at + n * degree, DEGREE
        return cls(vectors, layers, entry)


def diverse(vectors: np.ndarray, node: int, candidates: np.ndarray, most: int) -> np.ndarray:
    """Neighbours for a node: the nearest, but those nearer to one already taken come last."""
    cosines = vectors[candidates] @ vectors[node]
    order = np.argsort(-cosines, kind="stable")
    candidates, cosines = candidates[order], cosines[order]
    if len(candidates) <= most:
        return candidates
    among = vectors[candidates] @ vectors[candidates].T
    taken: list[int] = []
    closest = np.full(len(candidates), -np.inf, np.float32)
    for i in range(len(candidates)):
        if closest[i] < cosines[i]:
            taken.append(i)
            if len(taken) == most:
                break
            np.maximum(closest, among[i], out=closest)
    left = np.setdiff1d(np.arange(len(candidates)), taken)[: most - len(taken)]
    return candidates[np.concatenate([np.array(taken, int), left])]


def build_graph(vectors: np.ndarray) -> Graph:
    """Insert unit vectors in growing batches; a batch also meets its own members.

    A vector's top layer is drawn from a fixed sequence, so that a rebuild after a
    lost task gives the same graph.
    """
    n = len(vectors)
    draws = np.random.default_rng(7).random(n)
    levels = np.minimum(4, (-np.log(draws) / np.log(DEGREE)).astype(int))
    first = int(np.argmax(levels))
    top = int(levels[first])
    layers = [np.full((n, 2 * DEGREE if layer == 0 else DEGREE), -1) for layer in range(top + 1)]
    used = [np.zeros(n, int) for _ in layers]
    graph = Graph(vectors, layers, first)
    order = np.concatenate([[first], np.delete(np.arange(n), first)])
    done = 1
    while done < n:
        batch = order[done : done + min(_BATCH, done)]
        done += len(batch)
        start = np.full((len(batch), 1), first)
        mutual = vectors[batch] @ vectors[batch].T
        np.fill_diagonal(mutual, -np.inf)
        for layer in range(top, -1, -1):
            inserted = np.flatnonzero(levels[batch] >= layer)
            passing = np.flatnonzero(levels[batch] < layer)
            if len(passing):
                start[passing] = graph.walk(vectors[batch[passing]], start[passing][:, :1], 1, layer)[0]
            if not len(inserted):
                continue
            ids, cosines = graph.walk(vectors[batch[inserted]], start[inserted][:, :1], BUILD_BEAM, layer)
            start[inserted, 0] = ids[np.arange(len(inserted)), np.argmax(cosines, axis=1)]
            peers = batch[inserted]
            for row, place in enumerate(inserted):
                node = batch[place]
                others = mutual[place, inserted]
                near = peers[np.argsort(-others, kind="stable")[:DEGREE]]
                candidates = np.unique(np.concatenate([ids[row][ids[row] >= 0], near[near != node]]))
                for other in diverse(vectors, node, candidates, DEGREE):
                    _connect(vectors, layers[layer], used[layer], node, other)
                    _connect(vectors, layers[layer], used[layer], other, node)
    return graph


def _connect(vectors: np.ndarray, lists: np.ndarray, used: np.ndarray, node: int, other: int) -> None:
    n, room = used[node], lists.shape[1]
    if (lists[node, :n] == other).any():
        return
    if n < room:
        lists[node, n] = other
        used[node] = n + 1
        return
    kept = diverse(vectors, node, np.append(lists[node], other), room * 3 // 4)
    lists[node] = -1
    lists[node, : len(kept)] = kept
    used[node] = len(kept)


# -- links of two shards -----------------------------------------------------
def linked(graph: Graph, exact: np.ndarray, queries: np.ndarray, same: bool) -> np.ndarray:
    """Which queries (rows) and vectors of the graph (columns) reach the threshold.

    Queries whose whole beam reaches it lie in a cluster wider than the beam; they are
    compared with all vectors, which costs far less than beams of its size. Evenly spaced
    queries are also answered by comparing with all vectors; while too little of
    their links and nearest vectors is found, all beams are doubled. Each audited
    query counts alike, however many links it has, and those that rest on the
    first beam must reach the recall by themselves: a cluster that was compared
    with all vectors says nothing about them.
    """
    n, m = len(queries), len(exact)
    single = queries.astype(np.float32)
    audit = np.unique(np.linspace(0, n - 1, min(AUDIT, n)).astype(int))
    truth = queries[audit] @ exact.T
    if same:
        truth[np.arange(len(audit)), audit] = -np.inf
    wanted = truth >= COSINE
    if m > same:
        wanted[np.arange(len(audit)), truth.argmax(axis=1)] = True
    beam = BEAM
    while True:
        result = np.zeros((n, m), bool)
        reached, widened = np.zeros(wanted.shape, bool), np.zeros(len(audit), bool)
        for first in range(0, n, _BATCH):
            rows = np.arange(first, min(n, first + _BATCH))
            ids, cosines = graph.search(single[rows], min(beam, m), rows if same else None)
            full = (cosines.min(axis=1) >= COSINE - _SLACK) & (beam < m)
            for i in np.flatnonzero(np.isin(audit, rows[~full])):
                found = ids[np.flatnonzero(rows == audit[i])[0]]
                reached[i, found[found >= 0]] = True
            near = (ids >= 0) & (cosines >= COSINE - _SLACK) & ~full[:, None]
            place, column = np.nonzero(near)
            result[rows[place], ids[place, column]] = True
            wide = rows[full]
            result[wide] = queries[wide] @ exact.T >= COSINE - _SLACK
            reached[np.isin(audit, wide)] = True
            widened |= np.isin(audit, wide)
        if beam >= m or _enough(reached, wanted, np.ones_like(widened)) and _enough(reached, wanted, ~widened):
            break
        beam *= 2
    if same:
        result |= result.T
        np.fill_diagonal(result, False)
    # Confirmed in double precision.
    for first in range(0, n, _BATCH):
        part = result[first : first + _BATCH]
        place, column = np.nonzero(part)
        for at in range(0, len(place), 1 << 16):
            p, c = place[at : at + (1 << 16)], column[at : at + (1 << 16)]
            part[p, c] = np.einsum("ij,ij->i", queries[first + p], exact[c]) >= COSINE
    return result


def _enough(reached: np.ndarray, wanted: np.ndarray, chosen: np.ndarray) -> bool:
    """Whether the chosen queries found, on average over queries, the required share of what they want."""
    asked = chosen & wanted.any(axis=1)
    shares = (reached & wanted)[asked].sum(axis=1) / wanted[asked].sum(axis=1)
    return not len(shares) or bool(shares.mean() >= RECALL)


def roots(adjacent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows and columns of a link matrix, the smallest row connected with them (-1: none)."""
    n, m = adjacent.shape
    left, right = np.arange(n), np.full(m, n)
    while True:
        before = left.copy()
        for row in range(n):
            if adjacent[row].any():
                columns = adjacent[row]
                low = min(left[row], right[columns].min())
                left[row] = low
                right[columns] = low
        left = np.minimum(left, left[left])
        if (left == before).all():
            return np.where(adjacent.any(axis=1), left, -1), np.where(adjacent.any(axis=0), right, -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


# -- operators ---------------------------------------------------------------
def _build(shards: DataFrame) -> DataFrame:
    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        raw = np.array(group.column("embedding").to_pylist(), np.float64)
        exact = _unit(raw)
        graph = build_graph(exact.astype(np.float32))
        return pa.table(
            {
                **{name: group.column(name).slice(0, 1) for name in ("label", "size", "shard")},
                "nodes": pa.array([np.array(group.column("node")).astype("<i8").tobytes()], pa.binary()),
                "copies": pa.array([np.array(group.column("copies")).astype("<i8").tobytes()], pa.binary()),
                "vectors": pa.array([exact.astype("<f8").tobytes()], pa.binary()),
                "graph": pa.array([graph.pack()], pa.binary()),
                "entry": pa.array([graph.entry], pa.int64()),
            }
        )

    label = shards.schema["label"].dataType.simpleString()
    return shards.groupBy("label", "size", "shard").applyInArrow(
        build, f"label {label}, size int, shard long, nodes binary, copies binary, vectors binary, graph binary, entry long"
    )


def _compare(sides: DataFrame) -> DataFrame:
    """Links of each pair of shards (rows of one label, size, shard and other_shard; ``asked`` tells which asks)."""

    def compare(group: pa.Table) -> pa.Table:
        rows = {row["asked"]: row for row in group.to_pylist()}
        asked = rows[False]
        same = asked["shard"] == asked["other_shard"]
        sides = []
        for side in (asked, rows.get(True, asked)):
            nodes, copies = (np.frombuffer(side[k], "<i8") for k in ("nodes", "copies"))
            sides.append((nodes, copies, np.frombuffer(side["vectors"], "<f8").reshape(len(nodes), -1)))
        (nodes, copies, exact), (others, other_copies, queries) = sides
        graph = Graph.unpack(exact.astype(np.float32), asked["graph"], asked["entry"])
        found = linked(graph, exact, queries, same)
        query, vector = np.nonzero(found)
        parts = [(others, np.bincount(query, copies[vector], len(others)))]
        if not same:
            parts.append((nodes, np.bincount(vector, other_copies[query], len(nodes))))
        linking = found.any(axis=1)
        if same:
            # Row i and column i are one vector: tied, or pairs, paths and stars would fall apart.
            np.fill_diagonal(found, True)
        query_roots, vector_roots = roots(found)
        query_roots[~linking] = -1
        columns = [[], [], []]
        for (ids, links), root in zip(parts, (query_roots, vector_roots), strict=False):
            kept = np.flatnonzero(root >= 0)
            for column, values in zip(columns, (ids[kept], links[kept], others[root[kept]]), strict=True):
                column.append(values.astype(np.int64))
        return pa.table({n: np.concatenate(c) for n, c in zip(("node", "links", "root"), columns, strict=True)})

    return sides.groupBy("label", "size", "shard", "other_shard").applyInArrow(compare, "node long, links long, root long")


def _sides(shards: DataFrame) -> DataFrame:
    """Both shards of every pair to be compared, under the pair's key, so that pairs of one label spread.

    The pairs are listed by number first; a shard against itself has one row.
    """
    numbers = shards.select("label", "size", "shard")
    later = numbers.withColumnRenamed("shard", "other_shard")
    pairs = materialise(numbers.join(later, ["label", "size"]).filter("shard <= other_shard"), "shard-pairs")
    payload = ["nodes", "copies", "vectors", "graph", "entry"]
    columns = ["label", "size", "shard", "other_shard"]
    asked = shards.join(pairs, ["label", "size", "shard"]).select(*columns, *payload, F.lit(False).alias("asked"))
    # The asking side needs no graph.
    bare = [F.lit(None).cast(kind).alias(name) for name, kind in (("graph", "binary"), ("entry", "long"))]
    asking = shards.drop("graph", "entry").withColumnRenamed("shard", "other_shard")
    asking = asking.join(pairs.filter("shard < other_shard"), ["label", "size", "other_shard"])
    return asked.unionByName(asking.select(*columns, *payload[:3], *bare, F.lit(True).alias("asked")))


def near_vectors(vectors: DataFrame) -> DataFrame:
    """Link vectors of equal label whose cosine is at least ``COSINE``.

    Equal vectors are one class. Classes of a label are dealt into shards of about
    ``SHARD``; each shard gets a graph, stored as a row, and every shard is asked
    for all classes of its own and of later shards, in blocks of one shard. Each
    pair of shards is a group of its own, so those of one large label run side by
    side; their number grows with the square of the label's shards.

    Returns vec_id, n_links (other vectors linked directly), component_id (the
    smallest vec_id reachable, itself included), kept (vec_id = component_id).
    Null labels, null, empty or zero vectors and those with null or non-finite
    components link with nothing and keep their own id; so do vectors of another
    length. Null ids are never the smallest. Repeated rows are vectors of their
    own, linked with each other. An empty table gives no rows.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
    usable = usable & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select("vec_id", "label", "embedding", F.coalesce(usable, F.lit(False)).alias("usable"))
    classes = rows.filter("usable").groupBy("label", "embedding").agg(
        F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies")
    )
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    sized = classes.withColumn("size", F.size("embedding"))
    counts = sized.groupBy("label", "size").agg(F.ceil(F.count(F.lit(1)) / SHARD).alias("shards"))
    counts = materialise(counts, "label-sizes")
    dealt = sized.join(counts, ["label", "size"]).withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")))
    shards = materialise(_build(dealt.select("label", "size", "shard", "node", "copies", "embedding")), "shard-graphs")
    found = materialise(_compare(_sides(shards)), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    components = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = classes.join(links, "node", "left").join(components, "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    known = materialise(known, "vector-components")
    smallest = materialise(known.groupBy("component").agg(F.min("least_id").alias("component_id")), "component-ids")
    known = known.join(smallest, "component").select(
        F.col("label").alias("_label"),
        F.col("embedding").alias("_embedding"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.col("component_id").alias("_component"),
    )
    known = materialise(known, "vector-results")
    same = F.col("usable") & (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding"))
    component_id = F.when(F.col("usable"), F.col("_component")).otherwise(F.col("vec_id"))
    return (
        rows.join(known, same, "left")
        .withColumn("component_id", component_id)
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            "component_id",
            F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )
