"""Embedding near-dedup by a robust-pruned flat graph.

Equal vectors are one node. Centroids fitted on a bounded sample cut the nodes into clusters; each node is a
member of its two nearest clusters' shards, so shards overlap. In every shard a flat graph is built by batch
insertion: a greedy search from the medoid collects candidates, robust pruning keeps those that no kept
one is much closer to, and reverse links are pruned the same way. A node's adjacency lists of all its shards
are united into the one flat graph.

A search runs greedily from each shard's medoid over the united lists, for its members and for the
``probes`` - 2 further clusters that are next nearest to a node. The beam of a node whose whole beam is in
range is doubled up to ``WIDEST``. Every link found is verified in double precision. The nodes that
links join within a shard are then compared with each other exactly, in blocks, which also counts what a
beam has no room for. A node's hits count where they are at home (nearest cluster), so nothing counts twice and no pair
leaves a task: a shard returns a count and one tree link per node.

Recall is audited: up to ``AUDIT`` nodes are compared with all others in blocks, and while less than ``recall`` of
their links were found, ``probes`` doubles, up to all clusters.

Defined results: vectors that are null, zero or hold a null or non-finite component link with nothing (component: their own
id); repeated rows and equal vectors are further vectors, linked with each other; only vectors of equal
length meet; rows without id get a row and never name a component unless no member has an id; an empty table gives no rows;
extra columns are ignored. Very long vectors make smaller shards (``SHARD_BYTES``).

Bounds: the sample holds ``SAMPLE_BYTES`` in all and centroids a quarter of it, so beyond 4 MB of
centroids shards grow with the input; audited vectors hold ``AUDIT_BYTES``. One row per vector length reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, save

MIN_COSINE = 0.9
PROBES = 4  # clusters a node is searched in; it is a member of the first two
SHARD_NODES = 4096
SHARD_BYTES = 4 << 20
SAMPLE_BYTES = 16 << 20
SAMPLE_PER_CENTROID = 32
AUDIT = 1024
AUDIT_BYTES = 8 << 20
RECALL = 0.98
DEGREE = 24
BUILD_BEAM = 48
SEARCH_BEAM = 48
WIDEST = 192
ALPHA = 1.2  # a candidate goes if a kept neighbour is this many times closer to it than the node is
_BATCH = 256
_OPEN = 4  # nodes opened a step
_BLOCK = 1024
_SLACK = 1e-5  # single precision may see a link this far under the threshold
_SEED = 12


# ---- one shard --------------------------------------------------------------------
def greedy(x: np.ndarray, links: np.ndarray, q: np.ndarray, entry: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of all rows of ``q``: (nodes, similarities) [row, width], best first, -1 where none."""
    rows = len(q)
    seen = np.zeros((rows, len(x) + 1), bool)
    seen[:, [entry, -1]] = True
    ids = np.full((rows, width), -1, np.int64)
    sims = np.full((rows, width), -np.inf, np.float32)
    todo = np.zeros((rows, width), bool)
    ids[:, 0], sims[:, 0], todo[:, 0] = entry, q @ x[entry], True
    live = np.arange(rows)
    while len(live := live[todo[live].any(axis=1)]):
        own = todo[live]
        rank = np.cumsum(own, axis=1)
        chosen = own & (rank <= _OPEN)
        todo[live] = own & ~chosen
        opened = np.full((len(live), _OPEN), -1, np.int64)
        r, c = np.nonzero(chosen)
        opened[r, rank[r, c] - 1] = ids[live[r], c]
        new = np.sort(np.where(opened[:, :, None] >= 0, links[opened], -1).reshape(len(live), -1), axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        new[seen[live[:, None], new]] = -1
        seen[live[:, None], new] = True
        near = np.matmul(x[new], q[live][:, :, None])[:, :, 0]
        near[new < 0] = -np.inf
        all_sims = np.concatenate([sims[live], near], axis=1)
        best = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
        sims[live] = np.take_along_axis(all_sims, best, axis=1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], new], axis=1), best, axis=1)
        todo[live] = np.take_along_axis(np.concatenate([todo[live], new >= 0], axis=1), best, axis=1)
    return ids, sims


def robust_prune(x: np.ndarray, cand: np.ndarray, sims: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Up to ``degree`` of each row's candidates (-1: none), nearest first, without those that a kept one stands for."""
    order = np.argsort(-np.where(cand < 0, -np.inf, sims), axis=1, kind="stable")
    cand, sims = np.take_along_axis(cand, order, axis=1), np.take_along_axis(sims, order, axis=1)
    own = x[cand]
    apart = np.maximum(0, 1 - np.matmul(own, own.transpose(0, 2, 1)))  # half the squared distance
    away = np.maximum(0, 1 - sims)
    alive, kept, count = cand >= 0, np.full((len(cand), degree), -1, np.int64), np.zeros(len(cand), np.int64)
    for j in range(cand.shape[1]):
        take = np.flatnonzero(alive[:, j] & (count < degree))
        kept[take, count[take]] = cand[take, j]
        count[take] += 1
        alive[take] &= alpha * alpha * apart[take, j] > away[take]
    return kept


def build_graph(x: np.ndarray) -> tuple[int, np.ndarray]:
    """(medoid, links): the flat graph over unit vectors, ``links[i]`` padded by -1; one row more than nodes."""
    n = len(x)
    medoid = int(np.argmax(x @ x.mean(axis=0)))
    order = np.random.default_rng(_SEED).permutation(n)
    order = np.r_[medoid, order[order != medoid]]
    links = np.full((n + 1, DEGREE), -1, np.int64)
    done = 1
    while done < n:
        batch = order[done : done + min(_BATCH, max(8, done))]
        q = x[batch]
        cand, sims = greedy(x, links, q, medoid, BUILD_BEAM)
        mates = q @ q.T
        np.fill_diagonal(mates, -np.inf)
        near = np.argsort(-mates, axis=1, kind="stable")[:, : DEGREE]
        near_sims = np.take_along_axis(mates, near, axis=1)
        near = np.where(np.isfinite(near_sims), batch[near], -1)
        links[batch] = robust_prune(x, np.concatenate([cand, near], axis=1), np.concatenate([sims, near_sims], axis=1))
        _link_back(x, links, batch)
        done += len(batch)
    return medoid, links


def _link_back(x: np.ndarray, links: np.ndarray, nodes: np.ndarray) -> None:
    source, target = np.repeat(nodes, DEGREE), links[nodes].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    uniq, start, count = np.unique(target[order], return_index=True, return_counts=True)
    extra = np.full((len(uniq), count.max(initial=0)), -1, np.int64)
    extra[np.repeat(np.arange(len(uniq)), count), np.arange(len(order)) - np.repeat(start, count)] = source[order]
    for a in range(0, len(uniq), _BATCH):
        t = uniq[a : a + _BATCH]
        both = np.sort(np.concatenate([links[t], extra[a : a + _BATCH]], axis=1), axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        links[t] = robust_prune(x, both, np.matmul(x[both], x[t][:, :, None])[:, :, 0])


def roots_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable number of each of ``n`` nodes under the links (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def search_links(u: np.ndarray, member: np.ndarray, links: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Verified links (row, row) found from every row of ``u`` among the members, over ``links`` (by row)."""
    x = np.vstack([u, np.zeros((1, u.shape[1]))]).astype(np.float32)
    rows = np.flatnonzero(member)
    medoid = int(rows[np.argmax(x[rows] @ x[rows].mean(axis=0))])
    found_a, found_b = [], []

    def keep(a: np.ndarray, b: np.ndarray) -> None:
        for i in range(0, len(a), 1 << 16):
            p, q = a[i : i + (1 << 16)], b[i : i + (1 << 16)]
            linked = (p != q) & ((u[p] * u[q]).sum(axis=1) >= cosine)
            found_a.append(p[linked])
            found_b.append(q[linked])

    todo, width = np.arange(len(u)), SEARCH_BEAM
    while len(todo) and width <= WIDEST:
        wider = []
        for i in range(0, len(todo), _BATCH):
            q = todo[i : i + _BATCH]
            ids, sims = greedy(x[:-1], links, x[q], medoid, width)
            near = (ids >= 0) & (sims >= cosine - _SLACK)
            r, c = np.nonzero(near)
            keep(q[r], ids[r, c])
            wider.append(q[near.all(axis=1)])
        todo, width = np.concatenate(wider), 2 * width
    for i in range(0, len(rows), _BATCH):  # what is next to a hit is tried too
        own = rows[i : i + _BATCH]
        near = np.matmul(x[links[own]], x[own][:, :, None])[:, :, 0]
        r, c = np.nonzero((links[own] >= 0) & (near >= cosine - _SLACK))
        keep(own[r], links[own][r, c])
    return np.concatenate(found_a), np.concatenate(found_b)


def shard_links(u: np.ndarray, n: np.ndarray, home: np.ndarray, member: np.ndarray, links: np.ndarray, cosine: float):
    """(count, root) of every row: copies it is linked with that are at home here, and its component."""
    root = roots_of(len(u), *search_links(u, member, links, cosine))
    count = np.zeros(len(u), np.int64)
    order = np.argsort(root, kind="stable")
    starts = np.flatnonzero(np.r_[True, root[order][1:] != root[order][:-1]])
    for rows in np.split(order, starts[1:]):
        own = rows[home[rows]]
        if len(rows) == 1 or not len(own):
            continue
        for a in range(0, len(rows), _BLOCK):
            part = rows[a : a + _BLOCK]
            for b in range(0, len(own), _BLOCK):
                other = own[b : b + _BLOCK]
                linked = (u[part] @ u[other].T >= cosine) & (part[:, None] != other)
                count[part] += linked @ n[other]
    return count, root


# ---- on the cluster -----------------------------------------------------------------
def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _vectors(column, dim: int) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in chunks] or [np.empty(0)]).reshape(-1, dim)


def _numbers(column) -> np.ndarray:
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)


def _by_dim(batch: pa.RecordBatch):
    dims = _numbers(batch.column("dim"))
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        yield dim, (batch if len(at) == len(dims) else batch.take(pa.array(at)))


@dataclass
class Clusters:
    """Centroids of each vector length and the number of its first shard."""

    centroids: dict[int, np.ndarray]
    first: dict[int, int]
    shards: int

    def most(self) -> int:
        return max((len(c) for c in self.centroids.values()), default=1)


def fit_clusters(nodes: DataFrame, shard_nodes: int = SHARD_NODES) -> Clusters:
    """Spherical k-means on a bounded sample, taken by hash: the same for the same vectors."""
    sizes = {r["dim"]: r["n"] for r in nodes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    centroids, first, shards = {}, {}, 0
    for dim, n in sorted(sizes.items()):
        per_shard = max(2, min(shard_nodes, SHARD_BYTES // (8 * dim)))
        wanted = max(1, min(-(-n // per_shard), SAMPLE_BYTES // (16 * dim)))
        first[dim] = shards
        if wanted > 1:
            share = min(1.0, min(SAMPLE_PER_CENTROID * wanted, SAMPLE_BYTES // (4 * dim)) / n)
            picked = nodes.where((F.col("dim") == dim) & (F.expr("pmod(h1, 1048576)") < int(share * 1048576) + 1))
            sample = _unit(np.array([r["v"] for r in picked.orderBy("h1", "h2").select("v").collect()]))
            centroids[dim] = _kmeans(sample.astype(np.float32), wanted)
            wanted = len(centroids[dim])
        shards += wanted
    return Clusters(centroids, first, shards)


def _kmeans(x: np.ndarray, k: int, rounds: int = 5) -> np.ndarray:
    rng = np.random.default_rng(_SEED)
    centers = x[rng.permutation(len(x))[:k]]
    for _ in range(rounds):
        nearest = np.concatenate([np.argmax(x[i : i + _BLOCK] @ centers.T, axis=1) for i in range(0, len(x), _BLOCK)])
        order = np.argsort(nearest, kind="stable")
        used, start = np.unique(nearest[order], return_index=True)
        centers = centers.copy()
        centers[used] = np.add.reduceat(x[order], start, axis=0)
        centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-30)
    return centers


def place(nodes: DataFrame, clusters: Clusters, probes: int) -> DataFrame:
    """(shard, place, node, dim, n, v): every node in its ``probes`` nearest clusters' shards, ``place`` 0 the nearest."""
    shared = nodes.sparkSession.sparkContext.broadcast(clusters)

    def run(batches):
        known = shared.value
        for batch in batches:
            for dim, part in _by_dim(batch):
                centers = known.centroids.get(dim)
                if centers is None:
                    nearest = np.zeros((part.num_rows, 1), np.int64)
                else:
                    u = _unit(_vectors(part.column("v"), dim)).astype(np.float32)
                    width = min(probes, len(centers))
                    nearest = np.concatenate(
                        [np.argsort(-(u[i : i + 256] @ centers.T), axis=1, kind="stable")[:, :width] for i in range(0, len(u), 256)]
                    )
                for k in range(nearest.shape[1]):
                    shard = pa.array(nearest[:, k] + known.first[dim], pa.int64())
                    columns = [shard, pa.array(np.full(part.num_rows, k, np.int32)), *(part.column(c) for c in ("node", "dim", "n", "v"))]
                    yield pa.RecordBatch.from_arrays(columns, ["shard", "place", "node", "dim", "n", "v"])

    rows = nodes.select("node", "dim", "n", "v")
    return rows.mapInArrow(run, "shard long, place int, node long, dim int, n long, v array<double>")


def _build_shard(table: pa.Table) -> pa.Table:
    table = table.sort_by("node")
    x = _unit(_vectors(table.column("v"), table.column("dim")[0].as_py())).astype(np.float32)
    node, (_, links) = table.column("node").to_numpy(), build_graph(x)
    lists = [node[own[own >= 0]] for own in links[:-1]]
    return pa.table([pa.array(node), pa.array(lists, pa.list_(pa.int64()))], names=["node", "near"])


def flat_graph(placed: DataFrame, shards: int) -> DataFrame:
    """(node, near): the adjacency lists of both its shards united, saved."""
    members = placed.where("place < 2").select("shard", "node", "dim", "v").repartitionByRange(shards, "shard")
    lists = members.groupBy("shard").applyInArrow(_build_shard, "node long, near array<long>")
    return save(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "flat-graph")


def _search_shard(cosine: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        node, n, where = (table.column(c).to_numpy() for c in ("node", "n", "place"))
        member, home = where < 2, where == 0
        u = _unit(_vectors(table.column("v"), table.column("dim")[0].as_py()))
        near = table.column("near").combine_chunks()
        lengths = np.nan_to_num(_numbers(near.value_lengths())).astype(np.int64) * member
        links = np.full((len(node) + 1, max(1, lengths.max(initial=0))), -1, np.int64)
        flat, row = _numbers(near.flatten()).astype(np.int64), np.repeat(np.arange(len(node)), lengths)
        at = np.minimum(np.searchsorted(node, flat), len(node) - 1)
        column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        links[row, column] = np.where((node[at] == flat) & member[at], at, -1)  # other shards' nodes are searched there
        count, root = shard_links(u, n, home, member, links, cosine)
        linked = (count > 0) | (root != np.arange(len(node)))
        return pa.table([pa.array(node[linked]), pa.array(count[linked]), pa.array(node[root[linked]])], names=["node", "links", "root"])

    return run


def find_links(placed: DataFrame, graph: DataFrame, shards: int, cosine: float = MIN_COSINE) -> DataFrame:
    """(node, links, root) a shard and node: copies linked with it that are at home there, a node it is connected with; saved."""
    rows = placed.join(graph, "node", "left").withColumn("near", F.expr("IF(place < 2, near, NULL)")).repartitionByRange(shards, "shard")
    return save(rows.groupBy("shard").applyInArrow(_search_shard(cosine), "node long, links long, root long"), "embedding-links")


def exact_links(nodes: DataFrame, asked: DataFrame, cosine: float = MIN_COSINE) -> DataFrame:
    """(node, exact): copies linked with each node of ``asked``, a bounded set, by comparing it with all nodes."""
    held: dict[int, tuple[list, list]] = {}
    for r in asked.select("node", "dim", "v").collect():
        ids, vectors = held.setdefault(r["dim"], ([], []))
        ids.append(r["node"])
        vectors.append(r["v"])
    shared = nodes.sparkSession.sparkContext.broadcast(
        {dim: (np.array(ids, np.int64), _unit(np.array(vectors))) for dim, (ids, vectors) in held.items()}
    )

    def run(batches):
        sums = {dim: np.zeros(len(ids), np.int64) for dim, (ids, _) in shared.value.items()}
        for batch in batches:
            for dim, part in _by_dim(batch):
                if dim not in sums:
                    continue
                ids, q = shared.value[dim]
                node, n, u = _numbers(part.column("node")), _numbers(part.column("n")), _unit(_vectors(part.column("v"), dim))
                for i in range(0, len(u), _BLOCK):
                    linked = (q @ u[i : i + _BLOCK].T >= cosine) & (ids[:, None] != node[i : i + _BLOCK])
                    sums[dim] += linked @ n[i : i + _BLOCK]
        for dim, (ids, _) in shared.value.items():
            some = sums[dim] > 0
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(sums[dim][some])], ["node", "exact"])

    return nodes.select("node", "dim", "n", "v").mapInArrow(run, "node long, exact long").groupBy("node").agg(F.sum("exact").alias("exact"))


def audited_recall(nodes: DataFrame, links: DataFrame, most: int = AUDIT, cosine: float = MIN_COSINE) -> float:
    """Mean share of their links that ``most`` nodes at most (by hash) have in ``links``; 1 if they have none."""
    longest = nodes.agg(F.max("dim")).first()[0] or 1
    asked = nodes.orderBy("h1", "h2").limit(max(1, min(most, AUDIT_BYTES // (8 * longest))))
    exact = exact_links(nodes, asked, cosine)
    found = links.groupBy("node").agg(F.sum("links").alias("found"))
    share = exact.join(found, "node", "left").agg(F.avg(F.coalesce("found", F.lit(0)) / F.col("exact"))).first()[0]
    return 1.0 if share is None else float(share)


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(node, dim, n, first_id, h1, h2, v): a numbered row per distinct usable vector of (id, v, h1, h2), saved."""
    usable = "forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)"
    nodes = rows.where(F.col("v").isNotNull()).where(usable).groupBy("h1", "h2")
    nodes = nodes.agg(F.first("v").alias("v"), F.count("*").alias("n"), F.min("id").alias("first_id"))
    nodes = nodes.select(F.monotonically_increasing_id().alias("node"), F.size("v").alias("dim"), "n", "first_id", "h1", "h2", "v")
    return save(nodes, "embedding-nodes")


def near_duplicates(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = MIN_COSINE,
    probes: int = PROBES,
    shard_nodes: int = SHARD_NODES,
    recall: float = RECALL,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row: the vectors linked with it and the smallest id it is connected with."""
    v = F.col(vector_col).cast("array<double>")
    rows = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    rows = rows.withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(12), F.reverse("v")))
    nodes = distinct_vectors(rows)
    clusters = fit_clusters(nodes, shard_nodes)
    shards = max(1, clusters.shards)
    placed = save(place(nodes, clusters, probes), "embedding-shards")
    graph = flat_graph(placed, shards)
    links = find_links(placed, graph, shards, cosine)
    while probes < clusters.most() and audited_recall(nodes, links, cosine=cosine) < recall:
        probes *= 2
        links = find_links(save(place(nodes, clusters, probes), "embedding-shards"), graph, shards, cosine)
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    found = nodes.select("node", "h1", "h2", "n", "first_id").join(counts, "node", "left").join(roots, "node", "left")
    found = found.withColumn("root", F.coalesce("root", "node"))
    firsts = found.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = found.join(firsts, "root").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    out = rows.select("id", "h1", "h2").join(found, ["h1", "h2"], "left")
    out = out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
