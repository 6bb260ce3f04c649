"""Approximate nearest neighbours by inner product: one navigable small-world graph per shard.

Equal vectors are one node that keeps its ``k + 1`` smallest ids (no query can need more), so a
vector that very many rows share costs one node. Nodes are dealt to shards by their norm's power of
ten and a hash of the vector. Inner product becomes cosine by one extra component (the root of the shard's
largest squared norm minus the own squared norm), so a shard's graph works on one sphere; norms of a
shard differ by a factor of ten at most, so single precision tells its nodes apart, however long others are. A shard's graph is a few flat neighbour
arrays: level 0 links every node, each higher level a random ``1 / M`` of the level below. Levels are
built from the top; nodes enter in batches that are searched together, neighbours are
chosen for diversity, and reverse links are pruned the same way.

A query descends the levels of every shard, explores ``ef`` nodes at level 0, and the best are
scored again in double precision on the original vectors; shard results are merged by a
windowed top-k. Queries travel in blocks to each shard by an equi-join on the shard's keys.

Defined results: vectors that are null, zero or hold a null or non-finite component, and rows without
id, take no part; a repeated row counts once; only vectors of equal length meet. A query with
fewer candidates gets them all. Ties go to the smaller id. Extra columns are ignored.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save

M = 16  # links of a node on the higher levels; twice that at level 0
EF_BUILD = 64
EF_SEARCH = 160
SHARD_NODES = 8192
QUERY_BLOCK = 1024
_BATCH = 256
_WIDE = 4  # nodes opened per query and step
_SEED = 9


def _dots(vectors: np.ndarray, ids: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of each query with its own row of nodes."""
    return np.matmul(vectors[ids], q[:, :, None])[:, :, 0]


def beam(vectors: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of all queries in step: (ids, similarities) [query, ef], best first, -1 where none."""
    rows = np.arange(len(q))
    seen = np.zeros((len(q), len(vectors) + 1), bool)  # the last column stands for id -1
    seen[:, -1] = True
    ids = np.full((len(q), ef), -1, np.int64)
    sims = np.full((len(q), ef), -np.inf, np.float32)
    opened = np.ones((len(q), ef), bool)
    width = min(ef, entry.shape[1])
    seen[rows[:, None], entry] = True
    ids[:, :width], opened[:, :width] = entry[:, :width], entry[:, :width] < 0
    sims[:, :width] = np.where(ids[:, :width] >= 0, _dots(vectors, ids[:, :width], q), -np.inf)
    live = rows
    while len(live):
        closed = ~opened[live]
        live, closed = live[closed.any(axis=1)], closed[closed.any(axis=1)]
        if not len(live):
            break
        turn = closed & (np.cumsum(closed, axis=1) <= _WIDE)
        own = ids[live]
        at = np.argsort(~turn, axis=1, kind="stable")[:, :_WIDE]
        nodes = np.where(np.take_along_axis(turn, at, axis=1), np.take_along_axis(own, at, axis=1), -1)
        opened[live] |= turn
        new = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(len(live), -1)
        new = np.sort(new, axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        new[seen[live[:, None], new]] = -1
        seen[live[:, None], new] = True
        near = np.where(new >= 0, _dots(vectors, new, q[live]), -np.inf)
        all_sims = np.concatenate([sims[live], near], axis=1)
        best = np.argsort(-all_sims, axis=1, kind="stable")[:, :ef]
        sims[live] = np.take_along_axis(all_sims, best, axis=1)
        ids[live] = np.take_along_axis(np.concatenate([own, new], axis=1), best, axis=1)
        opened[live] = np.take_along_axis(np.concatenate([opened[live], new < 0], axis=1), best, axis=1)
    return ids, sims


def _diverse(vectors: np.ndarray, cand: np.ndarray, sims: np.ndarray, m: int) -> np.ndarray:
    """Up to ``m`` of each row's candidates (best first): first those closer to the row's node than to a chosen one, then the rest."""
    rows, width = cand.shape
    own = vectors[cand]
    between = np.matmul(own, own.transpose(0, 2, 1))
    chosen = np.zeros((rows, width), bool)
    count = np.zeros(rows, np.int64)
    for j in range(width):
        blocked = (chosen & (between[:, j] > sims[:, j, None])).any(axis=1)
        chosen[:, j] = (cand[:, j] >= 0) & ~blocked & (count < m)
        count += chosen[:, j]
    order = np.argsort(np.where(cand < 0, 2, np.where(chosen, 0, 1)), axis=1, kind="stable")[:, :m]
    out = np.take_along_axis(cand, order, axis=1)
    return np.pad(out, ((0, 0), (0, max(0, m - out.shape[1]))), constant_values=-1)


def _sorted_candidates(ids: np.ndarray, sims: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    sims = np.where(ids < 0, -np.inf, sims)
    order = np.argsort(-sims, axis=1, kind="stable")[:, :width]
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)


def _link_back(vectors: np.ndarray, links: np.ndarray, nodes: np.ndarray, m: int) -> None:
    """Give every neighbour of the new ``nodes`` a link back; lists that overflow are pruned."""
    source = np.repeat(nodes, links.shape[1])
    target = links[nodes].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    uniq, start, count = np.unique(target, return_index=True, return_counts=True)
    extra = np.full((len(uniq), count.max(initial=0)), -1, np.int64)
    extra[np.repeat(np.arange(len(uniq)), count), np.arange(len(target)) - np.repeat(start, count)] = source
    for a in range(0, len(uniq), 512):
        t = uniq[a : a + 512]
        both = np.sort(np.concatenate([links[t], extra[a : a + 512]], axis=1), axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        both, sims = _sorted_candidates(both, _dots(vectors, both, vectors[t]), 2 * m)
        links[t] = _diverse(vectors, both, sims, m)


def build(vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the bottom: (nodes, links) with links[i] the neighbours of node i (-1: none), all by node number."""
    n = len(vectors)
    level = np.floor(-np.log(1 - np.random.default_rng(_SEED).random(n)) / np.log(M)).astype(int)
    order = np.argsort(-level, kind="stable")  # every level is a prefix
    levels: list[tuple[np.ndarray, np.ndarray]] = []
    for top in range(level.max(initial=0), -1, -1):
        nodes = order[: int((level >= top).sum())]
        m = M if top else 2 * M
        links = np.full((n + 1, m), -1, np.int64)
        done = 0
        while done < len(nodes):
            batch = nodes[done : done + min(_BATCH, max(done, 32))]
            q = vectors[batch]
            mates = np.where(np.eye(len(batch), dtype=bool), -1, batch[None, :])
            cand, sims = mates, np.matmul(q, q.T)
            if done:
                entry = _descend(vectors, levels, q, nodes[:1])
                found, near = beam(vectors, links, q, entry, EF_BUILD)
                cand, sims = np.concatenate([found, mates], axis=1), np.concatenate([near, sims], axis=1)
            links[batch] = _diverse(vectors, *_sorted_candidates(cand, sims, EF_BUILD), m)
            _link_back(vectors, links, batch, m)
            done += len(batch)
        levels.insert(0, (nodes, links))
    return levels


def _descend(vectors: np.ndarray, levels, q: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Entry nodes after a narrow search of the given levels, the topmost first."""
    entry = np.tile(first, (len(q), 1))
    for _, links in reversed(levels):
        entry = beam(vectors, links, q, entry, 4)[0]
    return entry


def search(vectors: np.ndarray, levels, q: np.ndarray, ef: int) -> np.ndarray:
    """Node numbers [query, ef], nearest first, -1 where none."""
    first = levels[-1][0][:1]
    entry = _descend(vectors, levels[1:], q, first)
    return beam(vectors, levels[0][1], q, entry, ef)[0]


def _lift(vectors: np.ndarray) -> np.ndarray:
    """Append the component that puts every vector on the sphere of the largest norm; scaled before squaring."""
    scaled = vectors / np.abs(vectors).max()
    square = (scaled * scaled).sum(axis=1)
    return (np.column_stack([scaled, np.sqrt(square.max() - square)]) / np.sqrt(square.max())).astype(np.float32)


def _pack(levels) -> tuple[list[bytes], list[bytes]]:
    """Flat arrays: per level its nodes and their neighbour rows."""
    return [nodes.astype("<i4").tobytes() for nodes, _ in levels], [links[nodes].astype("<i4").tobytes() for nodes, links in levels]


def _unpack(n: int, nodes: list[bytes], links: list[bytes]):
    levels = []
    for k, (own, flat) in enumerate(zip(nodes, links)):
        own = np.frombuffer(own, "<i4").astype(np.int64)
        full = np.full((n + 1, M if k else 2 * M), -1, np.int64)
        full[own] = np.frombuffer(flat, "<i4").reshape(len(own), -1)
        levels.append((own, full))
    return levels


_INDEX = "dim int, band int, shard int, vectors binary, ids array<array<long>>, nodes array<binary>, links array<binary>"


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in column.chunks]).reshape(-1, dim)


def _build_shard(table: pa.Table) -> pa.Table:
    dim, band, shard = (table.column(c)[0].as_py() for c in ("dim", "band", "shard"))
    vectors = _matrix(table.column("v"), dim)
    ids = table.column("ids").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: ids[i])
    vectors, ids = vectors[order], [ids[i] for i in order]
    nodes, links = _pack(build(_lift(vectors)))
    row = [[dim], [band], [shard], [vectors.astype("<f8").tobytes()], [ids], [nodes], [links]]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.binary()), pa.list_(pa.binary())]
    return pa.table([pa.array(v, t) for v, t in zip(row, kinds)], names=[c.split()[0] for c in _INDEX.split(", ")])


def _search_shards(k: int, ef: int):
    def run(batches):
        for batch in batches:
            get = {c: batch.column(c) for c in batch.schema.names}
            for i in range(batch.num_rows):
                dim = get["dim"][i].as_py()
                vectors = np.frombuffer(get["vectors"][i].as_buffer(), "<f8").reshape(-1, dim)
                members = get["ids"][i].as_py()
                levels = _unpack(len(vectors), get["nodes"][i].as_py(), get["links"][i].as_py())
                asked = np.array(get["query_ids"][i].as_py(), np.int64)
                q = np.array(get["queries"][i].as_py(), float).reshape(-1, dim)
                lifted, scaled = _lift(vectors), q / np.abs(q).max(axis=1, keepdims=True)
                length = np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
                flat = np.column_stack([scaled / length, np.zeros(len(q))]).astype(np.float32)
                out: list[tuple[int, int, float]] = []
                for a in range(0, len(q), _BATCH):
                    found = search(lifted, levels, flat[a : a + _BATCH], ef)
                    for query, own, nodes in zip(asked[a : a + _BATCH].tolist(), q[a : a + _BATCH], found):
                        nodes = nodes[nodes >= 0]
                        scores = (vectors[nodes] * own).sum(axis=1)
                        best = np.argsort(-scores, kind="stable")
                        keep = scores[best] >= (scores[best[k]] if len(best) > k else -np.inf)
                        rows = [
                            (-s, v)
                            for node, s in zip(nodes[best[keep]].tolist(), scores[best[keep]].tolist())
                            for v in members[node]
                            if v != query
                        ]
                        out += [(query, v, -s) for s, v in sorted(rows)[:k]]
                columns = zip(*out) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"]
                )

    return run


def _valid(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    usable = F.expr("forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)")
    rows = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    return rows.where(usable).withColumn("dim", F.size("v"))


def build_index(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", keep: int = 21, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The saved index: one row per (dim, band of norms, shard) of flat arrays. ``keep`` ids are kept for each distinct vector."""
    valid = _valid(rows, id_col, vector_col)
    w = Window.partitionBy("dim", "v").orderBy("id")
    ranked = valid.distinct().withColumn("r", F.row_number().over(w)).where(F.col("r") <= keep)
    nodes = ranked.groupBy("dim", "v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    nodes = nodes.withColumn("big", F.expr("array_max(transform(v, x -> abs(x)))"))
    power = "log10(big) + log10(aggregate(v, 0D, (s, x) -> s + (x / big) * (x / big))) / 2"  # of the norm
    nodes = save(nodes.withColumn("band", F.expr(f"cast(round({power}) AS int)")).drop("big"), "ann-nodes")
    bands = nodes.groupBy("dim", "band").agg(F.count("*").alias("n"))
    bands = bands.withColumn("shards", F.expr(f"cast(ceil(n / {shard_nodes}) AS int)"))
    total = bands.agg(F.sum("shards")).first()[0] or 1
    dealt = nodes.join(bands, ["dim", "band"]).withColumn("shard", F.expr("cast(pmod(xxhash64(v), shards) AS int)"))
    parts = dealt.select("dim", "band", "shard", "v", "ids").repartition(int(total), "dim", "band", "shard")
    return save(parts.groupBy("dim", "band", "shard").applyInArrow(_build_shard, _INDEX), "ann-index")


def nearest(
    rows: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    ef: int = EF_SEARCH,
    shard_nodes: int = SHARD_NODES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row where ``is_query`` (on the id column) holds."""
    index = build_index(rows, id_col, vector_col, k + 1, shard_nodes)
    queries = _valid(rows.where(is_query), id_col, vector_col).distinct()
    queries = save(queries, "ann-queries")
    blocks = queries.groupBy("dim").agg(F.expr(f"cast(ceil(count(*) / {QUERY_BLOCK}) AS int)").alias("blocks"))
    queries = queries.join(blocks, "dim").withColumn("block", F.expr("cast(pmod(xxhash64(id), blocks) AS int)"))
    queries = queries.groupBy("dim", "block").agg(F.collect_list(F.struct("id", "v")).alias("q"))
    queries = queries.select("dim", "block", F.col("q.id").alias("query_ids"), F.flatten("q.v").alias("queries"))
    shards = index.groupBy("dim").agg(F.collect_list(F.struct("band", "shard")).alias("shards"))
    asked = queries.join(shards, "dim").withColumn("s", F.explode("shards")).drop("shards").select("*", "s.*").drop("s")
    tasks = max(1, index.count())
    key = ["dim", "band", "shard"]
    pairs = index.repartition(tasks, *key).join(asked.repartition(tasks, *key), key)
    found = pairs.drop("band", "shard", "block").mapInArrow(_search_shards(k, ef), "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def exact_nearest(vectors: np.ndarray, ids: np.ndarray, query: int, k: int) -> list[int]:
    """Brute force for recall measurements: ids of the ``k`` nearest of one row, by number."""
    scores = vectors @ vectors[query]
    order = sorted((-s, i) for s, i, n in zip(scores.tolist(), ids.tolist(), range(len(ids))) if n != query)
    return [i for _, i in order[:k]]
