"""Nearest neighbours by one navigable small-world graph per shard (operator 2).

Vectors are dealt to shards of bounded size by their id's hash. A shard's graph is a
hierarchy of layers; each vector is linked to diverse near ones on its layers, and all
links are stored as flat arrays in one row of a written table. Queries travel in blocks;
every block meets every shard, is searched there from the top layer down, and the shards'
best results are merged by exact distance. Shards and blocks are shuffled to each other,
never broadcast: a block is copied to every shard, which Spark's sizes of it leave out.
Equal vectors of a shard are one node with a list of members, so that large groups of
copies cannot cut a graph into pieces.

Defined results: vectors that are null, zero or hold null or non-finite components, and
rows with a null id, take no part; of rows with one id the smallest vector counts; only
vectors of the query's length are its candidates; ties go to the smaller id; an empty
table gives no rows.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 4096
BLOCK_QUERIES = 256
GROUP_BLOCKS = 64
LINKS = 12
BUILD_WIDTH = 64
SEARCH_WIDTH = 128


class Graph:
    """Layers of links over ``vectors``; row ``-1`` in ``links`` is no link.

    ``links[0]`` has a row per node, a higher layer a row for each of ``members[layer]``.
    """

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        n = len(vectors)
        # Heights fall off geometrically, from a fixed sequence, so a retry builds the same.
        draw = np.random.default_rng(n).random(n)
        self.height = np.minimum((-np.log(draw) / math.log(LINKS)).astype(int), 12)
        top = int(self.height.max(initial=0))
        self.links = [np.full((n, 2 * LINKS if k == 0 else LINKS), -1, np.int32) for k in range(top + 1)]
        self.entry, self.top = 0, int(self.height[0]) if n else 0
        self.seen = np.zeros(n, np.int64)
        self.turn = 0

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        graph = cls(vectors)
        for node in range(1, len(vectors)):
            graph.insert(node)
        return graph

    def distances(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        step = self.vectors[nodes] - q
        return np.einsum("ij,ij->i", step, step)

    def search_layer(self, q: np.ndarray, start: list[tuple[float, int]], width: int, layer: int) -> list[tuple[float, int]]:
        """Up to ``width`` near nodes of a layer, nearest first."""
        self.turn += 1
        seen, links = self.seen, self.links[layer]
        for _, node in start:
            seen[node] = self.turn
        todo = list(start)
        heapq.heapify(todo)
        best = [(-d, node) for d, node in start]
        heapq.heapify(best)
        while todo:
            d, node = heapq.heappop(todo)
            if d > -best[0][0] and len(best) >= width:
                break
            near = links[node]
            near = near[near >= 0]
            near = near[seen[near] != self.turn]
            if not len(near):
                continue
            seen[near] = self.turn
            for dist, other in zip(self.distances(q, near).tolist(), near.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (-dist, other))
                    heapq.heappush(todo, (dist, other))
                elif dist < -best[0][0]:
                    heapq.heapreplace(best, (-dist, other))
                    heapq.heappush(todo, (dist, other))
        return sorted((-d, node) for d, node in best)

    def diverse(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Near nodes of which none is nearer to another chosen one than to the centre."""
        nodes = np.array([node for _, node in found])
        v = self.vectors[nodes]
        square = np.einsum("ij,ij->i", v, v)
        between = square[:, None] + square[None, :] - 2 * (v @ v.T)
        chosen: list[int] = []
        for k, (d, _) in enumerate(found):
            if len(chosen) == most:
                break
            if not chosen or between[k, chosen].min() > d:
                chosen.append(k)
        for k in range(len(found)):
            if len(chosen) == most:
                break
            if k not in chosen:
                chosen.append(k)
        return nodes[chosen].tolist()

    def insert(self, node: int) -> None:
        q, height = self.vectors[node], int(self.height[node])
        found = [(float(self.distances(q, np.array([self.entry]))[0]), self.entry)]
        for layer in range(self.top, height, -1):
            found = self.search_layer(q, found[:1], 1, layer)
        for layer in range(min(self.top, height), -1, -1):
            found = self.search_layer(q, found, BUILD_WIDTH, layer)
            links = self.links[layer]
            chosen = self.diverse(found, LINKS)
            links[node, : len(chosen)] = chosen
            for other in chosen:
                free = np.flatnonzero(links[other] < 0)
                if len(free):
                    links[other, free[0]] = node
                    continue
                near = np.append(links[other], node)
                d = self.distances(self.vectors[other], near)
                order = np.argsort(d, kind="stable")
                kept = self.diverse([(float(d[k]), int(near[k])) for k in order], links.shape[1])
                links[other] = -1
                links[other, : len(kept)] = kept
        if height > self.top:
            self.entry, self.top = node, height

    def search(self, q: np.ndarray, width: int) -> list[int]:
        if not len(self.vectors):
            return []
        found = [(float(self.distances(q, np.array([self.entry]))[0]), self.entry)]
        for layer in range(self.top, 0, -1):
            found = self.search_layer(q, found[:1], 1, layer)
        return [node for _, node in self.search_layer(q, found, width, 0)]


INDEX_SCHEMA = (
    "shard long, size int, entry int, top int, vectors binary, links binary, "
    "upper_nodes binary, upper_links binary, starts binary, members binary"
)


def pack_index(shard: int, ids: np.ndarray, vectors: np.ndarray) -> tuple:
    """A shard's row: graph over its distinct vectors, and the ids of each."""
    distinct, of = np.unique(vectors, axis=0, return_inverse=True)
    # Sorted input would make the first nodes neighbours; deal them evenly instead.
    deal = np.random.default_rng(len(distinct)).permutation(len(distinct))
    place = np.argsort(deal)
    distinct, of = distinct[deal], place[of.ravel()]
    order = np.lexsort((ids, of))
    starts = np.searchsorted(of[order], np.arange(len(distinct) + 1)).astype(np.int64)
    graph = Graph.build(distinct)
    upper = [np.flatnonzero(graph.height >= k).astype(np.int32) for k in range(1, graph.top + 1)]
    nodes = b"".join(np.int32(len(u)).tobytes() + u.tobytes() for u in upper)
    links = b"".join(graph.links[k + 1][u].tobytes() for k, u in enumerate(upper))
    return (
        shard, vectors.shape[1], graph.entry, graph.top, distinct.tobytes(),
        graph.links[0].tobytes(), nodes, links, starts.tobytes(), ids[order].tobytes(),
    )


def open_index(size, entry, top, vectors, links, nodes, upper) -> Graph:
    graph = Graph.__new__(Graph)
    graph.vectors = np.frombuffer(vectors).reshape(-1, size)
    n = len(graph.vectors)
    graph.entry, graph.top, graph.turn = entry, top, 0
    graph.seen = np.zeros(n, np.int64)
    graph.links = [np.frombuffer(links, np.int32).reshape(n, -1)]
    at = low = 0
    for _ in range(top):
        count = int(np.frombuffer(nodes, np.int32, 1, at)[0])
        of = np.frombuffer(nodes, np.int32, count, at + 4)
        layer = np.full((n, LINKS), -1, np.int32)
        layer[of] = np.frombuffer(upper, np.int32, count * LINKS, low).reshape(count, LINKS)
        graph.links.append(layer)
        at, low = at + 4 + 4 * count, low + 4 * count * LINKS
    return graph


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def usable_vectors(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    vectors = df.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v")
    )
    return vectors.where(F.col("id").isNotNull() & _usable(F.col("v"))).groupBy("id").agg(F.min("v").alias("v"))


def build_index(vectors: DataFrame, store, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Written table of one row per shard over ``vectors`` (id, v)."""
    shards = max(1, -(-vectors.count() // shard_rows))
    size = F.size("v").cast("long")
    dealt = vectors.withColumn("shard", size * shards + F.pmod(F.xxhash64("id"), F.lit(shards)))

    def build(part: pa.Table) -> pa.Table:
        shard = part.column("shard")[0].as_py()
        ids = part.column("id").to_numpy()
        flat = part.column("v").combine_chunks().flatten().to_numpy()
        row = pack_index(shard, ids, flat.reshape(len(ids), -1))
        return pa.Table.from_pylist([dict(zip(names, row))], schema=arrow)

    names = [f.strip().split()[0] for f in INDEX_SCHEMA.split(",")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    arrow = pa.schema([(n, kinds[f.strip().split()[1]]) for n, f in zip(names, INDEX_SCHEMA.split(","))])
    built = dealt.groupBy("shard").applyInArrow(build, INDEX_SCHEMA)
    return store.keep(built.withColumn("shards", F.lit(shards)), "index")


def search(
    index: DataFrame, queries: DataFrame, *, k: int = 10, width: int = SEARCH_WIDTH
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for ``queries`` (id, v)."""
    blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    size = F.size("v").alias("size")
    packed = (
        queries.select("id", "v", size, F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
        .groupBy("size", "block")
        .agg(F.collect_list("id").alias("ids"), F.flatten(F.collect_list("v")).alias("flat"))
    )
    # Each block names the shards it visits, so that pairs are dealt by shard, not by length.
    # A shard is sent once for GROUP_BLOCKS blocks, which bounds what a task holds of them.
    known = index.select("shards").first()
    shards = known.shards if known else 1
    visits = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("at")
    group = F.floor(F.col("block") / GROUP_BLOCKS).cast("long").alias("part")
    pairs = packed.select("size", group, "ids", "flat", visits).select(
        (F.col("size").cast("long") * shards + F.col("at")).alias("shard"), "part", "ids", "flat"
    )
    parts = F.sequence(F.lit(0), F.lit((blocks - 1) // GROUP_BLOCKS)).cast("array<long>")
    columns = [f.strip().split()[0] for f in INDEX_SCHEMA.split(",")]
    copies = index.select(*columns, F.explode(parts).alias("part"))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def visit(shard: pa.Table, met: pa.Table) -> pa.Table:
        if not shard.num_rows or not met.num_rows:
            return schema.empty_table()
        _, size, *stored, starts, members = (shard.column(c)[0].as_py() for c in columns)
        graph = open_index(size, *stored)
        starts, members = np.frombuffer(starts, np.int64), np.frombuffer(members, np.int64)
        out: list[tuple] = []
        for ids, flat in zip(met.column("ids"), met.column("flat")):
            for query, q in zip(ids.as_py(), flat.values.to_numpy().reshape(-1, size)):
                found = []
                for node in graph.search(q, max(width, k + 1)):
                    own = [m for m in members[starts[node] : starts[node + 1]][: k + 1].tolist() if m != query]
                    step = graph.vectors[node] - q
                    found += [(math.sqrt(float(step @ step)), m) for m in own]
                out += [(query, m, score) for score, m in sorted(found)[:k]]
        return pa.table([list(c) for c in zip(*out)] or [[], [], []], schema=schema)

    found = (
        copies.groupBy("shard", "part")
        .cogroup(pairs.groupBy("shard", "part"))
        .applyInArrow(visit, "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
