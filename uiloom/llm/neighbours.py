"""Approximate nearest neighbours by robust-pruned directed graphs, one for each shard of the vectors.

Equal vectors are one node; of their ids the smallest K + 1 are kept, which is all that an answer of
K rows with ties to the smaller id can need. Nodes are dealt over shards of about SHARD by a hash, so a
shard is bounded whatever the table holds. Each shard builds its graph in batches: a greedy beam search over the graph
so far proposes neighbours, and robust pruning keeps the nearest candidate and drops those that
are ALPHA times nearer to it than to the node, until DEGREE edges remain; edges are then added in
reverse, and a node that has ROOM of them is pruned the same way. A task holds one graph and all queries stream past it in blocks: a beam of BEAM nodes finds
candidates, distances are computed anew in double precision, and the best of all shards are merged. Graphs and searches use single precision.

Edge cases: vectors that are null, zero, of another length than most, or hold null or non-finite numbers take no part, neither as
candidates nor as queries; nor do rows without an id. An empty table gives an empty result; with fewer than K candidates a query gets all of them.
Rows with equal vectors are candidates for each other at distance 0. Further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uiloom.llm.common import in_scratch, outer, stage

SHARD, DEGREE, ROOM, BUILD_BEAM, BEAM, ALPHA = 16_384, 24, 40, 48, 96, 1.2
BATCH, BLOCK, SALTS, AT_ONCE = 512, 1024, 16, 4


def squares(x: np.ndarray, ids: np.ndarray, q: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Squared distances of q (rows) to x[ids]; ids: one row of nodes for each q."""
    return np.maximum(norms[ids] - 2 * (x[ids] @ q[:, :, None])[:, :, 0] + (q * q).sum(1)[:, None], 0)


def beam_search(x: np.ndarray, norms: np.ndarray, edges: np.ndarray, entry: int, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest `beam` nodes that greedy search finds for each q, -1 where there are fewer, and their squared distances."""
    n, b = len(x), len(q)
    ids = np.full((b, beam), -1)
    far = np.full((b, beam), np.inf, x.dtype)
    ids[:, 0] = entry
    far[:, 0] = squares(x, ids[:, :1], q, norms)[:, 0]
    done = ids < 0
    seen = np.zeros((b, n + 1), bool)
    seen[:, entry] = seen[:, n] = True
    rows = np.arange(b)
    while len(rows):
        # the nearest AT_ONCE nodes that were not expanded yet; they are sorted by distance
        at = np.argsort(done[rows], 1, kind="stable")[:, :AT_ONCE]
        fresh = ~np.take_along_axis(done[rows], at, 1)
        near = edges[np.take_along_axis(ids[rows], at, 1)]
        near = np.where((near < 0) | ~fresh[:, :, None], n, near).reshape(len(rows), -1)
        done[rows[:, None], at] = True
        order = np.sort(near, 1)
        new = ~seen[rows[:, None], order]
        new[:, 1:] &= order[:, 1:] != order[:, :-1]
        seen[rows[:, None], order] = True
        d = np.full(order.shape, np.inf, x.dtype)
        r, c = np.nonzero(new)
        points = order[r, c]
        d[r, c] = np.maximum(norms[points] - 2 * np.einsum("nd,nd->n", x[points], q[rows[r]]) + (q[rows[r]] ** 2).sum(1), 0)
        all_far = np.concatenate((far[rows], d), 1)
        best = np.argsort(all_far, 1, kind="stable")[:, :beam]
        far[rows] = np.take_along_axis(all_far, best, 1)
        ids[rows] = np.take_along_axis(np.concatenate((ids[rows], np.where(new, order, -1)), 1), best, 1)
        done[rows] = np.take_along_axis(np.concatenate((done[rows], ~new), 1), best, 1)
        rows = rows[~done[rows].all(1)]
    return ids, far


def robust_prune(x: np.ndarray, norms: np.ndarray, nodes: np.ndarray, pool: np.ndarray, far: np.ndarray) -> np.ndarray:
    """DEGREE diverse neighbours of each node from its pool (-1: none)."""
    far = np.where((pool < 0) | (pool == nodes[:, None]), np.inf, far).astype(x.dtype)
    keep = np.argsort(far, 1)[:, : 2 * BUILD_BEAM]
    pool, far = np.take_along_axis(pool, keep, 1), np.take_along_axis(far, keep, 1)
    points = x[np.maximum(pool, 0)]
    own = norms[np.maximum(pool, 0)]
    between = points @ points.transpose(0, 2, 1)
    between *= -2
    between += own[:, :, None]
    between += own[:, None, :]
    between *= ALPHA * ALPHA
    out = np.full((len(pool), DEGREE), -1)
    rows = np.arange(len(pool))
    for r in range(DEGREE):
        best = far.argmin(1)
        ok = np.isfinite(far[rows, best])
        if not ok.any():
            break
        out[ok, r] = pool[rows, best][ok]
        far[(between[rows, best] <= far) & ok[:, None]] = np.inf
        far[rows, best] = np.inf
    return out


def add_reverse(x: np.ndarray, norms: np.ndarray, edges: np.ndarray, nodes: np.ndarray) -> None:
    """An edge back to `nodes` from each of their neighbours; neighbours without room are pruned."""
    source, target = np.repeat(nodes, edges.shape[1]), edges[nodes].ravel()
    new = (target >= 0) & ~(edges[target] == source[:, None]).any(1)
    order = np.argsort(target[new], kind="stable")
    source, target = source[new][order], target[new][order]
    owners, first, counts = np.unique(target, return_index=True, return_counts=True)
    used = (edges[owners] >= 0).sum(1)
    fits = used + counts <= ROOM
    place = np.arange(len(target)) - np.repeat(first, counts) + np.repeat(used, counts)
    easy = np.repeat(fits, counts)
    edges[target[easy], place[easy]] = source[easy]
    full = np.flatnonzero(~fits)
    full = full[np.argsort(counts[full], kind="stable")]
    for part in np.array_split(full, -(-len(full) // 256)) if len(full) else ():
        width = int((used[part] + counts[part]).max())
        pool = np.full((len(part), width), -1)
        for row, k in enumerate(part.tolist()):
            pool[row, : used[k]] = edges[owners[k], : used[k]]
            pool[row, used[k] : used[k] + counts[k]] = source[first[k] : first[k] + counts[k]]
        at = owners[part]
        edges[at, DEGREE:] = -1
        edges[at, :DEGREE] = robust_prune(x, norms, at, pool, squares(x, np.maximum(pool, 0), x[at], norms))


def build(vectors: np.ndarray) -> tuple[np.ndarray, int]:
    """Edges (ROOM for each node, -1: none) and the entry node."""
    x = vectors.astype("f4")
    n = len(x)
    norms = (x * x).sum(1)
    entry = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    edges = np.full((n, ROOM), -1)
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate(([entry], order[order != entry]))
    start = 1
    while start < n:
        nodes = order[start : start + min(BATCH, max(1, start))]
        start += len(nodes)
        pool, far = beam_search(x, norms, edges, entry, x[nodes], BUILD_BEAM)
        if len(nodes) > 1:  # those of one batch don't find each other in the graph
            d = np.maximum(norms[nodes][:, None] + norms[nodes][None, :] - 2 * x[nodes] @ x[nodes].T, 0)
            k = min(len(nodes), 16)
            near = np.argpartition(d, k - 1, 1)[:, :k]
            pool, far = np.concatenate((pool, nodes[near]), 1), np.concatenate((far, np.take_along_axis(d, near, 1)), 1)
        edges[nodes, :DEGREE] = robust_prune(x, norms, nodes, pool, far)
        add_reverse(x, norms, edges, nodes)
    return edges, entry


def sound(vector: Column) -> Column:
    """Whether a vector takes part."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(vector, lambda v: v != 0)


def answers(graphs: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """query_id, node and distance of the k + 1 best nodes of each graph. One task holds a graph, and the blocks of queries stream past it."""
    number = ["shard", "kind"]
    none = {"ids": "array<long>", "asked": "array<double>"}
    first = graphs.withColumn("kind", F.lit(0)).select(*number, "nodes", "x", "edges", "entry", *(F.lit(None).cast(t).alias(c) for c, t in none.items()))
    empty = {"nodes": "binary", "x": "binary", "edges": "binary", "entry": "int"}
    then = blocks.withColumn("kind", F.lit(1)).select(*number, *(F.lit(None).cast(t).alias(c) for c, t in empty.items()), "ids", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = x = small = norms = edges = None
        entry = 0
        for batch in batches:
            for row in range(batch.num_rows):
                cell = lambda i: batch.column(i)[row]  # noqa: B023, E731
                if cell(1).as_py() == 0:
                    node = np.frombuffer(cell(2).as_buffer(), "i8")
                    x = np.frombuffer(cell(3).as_buffer(), "f8").reshape(len(node), -1)
                    small, edges, entry = x.astype("f4"), np.frombuffer(cell(4).as_buffer(), "i4").reshape(len(node), -1).astype("i8"), cell(5).as_py()
                    norms = (small * small).sum(1)
                    continue
                own = cell(6).values.to_numpy(zero_copy_only=False)
                q = cell(7).values.to_numpy(zero_copy_only=False).reshape(len(own), -1)
                for at in range(0, len(q), BATCH):
                    part = q[at : at + BATCH]
                    ids, _ = beam_search(small, norms, edges, entry, part.astype("f4"), max(BEAM, k + 1))
                    d = np.sqrt(((x[np.maximum(ids, 0)] - part[:, None, :]) ** 2).sum(2))
                    d = np.where(ids < 0, np.inf, d)
                    best = np.argsort(d, 1, kind="stable")[:, : k + 1]
                    far = np.take_along_axis(d, best, 1).ravel()
                    kept = np.isfinite(far)
                    columns = [np.repeat(own[at : at + BATCH], best.shape[1])[kept], node[np.take_along_axis(ids, best, 1).ravel()][kept], far[kept]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "node", "score"])

    together = first.unionByName(then).repartition("shard").sortWithinPartitions("shard", "kind")
    return together.mapInArrow(run, "query_id long, node long, score double")


@in_scratch
def search(vectors: DataFrame, queries: Column, id_col: str, vector_col: str, k: int) -> DataFrame:
    """query_id, rank, id and score (Euclidean distance) of the k nearest rows for each row that `queries` selects."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), queries.alias("is_query"))
    rows = rows.where("vec_id IS NOT NULL").where(sound(F.col("vector"))).withColumn("length", F.size("vector"))
    common = rows.groupBy("length").count().orderBy(F.desc("count"), "length").first()
    rows = rows.where(F.col("length") == (common["length"] if common else 0)).drop("length")
    digest = [F.xxhash64("vector").alias("h1"), F.hash("vector").alias("h2")]
    nodes = stage(rows.groupBy("vector").agg(F.min("vec_id").alias("node")), "nodes")
    shards = max(1, math.ceil(nodes.count() / SHARD))

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["vector"].to_numpy()).astype("f8")
        edges, entry = build(x)
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "nodes": [pdf["node"].to_numpy("i8").tobytes()], "x": [x.tobytes()], "edges": [edges.astype("i4").tobytes()], "entry": [entry]})

    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int"))
    graphs = stage(dealt.groupBy("shard").applyInPandas(make, "shard int, nodes binary, x binary, edges binary, entry int"), "graphs")

    asked = rows.where("is_query").select("vec_id", "vector")
    packs = max(1, math.ceil(asked.count() / BLOCK))
    packed = asked.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(packs)).alias("block")).agg(F.collect_list(F.struct("vec_id", "vector")).alias("q"))
    blocks = packed.select(F.col("q.vec_id").alias("ids"), F.flatten("q.vector").alias("asked"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    found = answers(graphs, blocks, k)
    best = Window.partitionBy("query_id").orderBy("score", "node")
    top = stage(found.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1).drop("_r"), "found", owner=outer())

    # the smallest ids of each node: of each salt first, then of those
    ids = rows.select("vec_id", *digest).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    for by in (["h1", "h2", "salt"], ["h1", "h2"]):
        ids = ids.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("vec_id"))).where(F.col("_r") <= k + 1)
    keys = nodes.select("node", *digest)
    members = stage(ids.select("vec_id", "h1", "h2"), "members")
    wanted = top.select("node").distinct().join(keys, "node").join(members, ["h1", "h2"]).select("node", "vec_id")
    near = top.join(stage(wanted, "wanted", owner=outer()), "node").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
