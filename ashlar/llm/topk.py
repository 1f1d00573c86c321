"""Exact top-k search by inner product of quantised vectors: tiled matrix products, partial selection
per tile, tree merging.

Queries are dealt to blocks and vectors to shards, each of a bounded number of bytes; every pair of a block and a shard is one cell of
a grid, and all cells are tasks of one job. A cell multiplies tile by tile, keeps the best k of each tile and merges them; the shards'
lists are then merged FAN at a time until one is left for each query. Nothing is sent to the driver but two counts.
Products are of integers: in float64 where all sums stay below 2^53, else in Python integers.

Defined results: vectors that are null or hold null or non-finite components take no part; rows whose
number of components differs from a query's are no candidates for it; each query row has its own list, and only that
row itself is no candidate of it; rows with a null id take no part; ties go to the smaller vec_id, repeated candidate ids
rank one after the other. Scores beyond a long are held at its ends. An empty table, or one without queries, has no rows; very long
vectors make blocks and shards of fewer rows; other columns of the input play no part."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_table

#: Bytes of a block of queries and of a shard of vectors.
BLOCK_BYTES, SHARD_BYTES = 16 << 20, 64 << 20
TILE, FAN, SCALE = 4096, 16, 256.0
LOW, HIGH = -(2**63), 2**63 - 1
LISTS = "rid long, query_id long, part int, ids array<long>, scores array<long>"


def quantised(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): floor(256 * x) of each component as a whole double; only vectors that take part."""
    x = F.transform(vec_col, lambda c: F.when(F.abs(c.cast("double")) < 2.0**50, F.floor(c.cast("double") * SCALE).cast("double")).otherwise(c.cast("double") * SCALE))
    fine = F.forall(vec_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & fine).select(F.col(id_col).cast("long").alias("id"), x.alias("v"))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products, rows of q by rows of x."""
    bound = (np.abs(q).max(initial=0) * np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if bound < 2.0**53:
        return (q @ x.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    return np.clip(exact(q).dot(exact(x).T), LOW, HIGH).astype(np.int64)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest of each row, ties to smaller ids; ids: of each row, or of all rows alike."""
    if scores.shape[1] > 4 * k:  # all that tie with the k-th stay
        floor = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        width = int((scores >= floor[:, None]).sum(1).max())
        part = np.argpartition(-scores, width - 1, axis=1)[:, :width] if width < scores.shape[1] else np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
        ids = np.take_along_axis(np.broadcast_to(ids, scores.shape), part, 1)
        scores = np.take_along_axis(scores, part, 1)
    ids = np.broadcast_to(ids, scores.shape)
    order = np.lexsort((ids, ~scores), axis=1)[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


def by_size(table):
    """(components, row ids, ids, matrix) of an Arrow table (rid, id, v), for each number of components."""
    table = table.combine_chunks()
    column = lambda c: np.asarray(table.column(c).to_numpy()).astype(np.int64)
    rids, ids, lists = column("rid"), column("id"), table.column("v").combine_chunks()
    if hasattr(lists, "chunks"):
        lists = lists.chunk(0) if lists.num_chunks else None
    if lists is None or not len(rids):
        return {}
    sizes = np.diff(np.asarray(lists.offsets))
    flat, ends = np.asarray(lists.flatten()).astype(np.float64), np.concatenate([[0], np.cumsum(sizes)])
    found = {}
    for d in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == d)
        found[d] = rids[rows], ids[rows], flat[ends[rows][:, None] + np.arange(d)] if d else np.zeros((len(rows), 0))
    return found


def cell_lists(queries, shard, part: int, k: int, rows: int = 1024):
    """The best k of a shard for each query of a block, as an Arrow table."""
    import pyarrow as pa

    of, out = by_size(shard), ([], [], [], [], [])
    for d, (q_rid, q_id, q) in by_size(queries).items():
        if d not in of:
            continue
        rid, ids, x = of[d]
        for q0 in range(0, len(q_rid), rows):
            here, held = slice(q0, q0 + rows), None
            for lo in range(0, len(rid), TILE):
                tile = slice(lo, lo + TILE)
                s, own = products(q[here], x[tile]), q_rid[here][:, None] == rid[tile][None]
                names = np.broadcast_to(ids[tile], s.shape)
                if own.any():  # the query itself goes behind all others, and is not counted
                    s, names = np.where(own, LOW, s), np.where(own, HIGH, names)
                got = (*best(names, s, k), np.minimum(k, s.shape[1] - own.sum(1)))
                held = got if held is None else join_best(held, got, k)
            i, s, n = held
            for r in np.flatnonzero(n):
                for column, value in zip(out, (int(q_rid[q0 + r]), int(q_id[q0 + r]), part, i[r, : n[r]].tolist(), s[r, : n[r]].tolist()), strict=True):
                    column.append(value)
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["rid", "query_id", "part", "ids", "scores"])


def join_best(a, b, k: int):
    (ai, as_, an), (bi, bs, bn) = a, b
    i, s = np.concatenate([ai, bi], 1), np.concatenate([as_, bs], 1)
    void = np.concatenate([np.arange(ai.shape[1])[None] >= an[:, None], np.arange(bi.shape[1])[None] >= bn[:, None]], 1)
    order = np.lexsort((i, ~s, void), axis=1)[:, :k]
    return np.take_along_axis(i, order, 1), np.take_along_axis(s, order, 1), np.minimum(k, an + bn)


def tree_merge(lists: DataFrame, parts: int, k: int) -> DataFrame:
    """One list for each query: lists of FAN parts are merged in a step, until one part is left."""
    left = max(1, parts)
    while True:
        left = -(-left // FAN)
        pairs = F.flatten(F.collect_list(F.arrays_zip("ids", "scores")))  # at most FAN lists of k
        order = F.array_sort(pairs, lambda x, y: F.when(x["scores"] != y["scores"], F.when(x["scores"] > y["scores"], -1).otherwise(1)).when(x["ids"] < y["ids"], -1).when(x["ids"] > y["ids"], 1).otherwise(0))
        merged = lists.withColumn("part", (F.col("part") / FAN).cast("int")).groupBy("rid", "query_id", "part").agg(F.slice(order, 1, k).alias("b"))
        lists = merged.select("rid", "query_id", "part", F.col("b.ids").alias("ids"), F.col("b.scores").alias("scores"))
        if left == 1:
            return lists


def top_k(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k best candidates."""
    spark = vectors.sparkSession
    kept, _ = write_table(quantised(vectors, id_col, vec_col).withColumn("rid", F.monotonically_increasing_id()), "vectors")
    size = lambda df: df.agg(F.sum(16 + 8 * F.size("v").cast("long"))).first()[0] or 0
    queries = kept.where(is_query(F.col("id")))
    shards = max(spark.sparkContext.defaultParallelism, -(-size(kept) // shard_bytes))
    blocks = max(1, -(-size(queries) // block_bytes))
    deal = lambda salt, n: F.pmod(F.xxhash64("rid", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.select("rid", "id", "v", deal(1, blocks).alias("b"), every(shards).alias("s"))
    x = kept.select("rid", "id", "v", deal(2, shards).alias("s"), every(blocks).alias("b"))

    def cell(key, left, right):
        return cell_lists(left, right, key[1].as_py(), k)

    lists = q.groupBy("b", "s").cogroup(x.groupBy("b", "s")).applyInArrow(cell, LISTS)
    found = tree_merge(write_table(lists, "lists")[0], shards, k)
    each = found.select("query_id", F.posexplode(F.arrays_zip("ids", "scores")).alias("r", "p"))
    return each.select("query_id", (F.col("r") + 1).cast("int").alias("rank"), F.col("p.ids").alias("vec_id"), F.col("p.scores").alias("score"))
