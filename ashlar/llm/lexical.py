"""Ranked lexical search over norm buckets of impact vectors, exact in integers.

A document is a sparse vector of impacts: for each term that some query has, the term's weight times the
document's saturated frequency. A query is a vector of term counts, and a score is their inner product. Vectors are dealt
out by length, the longest first, over range partitions and, inside each, buckets of BUCKET vectors. A query has a threshold,
the least score of its k best so far: a first pass over the longest bucket of every partition gives it, and it grows from bucket to bucket.

- A bucket whose longest vector can't reach the threshold (Cauchy-Schwarz: |query| * |longest| is less) is not opened for the query.
- Inside a bucket the query's coordinates are split into a head and a tail. A vector that has no coordinate in the head can reach
  |tail of the query| * |longest| at most, so that only the lists of head coordinates are read where this is less than the threshold. Of
  what they hold, a vector stays if its head product and the Cauchy-Schwarz bound of the rest of it reach the threshold.
- What is left is scored anew with all its coordinates, in 64-bit integers. Bounds are floats, rounded up by SLACK.

Queries go in blocks of bounded size: a block's terms and vectors are sent to all tasks, and the documents are read
once for each block. No statistic is sampled: counts of documents and terms are of all rows.

Defined results: a null or wordless text has no term, is not counted and is never found; a null or wordless query has no rows;
repeated query rows each get their own list; repeated documents are ranked each, ties by id, null ids last; texts of any
length are read whole; empty tables give no rows. Other columns of the inputs play no part."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, release, write_table

#: Bytes of terms; A-Z are lower-cased, all others part terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
TOP = 20
#: Vectors in a bucket; words of the queries of one block, at most, or of one row more; relative excess of bounds over their floats.
BUCKET, BLOCK_TERMS, SLACK = 1024, 400_000, 1e-9


def blocks_of(items: DataFrame, item_id: str, text: str, block_terms: int = BLOCK_TERMS) -> list[DataFrame]:
    """Tables of (row, item_id, text), each with about block_terms words at most or one single row more."""
    rows = items.select(F.col(item_id).alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows, _ = write_table(rows.withColumn("id", F.monotonically_increasing_id()), "queries")
    size = F.floor(F.length("text") / 2 + 1)  # a text has no more words than that
    total = rows.agg(F.sum(size)).first()[0] or 0
    n = max(1, -(-total // block_terms))
    rows, _ = write_table(numbered(rows.withColumn("__bucket", F.pmod(F.xxhash64("id"), F.lit(256))), [], [F.col("id")], "row"), "queries")
    return [rows.where(F.pmod("row", F.lit(n)) == i).select("row", "item_id", "text") for i in range(n)]


def frequencies(docs: DataFrame, doc_id: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, t, tf) of every document with a term: its number of terms, and counts of those in the vocabulary."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("raw")).where(F.length("raw") > 0)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        number = sent.value.get
        for batch in batches:
            keep, n, starts, t, tf = [], [], [0], [], []
            for i, raw in enumerate(batch.column(1)):
                words = raw.as_py().translate(TERM_BYTES).split()
                if words:
                    counts = Counter(map(number, words))
                    counts.pop(None, 0)
                    keep.append(i)
                    n.append(len(words))
                    t.extend(counts)
                    tf.extend(counts.values())
                    starts.append(len(t))
            lists = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(x, pa.int64())) for x in (t, tf)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "t", "tf"])

    return rows.mapInArrow(run, f"doc_id {kind}, n long, t array<long>, tf array<long>")


def impacts(n: np.ndarray, tf: np.ndarray, weight: np.ndarray, docs: int, words: int) -> np.ndarray:
    """Weight times saturated frequency, in 64-bit integers; n and tf: of each entry's document and term."""
    m = 75 + (25 * n * docs) // words
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def vectors(found: DataFrame, weights: list[int], docs: int, words: int) -> DataFrame:
    """(doc_id, length, t, p): impact vectors of those rows that have any."""
    kind, w = found.schema["doc_id"].dataType.simpleString(), np.array(weights, np.int64)

    def run(batches):
        for batch in batches:
            t, tf = batch.column(2).flatten(), batch.column(3).flatten().to_numpy()
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            p = impacts(np.repeat(batch.column(1).to_numpy(), sizes), tf, w[t.to_numpy()], docs, words)
            ends = np.concatenate([[0], np.cumsum(p.astype(np.float64) ** 2)])
            marks = np.concatenate([[0], np.cumsum(sizes)])
            length = np.sqrt(np.add.reduceat(np.append(p.astype(np.float64) ** 2, 0.0), marks[:-1]) * (sizes > 0)) if len(sizes) else ends[:0]
            lists = pa.ListArray.from_arrays(pa.array(marks, pa.int32()), pa.array(p))
            ts = pa.ListArray.from_arrays(pa.array(marks, pa.int32()), t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(length), ts, lists], names=["doc_id", "length", "t", "p"])

    return found.where("size(t) > 0").mapInArrow(run, f"doc_id {kind}, length double, t array<long>, p array<long>").where("length > 0")


class Bucket:
    """Vectors by falling length, and the list of each coordinate."""

    def __init__(self, length: np.ndarray, sizes: np.ndarray, t: np.ndarray, p: np.ndarray):
        self.size = len(length)
        rows = np.repeat(np.arange(self.size), sizes)
        order = np.argsort(t, kind="stable")
        self.rows, self.p = rows[order], p[order]
        self.terms, starts = np.unique(t[order], return_index=True)
        self.ends = np.append(starts, len(t))
        self.squares = length**2

    def lists(self, terms: np.ndarray):
        """Where the lists of those terms begin and end; empty ones for terms that no vector has."""
        spot = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        has = self.terms[spot] == terms
        return np.where(has, self.ends[spot], 0), np.where(has, self.ends[spot + 1], 0)

    def search(self, query: tuple[np.ndarray, np.ndarray], least: float, head: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows with a score of `least` or more (above 0), and their exact scores. head: how many coordinates are looked up first."""
        terms, counts = query
        lo, hi = self.lists(terms)
        first = [(a, b, c) for a, b, c in zip(lo[:head], hi[:head], counts[:head], strict=True) if b > a]
        if not first:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.concatenate([self.rows[a:b] for a, b, _ in first])
        got = np.concatenate([self.p[a:b] * c for a, b, c in first])
        if head < len(terms):  # Cauchy-Schwarz on what the head has not seen of the vector
            part = np.bincount(at, got, self.size)
            seen = np.bincount(at, np.concatenate([self.p[a:b].astype(np.float64) ** 2 for a, b, _ in first]), self.size)
            tail = math.sqrt(float((counts[head:].astype(np.float64) ** 2).sum()))
            most = part + tail * np.sqrt(np.maximum(self.squares * (1 + SLACK) - seen, 0))
            stay = np.flatnonzero((most * (1 + SLACK) >= least) & (part > 0))
        else:
            stay = np.unique(at)
        if not len(stay):
            return stay, stay
        place = np.full(self.size, -1)
        place[stay] = np.arange(len(stay))
        exact = np.zeros(len(stay), np.int64)
        for a, b, c in zip(lo, hi, counts, strict=True):  # a vector has each coordinate once
            spots = place[self.rows[a:b]]
            exact[spots[spots >= 0]] += self.p[a:b][spots >= 0] * c
        good = (exact > 0) & (exact >= least)
        return stay[good], exact[good]


def packed(index: DataFrame, bucket: int) -> DataFrame:
    """One row for each norm bucket: vectors dealt out by length in range partitions, and cut into buckets in order."""
    kind = index.schema["doc_id"].dataType.simpleString()
    keys = [F.desc("length"), F.asc("id")]
    ranged = index.withColumn("id", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "length", "t", "p")

    def run(batches):
        first, held, rows = True, [], 0
        for batch in batches:
            while batch.num_rows:
                take = batch.slice(0, bucket - rows)
                held.append(take)
                rows += take.num_rows
                batch = batch.slice(take.num_rows)
                if rows == bucket:
                    yield row(held, rows, first)
                    first, held, rows = False, [], 0
        if rows:
            yield row(held, rows, first)

    def row(held, rows, first):
        whole = pa.Table.from_batches(held).combine_chunks()
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        ids, length = (whole.column(c).combine_chunks() for c in ("doc_id", "length"))
        t, p = (pa.concat_arrays([c.flatten() for c in whole.column(name).chunks]) for name in ("t", "p"))
        sizes = pa.array(np.concatenate([np.diff(c.offsets.to_numpy()) for c in whole.column("t").chunks]), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([length[0].as_py()]), pa.array([first]), *map(one, (ids, length, sizes, t.cast(pa.int32()), p))], names=["longest", "first", "ids", "lengths", "sizes", "t", "p"])

    return ranged.mapInArrow(run, f"longest double, first boolean, ids array<{kind}>, lengths array<double>, sizes array<int>, t array<int>, p array<long>")


def search_buckets(buckets: DataFrame, sent, floors: list[float], k: int) -> DataFrame:
    """(row, doc_id, score): of every task the k best of each query that reach its floor."""
    kind = buckets.schema["ids"].dataType.elementType.simpleString()

    def run(batches):
        rows, queries = sent.value
        lengths = [math.sqrt(float((c.astype(np.float64) ** 2).sum())) for _, c in queries]
        tails = [np.sqrt(np.cumsum((c.astype(np.float64) ** 2)[::-1])[::-1]) for _, c in queries]  # length of the coordinates from each on
        best: list[list] = [[] for _ in queries]
        least, id_type = list(floors), None
        for batch in batches:
            id_type = batch.column(2).type.value_type
            for i in range(batch.num_rows):
                longest = batch.column(0)[i].as_py() * (1 + SLACK)
                alive = [q for q, x in enumerate(lengths) if x * longest >= least[q]]
                if not alive:
                    continue
                ids, length, sizes, t, p = (batch.column(c)[i].values for c in range(2, 7))
                b = Bucket(length.to_numpy(), sizes.to_numpy(), t.to_numpy(), p.to_numpy())
                for q in alive:
                    enough = np.flatnonzero(tails[q] * longest < least[q])
                    found, scores = b.search(queries[q], least[q], int(enough[0]) if len(enough) else len(tails[q]))
                    if len(scores) > k:  # ties with the k-th stay
                        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                        found, scores = found[keep], scores[keep]
                    if len(scores):
                        new = zip(scores.tolist(), ids.take(pa.array(found)).to_pylist(), strict=True)
                        best[q] = sorted([*best[q], *new], key=lambda x: (-x[0], x[1] is None, 0 if x[1] is None else x[1]))[:k]
                        if len(best[q]) == k:
                            least[q] = max(least[q], float(best[q][-1][0]))
        out = [(rows[q], doc, score) for q, found in enumerate(best) for score, doc in found]
        if out:
            row, doc, score = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(doc, id_type), pa.array(score, pa.int64())], names=["row", "doc_id", "score"])

    return buckets.mapInArrow(run, f"row long, doc_id {kind}, score long")


def top(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of every query with their rank; partitions drop all but their own k best before the shuffle."""
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", k: int = TOP, bucket: int = BUCKET, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents with a score above 0 of each row of items."""
    spark, parts = docs.sparkSession, []
    for block in blocks_of(items, item_id, item_text, block_terms):
        asked = [(r["row"], Counter(r["text"].encode().translate(TERM_BYTES).split())) for r in block.orderBy("row").collect()]  # of bounded size
        asked = [(row, counts) for row, counts in asked if counts]
        words = sorted({w for _, counts in asked for w in counts})
        number = {w: i for i, w in enumerate(words)}
        found, found_path = write_table(frequencies(docs, doc_id, doc_text, number), "frequencies")
        n_docs, n_words = found.agg(F.count(F.lit(1)), F.sum("n")).first()
        df = dict(found.select(F.explode("t").alias("t")).groupBy("t").agg(F.count(F.lit(1))).collect())  # as many as the block has
        weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) if n_docs else 0 for i in range(len(words))]

        def as_query(counts: Counter) -> tuple[np.ndarray, np.ndarray]:
            """Coordinates by falling count, then by falling weight, so that the head has those that decide."""
            pairs = sorted(((number[w], c) for w, c in counts.items()), key=lambda x: (-x[1], -weights[x[0]]))
            return np.array([t for t, _ in pairs]), np.array([c for _, c in pairs])

        buckets, buckets_path = write_table(packed(vectors(found, weights, n_docs, n_words or 1), bucket), "buckets")
        rows = [row for row, _ in asked]
        sent = spark.sparkContext.broadcast((rows, [as_query(counts) for _, counts in asked]))
        # thresholds: each query's k-th best of the longest buckets; any k documents give a valid one
        first = top(search_buckets(buckets.where("first"), sent, [1.0] * len(rows), k), k).groupBy("row").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n"))
        floors = {r["row"]: float(r["low"]) for r in first.where(F.col("n") == k).collect()}  # one number for each query of the block
        best, _ = write_table(top(search_buckets(buckets, sent, [floors.get(r, 1.0) for r in rows], k), k), "best")
        parts.append(best.join(F.broadcast(block.select("row", "item_id")), "row").select("item_id", "rank", "doc_id", "score"))
        release(spark, found_path, buckets_path)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
