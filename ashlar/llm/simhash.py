"""SimHash near-duplicate groups by the generalised pigeonhole principle.

Fingerprints: 64 bits; a bit is set if it is set in over half of the XXH64 values (seed 42) of the
text's word shingles, repeats counted. Texts with equal fingerprints fall together first, so that
the search runs over distinct fingerprints.

Search: bits that go together are grouped into partitions (from the correlations over all
distinct fingerprints). With thresholds t_i whose sum is radius - partitions + 1, two fingerprints
within the radius differ by at most t_i bits in some partition i; t_i = -1 leaves a partition
out. The number of partitions and their unequal thresholds are those with the fewest estimated
candidates, found by dynamic programming. Candidates are probed by partition key and verified on
all bits.

Crowded keys: two fingerprints are within 2r bits exactly if some value lies within r bits of
both. Members of a key with over CROWD fingerprints therefore are not paired; each sends its
values within r = ceil(radius / 2) bits, at which they meet, and members of a meeting point that
are within the radius are linked to its smallest one. For radius 2, all that meet are linked, so
this way is exact and linear; for radius 1, each is linked to its one-bit neighbours. It is only offered for radius 2 or less.

Defined results: a null text has no words, as an empty one; no words give fingerprint zero. Rows
with a null doc_id belong to components as others do and are not counted for the smallest id, which
is null if no member has one. Repeated rows each get a row."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, keyed_join, scratch, write_table

CROWD = 64
BITS = 64


def fingerprint(raw: bytes, width: int) -> int:
    """One text's fingerprint, unsigned; words are runs without white space of ASCII."""
    import xxhash

    digest = xxhash.xxh64_digest
    words = raw.lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[k:] for k in range(width)], strict=False))
    total, n, block = np.zeros(BITS, dtype=np.int64), 0, []

    def add(block):
        bits = np.unpackbits(np.frombuffer(b"".join(block), dtype=np.uint8).reshape(-1, 8), axis=1)
        return bits.sum(axis=0, dtype=np.int64)

    for s in shingles:
        block.append(digest(s, 42))
        if len(block) == 65536:
            total, n, block = total + add(block), n + len(block), []
    if block:
        total, n = total + add(block), n + len(block)
    return int(np.packbits(2 * total > n).view(">u8")[0])


def majority(digests: bytes) -> int:
    """The fingerprint of 64-bit values, unsigned; zero for none."""
    total, step = np.zeros(BITS, dtype=np.int64), 65536 * 8
    for lo in range(0, len(digests), step):
        bits = np.unpackbits(np.frombuffer(digests[lo : lo + step], dtype=np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(digests) // 8).view(">u8")[0])


def fingerprints(docs: DataFrame, text: str, width: int, out: str) -> DataFrame:
    """docs without `text`, with the fingerprint as a (signed) long in column `out`."""
    kept = [c for c in docs.columns if c != text]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(out, T.LongType())])

    def run(batches):
        for batch in batches:
            raw = batch.column(batch.schema.get_field_index(text))
            raw = raw.cast(pa.binary() if pa.types.is_string(raw.type) else pa.large_binary()).to_pylist()
            found = np.array([fingerprint(t or b"", width) for t in raw], dtype=np.uint64).view(np.int64)
            cols = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(found)], names=[*kept, out])

    return docs.select(*kept, text).mapInArrow(run, schema)


def bit_moments(distinct: DataFrame, fp: str) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how often bits i and j are set together, over all of them.

    Each task adds up one 64 x 64 matrix and gives it row by row; Spark sums the rows, and 64 reach the driver."""
    names = [f"m{j}" for j in range(BITS)]

    def run(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            v = np.asarray(batch.column(0)).astype(np.int64)
            for lo in range(0, len(v), 65536):
                part = v[lo : lo + 65536].astype(">i8")
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)[:, ::-1].astype(np.float32)
                total += (bits.T @ bits).astype(np.float64)
                n += len(bits)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS, dtype=np.int32)), pa.array(np.full(BITS, n)), *(pa.array(total[:, j]) for j in range(BITS))], names=["i", "n", *names])

    parts = distinct.select(fp).mapInArrow(run, "i int, n long, " + ", ".join(f"{c} double" for c in names))
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).collect()
    together = np.zeros((BITS, BITS))
    for r in rows:
        together[r["i"]] = r[2:]
    return (rows[0]["n"] if rows else 0), together


def group_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Bits dealt to `parts` partitions of nearly equal size, correlated bits into the same one."""
    p = np.diag(together) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        rest = sorted(free)
        seed = max(rest, key=lambda b: corr[b, rest].sum())
        group = [seed]
        while len(group) < size:
            group.append(max((b for b in rest if b not in group), key=lambda b: (corr[b, group].sum(), -b)))
        groups.append(sorted(group))
        free -= set(group)
    return groups


def allocate(n: int, share: np.ndarray, groups: list[list[int]], same: list[float], radius: int) -> tuple[float, list[int]]:
    """Thresholds of least estimated cost: dynamic programming over partitions and what is left to allot.

    same[i]: pairs that agree on all bits of partition i. From it, pairs that differ by exactly r
    bits there follow as for independent bits."""
    costs = []
    for group, pairs in zip(groups, same, strict=True):
        q = 2 * share[group] * (1 - share[group])
        odds = np.minimum(q / np.maximum(1 - q, 1e-9), 1.0)
        poly = np.zeros(radius + 1)
        poly[0] = 1
        for o in odds:
            poly[1:] += poly[:-1] * o
        probes = np.cumsum([len(list(combinations(range(len(group)), r))) for r in range(radius + 1)])
        costs.append([0.0, *(np.cumsum(poly) * (pairs + 1) + probes * n * 0.2)])
    goal = radius - len(groups) + 1
    best = {0: (0.0, [])}
    for cost in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for total, (c, chosen) in best.items():
            for t in range(-1, radius + 1):
                new = (c + cost[t + 1], [*chosen, t])
                if total + t not in after or new < after[total + t]:
                    after[total + t] = new
        best = after
    return best[goal]


def project(fp, group: list[int]):
    """The bits of a partition, as a masked long."""
    mask = sum(1 << b for b in group)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask))


def flips(bits: list[int], upto: int) -> list[int]:
    """Masks of at most `upto` of these bits, as signed longs."""
    masks = [sum(1 << b for b in some) for r in range(upto + 1) for some in combinations(bits, r)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def links(distinct: DataFrame, radius: int, crowd: int = CROWD) -> tuple[DataFrame, dict]:
    """Pairs (a, b) of distinct fingerprints within the radius that connect all such pairs, and the plan
    that was chosen. distinct: one column fp."""
    if not 0 <= radius <= 2:
        raise ValueError("the radius must be 0, 1 or 2")
    n, together = bit_moments(distinct, "fp")
    share = np.diag(together) / max(n, 1)
    choice = None
    for parts in range(max(2, radius), radius + 3):
        groups = group_bits(n, together, parts)
        keys = distinct.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), project(F.col("fp"), g).alias("k")) for i, g in enumerate(groups)])).alias("x"))
        sizes = keys.groupBy("x.i", "x.k").agg(F.count(F.lit(1)).alias("c"))
        same = {r["i"]: float(r["s"]) for r in sizes.groupBy("i").agg(F.sum(F.col("c").cast("double") * (F.col("c") - 1) / 2).alias("s")).collect()}
        cost, limits = allocate(n, share, groups, [same.get(i, 0.0) for i in range(parts)], radius)
        if choice is None or cost < choice[0]:
            choice = (cost, groups, limits)
    cost, groups, limits = choice
    plan = {"bits": groups, "thresholds": limits, "estimated": cost, "fingerprints": n}
    near, crowded = [], []
    for i, (group, limit) in enumerate(zip(groups, limits, strict=True)):
        if limit < 0:
            continue
        own = distinct.select("fp", project(F.col("fp"), group).alias("k"))
        hot, _ = write_table(own.groupBy("k").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > crowd).select("k", F.lit(True).alias("hot")), "hot-keys")
        own = keyed_join(own, hot, ["k"], "left")
        reach = lambda df: df if limit == 0 else df.select("fp", F.explode(F.array(*[F.col("k").bitwiseXOR(F.lit(m)) for m in flips(group, limit)])).alias("k"))  # noqa: B023, E731
        cold = own.where("hot IS NULL").select("fp", "k")
        crowded.append(own.where("hot").select("fp"))
        if limit:  # those of other keys that a crowded key is within reach of
            crowded.append(keyed_join(reach(cold), hot, ["k"], "left_semi").select("fp"))
        # a crowded key's fingerprints meet their partners in that other way, so they don't probe here: a key has `crowd` rows
        # at most, and probes from as many keys as there are flips
        x, y = cold.select("k", F.col("fp").alias("a")), reach(cold).select("k", F.col("fp").alias("b"))
        both = x.join(y, "k").where(F.col("a") < F.col("b") if limit == 0 else F.col("a") != F.col("b"))
        near.append(both.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b"))
    pairs = near[0]
    for more in near[1:]:
        pairs = pairs.unionByName(more)
    packed = crowded[0]
    for more in crowded[1:]:
        packed = packed.unionByName(more)
    reach = 1 if radius else 0
    meet = packed.distinct().select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(m)) for m in flips(list(range(BITS)), reach)])).alias("z"))
    points = meet.groupBy("z").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("all"))  # at most 65 values of one bit's distance
    met = points.where(F.size("all") > 1).select("a", F.explode("all").alias("b")).where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
    if radius == 1:  # those that meet may be two bits apart; here each is linked to its own neighbours
        met = meet.where("fp <> z").join(distinct.select(F.col("fp").alias("z")), "z").select(F.col("fp").alias("a"), F.col("z").alias("b"))
    return pairs.unionByName(met), plan


def near_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """docs without `text`, with fp (long), component_id (smallest id that is reachable) and group_fp (the
    component's smallest fingerprint, which tells components apart where ids repeat)."""
    with scratch(docs.sparkSession):
        marked, _ = write_table(fingerprints(docs, text, width, "__fp"), "fingerprints")
        distinct, _ = write_table(marked.groupBy("__fp").agg(F.min(id_col).alias("low")).select(F.col("__fp").alias("fp"), "low"), "distinct")
        pairs, _ = links(distinct.select("fp"), radius)
        labels = components(pairs, "a", "b")
        of, _ = write_table(distinct.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("label", "fp").alias("label")), "labelled")
        ids, _ = write_table(of.groupBy("label").agg(F.min("low").alias("component_id")), "ids")
        by_fp, _ = write_table(keyed_join(of.select("fp", "label"), ids, ["label"]).select(F.col("fp").alias("__fp"), "component_id", F.col("label").alias("group_fp")), "by-fingerprint")
        found = keyed_join(marked.drop("component_id", "fp", "group_fp"), by_fp, ["__fp"]).withColumnRenamed("__fp", "fp")
        return write_table(found, "groups", keep=True)[0]


def numbered_rows(docs: DataFrame, id_col: str) -> DataFrame:
    """Each row as one struct (doc), with its id and two hashes of all its columns, by which keep_first tells rows apart."""
    return docs.select(F.struct(*docs.columns).alias("doc"), F.col(id_col).alias("id"), F.xxhash64(*docs.columns).alias("h1"), F.xxhash64(F.lit("again"), *docs.columns).alias("h2"))


def keep_first(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """One row of each group. rows: from numbered_rows; seen: id, h1, h2 and group_fp of each."""
    first = seen.groupBy("group_fp").agg(F.min(F.struct("id", "h1", "h2")).alias("w")).select("w.h1", "w.h2")
    copies = seen.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).join(first.withColumn("won", F.lit(True)), ["h1", "h2"], "left")
    special, _ = write_table(copies.where("won IS NULL OR n > 1"), "special", keep=True)
    gone, twice = special.select("h1", "h2"), special.where("won AND n > 1").select("h1", "h2")
    once = keyed_join(rows, gone, ["h1", "h2"], "left_anti").select("doc.*")
    return once.unionByName(keyed_join(rows, twice, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"]).select("doc.*"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """One document of each group: the one with the smallest id (null is the smallest); of rows that share it,
    the first by content. Ids of any type that sorts; the columns pass through whatever their names are."""
    rows = numbered_rows(docs, id_col)
    texts = rows.select("id", "h1", "h2", F.col("doc").getField(text).alias("t"))
    return keep_first(rows, near_groups(texts, "id", "t", width, radius))  # both leave narrow tables only
