"""Groups of texts whose sets of word shingles have a Jaccard similarity of 0.8 or more, exact.

Texts with equal sets fall together first. Sets are held as sorted 64-bit XXH64 values of the shingles.

Fingerprints: every text has a SimHash of its shingles, and fingerprints within RADIUS bits are found by the generalised
pigeonhole principle (simhash.links). Texts that it brings together and whose sets are within 0.8 are linked.
A similarity of 0.8 often leaves more bits different, so what fingerprints hold apart is then searched exactly.

Candidates: two sets within 0.8 share at least 0.8 of the larger one. Of n values, the smallest
n - ceil(0.8 n) + s then hold at least s of the shared ones in both sets (prefix filter with s = n / 20 + 1). A set with
fewer values there that any other set's prefix has is within 0.8 of none. Only for the others, whole sets are written.
Their values are put in the order of how many sets have them, rarest first; the first n - ceil(0.8 n) + 1 then hold
one shared value in both sets, and values that many unlike texts have (common lines) come last.

Blocks: sets that are connected by values of these prefixes. A block is compared in one task, as a product of
its sets and values; a larger one is cut into tiles by sizes (within a factor of 1.26, so that those within 5 / 4 are neighbours) and by hash, and tiles of the same or of
neighbouring sizes meet pair by pair. A task gives no more links than connect its sets, and tiles whose sets are all
in one group already are passed over. So each set goes to as many tasks as its block has tiles of such sizes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, keyed_join, release, scratch, write_table
from .simhash import keep_first, majority, numbered_rows
from .simhash import links as fingerprint_links

CROWD = 64
#: Bits in which fingerprints may differ.
RADIUS = 2
#: Values in the sets of a tile, on average.
TILE_VALUES = 500_000
#: Columns of a product at a time.
COLUMNS = 4096


def shingle_digests(raw: bytes, width: int) -> bytes:
    """XXH64 values of one text's shingles, repeats included; words are runs without white space of ASCII."""
    import xxhash

    words = raw.lower().split()
    if not words:
        return b""
    some = [b" ".join(words)] if len(words) < width else map(b" ".join, zip(*[words[k:] for k in range(width)], strict=False))
    digest = xxhash.xxh64_digest
    return b"".join([digest(s, 42) for s in some])


def shingle_sets(docs: DataFrame, text: str, width: int, whole: bool) -> DataFrame:
    """docs without `text`, with how many values the text's set has (n), the set's own value (sid) and values (h): all
    of them, or else those of the prefix, with the fingerprint (fp)."""
    import xxhash

    kept = [c for c in docs.columns if c != text]
    fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in kept)

    def run(batches):
        for batch in batches:
            raw = batch.column(batch.schema.get_field_index(text))
            raw = raw.cast(pa.binary() if pa.types.is_string(raw.type) else pa.large_binary())
            for lo in range(0, len(raw), 1000):
                fps, ids, ns, sets = [], [], [], []
                for t in raw.slice(lo, 1000):
                    values = shingle_digests(t.as_py() or b"", width)
                    own = np.unique(np.frombuffer(values, dtype=">i8").astype(np.int64))
                    n = len(own)
                    fps.append(0 if whole else majority(values))
                    ids.append(xxhash.xxh64_intdigest(own.tobytes(), 42))
                    ns.append(n)
                    sets.append(own if whole else own[: min(n, n - (4 * n + 4) // 5 + n // 20 + 1)].copy())
                ends = np.cumsum([0, *(len(s) for s in sets)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))
                fps, ids = (pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (fps, ids))
                cols = [batch.column(batch.schema.get_field_index(c)).slice(lo, 1000) for c in kept]
                yield pa.RecordBatch.from_arrays([*cols, ids, pa.array(ns, pa.int64()), fps, lists], names=[*kept, "sid", "n", "fp", "h"])

    found = docs.select(*kept, text).mapInArrow(run, fields + "sid long, n long, fp long, h array<long>")
    return found.drop("fp") if whole else found


def may_have_partners(sets: DataFrame) -> DataFrame:
    """sid of the sets that have, among the values of their prefixes (h), as many that other prefixes have as a set within 0.8 has. sets: sid (distinct), n, h."""
    every = sets.where("n > 0").select("sid", "n", F.explode("h").alias("k"))
    shared, _ = write_table(every.groupBy("k").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("k"), "shared")
    release(sets.sparkSession)
    need = F.least(F.floor(F.col("n") / 20) + 1, F.ceil(F.col("n") * 4 / 5))
    alive, _ = write_table(keyed_join(every, shared, ["k"], "left_semi").groupBy("sid").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n")).where(F.col("c") >= need).select("sid"), "alive")
    release(sets.sparkSession)
    return alive


def rare_values(sets: DataFrame) -> DataFrame:
    """(sid, k): the values of each set that another set has, of the rarest n - ceil(0.8 n) + 1. sets: sid (distinct), n, h (all values)."""
    every = sets.select("sid", "n", F.explode("h").alias("k"))
    counts, _ = write_table(every.groupBy("k").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "counts")
    release(sets.sparkSession)
    lists = keyed_join(every, counts, ["k"]).groupBy("sid").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("c", "k"))).alias("x"))  # values of one set
    due = F.col("n") - F.ceil(F.col("n") * 4 / 5) + 1 - (F.col("n") - F.size("x"))  # after those that no other set has
    kept, _ = write_table(lists.where(due > 0).select("sid", F.explode(F.slice("x", 1, due.cast("int"))).alias("y")).select("sid", "y.k"), "rare")
    release(sets.sparkSession)
    return kept


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have a similarity of 0.8 or more, written."""
    pairs, _ = write_table(pairs, "candidates")
    used, _ = write_table(pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct(), "used")
    held, path = write_table(keyed_join(sets, used, ["sid"], "left_semi").select("sid", "n", "h"), "compared")
    a, b = (held.select(F.col("sid").alias(c), F.col("n").alias(f"n{c}"), F.col("h").alias(f"h{c}")) for c in "ab")
    both = pairs.join(a, "a").join(b, "b")
    found, _ = write_table(both.where(9 * F.size(F.array_intersect("ha", "hb")) >= 4 * (F.col("na") + F.col("nb"))).select("a", "b"), "links")
    release(sets.sparkSession, path)
    return found


def near_fingerprints(marked: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) of the sets whose fingerprints are equal or near, each verified. marked: sid and fp; sets: those that can have a partner."""
    of, _ = write_table(marked.groupBy("sid").agg(F.min("fp").alias("fp")), "fingerprints")  # repeats differ, so that equal sets may differ here
    heads, _ = write_table(of.groupBy("fp").agg(F.min("sid").alias("head")), "heads")
    near, _ = fingerprint_links(heads.select("fp"), RADIUS)
    near, _ = write_table(near.distinct(), "near")
    same = keyed_join(of, heads, ["fp"]).select(F.col("sid").alias("a"), F.col("head").alias("b"))
    named, _ = write_table(keyed_join(near, heads.select(F.col("fp").alias("a"), F.col("head").alias("x")), ["a"]).select("b", "x"), "named")
    apart = keyed_join(named, heads.select(F.col("fp").alias("b"), F.col("head").alias("y")), ["b"]).select(F.col("x").alias("a"), F.col("y").alias("b"))
    pairs, _ = write_table(same.unionByName(apart).where("a <> b"), "met")
    alive = sets.select("sid")
    pairs, _ = write_table(keyed_join(pairs, alive.select(F.col("sid").alias("a")), ["a"], "left_semi"), "met")
    pairs = keyed_join(pairs, alive.select(F.col("sid").alias("b")), ["b"], "left_semi")
    return compared(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), sets)


def connecting(group: pa.Table) -> pa.Table:
    """Links (a, b) that connect what the links of one task's sets connect, without those inside a label."""
    n, labels, sids = (group.column(c).to_numpy() for c in ("n", "label", "sid"))
    none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    if (labels == labels[0]).all():
        return none
    lists = group.column("h").combine_chunks()
    _, value, times = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(n)), n)
    often = times[value] > 1
    _, value = np.unique(value[often], return_inverse=True)
    order = np.argsort(value, kind="stable")
    row, value = row[often][order], value[order]
    common = np.zeros((len(n), len(n)), dtype=np.float32)  # exact for sets of up to 2 ** 24 values
    for lo in range(0, int(value[-1]) + 1 if len(value) else 0, COLUMNS):
        some = slice(*np.searchsorted(value, [lo, lo + COLUMNS]))
        has = np.zeros((len(n), COLUMNS), dtype=np.float32)
        has[row[some], value[some] - lo] = 1
        common += has @ has.T
    linked = (9 * common.astype(np.float64) >= 4 * (n[:, None] + n[None, :])) | (labels[:, None] == labels[None, :])
    free, a, b = np.ones(len(n), dtype=bool), [], []
    for first in range(len(n)):
        front, free[first] = [first] if free[first] else [], False
        while front:
            at = front.pop()
            new = np.flatnonzero(linked[at] & free)
            free[new] = False
            front.extend(new)
            out = new[labels[new] != labels[at]]
            a.append(np.minimum(sids[at], sids[out]))
            b.append(np.maximum(sids[at], sids[out]))
    return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)}) if a else none


def block_links(sets: DataFrame, rare: DataFrame, linked: DataFrame, crowd: int) -> DataFrame:
    """Links (a, b) that connect, with `linked`, all pairs of sets within 0.8. rare: of rare_values(sets)."""
    heads, _ = write_table(rare.groupBy("k").agg(F.min("sid").alias("head"), F.count(F.lit(1)).alias("c")).where("c > 1").select("k", "head"), "heads")
    edges, _ = write_table(keyed_join(rare, heads, ["k"]).where("sid <> head").select("sid", "head").distinct(), "block-edges")
    block, _ = write_table(components(edges, "sid", "head").select(F.col("node").alias("sid"), F.col("label").alias("block")), "blocks")
    block = block.unionByName(block.select(F.col("block").alias("sid"), "block").distinct()).distinct()  # the smallest node too
    label = components(linked, "a", "b").select(F.col("node").alias("sid"), "label")
    member, _ = write_table(keyed_join(sets.select("sid", "n"), write_table(block, "blocks")[0], ["sid"]), "members")
    member, _ = write_table(keyed_join(member, write_table(label, "known")[0], ["sid"], "left").withColumn("label", F.coalesce("label", "sid")), "members")
    most = 8 * crowd
    size = member.groupBy("block").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("v"), F.count_distinct("label").alias("l")).where("l > 1").select("block", (F.col("c") > most) | (F.col("v") > TILE_VALUES))
    size, _ = write_table(size.toDF("block", "large"), "sizes")
    member, _ = write_table(keyed_join(member, size, ["block"]).withColumn("s", F.when(F.col("large"), F.floor(F.log(1.26, "n"))).otherwise(0)), "members")
    counts = member.groupBy("block", "s").agg(F.greatest(F.ceil(F.count(F.lit(1)) / most), F.ceil(F.sum("n") / TILE_VALUES)).alias("parts"), F.first("large").alias("large"))
    counts = counts.select("block", "s", F.when(F.col("large"), F.col("parts")).otherwise(1).alias("parts"))
    parts, _ = write_table(counts, "parts")
    near = parts.select("block", F.col("s"), "parts", F.lit(0).alias("d")).unionByName(parts.select("block", F.col("s") - 1, "parts", F.lit(1)).toDF("block", "s", "parts", "d")).unionByName(parts.select("block", F.col("s") + 1, "parts", F.lit(-1)).toDF("block", "s", "parts", "d"))
    near = near.groupBy("block", "s").agg(*[F.coalesce(F.max(F.when(F.col("d") == d, F.col("parts"))), F.lit(0)).alias(c) for d, c in ((0, "own"), (1, "after"), (-1, "before"))])
    near, _ = write_table(near.where("own > 0").withColumn("bs", F.xxhash64("block", "s")), "near-sizes")
    member = keyed_join(member.withColumn("bs", F.xxhash64("block", "s")), near.select("bs", F.col("block").alias("nb"), F.col("s").alias("ns"), "own", "after", "before"), ["bs"]).where("block = nb AND s = ns")
    member = member.withColumn("i", F.pmod(F.xxhash64("sid"), F.col("own")))
    meet = """concat(transform(sequence(0L, own - 1), j -> struct(s AS s1, least(i, j) AS i1, s AS s2, greatest(i, j) AS i2)),
        transform(if(after > 0, sequence(0L, after - 1), array()), j -> struct(s AS s1, i AS i1, s + 1 AS s2, j AS i2)),
        transform(if(before > 0, sequence(0L, before - 1), array()), j -> struct(s - 1 AS s1, j AS i1, s AS s2, i AS i2)))"""
    tasks, _ = write_table(member.select("sid", "block", "label", F.explode(F.expr(meet)).alias("t")), "tasks")
    dealt = sets.join(tasks, "sid").select("sid", "n", "label", "h", "block", "t.*")
    found = dealt.groupBy("block", "s1", "i1", "s2", "i2").applyInArrow(connecting, "a long, b long")
    return write_table(found, "block-links")[0]


def similar_groups(docs: DataFrame, text: str, width: int = 5, crowd: int = CROWD) -> DataFrame:
    """docs without `text`, with group_fp: the smallest set value that is reachable. A block of over 8 * crowd sets goes in tiles."""
    with scratch(docs.sparkSession):
        texts = docs.withColumn("__th", F.xxhash64(text))
        marked, _ = write_table(shingle_sets(texts.withColumn("__rid", F.monotonically_increasing_id()), text, width, False), "shingles")
        first, _ = write_table(marked.groupBy("sid").agg(F.min("__rid").alias("__first")), "first")
        again, _ = write_table(keyed_join(marked.select("sid", "__rid"), first, ["sid"]).where("__rid <> __first").select("__rid"), "again")
        once = keyed_join(marked, again, ["__rid"], "left_anti")
        alive = may_have_partners(once.select("sid", "n", "h"))
        wanted, _ = write_table(keyed_join(marked.select("sid", "__rid", "__th"), alive, ["sid"], "left_semi").select("__th").distinct(), "wanted")
        again_read = keyed_join(texts.select("__th", text), wanted, ["__th"], "left_semi").select(text)
        sets, _ = write_table(shingle_sets(again_read, text, width, True).dropDuplicates(["sid"]), "sets")
        linked = near_fingerprints(marked.select("sid", "fp"), sets)
        linked = linked.unionByName(block_links(sets, rare_values(sets), linked, crowd))
        labels, _ = write_table(components(linked, "a", "b").select(F.col("node").alias("sid"), "label"), "labels")
        found = keyed_join(marked.drop("h", "n", "fp", "__rid", "__th"), labels, ["sid"], "left").withColumn("group_fp", F.coalesce("label", "sid")).drop("sid", "label")
        return write_table(found, "groups", keep=True)[0]


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5, crowd: int = CROWD) -> DataFrame:
    """One document of each group: the one with the smallest id (null is the smallest); of rows that share it,
    the first by content. Ids of any type that sorts; the columns pass through whatever their names are."""
    rows = numbered_rows(docs, id_col)
    texts = rows.select("id", "h1", "h2", F.col("doc").getField(text).alias("t"))
    return keep_first(rows, similar_groups(texts, "t", width, crowd))
