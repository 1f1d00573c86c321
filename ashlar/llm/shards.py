"""Sharding by balanced label propagation, in DataFrame functions only.

Documents that share a link key (for the query: equal texts) hang on one hub. Linked documents
start in shards by hash; in each round the hubs count their members by shard, members are asked to
move to the shard where most of their hub's members are among those with room, and requests are
granted hub by hub, as far as the target's quota goes. Documents without links then fill the gaps, so
that counts differ by one at most, whatever the links are.

Ranks (for quotas and for the gapless slots) come from per-bucket numbering plus bucket offsets, so
no task holds a whole shard; hubs are handled as counts by (hub, shard), and rows of a large hub get
their hub's data by a broadcast of a bounded number of rows (keyed_join), so no task holds a hub.

cut_edges() gives what is minimised: the pairs of linked documents that stand in different shards.

Defined results: a null text has no bytes and size 1, crc32 0, and counts as equal to the empty text;
repeated rows and null ids get slots of their own; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_table, keyed_join, numbered, write_table

SHARDS, ROUNDS, BUCKETS = 8, 4, 256


def bucket(*columns) -> F.Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).cast("int")


def quotas(n: int, shards: int) -> list[int]:
    return [n // shards + (s < n % shards) for s in range(shards)]


def by_shard(values: list[int], shard):
    """The value of a shard, of which there are few."""
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), shard + 1)


def loads(df: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["n"] for r in df.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def propagate(linked: DataFrame, quota: list[int], rounds: int = ROUNDS) -> DataFrame:
    """(rid, hub, shard) after the rounds. linked: (rid, hub), hubs of two members or more."""
    shards, spark = len(quota), linked.sparkSession
    now, path = write_table(linked.select("rid", "hub", F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int").alias("shard")), "labels")
    for _ in range(rounds):
        pairs, pairs_path = write_table(now.groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("n")), "hubs")
        room = [q - used for q, used in zip(quota, loads(pairs, shards), strict=True)]
        open_to = by_shard([max(r, 0) for r in room], F.col("shard"))
        best = pairs.where(open_to > 0).groupBy("hub").agg(F.max(F.struct("n", (-F.col("shard")).alias("back"))).alias("t"))
        best = best.select("hub", (-F.col("t.back")).alias("target"), F.col("t.n").alias("most"))
        asks = pairs.join(best, "hub").where((F.col("shard") != F.col("target")) & ((F.col("n") < F.col("most")) | ((F.col("n") == F.col("most")) & (F.col("shard") > F.col("target")))))
        asks = asks.select("hub", "shard", "target", "n", bucket("hub", "shard").alias("b"))
        sums = asks.groupBy("target", "b").agg(F.sum("n").alias("n"))
        before = sums.select("target", "b", F.coalesce(F.sum("n").over(Window.partitionBy("target").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shift"))
        inside = Window.partitionBy("target", "b").orderBy("hub", "shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = asks.withColumn("upto", F.sum("n").over(inside)).join(F.broadcast(before), ["target", "b"])  # targets x buckets rows
        free = by_shard([max(r, 0) for r in room], F.col("target")) - F.col("shift") - F.col("upto") + F.col("n")
        moves, moves_path = write_table(placed.select("hub", "shard", "target", (F.least(free, F.col("n")) / F.col("n")).alias("part")).where("part > 0"), "moves")
        if moves.isEmpty():
            break
        chance = F.pmod(F.xxhash64("rid", F.lit(1)), F.lit(1_000_000)) / 1_000_000
        after, after_path = write_table(
            keyed_join(now, moves, ["hub", "shard"], "left").select("rid", "hub", F.when(chance < F.col("part"), F.col("target")).otherwise(F.col("shard")).alias("shard")), "labels"
        )
        for old in (path, pairs_path, moves_path):
            drop_table(spark, old)
        now, path = after, after_path
    return now


def assign(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(rid, shard, slot) for rows (rid, hub): counts differ by one at most, slots are gapless from 0."""
    n = rows.count()
    quota = quotas(n, shards)
    hubs, _ = write_table(rows.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hub", F.lit(True).alias("many")), "many")
    marked, _ = write_table(keyed_join(rows.select("rid", "hub"), hubs, ["hub"], "left"), "marked")
    linked = marked.where("many").select("rid", "hub")
    alone = marked.where("many IS NULL").select("rid")
    placed = numbered(propagate(linked, quota, rounds).withColumn("__bucket", bucket("rid")), ["shard"], [F.col("rid")], "slot", BUCKETS)
    placed, _ = write_table(placed.select("rid", "shard", "slot"), "placed")
    kept = placed.where(F.col("slot") < by_shard(quota, F.col("shard")))
    have = loads(kept.withColumn("n", F.lit(1)), shards)
    rest = alone.unionByName(placed.where(F.col("slot") >= by_shard(quota, F.col("shard"))).select("rid"))
    filled = numbered(rest.withColumn("__bucket", bucket("rid")), [], [F.col("rid")], "i", BUCKETS)
    shard, slot, begin = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for s in range(shards):
        end = begin + quota[s] - have[s]
        here = (F.col("i") >= begin) & (F.col("i") < end)
        shard = F.when(here, F.lit(s)).otherwise(shard)
        slot = F.when(here, F.col("i") - begin + have[s]).otherwise(slot)
        begin = end
    return kept.unionByName(filled.select("rid", shard.alias("shard"), slot.alias("slot")))


def shard_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, hub, shard, slot) for every row; texts are read once and not shuffled."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    base, _ = write_table(
        docs.select(F.monotonically_increasing_id().alias("rid"), F.col(doc_id).alias("doc_id"), (F.octet_length(raw) + F.lit(1)).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.md5(raw).alias("hub")), "base"
    )
    return base.join(assign(base.select("rid", "hub"), shards), "rid").select("doc_id", "size", "text_crc32", "hub", "shard", "slot")


def cut_edges(placed: DataFrame, hub: str = "hub", shard: str = "shard") -> DataFrame:
    """One row (links, cut): how many pairs of rows share a hub, and how many of them stand in different shards.

    Counted from the sizes by hub and shard; no pair is made."""
    by = placed.groupBy(hub, shard).agg(F.count(F.lit(1)).cast("decimal(20,0)").alias("n"))
    pairs = lambda n: n * (n - 1) / 2
    each = by.groupBy(hub).agg(F.sum("n").alias("n"), F.sum(pairs(F.col("n"))).alias("inside"))
    total = each.agg(F.sum(pairs(F.col("n").cast("decimal(20,0)"))).alias("links"), F.sum("inside").alias("inside"))
    zero = F.lit(0).cast("decimal(38,0)")
    return total.select(F.coalesce(F.col("links").cast("decimal(38,0)"), zero).alias("links"), F.coalesce((F.col("links") - F.col("inside")).cast("decimal(38,0)"), zero).alias("cut"))
