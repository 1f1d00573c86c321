"""Joins of points with ranges and with starts, and running counts, none of which needs a small side or a task for a whole group.

A range is cut into aligned blocks of sizes 1, 8, 64, ..., of which it needs 14 a size at most; a point lies in one block of each size.
So a point meets a range at just one block, by an equi-join. Points that repeat are resolved once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import ranged, small, written

#: A block holds 2**BITS blocks of the size below. Values lie between -2**62 and 2**62.
BITS = 3


def blocks(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """ranges, one row for each block (level, block) of start to end, both included; ranges that are empty or open have none."""
    kept = ranges.where(F.col(start) <= F.col(end))
    longest = kept.agg(F.max(F.col(end).cast("long") - F.col(start).cast("long"))).first()[0]
    levels = (max(longest or 0, 1).bit_length() + BITS - 1) // BITS
    lo, past = F.col(start).cast("long"), F.col(end).cast("long") + 1
    none = F.array().cast("array<bigint>")

    def numbers(a: Column, b: Column) -> Column:
        return F.when(a < b, F.sequence(a, b - 1)).otherwise(none)

    first = lambda level: -F.shiftright(-lo, BITS * level)  # noqa: E731  the first whole block
    after = lambda level: F.shiftright(past, BITS * level)  # noqa: E731  the one past the last
    parts = []
    for level in range(levels + 1):
        a, b, up_a, up_b = first(level), after(level), F.shiftleft(first(level + 1), BITS), F.shiftleft(after(level + 1), BITS)
        own = F.when(first(level + 1) >= after(level + 1), numbers(a, b)).otherwise(F.concat(numbers(a, up_a), numbers(up_b, b)))
        parts.append(tagged(own, level))
    cut = kept.withColumn("__b", F.explode(F.flatten(F.array(*parts))))
    return cut.withColumns({"level": F.col("__b.level"), "block": F.col("__b.block")}).drop("__b")


def tagged(numbers: Column, level: int) -> Column:
    return F.transform(numbers, lambda x: F.struct(F.lit(level).alias("level"), x.alias("block")))


def points_in_blocks(values: DataFrame, value: str, cut: DataFrame) -> DataFrame:
    """values, one row for each size of block that cut has."""
    levels = sorted(r["level"] for r in cut.select("level").distinct().collect())  # 22 sizes at most
    tags = F.array(*[F.struct(F.lit(x).alias("level"), F.shiftright(F.col(value).cast("long"), BITS * x).alias("block")) for x in levels]) if levels else F.array().cast("array<struct<level:int,block:bigint>>")
    return values.where(F.col(value).isNotNull()).withColumn("__b", F.explode(tags)).withColumns({"level": F.col("__b.level"), "block": F.col("__b.block")}).drop("__b")


def pairs(values: DataFrame, value: str, ranges: DataFrame, start: str, end: str) -> DataFrame:
    """Each value with each range that holds it; the columns of both."""
    cut = written(blocks(ranges, start, end), "blocks")
    return points_in_blocks(values, value, cut).join(cut, ["level", "block"]).drop("level", "block")


def first_range(values: DataFrame, value: str, ranges: DataFrame, start: str, end: str, order: str, what: str) -> DataFrame:
    """(value, what): of the ranges that hold a value the first in order; values without one are left out. Blocks keep their first range only, so
    that a block has one row however many ranges cover it."""
    cut = blocks(ranges.select(start, end, order, what), start, end)
    cut = written(cut.groupBy("level", "block").agg(F.min(order).alias("__o"), F.min_by(what, order).alias(what)), "blocks")
    met = points_in_blocks(values.select(value).distinct(), value, cut).join(cut, ["level", "block"])
    return met.groupBy(value).agg(F.min_by(what, "__o").alias(what))


def last_start(values: DataFrame, value: str, starts: DataFrame, what: str) -> DataFrame:
    """(value, what): what starts at a value or last before it; values before the first start are left out. starts has one row for each value.

    Both sides are sorted as one over range partitions; what stands last in a partition is carried to those after it."""
    both = starts.select(value, F.struct(what).alias("__s")).unionByName(values.where(F.col(value).isNotNull()).select(value, F.lit(None).cast(starts.select(F.struct(what).alias("s")).schema["s"].dataType).alias("__s")))
    held = ranged(both.groupBy(value).agg(F.max("__s").alias("__s")), [value], "starts")
    local = F.last("__s", ignorenulls=True).over(Window.partitionBy("__part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    ends = held.groupBy("__part").agg(F.max_by("__s", F.when(F.col("__s").isNotNull(), F.col(value))).alias("__e"))  # a row for each part
    before = F.last("__e", ignorenulls=True).over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    carried = F.broadcast(ends.select("__part", before.alias("__c")))
    found = held.withColumn("__l", local).join(carried, "__part").select(value, F.coalesce("__l", "__c").alias("__s"))
    return found.where("__s IS NOT NULL").select(value, F.col(f"__s.{what}").alias(what))


def running_count(rows: DataFrame, group: str, order: str, opens: Column, name: str) -> DataFrame:
    """rows with the number of rows of their group, up to and with themselves, where `opens` holds."""
    return running_sum(rows, group, order, F.when(opens, 1).otherwise(0), name)


def running_sum(rows: DataFrame, group: str, order: str, value: Column, name: str) -> DataFrame:
    """rows with the sum of an integer over the rows of their group, up to and with themselves.

    Rows are sorted over range partitions of (group, order). A partition sums by itself, and of all groups in it only its first can
    have begun before it: what such groups have summed so far is one row a partition, and is sent to all."""
    held = ranged(rows.withColumn("__open", value), [group, order], "groups")
    inside = Window.partitionBy("__part", group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    totals = held.groupBy(group, "__part").agg(F.sum("__open").alias("__n"))
    earlier = F.sum("__n").over(Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    carried = totals.select(F.col(group).alias("__g"), F.col("__part").alias("__p"), earlier.alias("__before")).where("__before <> 0")
    counted = held.withColumn("__local", F.sum("__open").over(inside))
    both = counted.join(F.broadcast(carried), (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g")), "left")
    return both.withColumn(name, F.col("__local") + F.coalesce("__before", F.lit(0))).drop("__open", "__part", "__local", "__g", "__p", "__before")


def entered_state(rows: DataFrame, group: str, order: str, after_0: Column, after_1: Column, name: str) -> DataFrame:
    """rows with the state, 0 or 1, in which their group enters them; it begins in 0. A row entered in 0 leaves in after_0, in 1 in after_1.

    A row keeps the state, turns it, or sets it; a range partition of (group, order) composes its rows to one such step a group, so that what
    is carried from partition to partition is one row a partition, and is sent to all."""
    held = ranged(rows.withColumns({"__a": after_0.cast("int"), "__b": after_1.cast("int")}), [group, order], "states")
    local = stepped(held, ["__part", group], order)
    left = lambda state: (F.coalesce("__set", F.lit(state)) + F.col("__turns")) % 2  # noqa: E731  by the steps so far
    ends = local.groupBy(group, "__part").agg(F.max_by(left(0), order).alias("__a"), F.max_by(left(1), order).alias("__b"))
    carry = stepped(ends, [group], "__part").select(F.col(group).alias("__g"), F.col("__part").alias("__p"), entered([group], "__part", F.lit(0)).alias("__carry")).where("__carry <> 0")
    both = local.withColumn("__e", entered(["__part", group], order, F.lit(None).cast("int"))).withColumn("__t", F.coalesce(F.lag("__turns").over(Window.partitionBy("__part", group).orderBy(order)), F.lit(0)))
    met = both.join(F.broadcast(carry), (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g")), "left")
    state = F.coalesce("__e", (F.coalesce("__carry", F.lit(0)) + F.col("__t")) % 2)
    return met.withColumn(name, state.cast("int")).drop("__a", "__b", "__part", "__turns", "__set", "__e", "__t", "__g", "__p", "__carry")


def stepped(rows: DataFrame, groups: list[str], order: str) -> DataFrame:
    """rows with __turns, how often the state was turned so far, and __set, what the last row that set it has set, less the turns by then; null if none has."""
    upto = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    turned = rows.withColumn("__turns", F.sum(F.when(F.col("__a") > F.col("__b"), 1).otherwise(0)).over(upto))
    return turned.withColumn("__set", F.last(F.when(F.col("__a") == F.col("__b"), (F.col("__a") + F.col("__turns")) % 2), ignorenulls=True).over(upto))


def entered(groups: list[str], order: str, start: Column) -> Column:
    """The state that a row of stepped() is entered in, if its group begins in `start`; null where that is null and nothing has set the state."""
    before = Window.partitionBy(*groups).orderBy(order)
    return (F.coalesce(F.lag("__set").over(before), start) + F.coalesce(F.lag("__turns").over(before), F.lit(0))) % 2


def numbered(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """rows with their place, from 0, in the order of keys: each range partition numbers its own as it is written, after the counts of those before it."""
    held = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part, local = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = held.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))  # a row for each part
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    both = held.withColumn("__part", part).join(F.broadcast(counts.select("__part", before.alias("__before"))), "__part")
    return both.withColumn(name, local + F.col("__before")).drop("__part", "__at", "__before")


def placed(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """rows with what was found for their key, null where nothing was."""
    return rows.join(small(found), key, "left")
