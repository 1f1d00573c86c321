"""Secret scans with an incremental ledger of blobs.

Every version of every file (a row of a table) is addressed by the SHA-256 of its content. The ledger, a table in
a folder of its own, has for each blob the rule versions that have read it and what they found. A scan works out which
pairs of blob and rule version the ledger lacks, reads one row for each such blob with just those rules, appends what they
find, and joins the findings of all its blobs back to all rows. A rule that changes gets a new version, so that
only it is run again; content that moves, returns or is copied is not read again.

Texts are not shuffled where either the rows to read or the rows to leave out are few (BROADCAST_ROWS): a broadcast of their
addresses marks them. Else they are joined with the addresses, frequent ones apart. Appending is one Parquet job, whose commit makes
its rows seen; a scan that dies before it leaves the ledger as it was, and pairs that two scans at once have both
found count once.

Rules are patterns whose time is linear: a match that is too short is dropped and its text is used up.

Defined results: a null text is empty, and an empty text has no findings; null and repeated keys each keep their rows;
rows alike in keys and text are read each, all other copies once; texts of any length are read whole, positions are code points;
bytes that are no UTF-8 count one each as a replacement character; an empty table gives no rows. Columns of the input other than keys and text play no part."""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fits, keyed_join, write_table


@dataclass(frozen=True)
class Rule:
    """What to find. least: the shortest length of the group that counts; hints: a text without any of them (in lower case) cannot match."""

    name: str
    pattern: str
    least: int
    group: int = 0
    hints: tuple[str, ...] = ()
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# The contract's three rules.
BASE = (
    Rule("assign", r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 1, ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", r"AKIA[A-Z0-9]+", 16, 0, ("akia",)),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", 32),
)
#: What is found besides: tokens by the prefixes that their issuers give them, and heads of private keys.
MORE = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", 40, 0, ("gh",)),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20, 0, ("xox",)),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39, 0, ("aiza",)),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, 0, ("private key-----",)),
)
SPANS = "array<struct<start:int,rule:string,end:int>>"


def matches(rule: Rule, text: str) -> list[tuple[int, int]]:
    """Leftmost matches that don't overlap, without the short ones."""
    return [m.span() for m in re.finditer(rule.pattern, text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def scan_rows(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """rows: blob, raw (bytes) and due (keys of rules). Returns the ledger's rows: blob, done (keys), spans."""
    by = {r.key: r for r in rules}

    def run(batches):
        for batch in batches:
            spans = []
            for raw, due in zip(batch.column(1), batch.column(2), strict=True):
                text, found = raw.as_py().decode("utf-8", "replace"), []
                low = text.lower()
                for key in due.as_py():
                    if not by[key].hints or any(h in low for h in by[key].hints):
                        found += [{"start": a, "rule": key, "end": b} for a, b in matches(by[key], text)]
                spans.append(found)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("rule", pa.string()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(spans, kind)], names=["blob", "done", "spans"])

    return rows.select("blob", "raw", "due").mapInArrow(run, f"blob binary, done array<string>, spans {SPANS}")


class Ledger:
    """The pairs of blob and rule version that were read, in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.schema = f"blob binary, done array<string>, spans {SPANS}"
        spark.createDataFrame([], self.schema).write.mode("append").parquet(path)  # the table exists from now on

    def pairs(self) -> DataFrame:
        """One row for each blob and scan that read it."""
        return self.spark.read.schema(self.schema).parquet(self.path)

    def due(self, blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
        """blobs (one row each) with `due`, the keys of the rules that haven't read them; blobs that all have read are left out."""
        keys = F.array(*[F.lit(r.key) for r in rules])
        seen = self.pairs().select("blob", F.explode("done").alias("rule")).where(F.array_contains(keys, F.col("rule"))).distinct()
        seen = seen.groupBy("blob").agg(F.collect_list("rule").alias("done"))  # as many as there are rules
        left = blobs.join(seen, "blob", "left").withColumn("due", F.when(F.col("done").isNull(), keys).otherwise(F.array_except(keys, "done")))
        return left.where(F.size("due") > 0).drop("done")

    def scan(self, versions: DataFrame, keys: list[str], text: str = "text", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
        """(keys, blob, spans: start, rule, end in order) of every row; reads what the ledger lacks and adds it."""
        raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
        read = versions.select(F.struct(*keys).alias("keys"), raw.alias("raw"), F.unhex(F.sha2(raw, 256)).alias("blob")).withColumn("k", F.xxhash64("keys"))
        addressed, _ = write_table(read.select("keys", "k", "blob"), "versions")
        blobs = addressed.groupBy("blob").agg(F.min("k").alias("k"))  # copies meet before they are shuffled
        due, _ = write_table(self.due(blobs, rules), "due")
        self._read(read, addressed, due, rules)
        found, _ = write_table(self.findings(rules), "found")
        whole = keyed_join(addressed, found, ["blob"], "left")
        return whole.select(*[F.col("keys").getField(c).alias(c) for c in keys], "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))

    def _read(self, read: DataFrame, addressed: DataFrame, due: DataFrame, rules: tuple[Rule, ...]) -> None:
        marks = due.select("blob", "k", "due")
        if not due.take(1):
            return
        if fits(due):
            rows = read.join(F.broadcast(marks), ["blob", "k"])
        else:
            rest, _ = write_table(addressed.select("blob", "k").distinct().join(due, ["blob", "k"], "left_anti"), "rest")
            kinds = due.select("due").distinct().limit(2).collect()  # of a first scan all blobs have the same
            if len(kinds) == 1 and fits(rest):
                rows = read.join(F.broadcast(rest), ["blob", "k"], "left_anti").withColumn("due", F.array(*[F.lit(x) for x in kinds[0]["due"]]))
            else:
                rows = keyed_join(read.select("blob", "k", "raw"), marks, ["blob", "k"])
        scan_rows(rows, rules).write.mode("append").parquet(self.path)

    def findings(self, rules: tuple[Rule, ...]) -> DataFrame:
        """(blob, spans) of the blobs in which the present versions of the rules have found anything."""
        order = F.element_at(F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))]), F.col("s.rule"))
        each = self.pairs().where(F.size("spans") > 0).select("blob", F.explode("spans").alias("s")).where(F.col("s.rule").isin([r.key for r in rules]))
        each = each.select("blob", F.struct(F.col("s.start").alias("start"), order.alias("place"), F.col("s.end").alias("end")).alias("s")).distinct()
        names = F.array(*[F.lit(r.name) for r in rules])
        in_order = F.transform(F.array_sort(F.collect_list("s")), lambda s: F.struct(s["start"].alias("start"), F.element_at(names, s["place"] + 1).alias("rule"), s["end"].alias("end")))
        return each.groupBy("blob").agg(in_order.alias("spans"))  # as many as one text has


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))), ",")
