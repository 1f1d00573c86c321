"""Benchmark decontamination over a distributed positional inverted index, in DataFrame functions only.

The index is a written table of postings (document, position, term) of all words of the training documents,
with one header row for each document; it serves any benchmark. Phrases are found from it alone: list
lengths are counted, every window of a test item is anchored at its rarest term, the
anchors' lists give alignments (document, item, offset), the lists of the second rarest terms,
adjusted by their offsets, are intersected with them, and only what remains is compared with the
terms about the anchor. Postings of common terms are thus read for surviving documents only. Proximity matches
go the same way: the rarest term of an item, then its second rarest within reach, then all others.

Lists are found by a 32-bit hash of their term, which is cheaper to join than text; all that is found so is compared with the
terms themselves in the end, so that a collision costs time only. Postings are met with terms by a broadcast of bounded size, or by a shuffle in which frequent terms are taken apart
(keyed_join).

Defined results: a null text has no words; a null or wordless item has no windows; items that
share an item_id count once; repeated documents each get their row. A document without words has
n_words 0 and is clean; an empty table of documents gives no rows, an empty benchmark no hits. Very long texts are
rows of postings as any other. Other columns of the input play no part, and drop_contaminated() passes them
through whatever their names are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, fits, keyed_join, scratch, small, write_table

WIDTH = 13
#: How many words after or before an item's rarest term its other terms may stand, for a proximity match.
SLOP = 50
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The term of the row that stands for the document itself; no word is empty.
HEADER = ""


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), 0), F.array().cast("array<string>"))


def item_terms(bench: DataFrame, id_col: str, text: str) -> DataFrame:
    """(iid, item_id, len, j, term, t), one row for each word of each item; iid tells rows apart."""
    rows = bench.select(F.col(id_col).cast("string").alias("item_id"), words(F.col(text)).alias("w")).distinct()
    rows = rows.select(F.xxhash64("item_id", F.concat_ws(" ", "w")).alias("iid"), "item_id", "w", F.size("w").alias("len"))
    return rows.select("iid", "item_id", "len", F.posexplode("w").alias("j", "term")).withColumn("t", F.hash("term"))


def build_index(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Postings (rid, doc_id, n_words, pos, term, t: the hash of the term) of all words, and header rows at position -1."""
    read = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), words(F.col(text)).alias("w"))
    flat = read.select("rid", "doc_id", F.size("w").alias("n_words"), F.posexplode(F.concat(F.array(F.lit(HEADER)), F.col("w"))).alias("pos", "term"))
    index, _ = write_table(flat.select("rid", "doc_id", "n_words", (F.col("pos") - 1).alias("pos"), "term", F.hash("term").alias("t")), "postings")
    return index


def list_lengths(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, cf) of the terms that any document has: counts of the terms themselves, so that a collision of hashes adds nothing."""
    wanted, _ = write_table(terms.select("t", "term").distinct(), "wanted")
    postings = index.where("pos >= 0").select("t", "term")
    if fits(wanted):
        postings = postings.join(F.broadcast(wanted.select("t").distinct()), "t", "left_semi")
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("cf"))  # counted before it is shuffled
    return write_table(counts.join(wanted.select("term"), "term", "left_semi"), "lengths")[0]


def lists_of(index: DataFrame, side: DataFrame, columns: list[str]) -> DataFrame:
    """Postings (rid, pos, t) with what `side` has for their terms: one row for each row of side."""
    postings = index.where("pos >= 0").select("rid", "pos", "t")
    if not columns:
        return keyed_join(postings, side.select("t").distinct(), ["t"], "left_semi")
    if fits(side):
        return postings.join(F.broadcast(side), "t")
    by = side.groupBy("t").agg(F.collect_list(F.struct(*columns)).alias("x"))  # as many as the benchmark has
    return keyed_join(postings, write_table(by, "by-term")[0], ["t"]).select("rid", "pos", "t", F.explode("x").alias("x")).select("rid", "pos", "t", "x.*")


def anchors(terms: DataFrame, lengths: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """The rarest term of every window (iid, len, j, t), and the second rarest (iid, j, j2, t2).

    Windows with a term that no document has are left out: they cannot occur."""
    rated = terms.join(lengths, "term", "left").withColumn("cf", F.coalesce("cf", F.lit(0)))
    starts = terms.select("iid", "len").distinct().select("iid", "len", F.explode(F.sequence(F.lit(0), F.greatest(F.col("len") - width, F.lit(0)))).alias("s"))
    inside = starts.select("iid", "len", "s", F.explode(F.sequence("s", F.least(F.col("s") + width, F.col("len")) - 1)).alias("j"))
    lists = inside.join(rated.select("iid", "j", "t", "cf"), ["iid", "j"]).groupBy("iid", "len", "s").agg(F.array_sort(F.collect_list(F.struct("cf", "j", "t"))).alias("by"))
    lists = lists.where(F.col("by")[0]["cf"] > 0)
    second = F.col("by")[F.least(F.size("by"), F.lit(2)) - 1]
    chosen = lists.select("iid", "len", F.col("by")[0].alias("a"), second.alias("b"))
    first = chosen.select("iid", "len", "a.j", "a.t").distinct()
    then = chosen.select("iid", "a.j", F.col("b.j").alias("j2"), F.col("b.t").alias("t2")).distinct()
    return first, then


def phrase_matches(index: DataFrame, terms: DataFrame, lengths: DataFrame, width: int = WIDTH) -> DataFrame:
    """Where windows of the items occur: (rid, iid, item_id, first, last), word positions, last included.

    Overlapping windows of one alignment come as one row."""
    (first, then), keep = anchors(terms, lengths, width), ["rid", "iid"]
    first, _ = write_table(first, "anchors")
    then, _ = write_table(then, "seconds")
    lined = lists_of(index, first.select("t", "iid", "j"), ["iid", "j"]).select("rid", "iid", "j", (F.col("pos") - F.col("j")).alias("delta"))  # negative where the document has a later part of the item only
    due = lined.join(small(then), ["iid", "j"]).select("rid", "iid", "j", "delta", (F.col("delta") + F.col("j2")).alias("pos"), F.col("t2").alias("t"))
    seconds = lists_of(index, then.select(F.col("t2").alias("t")), [])
    left, _ = write_table(due.join(seconds, ["rid", "pos", "t"]).select(*keep, "j", "delta").distinct(), "alignments")
    rest = index.where("pos >= 0").select("rid", "pos", "term")
    rest = keyed_join(rest, write_table(left.select("rid").distinct(), "survivors")[0], ["rid"], "left_semi")
    # the windows that an anchor stands for lie about it
    about = first.select("iid", "j", F.explode(F.sequence(F.greatest(F.col("j") - width + 1, F.lit(0)), F.least(F.col("j") + width, F.col("len")) - 1)).alias("i"))
    about, _ = write_table(about.join(terms.select("iid", "item_id", "len", F.col("j").alias("i"), "term"), ["iid", "i"]), "about")
    need = left.join(small(about), ["iid", "j"]).select("rid", "iid", "item_id", "len", "delta", "i", "term", (F.col("delta") + F.col("i")).cast("int").alias("pos")).distinct()
    same = need.join(rest, ["rid", "pos", "term"])
    runs = same.withColumn("run", F.col("i") - F.row_number().over(Window.partitionBy(*keep, "delta").orderBy("i")))
    runs = runs.groupBy(*keep, "item_id", "len", "delta", "run").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    return runs.where(F.col("last") - F.col("first") + 1 >= F.least(F.lit(width), F.col("len"))).select(*keep, "item_id", "first", "last")


def proximity_matches(index: DataFrame, terms: DataFrame, lengths: DataFrame, slop: int = SLOP) -> DataFrame:
    """Where all terms of an item stand within `slop` words after or before its rarest one: (rid, iid, item_id, pos).

    terms: as of item_terms; repeated terms of an item count once. Of terms that are as rare, the first in the order of their bytes is the rarest."""
    sets = terms.select("iid", "item_id", "term", "t").distinct()
    rated = sets.join(lengths, "term", "left").withColumn("cf", F.coalesce("cf", F.lit(0)))
    by = rated.groupBy("iid", "item_id").agg(F.array_sort(F.collect_list(F.struct("cf", "term", "t"))).alias("by")).where(F.col("by")[0]["cf"] > 0)
    rare, _ = write_table(by.select("iid", "item_id", F.size("by").alias("n"), F.col("by")[0]["t"].alias("t"), F.col("by")[F.least(F.size("by"), F.lit(2)) - 1]["t"].alias("t2")), "rarest")
    sets, _ = write_table(sets, "sets")
    wide = 2 * slop + 1
    cell = lambda p: F.floor(p / wide)
    cells = lambda p: F.explode(F.array_distinct(F.array(cell(p - slop), cell(p + slop))))
    at = lists_of(index, rare.select("t", "iid", "item_id", "n", "t2"), ["iid", "item_id", "n", "t2"]).select("rid", "iid", "item_id", "n", F.col("pos").alias("at"), F.col("t2").alias("other"))
    seconds = lists_of(index, rare.select(F.col("t2").alias("t")), []).select("rid", F.col("t").alias("other"), F.col("pos").alias("near"), cell(F.col("pos")).alias("cell"))
    close = at.withColumn("cell", cells(F.col("at"))).join(seconds, ["rid", "other", "cell"]).where(F.abs(F.col("near") - F.col("at")) <= slop)
    left, _ = write_table(close.select("rid", "iid", "item_id", "n", "at").distinct(), "near")
    rest = keyed_join(index.where("pos >= 0").select("rid", F.col("pos").alias("near"), F.col("term").alias("other")), write_table(left.select("rid").distinct(), "survivors")[0], ["rid"], "left_semi")
    want = left.join(small(sets.select("iid", F.col("term").alias("other"))), "iid").withColumn("cell", cells(F.col("at")))
    met = want.join(rest.withColumn("cell", cell(F.col("near"))), ["rid", "other", "cell"]).where(F.abs(F.col("near") - F.col("at")) <= slop)
    full = met.groupBy("rid", "iid", "item_id", "at").agg(F.max("n").alias("n"), F.count_distinct("other").alias("k"))
    return full.where("k = n").select("rid", "iid", "item_id", F.col("at").alias("pos"))


def overlaps(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WIDTH, slop: int | None = None) -> DataFrame:
    """(rid, doc_id, n_words, n_hit, n_items, items) for every document row; items: sorted ids of the items that occur in it.

    With `slop` also n_near: how many items have all their terms near each other in the document."""
    with scratch(docs.sparkSession):
        terms, _ = write_table(item_terms(bench, item_id, item_text), "terms")
        index = build_index(docs, doc_id, doc_text)
        lengths = list_lengths(index, terms)
        found, _ = write_table(phrase_matches(index, terms, lengths, width), "matches")
        spots = found.select("rid", F.explode(F.sequence("first", "last")).alias("pos")).distinct().groupBy("rid").agg(F.count(F.lit(1)).alias("n_hit"))
        items = found.select("rid", "item_id").distinct().groupBy("rid").agg(F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list("item_id")).alias("items"))
        heads = index.where("pos < 0").select("rid", "doc_id", F.col("n_words").cast("long").alias("n_words"))
        zero = F.lit(0).cast("long")
        whole = heads.join(spots.join(items, "rid"), "rid", "left").select("rid", "doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
        if slop is None:
            return write_table(whole, "overlaps", keep=True)[0]
        near = proximity_matches(index, terms, lengths, slop).select("rid", "item_id").distinct().groupBy("rid").agg(F.count(F.lit(1)).alias("near"))
        whole = whole.join(near, "rid", "left").withColumn("n_near", F.coalesce("near", zero)).drop("near")
        return write_table(whole, "overlaps", keep=True)[0]


def contaminated() -> Column:
    """The rule: any hit, and hits are a twentieth of the words at least."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", doc_text: str = "text") -> DataFrame:
    """docs without the contaminated rows. Rows are told apart by two hashes of their whole content, so that repeated rows go together."""
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.xxhash64(*docs.columns).alias("h1"), F.xxhash64(F.lit("again"), *docs.columns).alias("h2"))
    marked = rows.select(F.struct("h1", "h2").alias("doc_id"), F.col("doc").getField(doc_text).alias("text"))
    bad, _ = write_table(overlaps(marked, bench).where(contaminated()).select("doc_id.h1", "doc_id.h2").distinct(), "contaminated")
    return keyed_join(rows, bad, ["h1", "h2"], "left_anti").select("doc.*")
