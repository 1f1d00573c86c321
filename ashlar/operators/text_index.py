"""A persisted index of texts, for the searches that ask which texts contain something: lists of places of grams, written once and read for the
grams of a query only.

A gram is GRAM characters of the text in lower case; a text's last grams are filled up with zero characters, so that each place has one.
Texts are taken in segments of a few MB as they lie, with no shuffle; in a segment they stand one behind the other, and a gram's list is one row: the gaps between its places, in bytes of seven
bits. A segment's rows are sorted by gram, in pages whose statistics tell which grams they hold; its first row, of the empty gram, has its texts' `ord` and lengths. A query of at least GRAM
characters is found where the grams that cover it stand at their distances; a shorter one is the beginning of grams. Nothing but lists is read for it, so no text is compared.

Keywords are kept beside them as whole words. `ord` tells texts apart and is their order; null texts are not indexed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from .shared import SMALL_ROWS, settings, small, spread

GRAM = 3
#: Bytes of text that are indexed together; a longer text is a segment by itself.
SEGMENT = 4 << 20
#: A word's list is dealt to so many tasks, and found in as many files at most.
SALT = 16
LISTS = "gram string, segment long, data binary"
#: Pages of few lists, so that a query reads little besides its own; gaps repeat little as wholes, but their bytes are uneven, which Zstandard's codes take.
FILES = {"compression": "zstd", "parquet.page.row.count.limit": "256", "parquet.enable.dictionary": "false"}


def packed(gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 as bytes of seven bits, the lowest first, all but the last of a number with the high bit set; and where each number begins."""
    long = gaps >= 128
    size = 1 + long.astype(np.int64)
    for bits in (14, 21, 28, 35):
        size[long] += gaps[long] >= 1 << bits
    begin = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint8)
    out[begin] = (gaps & 127) | (long << 7)
    at, rest, k = np.flatnonzero(long), gaps[long] >> 7, 1
    while len(at):
        more = rest >= 128
        out[begin[at] + k] = (rest & 127) | (more << 7)
        at, rest, k = at[more], rest[more] >> 7, k + 1
    return out, begin


def unpacked(data: bytes) -> np.ndarray:
    byte = np.frombuffer(data, np.uint8).astype(np.int64)
    last = np.flatnonzero(byte < 128)
    first = np.r_[0, last[:-1] + 1][: len(last)]
    value = byte[first] & 127
    for k in range(1, int((last - first).max(initial=0)) + 1):
        more = last - first >= k
        value[more] |= (byte[first[more] + k] & 127) << 7 * k
    return value


def lists_of(ords: np.ndarray, texts: pa.Array, segment: int) -> pa.RecordBatch:
    """The lists of one segment, sorted by gram."""
    length = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    code = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32)
    place = np.arange(len(code)) + np.repeat(np.arange(len(length)) * (GRAM - 1), length)
    seen = np.zeros(int(code.max()) + 1, bool)
    seen[0], seen[code] = True, True
    alphabet = np.flatnonzero(seen)
    number = np.zeros(len(seen), np.int64)
    number[alphabet] = np.arange(len(alphabet))
    line = np.zeros(len(code) + (GRAM - 1) * len(length), np.int64)
    line[place] = number[code]
    key = line[place]
    for k in range(1, GRAM):
        key = key * len(alphabet) + line[place + k]
    bits = len(line).bit_length()
    if len(alphabet) ** GRAM < 1 << 63 - bits:
        both = np.sort(key << bits | place)
        key, place = both >> bits, both & (1 << bits) - 1
    else:
        order = np.argsort(key, kind="stable")
        key, place = key[order], place[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    gaps = np.diff(place, prepend=0)
    gaps[first] = place[first]
    data, begin = packed(gaps)
    key, symbols = key[first], []
    for _ in range(GRAM):
        symbols.append(alphabet[key % len(alphabet)])
        key = key // len(alphabet)
    letters = np.stack(symbols[::-1], axis=1).astype("<u4").tobytes().decode("utf-32-le")
    grams = pa.array(["", *(letters[i : i + GRAM] for i in range(0, len(letters), GRAM))], pa.string())
    held = ords.astype("<i8").tobytes() + length.astype("<i4").tobytes()
    offsets = np.r_[0, len(held) + begin[first], len(held) + len(data)].astype(np.int32)
    lists = pa.BinaryArray.from_buffers(pa.binary(), len(grams), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(held + data.tobytes())])
    return pa.RecordBatch.from_arrays([grams, pa.array(np.full(len(grams), segment), pa.int64()), lists], names=["gram", "segment", "data"])


def segments(batches):
    """Lists of (ord, t), texts that are not empty, in segments."""
    task, n, held, size = TaskContext.get().partitionId(), 0, [], 0

    def done():
        whole = pa.Table.from_batches(held)
        return lists_of(whole.column(0).to_numpy(), whole.column(1).combine_chunks(), task << 32 | n)

    for batch in batches:
        if held and size + batch.nbytes > SEGMENT:
            yield done()
            n, held, size = n + 1, [], 0
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
    if held:
        yield done()


def places(lists: dict[str, bytes], covers: list[tuple[int, str]], beginning: str) -> np.ndarray:
    """Where a query of these grams (at, gram) stands in a segment, or, if there are none, what begins with the beginning."""
    if covers:
        if any(gram not in lists for _, gram in covers):
            return np.empty(0, np.int64)
        found, *others = sorted((np.cumsum(unpacked(lists[gram])) - at for at, gram in covers), key=len)
        for x in others:
            found = np.intersect1d(found, x, assume_unique=True)
        return found
    return np.sort(np.concatenate([np.empty(0, np.int64), *(np.cumsum(unpacked(x)) for gram, x in lists.items() if gram and gram.startswith(beginning))]))


def write_index(rows: DataFrame, text: Column, path: str, words: Column | None = None) -> TextIndex:
    """Index rows (ord, ...) by a text and, if it is given, by a list of keywords."""
    texts = spread(rows, "ord").select(F.col("ord").cast("long").alias("ord"), F.lower(text).alias("t")).where("t <> ''")
    with settings(rows.sparkSession, {"spark.sql.execution.arrow.maxBytesPerBatch": f"{SEGMENT // 4}b"}):
        texts.mapInArrow(segments, LISTS).write.options(**FILES).parquet(f"{path}/grams")
    if words is not None:
        each = rows.select("ord", F.explode(F.array_distinct(F.transform(words, lambda w: F.lower(w)))).alias("word")).where("word IS NOT NULL")
        each.select("word", "ord").repartition("word", F.pmod("ord", F.lit(SALT))).sortWithinPartitions("word", "ord").write.parquet(f"{path}/words")
    return TextIndex(rows.sparkSession, path)


class TextIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def occurrences(self, terms: list[str]) -> DataFrame:
        """(term, ord, pos): the number of each term and where it stands, from 0; terms are not empty and in lower case."""
        covers = [[(at, x[at : at + GRAM]) for at in sorted({*range(0, len(x) - GRAM + 1, GRAM), len(x) - GRAM})] if len(x) >= GRAM else [] for x in terms]  # a gram for every GRAM characters of the query
        schema, short = "term int, ord long, pos int", sorted({x for x in terms if len(x) < GRAM})
        if not terms:
            return self.spark.createDataFrame([], schema)
        gram = F.col("gram")
        asked = [F.startswith(gram, F.lit(x)) for x in short]
        if grams := sorted({gram for held in covers for _, gram in held}):
            asked.append(gram.isin(grams))
        some = asked[0]
        for x in asked[1:]:
            some = some | x
        lists = self.spark.read.schema(LISTS).parquet(f"{self.path}/grams")
        hit = lists.where(gram == "").unionByName(lists.where(some & (gram != "")))

        def run(table: pa.Table) -> pa.Table:
            held = dict(zip(table.column("gram").to_pylist(), table.column("data").to_pylist(), strict=True))
            texts = held.pop("")
            n = len(texts) // 12
            ords, length = np.frombuffer(texts, "<i8", n), np.frombuffer(texts, "<i4", n, 8 * n).astype(np.int64)
            start = np.cumsum(length + GRAM - 1) - (length + GRAM - 1)
            found = []
            for term, (x, cover) in enumerate(zip(terms, covers, strict=True)):
                at = places(held, cover, x)
                which = np.searchsorted(start, at, side="right") - 1
                pos = at - start[which]
                kept = pos + len(x) <= length[which]
                found.append(pa.table([pa.array(np.full(int(kept.sum()), term), pa.int32()), pa.array(ords[which[kept]], pa.int64()), pa.array(pos[kept], pa.int32())], names=["term", "ord", "pos"]))
            return pa.concat_tables(found)

        return hit.groupBy("segment").applyInArrow(run, schema)

    def containing(self, query: str) -> DataFrame:
        """(ord, pos): the texts that contain a query, without regard to case, and its first place."""
        return self.occurrences([query.lower()]).groupBy("ord").agg(F.min("pos").alias("pos"))

    def search_words(self, query: str, limit: int = 20) -> DataFrame:
        """(ord, score): texts by how many of the query's words they contain; ties in order."""
        if limit < 0:
            raise ValueError("INVALID_PARAM: limit")
        terms = sorted(set(query.lower().split()))
        held = self.occurrences(terms).select("term", "ord").distinct()
        return held.groupBy("ord").agg(F.count(F.lit(1)).cast("int").alias("score")).orderBy(F.desc("score"), "ord").limit(limit)

    def search_keywords(self, wanted: list[str]) -> DataFrame:
        """(ord, matched, score): texts by the share of wanted keywords that they have exactly, without regard to case."""
        if not wanted:
            raise ValueError("INVALID_PARAM: no keywords")
        lists = self.spark.read.schema("word string, ord long").parquet(f"{self.path}/words")
        held = lists.where(F.col("word").isin(sorted({w.lower() for w in wanted}))).groupBy("ord").agg(F.collect_set("word").alias("have"))  # of the wanted ones
        hit = F.filter(F.array(*[F.lit(w) for w in wanted]), lambda w: F.array_contains("have", F.lower(w)))
        return held.select("ord", hit.alias("matched")).withColumn("score", F.bround(F.size("matched") / F.lit(len(wanted)), 2))


def search_nodes(index: TextIndex, nodes: DataFrame, query: str, limit: int = 20) -> DataFrame:
    """nodes with their score, as graph.search_nodes() gives them; the order and the limit are found in the lists."""
    return nodes.join(F.broadcast(index.search_words(query, limit)), "ord").orderBy(F.desc("score"), "ord")


def search_keywords(index: TextIndex, nodes: DataFrame, wanted: list[str]) -> DataFrame:
    return nodes.join(small(index.search_keywords(wanted)), "ord").orderBy(F.desc("score"), "id")


def search_text(index: TextIndex, chunks: DataFrame, text: str, query: str, around: int = 50, most: int = SMALL_ROWS) -> DataFrame:
    """chunks that contain the query, with its first position and what stands around it; texts are read for the excerpts only.

    Beyond so many hits most files of texts hold one, and a join would shuffle whole texts: then texts are read where they lie, once, and tell their position themselves."""
    if len(query) < 2:
        raise ValueError("INVALID_PARAM: query")
    found = index.containing(query)
    if found.limit(most + 1).count() <= most:
        hit = chunks.join(F.broadcast(found), "ord")
    else:
        low = F.lower(F.col(text))
        hit = chunks.where(F.contains(low, F.lit(query.lower()))).withColumn("pos", F.instr(low, query.lower()) - 1)
    return hit.withColumns({"position": F.col("pos"), "excerpt": C.excerpt(F.col(text), query, around)}).drop("pos")


def first_with_text(index: TextIndex, chunks: DataFrame, query: str, limit: int = 10) -> DataFrame:
    """The first chunks that contain a text, in order; one at least."""
    return chunks.join(F.broadcast(index.containing(query).orderBy("ord").limit(max(limit, 1)).select("ord")), "ord").orderBy("ord")
