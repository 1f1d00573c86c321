"""WARC archives in seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each with the records of about FRAME bytes, a skippable frame with the
index from record ids to (frame, offset in the frame, length), and a
footer in a skippable frame: the seek table of the public seekable format (compressed and plain size
of each frame). So a record is read by decompressing its frame alone. Bundles are rows of a table that Spark writes
and commits, so a lost executor leaves none behind half written; the index stands beside each as a column too.
export() writes bundles as .warc.zst files, read_files() reads such files.

What a record refers to is decided on ids and digests; the payloads are not shuffled where the digests that repeat
can be broadcast, and else a frequent digest is taken apart (keyed_join).

Pages with equal payloads are stored once: the one with the largest page_id is a response, the others
are revisit records that refer to it and carry the payload's digest and size.

Defined results: null html is the empty payload, which is deduplicated as any other; rows that repeat
the largest page_id with the same payload are all responses; a null page_id is smaller than any other,
and where all are null they are all responses; a null url leaves the target out. Rows that repeat a page_id have the same record
id, and lookup() gives all of them. All records have the date that is passed (pages have none of their own). An empty table gives no
bundle; very long payloads make frames of their own; other columns of the input play no part."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keyed_join, small, write_table

FRAME, BUNDLE, LEVEL = 1 << 20, 16 << 20, 3
# Fixed values of the seekable format: skippable frame magic and footer magic.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: The skippable frame of the index: the first magic number of such frames.
INDEX = 0x184D2A50
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BUNDLES = "bundle string, data binary, index array<struct<record:string,frame:int,offset:int,length:int>>"


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", a, b) for a, b in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame."""
    n, _, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    at, frames = 0, []
    body = len(data) - 9 - 8 * n
    for i in range(n):
        a, b = struct.unpack_from("<II", data, body + 8 * i)
        frames.append((at, a, b))
        at += a
    return frames


def index_frame(index: list[dict], pack) -> bytes:
    """The index as lines of JSON, compressed, in a skippable frame."""
    body = pack.compress("\n".join(json.dumps([x["record"], x["frame"], x["offset"], x["length"]]) for x in index).encode())
    return struct.pack("<II", INDEX, len(body)) + body


def read_index(data: bytes) -> list[tuple[str, int, int, int]]:
    """(record, frame, offset, length) of each record of a bundle."""
    import zstandard

    at = sum(size for _, size, _ in read_seek_table(data))
    magic, size = struct.unpack_from("<II", data, at)
    if magic != INDEX:
        raise ValueError("no index")
    text = zstandard.ZstdDecompressor().decompressobj().decompress(data[at + 8 : at + 8 + size]).decode()
    return [tuple(json.loads(x)) for x in text.splitlines()]


def urn(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record(page_id, url, payload: bytes | None, digest: str, size: int, refers_to, date: str = DATE) -> bytes:
    """One record; payload None: a revisit."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}", f"WARC-Record-ID: {urn(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if payload is None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {urn(refers_to)}"]
    else:
        block += payload
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at a position."""
    head = data.index(b"\r\n\r\n", at)
    lines = data[at:head].decode("utf-8", "surrogatepass").split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    end = head + 4 + int(headers["Content-Length"])
    if lines[0] != "WARC/1.1" or data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("no WARC record here")
    return headers, data[head + 4 : end], end + 4


def bundles(pages: DataFrame, frame: int = FRAME, bundle: int = BUNDLE, level: int = LEVEL, date: str = DATE) -> DataFrame:
    """Bundles of the rows (page_id, url, html, sha1, size, refers_to)."""

    def run(batches):
        import zstandard
        from pyspark import TaskContext

        pack = zstandard.ZstdCompressor(level=level)
        task, count = TaskContext.get().partitionId(), 0
        frames, sizes, index, open_, plain = [], [], [], [], 0

        def end_frame():
            nonlocal open_
            if open_:
                whole = b"".join(open_)
                frames.append(pack.compress(whole))
                sizes.append((len(frames[-1]), len(whole)))
                open_ = []

        def end_bundle():
            nonlocal frames, sizes, index, plain, count
            end_frame()
            data = b"".join(frames) + index_frame(index, pack) + seek_table(sizes)
            made = pa.RecordBatch.from_pylist([{"bundle": f"part-{task:06d}-{count:05d}.warc.zst", "data": data, "index": index}], schema=pa.schema([("bundle", pa.string()), ("data", pa.binary()), ("index", pa.list_(pa.struct([("record", pa.string()), ("frame", pa.int32()), ("offset", pa.int32()), ("length", pa.int32())])))]))
            frames, sizes, index, plain, count = [], [], [], 0, count + 1
            return made

        held = 0
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url", "html", "sha1", "size", "refers_to")]
            cols[2] = cols[2].cast(pa.binary() if pa.types.is_string(cols[2].type) else pa.large_binary())
            for page_id, url, payload, sha1, size, refers_to in zip(*(c.to_pylist() for c in cols), strict=True):
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                raw = record(page_id, url, None if refers_to is not None else payload or b"", digest, size, refers_to, date)
                index.append({"record": urn(page_id), "frame": len(frames), "offset": held, "length": len(raw)})
                open_.append(raw)
                held += len(raw)
                plain += len(raw)
                if held >= frame:
                    end_frame()
                    held = 0
                if plain >= bundle:
                    yield end_bundle()
                    held = 0
        if index:
            yield end_bundle()

    return pages.select("page_id", "url", "html", "sha1", "size", "refers_to").mapInArrow(run, BUNDLES)


def archive(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", **options) -> DataFrame:
    """Write the pages to a table of bundles in the shared folder."""
    raw = F.coalesce(F.col(html), F.lit(""))
    read = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), raw.alias("html"), F.sha1(raw.cast("binary")).alias("sha1"), F.octet_length(raw).cast("long").alias("size"))
    shared = read.groupBy("sha1").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("last")).where("n > 1 AND last IS NOT NULL").select("sha1", "last")
    shared, _ = write_table(shared, "shared-payloads")
    ruled = keyed_join(read, shared, ["sha1"], "left").withColumn("refers_to", F.when(F.col("last") != F.coalesce(F.col("page_id"), F.lit(-(2**63))), F.col("last")))
    return write_table(bundles(ruled, **options), "warc", compression="none")[0]


def read_records(archives: DataFrame) -> DataFrame:
    """Every record of the bundles, read frame by frame: what its headers say, checked against its payload."""
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType())])

    def number(text: str):
        return None if text == "<urn:page:none>" else int(text[len("<urn:page:") : -1])

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for data in batch.column(0).to_pylist():
                rows = []
                for start, size, plain in read_seek_table(data):
                    frame, at = unpack.decompress(data[start : start + size], max_output_size=plain), 0
                    while at < len(frame):
                        headers, block, at = parse(frame, at)
                        body = block.index(b"\r\n\r\n") + 4
                        length = int(re.search(rb"Content-Length: (\d+)", block[:body])[1])
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        if headers["WARC-Type"] == "response" and (len(block) - body != length or base64.b32encode(hashlib.sha1(block[body:]).digest()).decode() != digest):
                            raise ValueError(f"payload of {headers['WARC-Record-ID']} is not what was written")
                        rows.append((number(headers["WARC-Record-ID"]), length, digest, headers["WARC-Type"], number(headers["WARC-Refers-To"]) if "WARC-Refers-To" in headers else None))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], names=schema.names)

    return archives.select("data").mapInArrow(run, schema)


def lookup(archives: DataFrame, page_ids: DataFrame) -> DataFrame:
    """(record, raw): records by id (column page_id), each read from its frame alone."""
    wanted = page_ids.select(F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">")).alias("record")).distinct()
    at = archives.select("bundle", F.explode("index").alias("i")).select("bundle", "i.*").join(small(wanted), "record", "left_semi")
    groups = at.groupBy("bundle").agg(F.collect_list(F.struct("record", "frame", "offset", "length")).alias("found"))
    schema = "record string, raw binary"

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for data, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                table, out = read_seek_table(data), []
                for number in sorted({x["frame"] for x in found}):
                    start, size, plain = table[number]
                    frame = unpack.decompress(data[start : start + size], max_output_size=plain)
                    out += [(x["record"], frame[x["offset"] : x["offset"] + x["length"]]) for x in found if x["frame"] == number]
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in out], pa.string()), pa.array([b for _, b in out], pa.binary())], names=["record", "raw"])

    return archives.join(groups, "bundle").select("data", "found").mapInArrow(run, schema)


def export(archives: DataFrame, folder: str) -> DataFrame:
    """Write each bundle as a file into a shared folder (a URI such as file:///data/warc); returns (file, size).

    A file is written under a name of its own attempt and then renamed, so that a lost task leaves no half file under a final
    name, and a second attempt writes the same."""

    def run(batches):
        import uuid

        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            names, datas = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("bundle", "data"))
            for name, data in zip(names, datas, strict=True):
                part = f"{root}/_{uuid.uuid4().hex}"
                with store.open_output_stream(part) as out:
                    out.write(data)
                store.move(part, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([len(d) for d in datas], pa.int64())], names=["file", "size"])

    return write_table(archives.select("bundle", "data").mapInArrow(run, "file string, size long"), "exported")[0]


def read_files(spark, folder: str) -> DataFrame:
    """Bundles (bundle, data) of the .warc.zst files of a folder, for read_records()."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return found.select(F.substring_index("path", "/", -1).alias("bundle"), F.col("content").alias("data"))
