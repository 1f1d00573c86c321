"""SentencePiece encoding and decoding by Viterbi over a trie of words.

A text is cut at its spaces; every word gets the mark U+2581 in front, as the vocabulary has it. The
distinct words of a batch are sorted, which is the depth-first order of their trie: a word shares the
forward scores of the characters that it has in common with the word before it, and only the rest is
computed. Each word's best segmentation is the one of highest summed piece scores (of several, the
one whose last piece is longest, and so on backwards); characters without a piece become byte pieces.

The vocabulary is public and read from a path on the driver; its 32,000 or so pieces (bounded by the
file) are broadcast. Decoding joins the pieces' bytes and is exact for every text: a mark that
stands in a text itself is always encoded as bytes.

Defined results: null and empty texts have no ids and decode to the empty text; columns of the input
that have the names of the outputs are replaced."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
#: A mark in the text itself, while words are segmented; no valid text holds a lone surrogate.
OWN_MARK = "\udc81"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: A byte piece costs as much more than the worst piece.
BYTE_COST = 10.0
KEEP_WORDS, KEEP_CHARS = 400_000, 32
#: A batch is cut into runs of about so many characters, a longer text being one by itself.
RUN_CHARS = 2_000_000


def load_vocabulary(path: str = DEFAULT_MODEL) -> dict:
    """Piece scores and ids, the ids of bytes, and each id's bytes; plain types, so that any worker can read them."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids, raw = {}, [0] * 256, []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            value = int(piece[3:5], 16)
            byte_ids[value] = i
            raw.append(bytes([value]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            raw.append(b"")
        else:
            pieces[piece] = (float(sp.get_score(i)), i)
            raw.append(piece.replace(MARK, " ").encode())
    return {"pieces": pieces, "bytes": byte_ids, "raw": raw}


class Encoder:
    def __init__(self, vocabulary: dict):
        self.pieces, self.byte_ids, self.raw = vocabulary["pieces"], vocabulary["bytes"], vocabulary["raw"]
        self.root: dict = {}  # pieces by their characters from the last to the first; at "": (score, id)
        for p, entry in self.pieces.items():
            node = self.root
            for c in reversed(p):
                node = node.setdefault(c, {})
            node[""] = entry
        self.byte_score = min((s for s, _ in self.pieces.values()), default=0.0) - BYTE_COST
        self.kept: dict[str, tuple[int, ...]] = {}

    def char_bytes(self, c: str) -> bytes:
        return MARK.encode() if c == OWN_MARK else c.encode()

    def words(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of each word; words must be sorted and distinct."""
        found, pieces, root = {}, self.pieces, self.root
        best, back, before = [0.0], [0], ""
        for word in words:
            top = min(len(word), len(before))
            same = next((i for i in range(top) if word[i] != before[i]), top)
            del best[same + 1 :], back[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                score, start, at, node = -1e300, end - 1, end, root
                while at and (node := node.get(word[at - 1])) is not None:
                    at -= 1
                    if (p := node.get("")) is not None and (s := best[at] + p[0]) >= score:  # of equals the longest
                        score, start = s, at
                if word[end - 1] not in pieces and (s := best[end - 1] + self.byte_score * len(self.char_bytes(word[end - 1]))) > score:
                    score, start = s, ~(end - 1)
                best.append(score)
                back.append(start)
            before, at, ids = word, len(word), []
            while at:
                start = back[at]
                if start < 0:
                    start = ~start
                    ids += [self.byte_ids[b] for b in reversed(self.char_bytes(word[start]))]
                else:
                    ids.append(pieces[word[start:at]][1])
                at = start
            found[word] = tuple(reversed(ids))
        return found

    def encode(self, texts: list[str]) -> list[list[int]]:
        split = [[MARK + w for w in t.replace(MARK, OWN_MARK).split(" ")] if t else [] for t in texts]
        fresh = self.words(sorted({w for ws in split for w in ws if w not in self.kept}))
        of = self.kept
        of |= fresh
        found = [[i for w in ws for i in of[w]] for ws in split]
        for w in fresh:
            if len(w) > KEEP_CHARS:
                del of[w]
        if len(of) > KEEP_WORDS:  # what this batch used stays
            self.kept = {w: of[w] for ws in split for w in ws if w in of}
        return found

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids))[1:]


def runs(sizes: list[int], limit: int = RUN_CHARS):
    """(first, how many) of consecutive texts of these sizes, of about `limit` together."""
    lo, held = 0, 0
    for i, size in enumerate(sizes):
        held += size
        if held >= limit or i == len(sizes) - 1:
            yield lo, i + 1 - lo
            lo, held = i + 1, 0


def encode(docs: DataFrame, text: str = "text", model_path: str = DEFAULT_MODEL, carry_text: bool = False) -> DataFrame:
    """docs with ids (array of int), n_ids, and round_trip: whether the ids decode to the text."""
    import zlib

    docs = docs.drop("ids", "n_ids", "round_trip", "decoded_crc32")
    kept = [c for c in docs.columns if c != text or carry_text]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_ids", T.LongType()), T.StructField("round_trip", T.BooleanType()), T.StructField("decoded_crc32", T.LongType())])
    sent = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model_path))

    def run(batches):
        use = Encoder(sent.value)
        for whole in batches:
            column = whole.schema.get_field_index(text)
            sizes = pc.fill_null(pc.binary_length(whole.column(column)), 0).to_pylist()
            for lo, n in runs(sizes):  # texts become Python's a run at a time
                batch = whole.slice(lo, n)
                texts = [t or "" for t in batch.column(column).to_pylist()]
                ids = use.encode(texts)
                back = [use.decode(x) for x in ids]
                ends = np.cumsum([0] + [len(x) for x in ids]).astype(np.int32)
                flat = np.fromiter((i for x in ids for i in x), dtype=np.int32, count=int(ends[-1]))
                out = [
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(np.diff(ends).astype(np.int64)),
                    pa.array([b == t.encode() for b, t in zip(back, texts, strict=True)]), pa.array([zlib.crc32(b) for b in back], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), *out], names=[*kept, "ids", "n_ids", "round_trip", "decoded_crc32"])

    return docs.mapInArrow(run, schema)


def decode(coded: DataFrame, ids: str = "ids", out: str = "text", model_path: str = DEFAULT_MODEL) -> DataFrame:
    """coded with the text of its ids in column `out`; null ids are the empty text."""
    coded = coded.drop(out)
    kept = coded.columns
    sent = coded.sparkSession.sparkContext.broadcast(load_vocabulary(model_path)["raw"])

    def run(batches):
        raw = sent.value
        for batch in batches:
            texts = [b"".join(map(raw.__getitem__, x or ()))[1:].decode("utf-8", "replace") for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, out])

    return coded.mapInArrow(run, T.StructType([*coded.schema.fields, T.StructField(out, T.StringType())]))


def digest(ids: str = "ids"):
    return F.sha2(F.array_join(F.transform(ids, lambda i: i.cast("string")), ","), 256)
