"""Language identification with a byte convolutional network, trained in numpy.

Every text is cut into windows of WINDOW bytes that lie side by side (the last one is padded with
zero bytes), so that the whole text is read. Filters of widths 2, 3 and 4 run over byte
embeddings, each is max-pooled over the window, and a softmax layer gives the window's
probabilities. A text has the mean of its windows' probabilities, weighted by their bytes.

At prediction a filter over embeddings is a sum of table rows, since both are linear: one lookup by
byte pair serves all widths at once, a second one adds what widths 3 and 4 see beyond the pair.

Defined results: a null text, or one without any letter (Unicode category L), is `und` with
score 0; without a single labelled training row every text is `und`; very long texts are read in parts;
an empty table gives no rows. Repeated rows are predicted alike; columns of the input that have the names of the outputs are replaced."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import write_table

WINDOW, DIM, FILTERS, WIDTHS = 192, 8, 8, (2, 3, 4)
#: Different labelled texts of each language that the classifier is fitted on: those of the smallest hashes,
#: so that copies count once. Of more labels than MAX_LANGS the most frequent ones are learned.
SAMPLE_PER_LANG, MAX_LANGS = 500, 256
#: A language's smallest hashes are sought in so many parts first, so that the last step reads PARTS * SAMPLE_PER_LANG rows of it at most.
PARTS = 16
#: Of each of these rows the classifier sees windows of so many characters, drawn by hash from the whole text.
SAMPLE_WINDOWS = (192, 192, 48, 16)
#: Rows that become Python's at a time.
SLICE = 1000
UND = "und"


@dataclass
class Model:
    labels: list[str]
    embedding: np.ndarray  # 256 x DIM
    filters: dict[int, np.ndarray]  # width -> width x DIM x FILTERS
    bias: np.ndarray  # FILTERS of each width
    out: np.ndarray  # all filters x labels
    out_bias: np.ndarray


def letters(text):
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def training_sample(docs: DataFrame, text: str, lang: str, usable, per_lang: int) -> list[tuple[bytes, str]]:
    """Windows of per_lang different texts of each language (all, if fewer): those of the smallest hashes. However often a text
    repeats and however many texts a language has, MAX_LANGS * per_lang * len(SAMPLE_WINDOWS) windows at most reach the driver."""
    rows = docs.where(usable & F.col(lang).isNotNull()).select(F.col(text).alias("t"), F.col(lang).alias("lang")).where(letters(F.col("t")))
    hashed = rows.withColumn("h", F.xxhash64("t", F.lit(7)))
    each = hashed.groupBy("lang", "h").agg(F.count(F.lit(1)).alias("n"))  # copies are counted before they are shuffled
    first = lambda df, *by: df.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("h"))).where(F.col("r") <= per_lang)
    few = first(each.withColumn("part", F.pmod("h", F.lit(PARTS))), "lang", "part")  # however many tasks hold a language
    ranked, _ = write_table(first(few, "lang").select("lang", "h"), "sample")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS)
    names = [r["lang"] for r in counts.collect()]
    if not names:
        return []
    chosen = ranked.where(F.col("lang").isin(names))
    start = lambda i, n: (F.lit(1) + F.pmod(F.xxhash64("t", F.lit(8 + i)), F.greatest(F.length("t") - n + 1, F.lit(1)))).cast("int")
    windows = F.array(*[F.substring(F.col("t"), start(i, n), F.lit(n)) for i, n in enumerate(SAMPLE_WINDOWS)])
    drawn = hashed.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min(windows).alias("ws"))
    return sorted((r["w"].encode()[:WINDOW], r["lang"]) for r in drawn.select(F.explode("ws").alias("w"), "lang").collect())


def as_windows(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows (n x size), how many each text has, and the bytes in each window."""
    counts = np.array([max(1, -(-len(t) // size)) for t in texts], dtype=np.int64)
    flat = b"".join([t.ljust(int(k) * size, b"\0") for t, k in zip(texts, counts, strict=True)])
    used = np.full(int(counts.sum()), size, dtype=np.float32)
    used[np.cumsum(counts) - 1] = [len(t) - (int(k) - 1) * size for t, k in zip(texts, counts, strict=True)]
    return np.frombuffer(flat, dtype=np.uint8).reshape(-1, size), counts, np.maximum(used, 1)


def train(sample: list[tuple[bytes, str]], epochs: int = 14, batch: int = 64, rate: float = 0.01, seed: int = 5) -> Model:
    """Adam on cross entropy; the sample: windows of at most WINDOW bytes, of several lengths, as texts have them."""
    rng = np.random.default_rng(seed)
    labels = sorted({name for _, name in sample})
    x = as_windows([w for w, _ in sample])[0].astype(np.int64)
    y = np.array([labels.index(name) for _, name in sample])
    p = {"e": rng.normal(0, 0.3, (256, DIM)), "b": np.zeros(len(WIDTHS) * FILTERS), "o": rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(labels))), "ob": np.zeros(len(labels))}
    p |= {w: rng.normal(0, 0.3, (w, DIM, FILTERS)) for w in WIDTHS}
    m, v, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(order), batch):
            take = order[lo : lo + batch]
            xb, n = x[take], len(take)
            pooled, spots = [], []
            for w in WIDTHS:
                conv = sum((p["e"] @ p[w][k])[xb[:, k : WINDOW - w + 1 + k]] for k in range(w))
                spot = conv.argmax(axis=1)
                spots.append(spot)
                pooled.append(np.take_along_axis(conv, spot[:, None, :], 1)[:, 0])
            z = np.concatenate(pooled, 1) + p["b"]
            h = np.maximum(z, 0)
            s = h @ p["o"] + p["ob"]
            q = np.exp(s - s.max(1, keepdims=True))
            q /= q.sum(1, keepdims=True)
            q[np.arange(n), y[take]] -= 1
            q /= n
            g = {k: np.zeros_like(a) for k, a in p.items()}
            g["o"], g["ob"] = h.T @ q, q.sum(0)
            dz = (q @ p["o"].T) * (z > 0)
            g["b"] = dz.sum(0)
            for i, w in enumerate(WIDTHS):
                d = dz[:, i * FILTERS : (i + 1) * FILTERS]
                for k in range(w):
                    seen = xb[np.arange(n)[:, None], spots[i] + k]
                    g[w][k] = np.einsum("nf,nfd->df", d, p["e"][seen])
                    np.add.at(g["e"], seen, d[:, :, None] * p[w][k].T[None])
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Model(labels, p["e"], {w: p[w] for w in WIDTHS}, p["b"], p["o"], p["ob"])


class Predictor:
    """The network with its filters folded into lookup tables."""

    def __init__(self, model: Model):
        self.model = model
        e = [(model.embedding @ model.filters[w][k]).astype(np.float32) for w in WIDTHS for k in range(w)]
        by = dict(zip([(w, k) for w in WIDTHS for k in range(w)], e, strict=True))
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        self.first = np.concatenate([pair(by[w, 0], by[w, 1]) for w in WIDTHS], 1)
        self.third = by[3, 2]
        self.last = pair(by[4, 2], by[4, 3])
        self.bias, self.out, self.out_bias = (a.astype(np.float32) for a in (model.bias, model.out, model.out_bias))

    def windows(self, x: np.ndarray, block: int = 48) -> np.ndarray:
        """Probabilities of each window, n x labels."""
        found = np.empty((len(x), len(self.model.labels)), dtype=np.float32)
        f = FILTERS
        for lo in range(0, len(x), block):
            t = np.ascontiguousarray(x[lo : lo + block].T)
            pairs = (t[:-1].astype(np.uint16) << 8) | t[1:]
            a = self.first.take(pairs, axis=0)
            c3 = a[:-1, :, f : 2 * f] + self.third.take(t[2:], axis=0)
            c4 = a[:-2, :, 2 * f :] + self.last.take(pairs[2:], axis=0)
            z = np.concatenate([a[:, :, :f].max(0), c3.max(0), c4.max(0)], 1) + self.bias
            s = np.maximum(z, 0) @ self.out + self.out_bias
            q = np.exp(s - s.max(1, keepdims=True))
            found[lo : lo + block] = q / q.sum(1, keepdims=True)
        return found

    def texts(self, texts: list[bytes], limit: int = 4_000_000) -> tuple[list[str], list[float]]:
        """Labels and scores; texts are taken in runs of about `limit` bytes, a longer one in parts."""
        labels, scores, run, held = [], [], [], 0

        def flush():
            x, counts, used = as_windows(run)
            q = self.windows(x) * used[:, None]
            q = np.add.reduceat(q, np.concatenate([[0], np.cumsum(counts)[:-1]]), axis=0)
            q /= q.sum(1, keepdims=True)
            best = q.argmax(1)
            labels.extend(self.model.labels[i] for i in best)
            scores.extend(q[np.arange(len(best)), best].astype(float).clip(0, 1).tolist())

        for text in texts:
            run.append(text)
            held += len(text)
            if held >= limit:
                flush()
                run, held = [], 0
        if run:
            flush()
        return labels, scores


def predict(docs: DataFrame, model: Model | None, text: str = "text", carry: str | None = None) -> DataFrame:
    """docs with lang_pred and score; the other columns pass through as they are."""
    docs = docs.drop("lang_pred", "score")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UND), "score": F.lit(0.0)})
    kept = [c for c in docs.columns if c != text or carry == text]
    marked = docs.withColumn("__letters", letters(F.col(text)))
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    und = UND

    def run(batches):
        use = Predictor(model)  # some 20 KB in the closure
        for batch in (whole.slice(lo, SLICE) for whole in batches for lo in range(0, whole.num_rows, SLICE)):
            at = batch.schema.get_field_index(text)
            has = batch.column(batch.schema.get_field_index("__letters")).to_pylist()
            raw = batch.column(at).cast(pa.binary() if pa.types.is_string(batch.column(at).type) else pa.large_binary()).to_pylist()
            some = [i for i, ok in enumerate(has) if ok]
            names, scores = [und] * len(raw), [0.0] * len(raw)
            got = use.texts([raw[i] for i in some]) if some else ([], [])
            for i, name, value in zip(some, *got, strict=True):
                names[i], scores[i] = name, value
            cols = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*kept, "lang_pred", "score"])

    return marked.mapInArrow(run, schema)


def fit(docs: DataFrame, usable, text: str = "text", lang: str = "lang", per_lang: int = SAMPLE_PER_LANG) -> Model | None:
    """The network fitted on a sample of the rows where `usable` holds; None without such a row."""
    sample = training_sample(docs, text, lang, usable, per_lang)
    return train(sample) if sample else None


def held_out(doc_id: int | None) -> bool:
    """The contract's fold in Python, for tests."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
