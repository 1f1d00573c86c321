"""Language-model scoring with a causal self-attention model trained in numpy on subword ids.

Texts are words (runs without white space of ASCII, A-Z in lower case) and an end. Words become subword
ids of a public vocabulary by its own library. From the corpus come exact counts of all
training words; from these all counts of pieces, of pairs of pieces within words, and of word starts.

The attention layer reads embeddings of the subword ids themselves and their positions. Its output softmax is factored by
classes: the most frequent pieces have one each, the others share some, and a piece has its share of its class. It stands on
top of the corpus's class bigrams. With Z the attention's distribution over classes and S its share of those that begin a word
or end the text, a word that is spelled has, with a weight m of the pair counts,

- where a word begins: P(id) = m * P(id begins a word, or the text ends) + (1 - m) * Z(class) / S * P(id | class),
- inside a word: P(id) = m * P(id | piece before) + (1 - m) * Z(class) * P(id | class),
- and the word ends with m * P(end | piece before) + (1 - m) * S.

Pair counts here are counts of different words, as it is new words that must be spelled. A word that is known has
Z(class) / S * P(word | class), with the class of its first piece and its share of that class's training words; the text's end is a word of its own
class. Both are mixed with the weights MIX. All these distributions sum to 1 (that of known words where each class has training words).

Word starts that share a class are grouped by their company: after the first round of training, k-means of how often each piece
stands near each of the most frequent word starts. So a class tells a text's language and subject, and the attention finds it in the ids before.

The layer is trained with Adam where the data are: in each round every task trains
on its share of the training documents (each document in one of the rounds, whole), and the tasks' weights are averaged by a tree
of merges, weighted by their ids, an embedding's by how often the task saw its id.

Scoring: windows of CONTEXT + SPAN ids overlap by CONTEXT; each window scores its last SPAN ids only,
so that each id is scored once, with at least CONTEXT ids before it where there are so many. Masked attention
runs over batches of windows.

The base score needs every word's count: the HOT most frequent words are looked up in the scoring tasks,
the others, with their numbers, are joined with the written table of counts. So are the scores of those words and
of pairs past PAIRS finished, by joins with the tables of counts and pairs.

Defined results: a null text is empty, which has the end only; a null doc_id is no training document and not
held out; repeated rows each get their row; without training words all words are unknown. Very long texts are runs of windows as
any other; an empty table gives no rows. Other columns pass through whatever their names are (those named as an output are
replaced)."""

from __future__ import annotations

from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_batches, write_table
from .pieces import DEFAULT_MODEL, runs

DIM, CONTEXT, SPAN, CLASSES = 8, 16, 16, 48
LENGTH = CONTEXT + SPAN
END = CLASSES - 1  # a class; as inputs only there are, after all pieces, the start of a text and what stands for no id
ROUNDS, SLICES, RATE, FAN, BATCH = 2, 32, 0.01, 32, 256
#: Weights of the pair counts inside words and at their beginnings, and of the words that are known, held to KNOWN (None: one
#: less the share of the training tokens that occur once, an estimate of how often a word is new).
MIX, KNOWN = (0.7, 0.7, None), (0.05, 0.99)
#: Words and piece pairs that scoring tasks hold: the most frequent ones.
HOT, PAIRS = 120_000, 400_000
KEEP_WORDS, KEEP_IDS, FLUSH, RUN_BYTES = 300_000, 2_000_000, 200_000, 1_000_000
SINGLE_STARTS, SINGLE_INNER, GROUP_STARTS, GROUP_INNER = 16, 4, 24, 3
STARTS = SINGLE_STARTS + GROUP_STARTS  # the first classes are those of word starts
REACH = 3  # words on each side whose classes make a word start's company


def raw_texts(batch, name: str) -> list[bytes]:
    col = batch.column(batch.schema.get_field_index(name))
    col = col.cast(pa.binary() if pa.types.is_string(col.type) else pa.large_binary())
    return [t or b"" for t in col.to_pylist()]


def text_runs(batches, name: str):
    """(rows, their texts) of about RUN_BYTES of text each, so that a batch's texts are never Python's together."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(name))
        for lo, n in runs(pc.fill_null(pc.binary_length(column), 0).to_pylist(), RUN_BYTES):
            yield batch.slice(lo, n), column.slice(lo, n)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of the texts, the last being the end; all words by their numbers there, each text with its end; and how many each text has."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    counts, flat = pc.list_value_length(parts).to_numpy().astype(np.int64), parts.flatten()
    full = pc.binary_length(flat).to_numpy() > 0  # white space at a text's beginning or end gives empty parts
    if not full.all():
        counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[full], minlength=len(counts))
        flat = flat.filter(pa.array(full))
    coded, counts = flat.dictionary_encode(), counts + 1
    codes, inner = np.full(int(counts.sum()), len(coded.dictionary), dtype=np.int32), np.ones(int(counts.sum()), dtype=bool)
    inner[np.cumsum(counts) - 1] = False
    codes[inner] = coded.indices.to_numpy()
    return pa.concat_arrays([coded.dictionary, pa.array([""], flat.type)]), codes, counts


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(token, c) over all texts; the token '' is the end of a text."""

    def run(batches):
        from collections import Counter

        held: Counter = Counter()

        def flush():
            keys = [k.decode("utf-8", "replace") for k in held]
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(list(held.values()), pa.int64())], names=["token", "n"])

        for batch, _ in text_runs(batches, text):
            for raw in raw_texts(batch, text):
                held.update(raw.lower().split())
                held[b""] += 1
                if len(held) >= FLUSH:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    return docs.select(text).mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("c"))


class Subwords:
    """Ids of words: the first begins a word, the others don't. A word of other pieces, or of none, is the unknown piece."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = self.sp.get_piece_size()
        self.begin = self.starts()

    def ids(self, words: list[str]) -> list[list[int]]:
        ids, sizes = self.flat(words)
        ends, ids = np.cumsum(sizes).tolist(), ids.tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def flat(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other, and how many each word has."""
        coded = self.sp.encode(words, num_threads=1)
        sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        ids = np.fromiter(chain.from_iterable(coded), dtype=np.int64, count=int(sizes.sum()))
        del coded
        ends = np.cumsum(sizes)
        begins = np.concatenate([[0], np.cumsum(self.begin[ids])])
        whole = (sizes > 0) & (begins[ends] - begins[ends - sizes] == 1)  # one piece begins a word, and it is the first
        whole[whole] = self.begin[ids[(ends - sizes)[whole]]]
        if not whole.all():
            kept = np.repeat(whole, sizes)
            many = np.where(whole, sizes, 1)
            out = np.zeros(int(many.sum()), dtype=np.int64)
            out[np.repeat(whole, many)] = ids[kept]
            ids, sizes = out, many
        return ids, sizes

    def starts(self) -> np.ndarray:
        """Which pieces begin a word; the unknown piece does."""
        return np.array([i == 0 or self.sp.id_to_piece(i).startswith("\u2581") for i in range(self.size)])


def piece_pairs(counts: DataFrame, sent) -> DataFrame:
    """(a, b, n, t): how often piece b follows a within words, and in how many different words; a = -1: b starts a word; b = -1: a ends one."""

    def run(batches):
        use = Subwords(sent.value)
        held: dict[int, int] = {}
        kinds: dict[int, int] = {}

        def flush():
            keys = np.fromiter(held.keys(), dtype=np.int64, count=len(held))
            return pa.RecordBatch.from_arrays([pa.array((keys >> 20).astype(np.int32) - 1), pa.array((keys & 0xFFFFF).astype(np.int32) - 1), pa.array(list(held.values()), pa.int64()), pa.array(list(kinds.values()), pa.int64())], names=["a", "b", "n", "t"])

        for batch in batches:
            tokens, ns = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for n, ids in zip(ns, use.ids(tokens), strict=True):
                before = 0
                for i in (*ids, -1):
                    key = before << 20 | i + 1
                    held[key] = held.get(key, 0) + n
                    kinds[key] = kinds.get(key, 0) + 1  # the same keys in the same order
                    before = i + 1
            if len(held) >= FLUSH:
                yield flush()
                held.clear()
                kinds.clear()
        if held:
            yield flush()

    parts = counts.where("token <> ''").select("token", "c").mapInArrow(run, "a int, b int, n long, t long")
    return parts.groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))


def classes_of(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A class for each piece id: the most frequent word starts and inner pieces have one each, the rest
    share classes of about equal mass, by frequency."""
    found, at = np.zeros(len(starts), dtype=np.int64), 0
    for kind, single, groups in ((True, SINGLE_STARTS, GROUP_STARTS), (False, SINGLE_INNER, GROUP_INNER)):
        ids = np.flatnonzero(starts == kind)
        ids = ids[np.lexsort((ids, -counts[ids]))]
        found[ids[:single]] = at + np.arange(min(single, len(ids)))
        rest = ids[single:]
        mass = np.cumsum(counts[rest] + 0.5)
        if len(rest):
            found[rest] = at + single + np.minimum((mass - mass[0]) / mass[-1] * groups, groups - 1).astype(np.int64)
        at += single + groups
    return found


def company(kinds: np.ndarray, firsts: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """A key (piece * SINGLE_STARTS + class) for each word of a single class within REACH words of a word's first piece.

    kinds, firsts, texts: each word's class, its first piece, and which text it stands in."""
    keys = []
    for d in range(1, REACH + 1):
        same = texts[d:] == texts[:-d]
        for piece, near in ((firsts[d:], kinds[:-d]), (firsts[:-d], kinds[d:])):
            take = same & (near < SINGLE_STARTS)
            keys.append(piece[take] * SINGLE_STARTS + near[take])
    return np.concatenate(keys)


def regrouped(cls: np.ndarray, starts: np.ndarray, near: np.ndarray, rounds: int = 20) -> np.ndarray:
    """The classes, with the grouped word starts grouped anew by their company: k-means of its square roots, each piece with
    the weight of its company. near: pieces x SINGLE_STARTS. Pieces without company stay where they are."""
    found, weight = cls.copy(), near.sum(1)
    ids = np.flatnonzero(starts & (cls >= SINGLE_STARTS) & (cls < STARTS) & (weight > 0))
    ids = ids[np.lexsort((ids, -weight[ids]))]
    if len(ids) < GROUP_STARTS:
        return found
    x, w = np.sqrt((near[ids] + 0.5 * near.sum(0) / near.sum()) / (weight[ids] + 0.5)[:, None]), weight[ids]
    centres, far = x[:1], np.full(len(ids), np.inf)
    while len(centres) < GROUP_STARTS:  # next the piece that is farthest from all centres, by distance and weight
        far = np.minimum(far, ((x - centres[-1]) ** 2).sum(1))
        centres = np.concatenate([centres, x[[np.argmax(far * w)]]])
    for _ in range(rounds):
        group = np.argmin((centres**2).sum(1) - 2 * x @ centres.T, axis=1)
        mass = np.bincount(group, w, GROUP_STARTS)
        sums_ = np.stack([np.bincount(group, w * x[:, j], GROUP_STARTS) for j in range(x.shape[1])], axis=1)
        centres = np.where(mass[:, None] > 0, sums_ / np.maximum(mass, 1e-9)[:, None], centres)
    found[ids] = SINGLE_STARTS + group
    return found


def initial(bigrams: np.ndarray, inputs: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    """The layer as training begins. bigrams: log-probabilities of classes after each input class; inputs: the input class of each id."""
    rng = np.random.default_rng(seed)
    p = {"e": rng.normal(0, 0.3, (len(inputs), DIM)), "p": rng.normal(0, 0.1, (LENGTH, DIM)), "o": rng.normal(0, 0.05, (DIM, CLASSES))}
    p |= {k: rng.normal(0, 0.3, (DIM, DIM)) for k in ("q", "k", "v")}
    return {k: a.astype(np.float32) for k, a in p.items()} | {"bigrams": bigrams.astype(np.float32), "inputs": inputs}


FIXED = ("bigrams", "inputs")
ALLOWED = (np.arange(LENGTH)[None] <= np.arange(CONTEXT, LENGTH)[:, None]).astype(np.float32)
#: The classes that begin a word or end the text, and all.
OPENING = np.stack([(np.arange(CLASSES) < STARTS) | (np.arange(CLASSES) == END), np.ones(CLASSES)], axis=1).astype(np.float32)


def windows(stream: np.ndarray, sizes: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Inputs (n x LENGTH) and where each target stands in the stream (n x SPAN; -1: none).

    stream: the ids of all texts, one after the other; sizes: how many each text has; pad: what stands for no id, after the
    id of a text's start."""
    counts = -(-sizes // SPAN)
    begin = np.repeat(np.cumsum(sizes) - sizes, counts)
    size = np.repeat(sizes, counts)
    number = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    begin, size = begin.astype(np.int32), size.astype(np.int32)[:, None]
    at = (number * SPAN).astype(np.int32)[:, None] + np.arange(-CONTEXT, SPAN, dtype=np.int32)
    ids = stream.astype(np.int32, copy=False).take(begin[:, None] + at - 1, mode="clip")
    ids[(at < 0) | (at >= size)] = pad
    ids[at == 0] = pad - 1
    goal = at[:, CONTEXT:]
    return ids, np.where(goal < size, begin[:, None] + goal, np.int32(-1))


def sums(m: np.ndarray) -> np.ndarray:
    """Sums over the last axis, which stays, as one product."""
    return (m.reshape(-1, m.shape[-1]) @ np.ones(m.shape[-1], np.float32)).reshape(*m.shape[:-1], 1)


def forward(p: dict, ids: np.ndarray, logs: bool = True):
    """Class probabilities of the SPAN last positions (logs: their natural logarithms), and what the backward pass needs.

    Exponents are held to 40 instead of being shifted, as in attention_scores()."""
    by = lambda m, w: (m.reshape(-1, m.shape[-1]) @ w).reshape(*m.shape[:2], -1)  # noqa: E731  one product for all windows
    x = p["e"].take(ids, 0)
    x += p["p"]
    xq = np.ascontiguousarray(x[:, CONTEXT:])
    q, k, v = by(xq, p["q"] * np.float32(DIM**-0.5)), by(x, p["k"]), by(x, p["v"])
    a = q @ k.transpose(0, 2, 1)
    np.clip(a, -40, 40, out=a)
    np.exp(a, out=a)
    a *= ALLOWED
    void = ids == len(p["inputs"]) - 1
    if len(cut := np.flatnonzero(void.any(1))):
        a[cut] *= ~void[cut][:, None, :]
    a /= sums(a) + np.float32(1e-30)
    h = a @ v
    h += xq
    z = by(h, p["o"])
    np.clip(z, -40, 40, out=z)
    np.exp(z, out=z)
    z *= np.exp(p["bigrams"]).take(p["inputs"].take(ids[:, CONTEXT:]), 0)
    z /= sums(z)
    return np.log(z) if logs else z, (x, xq, q, k, v, a, h)


def backward(p: dict, ids: np.ndarray, goals: np.ndarray, weight: np.ndarray, z: np.ndarray, saved, logs: bool = True) -> dict:
    """Gradients of the mean loss; that of the embeddings as (ids, rows, how often each id occurs). z, logs: as in forward()."""
    x, xq, q, k, v, a, h = saved
    flat = lambda m: m.reshape(-1, m.shape[-1])
    by = lambda m, w: (flat(m) @ w).reshape(*m.shape[:2], -1)
    share, scale = weight / max(weight.sum(), 1), np.float32(DIM**-0.5)
    dz = (np.exp(z) if logs else z) * share[:, :, None]
    flat(dz)[np.arange(goals.size), goals.ravel()] -= share.ravel()
    g = {"o": flat(h).T @ flat(dz)}
    dh = by(dz, p["o"].T)
    da = dh @ v.transpose(0, 2, 1)
    da *= a
    da -= sums(da) * a
    dq, dk, dv = da @ k, da.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ dh
    g |= {"q": flat(xq).T @ flat(dq) * scale, "k": flat(x).T @ flat(dk), "v": flat(x).T @ flat(dv)}
    dx = by(dk, p["k"].T)
    dx += by(dv, p["v"].T)
    dh += by(dq, p["q"].T * scale)
    dx[:, CONTEXT:] += dh
    g["p"] = dx.sum(0)
    key = ids.ravel()
    if len(p["inputs"]) <= 65536:
        key = key.astype(np.uint16)  # sorted by radix
    order = np.argsort(key, kind="stable")
    row = key[order]
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    g["e"] = (row[first].astype(np.int64), np.add.reduceat(flat(dx).take(order, 0), first, axis=0), np.diff(np.append(first, len(row))))
    return g


class Trainer:
    """Adam over the attention layer; the bigrams stay as counted. An embedding is moved where its id occurs."""

    def __init__(self, params: dict):
        self.p = {k: a.copy() for k, a in params.items()}
        self.m = {k: np.zeros_like(a) for k, a in params.items() if k not in FIXED}
        self.v = {k: np.zeros_like(a) for k, a in self.m.items()}
        self.steps, self.seen, self.met = 0, 0, np.zeros(len(params["inputs"]))

    def move(self, k: str, at, g: np.ndarray, rate: float) -> None:
        self.m[k][at] = m = 0.9 * self.m[k][at] + 0.1 * g
        self.v[k][at] = v = 0.99 * self.v[k][at] + 0.01 * g**2
        self.p[k][at] -= (rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.99**self.steps)) + 1e-6)).astype(np.float32)

    def learn(self, stream: np.ndarray, cls: np.ndarray, sizes: np.ndarray, batch: int = BATCH) -> None:
        ids, places = windows(stream, sizes, len(self.p["inputs"]) - 1)
        order = np.random.default_rng(self.steps).permutation(len(ids))
        for lo in range(0, len(order), batch):
            take = order[lo : lo + batch]
            weight = (places[take] >= 0).astype(np.float32)
            goals = cls[np.maximum(places[take], 0)]
            here = ids[take]
            z, saved = forward(self.p, here, logs=False)
            g = backward(self.p, here, goals, weight, z, saved, logs=False)
            self.steps += 1
            rate = RATE / (1 + self.steps / 400) ** 0.5
            rows, grads, times = g.pop("e")
            self.met[rows] += times
            self.move("e", rows, grads, rate)
            for k in g:
                self.move(k, slice(None), g[k], rate)
            self.seen += int(weight.sum())


class Words:
    """What is known of each word, in flat arrays: its pieces and their pair probabilities, and its base score."""

    def __init__(self, model: bytes, tables: dict):
        self.subwords, self.t = Subwords(model), tables
        self.hot = dict(zip(tables["hot"], tables["hot_c"].tolist(), strict=True))
        self.index: dict[bytes, int] = {b"": 0}
        c = self.hot.get(b"")
        self.arrays = [
            np.ones(1, np.int32), np.zeros(1, np.int64), np.array([0.0 if c is None else np.log10(c + 1)]), np.array([-1 if c is None else 1], np.int8), self.log_share(np.array([c or 0])),
            np.array([self.subwords.size], np.int32), np.array([self.t["end_p"]], np.float32),
        ]

    def reset(self) -> None:
        """Forget all but the end and the hot words."""
        names = [w for w in self.index if not w or w in self.hot]
        keep = np.fromiter(map(self.index.__getitem__, names), dtype=np.int64, count=len(names))
        sizes, offs, base, known, share, *by_id = self.arrays
        n = sizes[keep]
        begin = np.cumsum(n, dtype=np.int64) - n
        at = np.arange(int(n.sum())) + np.repeat(offs[keep] - begin, n)
        self.index = {w: i for i, w in enumerate(names)}
        self.arrays = [n, begin, base[keep], known[keep], share[keep], *(a[at] for a in by_id)]

    def add(self, new: list[bytes]) -> None:
        """Put words into the arrays, all at once."""
        if not new:
            return
        t, names = self.t, list(new)
        ids, sizes = self.subwords.flat([w.decode("utf-8", "replace") for w in names])
        begin = np.cumsum(sizes) - sizes
        before = np.concatenate([[0], ids[:-1] + 1])
        before[begin] = 0
        keys, have = before << 20 | ids + 1, t["pair_keys"]
        pair = np.full(len(ids), -1, np.float32)
        if len(have):
            at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
            pair = np.where(have[at] == keys, t["pair_p"][at], np.float32(-1))
        c = np.fromiter(map(self.hot.get, names, repeat(-1)), dtype=np.int64, count=len(names))
        first = len(self.index)
        self.index.update(zip(names, range(first, first + len(names)), strict=True))
        fresh = [sizes, begin + len(self.arrays[5]), np.where(c < 0, 0.0, np.log10(np.maximum(c, 0) + 1.0)), np.sign(c), self.log_share(c), ids, pair]
        for i, x in enumerate(fresh):
            self.arrays[i] = np.concatenate([self.arrays[i], x.astype(self.arrays[i].dtype, copy=False)])

    def flat(self):
        return self.arrays

    def log_share(self, c: np.ndarray) -> np.ndarray:
        """Natural logarithm of a word's count in the training words; very low where it is not known here."""
        return np.log(np.maximum(c, 1e-300))

    def share_of(self, numbers: np.ndarray) -> np.ndarray:
        return self.arrays[4][numbers]

    def texts(self, texts: pa.Array):
        """Words of the texts as numbers, with an end each, how many each text has, and the words, each kept once."""
        if len(self.index) > KEEP_WORDS or len(self.arrays[5]) > KEEP_IDS:
            self.reset()
        kinds, codes, counts = split_words(texts)
        names = kinds.cast(pa.large_binary()).to_pylist()
        numbers = np.fromiter(map(self.index.get, names, repeat(-1)), dtype=np.int64, count=len(names))
        unseen = np.flatnonzero(numbers < 0)
        numbers[unseen] = len(self.index) + np.arange(len(unseen))
        self.add([names[i] for i in unseen.tolist()])
        return numbers[codes], counts, pa.DictionaryArray.from_arrays(codes, kinds)

    def stream(self, numbers: np.ndarray, counts: np.ndarray):
        """All ids, where they stand in the arrays, ids of each text, and where words begin."""
        sizes, offs, *_ = self.arrays
        n = sizes[numbers].astype(np.int64)
        ends = np.cumsum(n)
        at = np.arange(int(ends[-1])) + np.repeat(offs[numbers] - (ends - n), n)
        per_text = np.add.reduceat(n, np.cumsum(counts) - counts)
        return self.arrays[5][at], at, per_text, ends - n


def train(docs: DataFrame, text: str, params: dict, vocabulary, tables) -> tuple[dict, DataFrame]:
    """One round: each task trains on its rows; weights are averaged by a tree of merges. And the word starts' company (k, n)."""
    names = sorted(k for k in params if k not in (*FIXED, "e"))
    shapes = {k: params[k].shape for k in names}
    sent, many = docs.sparkSession.sparkContext.broadcast(params), len(params["inputs"])

    def run(batches):
        words, trainer = Words(vocabulary.value, tables.value), Trainer(sent.value)
        classes = tables.value["cls"]
        near = np.zeros((many - 1) * SINGLE_STARTS, dtype=np.int64)
        for _, texts in text_runs(batches, text):
            numbers, counts, _ = words.texts(texts)
            ids, _, sizes, starts = words.stream(numbers, counts)
            trainer.learn(ids, classes[ids], sizes)
            near += np.bincount(company(classes[ids[starts]], ids[starts], np.repeat(np.arange(len(texts)), counts)), minlength=len(near))
        if trainer.seen:
            row = np.concatenate([trainer.seen * np.concatenate([trainer.p[k].ravel() for k in names]).astype(np.float64), (trainer.p["e"] * trainer.met[:, None]).ravel(), trainer.met])
            whole = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), pa.array(a))
            held = np.flatnonzero(near)
            yield pa.RecordBatch.from_arrays([pa.array([float(trainer.seen)]), whole(row), whole(held), whole(near[held])], names=["w", "v", "k", "n"])

    with byte_batches(docs.sparkSession):
        made, _ = write_table(docs.select(text).mapInArrow(run, "w double, v array<double>, k array<long>, n array<long>").withColumn("part", F.spark_partition_id()), "weights")
    met = made.select(F.explode(F.arrays_zip("k", "n")).alias("x")).groupBy("x.k").agg(F.sum("x.n").alias("n"))
    parts = made.select("w", "v", "part")
    left = parts.agg(F.max("part")).first()[0]
    if left is None:
        return params, met
    left += 1

    def merge(pdf):
        import pandas as pd

        return pd.DataFrame({"w": [pdf["w"].sum()], "v": [np.sum(np.stack(pdf["v"].to_list()), axis=0)], "part": [int(pdf["part"].iloc[0]) // FAN]})

    while left > 1:
        parts, _ = write_table(parts.groupBy((F.col("part") / FAN).cast("int").alias("g")).applyInPandas(merge, "w double, v array<double>, part int"), "weights")
        left = -(-left // FAN)
    one = parts.toPandas()
    total, row, at, found = one["w"][0], np.asarray(one["v"][0]), 0, {k: params[k] for k in FIXED}
    for k in names:
        n = int(np.prod(shapes[k]))
        found[k] = (row[at : at + n] / total).reshape(shapes[k]).astype(np.float32)
        at += n
    e, times = row[at : at + many * DIM].reshape(many, DIM), row[at + many * DIM :]
    found["e"] = np.where(times[:, None] > 0, e / np.maximum(times, 1)[:, None], params["e"]).astype(np.float32)
    return found, met


def attention_tables(p: dict):
    """What attention_scores() takes from tables: keys, values, queries and the embedding itself of each id and each position."""
    scale = np.float32(DIM**-0.5)
    split = lambda x: np.concatenate([x @ p["k"], x @ p["v"], x @ p["q"] * scale, x], axis=1)
    ids, places = split(p["e"]), split(p["p"])
    longest = lambda m, j: np.sqrt((m[:, j * DIM : (j + 1) * DIM] ** 2).sum(1)).max()
    both = [longest(ids, j) + longest(places, j) for j in range(4)]
    hold_a = both[2] * both[0] > 40
    hold_z = (both[3] + both[1]) * np.sqrt((p["o"] ** 2).sum(0)).max() > 40
    one = lambda m, value: np.concatenate([m[:, : 2 * DIM], np.full((len(m), 1), value, np.float32)], axis=1)  # noqa: E731  a value that sums the weights
    return one(ids, 1), one(places, 0), np.ascontiguousarray(ids[:, 2 * DIM :]), places[CONTEXT:, 2 * DIM :], hold_a, hold_z, np.exp(p["bigrams"])


def attention_scores(p: dict, tables, stream: np.ndarray, cls: np.ndarray, sizes: np.ndarray, block: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Of every id of the stream, each scored once: P(its class | ids before), and the share S of classes that begin a word or
    end the text.

    As forward(), with what depends on an id or a position taken from tables, and without logarithms:
    exponents are held to 40 where the tables' lengths don't bound them already, so nothing is shifted."""
    own_kv, place_kv, own_q, place_q, hold_a, hold_z, odds = tables
    pad = len(p["inputs"]) - 1
    ids, places = windows(stream, sizes, pad)
    void = ids == pad
    ragged = void.any(1)  # at the ends of texts
    found, opens = np.empty(len(stream), dtype=np.float32), np.empty(len(stream), dtype=np.float32)
    for lo in range(0, len(ids), block):
        here = slice(lo, lo + block)
        kv = own_kv.take(ids[here], 0)
        kv += place_kv
        qx = own_q.take(ids[here, CONTEXT:], 0)
        qx += place_q
        a = qx[..., :DIM] @ kv[..., :DIM].transpose(0, 2, 1)
        if hold_a:
            np.clip(a, -40, 40, out=a)
        np.exp(a, out=a)
        a *= ALLOWED
        if len(cut := np.flatnonzero(ragged[here])):
            a[cut] *= ~void[here][cut][:, None, :]
        h = a @ kv[..., DIM:]
        h, whole = h[..., :DIM], h[..., DIM:]
        h /= np.maximum(whole, np.float32(1e-30))
        h += qx[..., DIM:]
        seen = places[here] >= 0
        z = h[seen] @ p["o"]
        if hold_z:
            np.clip(z, -40, 40, out=z)
        np.exp(z, out=z)
        goal, before = places[here][seen], p["inputs"].take(ids[here, CONTEXT:][seen])
        to = cls[goal]
        z *= odds.take(before, 0)
        both = z @ OPENING
        found[goal] = z[np.arange(len(to)), to] / both[:, 1]
        opens[goal] = both[:, 0] / both[:, 1]
    return found, opens


def class_tables(pairs: DataFrame, cls: np.ndarray, unigrams: np.ndarray, texts: int, end_p: float) -> tuple[dict, dict]:
    """What goes by the classes of pieces: shares and counts for the scoring tasks, and the layer as training begins."""
    spark = pairs.sparkSession
    mass = np.bincount(cls, unigrams + 0.5, minlength=CLASSES)
    inner = ((unigrams + 0.5) / mass[cls]).astype(np.float32)
    mapped = spark.createDataFrame([(int(i), int(c)) for i, c in enumerate(cls)] + [(-1, -1)], "i int, c int")  # one row a piece
    at, to = F.broadcast(mapped.withColumnsRenamed({"i": "a", "c": "ca"})), F.broadcast(mapped.withColumnsRenamed({"i": "b", "c": "cb"}))
    table = np.zeros((CLASSES + 1, CLASSES + 1))  # the last row: word starts; the last column: word ends
    for r in pairs.join(at, "a").join(to, "b").groupBy("ca", "cb").agg(F.sum("n").alias("n")).collect():
        table[r["ca"], r["cb"]] = r["n"]
    class_words = table[CLASSES, :CLASSES].copy()  # training words by the class of their first piece; the ends of texts
    class_words[END] = texts
    start = (table[CLASSES, :CLASSES] + 0.01) / (table[CLASSES, :CLASSES] + 0.01).sum() * (1 - end_p)
    start[END] = end_p
    start /= start.sum()
    joint = table[:CLASSES, :CLASSES] + table[:CLASSES, CLASSES][:, None] * start[None] + 0.5 * start[None]
    rows = np.concatenate([joint / joint.sum(1, keepdims=True), start[None], np.full((1, CLASSES), 1 / CLASSES)])
    inputs = np.concatenate([cls, [CLASSES, CLASSES + 1]])  # of the start of a text, and of no id
    known = {"cls": np.append(cls, END), "inner": np.append(inner, np.float32(1)), "class_words": np.log(np.maximum(class_words, 1))}
    return known, initial(np.log(np.maximum(rows, 1e-12)), inputs)


def fit(docs: DataFrame, text: str, slice_of, model_path: str = DEFAULT_MODEL, mix: tuple[float, float, float | None] = MIX):
    """Counts table, totals, and what the scoring tasks need. docs: the training documents; slice_of: their slice."""
    spark = docs.sparkSession
    with byte_batches(spark):
        counts, _ = write_table(word_counts(docs, text), "counts")
    n, v, once = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.count(F.when(F.col("c") == 1, 1))).first()
    mix = (*mix[:2], float(np.clip(1 - once / max(1, n), *KNOWN)) if mix[2] is None else mix[2])
    with open(model_path, "rb") as f:
        proto = f.read()
    vocabulary, subwords = spark.sparkContext.broadcast(proto), Subwords(proto)
    pairs, _ = write_table(piece_pairs(counts, vocabulary), "pairs")
    unigrams = np.zeros(subwords.size)
    for r in pairs.where("b >= 0").groupBy("b").agg(F.sum("n").alias("n")).collect():  # at most one row a piece
        unigrams[r["b"]] = r["n"]
    texts = (counts.where("token = ''").first() or [None, 0])[1]
    end_p = (texts + 0.5) / (n + 1)
    cls = classes_of(subwords.starts(), unigrams)
    known, params = class_tables(pairs, cls, unigrams, texts, end_p)
    hot = counts.orderBy(F.desc("c"), "token").limit(HOT).collect()  # HOT rows
    before = pairs.where("b >= 0 OR a >= 0").groupBy("a").agg(F.sum("t").alias("total"))
    shares = pairs.where("b >= 0").join(F.broadcast(before), "a")  # totals: one row a piece
    key, p = (F.col("a") + 1).cast("long") * 1048576 + F.col("b") + 1, F.when(F.col("a") < 0, 1 - end_p).otherwise(1.0) * F.col("t") / F.col("total")
    top = shares.orderBy(F.desc("t"), "a", "b").limit(PAIRS).select(key.alias("k"), p.alias("p")).orderBy("k").toPandas()
    ends = np.zeros(subwords.size + 1, np.float32)
    for r in pairs.where("b = -1").join(F.broadcast(before), "a").select("a", (F.col("t") / F.col("total")).alias("p")).collect():  # at most one row a piece
        ends[r["a"]] = r["p"]
    tables = known | {"ends": ends, "pair_keys": top["k"].to_numpy(np.int64), "pair_p": top["p"].to_numpy(np.float32), "end_p": float(end_p), "hot": [r["token"].encode() for r in hot], "hot_c": np.array([r["c"] for r in hot], dtype=np.int64)}
    for r in range(ROUNDS):
        sent = spark.sparkContext.broadcast(tables)
        params, met = train(docs.where(F.coalesce(slice_of, F.lit(0)) % ROUNDS == r), text, params, vocabulary, sent)
        if r == 0:  # the classes of the other rounds go by the company that word starts have in this one
            near = np.zeros((subwords.size + 1, SINGLE_STARTS))
            for x in met.collect():  # at most one row a word start and single class
                near[divmod(x["k"], SINGLE_STARTS)] = x["n"]
            cls = regrouped(cls, subwords.starts(), near[:-1])
            known, fresh = class_tables(pairs, cls, unigrams, texts, end_p)
            tables, moved = tables | known, slice(SINGLE_STARTS, STARTS)
            params = params | {k: fresh[k] for k in FIXED} | {"o": np.concatenate([params["o"][:, : moved.start], fresh["o"][:, moved], params["o"][:, moved.stop :]], axis=1)}
    sent = spark.sparkContext.broadcast(tables)
    return {"counts": counts, "pairs": shares.select(key.alias("k"), p.alias("p")), "n": int(n), "v": int(v), "words": int(n - texts), "params": params, "mix": np.array(mix), "vocabulary": vocabulary, "tables": sent}


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """docs without the text, with n_tokens, n_known, n_ids, train_tokens, base_score and score (log10)."""
    docs = docs.drop("n_tokens", "n_known", "n_ids", "train_tokens", "base_score", "score")
    kept = [c for c in docs.columns if c != text]
    vocabulary, tables, mix = (model[k] for k in ("vocabulary", "tables", "mix"))
    layer = docs.sparkSession.sparkContext.broadcast(model["params"])

    def run(batches):
        words, params, t = Words(vocabulary.value, tables.value), layer.value, tables.value
        lookup = attention_tables(params)
        for part, texts in text_runs(batches, text):
            numbers, counts, tokens = words.texts(texts)
            _, _, base, known, *_ = words.flat()
            begin = np.cumsum(counts) - counts
            state = known[numbers]
            ids, spot, sizes, starts = words.stream(numbers, counts)
            pair = words.flat()[6][spot]
            del spot
            found, opens = attention_scores(params, lookup, ids, t["cls"][ids], sizes)
            m, other = np.full(len(ids), mix[0]), found * t["inner"][ids]
            m[starts] = mix[1]
            other[starts] = found[starts] / np.maximum(opens[starts], np.float32(1e-30)) * t["inner"][ids[starts]]
            other = (1 - m) * other
            lack = pair < 0
            spelled = m * pair
            spelled += other
            spelled[lack] = 1
            spelled = np.add.reduceat(np.log(np.maximum(spelled, 1e-300, out=spelled), out=spelled), starts)
            kind = t["cls"][ids[starts]]  # what the layer expects of a word that is known: its class here, by the class's words
            due = np.log(np.maximum(found[starts] / np.maximum(opens[starts], 1e-30), 1e-300)) - t["class_words"][kind]
            inner_words = np.ones(len(starts), dtype=bool)
            inner_words[begin + counts - 1] = False  # the ends of texts
            after = starts[np.flatnonzero(inner_words) + 1]  # where the next word begins
            spelled[inner_words] += np.log(np.maximum(mix[0] * t["ends"][ids[after - 1]] + (1 - mix[0]) * opens[after], 1e-300))
            lacks = np.add.reduceat(lack.astype(np.int32), starts)
            rare = state < 0
            late = rare | (lacks > 0)
            by_word = spelled + np.log(1 - mix[2])
            total = np.add.reduceat(np.where(late, 0.0, np.logaddexp(by_word, words.share_of(numbers) + due + np.log(mix[2]))), begin) * np.log10(np.e)
            ends = np.concatenate([[0], np.cumsum(np.add.reduceat(late.astype(np.int32), begin))]).astype(np.int32)
            here = np.flatnonzero(late)
            at = np.concatenate([[0], np.cumsum(lacks[here])]).astype(np.int32)
            asked, first = np.flatnonzero(lack), np.zeros(len(ids), dtype=bool)
            first[starts] = True
            before = np.where(first[asked], 0, ids[asked - 1].astype(np.int64) + 1)
            pieces = pa.StructArray.from_arrays([pa.array(before << 20 | ids[asked] + 1), pa.array(m[lack]), pa.array(other[lack].astype(np.float64))], names=["k", "m", "o"])
            each = [
                tokens.take(pa.array(here)).dictionary_decode().cast(pa.string()), pa.array(rare[here]), pa.array(spelled[here]),
                pa.array(words.share_of(numbers)[here]), pa.array(due[here]), pa.ListArray.from_arrays(pa.array(at), pieces),
            ]
            cold = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(each, names=["token", "rare", "spelled", "share", "due", "pieces"]))
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(part.schema.get_field_index(c)) for c in (*kept, "__rid")), pa.array(counts), pa.array(np.add.reduceat((state > 0).astype(np.int64), begin)), pa.array(sizes),
                    pa.array(np.add.reduceat(base[numbers], begin)), pa.array(total), cold,
                ],
                names=[*kept, "__rid", "n_tokens", "__known", "n_ids", "__base", "score", "__cold"],
            )

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    schema = (fields + ", " if fields else "") + "__rid long, n_tokens long, __known long, n_ids long, __base double, score double, __cold array<struct<token:string,rare:boolean,spelled:double,share:double,due:double,pieces:array<struct<k:long,m:double,o:double>>>>"
    with byte_batches(docs.sparkSession):
        found, _ = write_table(docs.withColumn("__rid", F.monotonically_increasing_id()).mapInArrow(run, schema), "scored")
    late = found.select("__rid", F.posexplode("__cold").alias("__w", "x")).select("__rid", "__w", "x.*")
    ask = late.select("__rid", "__w", F.explode("pieces").alias("x")).select("__rid", "__w", "x.*").join(model["pairs"], "k", "left")
    ask = ask.groupBy("__rid", "__w").agg(F.sum(F.log(F.greatest(F.col("m") * F.coalesce("p", F.lit(0.0)) + F.col("o"), F.lit(1e-300)))).alias("asked"))
    late = late.drop("pieces").join(ask, ["__rid", "__w"], "left").join(model["counts"].select("token", "c"), "token", "left")
    counted = F.col("rare") & F.col("c").isNotNull()
    spelled = F.col("spelled") + F.coalesce("asked", F.lit(0.0)) + F.lit(float(np.log(1 - mix[2])))
    share = F.when(~F.col("rare"), F.col("share")).when(counted, F.log("c")).otherwise(F.lit(float(np.log(1e-300)))) + F.col("due") + F.lit(float(np.log(mix[2])))
    mixed = F.greatest(spelled, share) + F.log1p(F.exp(-F.abs(spelled - share)))
    rare = late.groupBy("__rid").agg(F.count(F.when(counted, 1)).alias("__more"), F.sum(F.when(counted, F.log10(F.col("c") + 1))).alias("__rare"), (F.sum(mixed) * F.lit(float(np.log10(np.e)))).alias("__late"))
    whole = found.join(rare, "__rid", "left")
    return whole.select(
        *kept, "n_tokens", (F.col("__known") + F.coalesce("__more", F.lit(0))).alias("n_known"), F.lit(model["n"]).cast("long").alias("train_tokens"),
        (F.col("__base") + F.coalesce("__rare", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(np.log10(model["n"] + model["v"] + 1)))).alias("base_score"), (F.col("score") + F.coalesce("__late", F.lit(0.0))).alias("score"), "n_ids",
    )
