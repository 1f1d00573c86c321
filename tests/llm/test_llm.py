"""The operators against brute-force versions, round trips, held-out accuracy and odd inputs."""

import base64
import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ashlar.llm import common, decontam, html_text, langid, lm_score, pieces, pii, queries, shards, simhash, topk, warc

DOCS = "doc_id long, text string, lang string, n_words int, component_id long, __t string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like outputs."""
    long = "wort " * 30_000 + "a" * 5000
    texts = ["", None, "   \n ", "one two", "the cat sat on the mat, the end", "the cat sat on the mat, the end", "!!! 123 ???", long, "▁odd ▁ mark  x", "ÀÉ ñ 漢字 \U0001f600 end", "İstanbul ẞ"]
    rows = [(i, t, "en" if i % 2 else None, 7, 9, "x") for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, "null id text here", "en", 1, 1, "y"), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").encode().lower().decode())


def test_fingerprints_and_groups(spark, docs, odd):
    def brute(rows):
        fps = [simhash.fingerprint((t or "").encode(), 3) for _, t in rows]
        parent = {f: f for f in fps}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in itertools.combinations(sorted(parent), 2):
            if (a ^ b).bit_count() <= 2:
                parent[root(b)] = root(a)
        low = {}
        for (i, _), f in zip(rows, fps, strict=True):
            if i is not None:
                low[root(f)] = min(low.get(root(f), i), i)
        return collections.Counter((i, f, low.get(root(f))) for (i, _), f in zip(rows, fps, strict=True))

    for df in (docs, odd):
        rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        got = simhash.near_groups(df.select("doc_id", "text")).collect()
        assert collections.Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got) == brute(rows)
    kept = simhash.keep_one(odd).collect()
    groups = {r["group_fp"] for r in simhash.near_groups(odd.select("doc_id", "text")).collect()}
    assert len(kept) == len(groups) == 9
    assert set(kept[0].asDict()) == set(odd.columns)
    assert simhash.near_groups(odd.where("false").select("doc_id", "text")).count() == 0


def test_fingerprint_is_the_contracts(spark):
    text = "B a c D a b c"
    shingles = [" ".join(x) for x in zip(*[words(text)[k:] for k in range(3)])]
    hashes = [r[0] % 2**64 for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s")).collect()]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text.encode(), 3) == want


def test_crowded_keys_lose_no_link(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(3)]
    values = {b for b in base} | {base[0] ^ 1 << i ^ 1 << j for i, j in itertools.combinations(range(0, 64, 3), 2)} | {rng.getrandbits(64) for _ in range(50)}
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    pairs, plan = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 2, crowd=4)
    label = {r["node"]: r["label"] for r in common.components(pairs, "a", "b").collect()}
    of = {v: label.get(v, v) for v in signed}
    near = lambda a, b: ((a % 2**64) ^ (b % 2**64)).bit_count() <= 2
    assert all(of[a] == of[b] for a, b in itertools.combinations(signed, 2) if near(a, b))
    assert len(set(of.values())) == 53
    assert sum(plan["thresholds"]) == 2 - len(plan["thresholds"]) + 1


def test_language(spark, docs, odd):
    got = {r["doc_id"]: r for r in queries.op7_language_id(spark, "/root/testdata/sf0.001").collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [i for i, r in got.items() if r["held_out"]]
    assert {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0} == set(held)
    assert np.mean([got[i]["lang_pred"] == truth[i] for i in held]) >= 0.95
    model = langid.train([(b"the cat and the dog", "en"), ("le chat et la souris".encode(), "fr")] * 20, epochs=3)
    out = langid.predict(odd, model, carry="text").collect()
    assert len(out) == odd.count()
    for r in out:
        empty = not re.search(r"[^\W\d_]", r["text"] or "")
        assert (r["lang_pred"] == "und") == empty and (r["score"] == 0 if empty else 0 < r["score"] <= 1)
    assert langid.fit(odd.where("false"), F.lit(True)) is None
    assert {r["lang_pred"] for r in langid.predict(odd, None).collect()} == {"und"}


def test_language_sample_is_bounded(spark):
    texts = [(i, "always the same few words of a line", "en") for i in range(3000)] + [(3000 + i, f"der satz nummer {'x' * i} steht hier", "de") for i in range(60)]
    rows = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    found = langid.training_sample(rows, "text", "lang", F.lit(True), 50)
    by = collections.Counter(lang for _, lang in found)
    assert by == {"en": len(langid.SAMPLE_WINDOWS), "de": 50 * len(langid.SAMPLE_WINDOWS)}


def brute_windows(docs, bench):
    find = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (s or "").encode().lower().decode())
    windows = {}
    for i, t in bench:
        w = find(t)
        for s in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[s : s + 13]), set()).add(str(i))
    found = []
    for i, t in docs:
        w, hit, items = find(t), set(), set()
        for p in range(len(w)):
            for n in {len(k) for k in windows}:
                if (k := tuple(w[p : p + n])) in windows and len(k) == n:
                    items |= windows[k]
                    hit.update(range(p, p + n))
        found.append((i, len(w), len(hit), len(items), tuple(sorted(items))))
    return collections.Counter(found)


def test_decontamination(spark, docs, odd, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    own = spark.createDataFrame([(1, "the CAT sat"), (2, None), (3, ""), (4, " ".join(f"w{i}" for i in range(20))), (4, "the end"), (5, "a a a")], "item_id long, text string")
    more = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(90, "x " + " ".join(f"w{i}" for i in range(3, 18)) + " y"), (91, "a a a a b a a a")], "doc_id long, text string"))
    for d, b in ((docs.select("doc_id", "text"), bench), (more, own), (more, own.where("false")), (more.where("false"), own)):
        got = decontam.overlaps(d, b).collect()
        assert collections.Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], tuple(r["items"])) for r in got) == brute_windows([tuple(r) for r in d.collect()], [tuple(r) for r in b.select("item_id", "text").collect()])
    kept = decontam.drop_contaminated(odd, own)
    assert kept.columns == odd.columns and kept.where("doc_id = 4").count() == 0 and kept.where("doc_id IS NULL").count() == 2
    one = decontam.item_terms(own.where("item_id = 1"), "item_id", "text")
    index = decontam.build_index(more, "doc_id", "text")
    near = decontam.proximity_matches(index, one, decontam.list_lengths(index, one), 3)
    assert near.count() == 4


def test_personal_data(spark, docs, odd):
    kinds = ("email", "ip", "card", "phone")
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]

    def good(k, v):
        d = re.sub("[^0-9]", "", v)
        luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
        return [True, k != 1 or all(int(x) <= 255 for x in v.split(".")), 12 <= len(d) <= 19 and luhn, 9 <= len(d) <= 15][k]

    def brute(text):
        found = sorted((m.start(), k, m.end()) for k, p in enumerate(patterns) for m in re.finditer(p, text or "") if good(k, m[0]))
        return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in found)

    tricky = ["a@b.c.@d.e", "x..y@z-.q..w@e.f", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4", "4111 1111-1111 1111 4111  1111 1111 1111", "+1 (555) 010-9999x +12 +1-2-3-4-5-6-7-8-9-", "😀 a@b.co 12 34 4111111111111111",
              "999.1.1.1.1 é@b.c", "1-" * 3000 + "2", "a." * 500 + "@" + "b." * 400 + "c", "4111111111111111@x.y +4111111111111111 8.8.8.8"]
    frame = odd.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(tricky, 50)), "doc_id long, text string"))
    for df in (docs.select("doc_id", "text"), frame, frame.where("false")):
        got = pii.spans_of(df, "text", ["doc_id", "text"]).select("text", pii.joined(F.col("base")).alias("b")).collect()
        assert len(got) == df.count() and all(r["b"] == brute(r["text"]) for r in got)


def test_patterns_discover_identifiers(spark):
    rows = [(i, f"we wrote yesterday. passport-phone: +1 (202) 555-01{i:02d} was given") for i in range(12)] + [(20, "then passport-phone: 0049-301-2345 came up"), (21, "the room 12345 is here")]
    got = {r["doc_id"]: r["s"] for r in pii.spans_of(spark.createDataFrame(rows, "doc_id long, text string"), "text", ["doc_id"]).select("doc_id", pii.joined(F.col("spans")).alias("s")).collect()}
    assert got[20] == "phone:21:34" and got[21] == "" and got[0].startswith("phone:")
    masked = {r["doc_id"]: r["text"] for r in pii.mask(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert masked[20] == "then passport-phone: <PHONE> came up" and masked[21] == rows[-1][1]


def test_pieces(spark, odd, docs):
    got = pieces.encode(odd, carry_text=True).collect()
    assert all(r["round_trip"] for r in got) and all((r["n_ids"] == 0) == (not r["text"]) for r in got)
    back = pieces.decode(pieces.encode(odd.select("doc_id", F.col("text").alias("was")), "was", carry_text=True)).collect()
    assert all(r["text"] == (r["was"] or "") for r in back)
    assert all(r["round_trip"] for r in pieces.encode(docs).collect())
    use = pieces.Encoder(pieces.load_vocabulary())
    for word in ("▁reading", "▁the", "▁straße", "▁éa漢"):

        def best(rest):
            if not rest:
                return 0.0
            ways = [use.pieces[rest[:n]][0] + best(rest[n:]) for n in range(1, len(rest) + 1) if rest[:n] in use.pieces]
            return max(ways) if rest[0] in use.pieces else max([use.byte_score * len(rest[0].encode()) + best(rest[1:]), *ways])

        ids = use.words([word])[word]
        scores = {i: s for s, i in use.pieces.values()}
        assert math.isclose(sum(scores.get(i, use.byte_score) for i in ids), best(word))
    many = sorted({"▁" + w for w in words(docs.first()["text"])})
    assert use.words(many) == {w: use.words([w])[w] for w in many}


def test_top_k(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.normal(0, 1, 8).round(2).tolist()) for i in range(300)] + [(300 + i, [0.5] * 8) for i in range(60)]
    vectors += [(400, None), (401, [0.1, None] + [0.0] * 6), (402, [float("nan")] * 8), (403, [1e30] * 8), (None, [1.0] * 8), (404, [1.0, 2.0]), (450, [1.0, 2.0]), (50, vectors[50][1])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = topk.top_k(frame, lambda i: i % 50 == 0, block_bytes=400, shard_bytes=4000).collect()
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for at, (q, qv) in enumerate(fine):
        if q % 50 == 0:
            scored = sorted((-max(min(sum(a * b for a, b in zip(qv, v)), 2**63 - 1), -(2**63)), i) for n, (i, v) in enumerate(fine) if n != at and len(v) == len(qv))
            want += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:5], 1)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert topk.top_k(frame.where("false"), lambda i: i % 50 == 0).count() == 0


def test_main_text():
    page = "<html><head><title>T</title><script>var a='<p>no</p>';</script></head><body class='has-sidebar'><header>Top</header><nav><a href=x>Home</a></nav><div id=content><div class='ad'>Buy, now, it, is, good</div><h1>Head &amp; line</h1><p>First, para\n with <b>bold</b>&nbsp;text, and more.<p>Second one, here.<ul><li>a<li>b</ul><form>Your name, please<input></form><div class='comments'><p>I, the reader, think, that, this, is, fine.</p></div></div><aside>See, also</aside><footer>(c)</footer>"
    assert html_text.extract(page) == "Head & line\nFirst, para with bold text, and more.\nSecond one, here.\na\nb"
    assert html_text.extract("") == "" and html_text.extract("<nav><a>x</a></nav>") == ""
    assert html_text.extract("<p>a < b &lt; c</p><!-- <p>no</p> -->") == "a < b < c"
    html_text.extract("<" * 20_000 + "<div>" * 3000 + "<a b='" * 50)


def test_main_text_rows(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "v", "<p>hi &#55357; there</p>")], "page_id long, url string, html string")
    got = html_text.main_text(pages.withColumn("text", F.lit("clash"))).collect()
    assert sorted((r["page_id"] or 0, r["text"]) for r in got) == [(0, "hi � there"), (1, ""), (2, "")]


def test_warc(spark):
    rows = [(1, "http://a/ b\n", "x"), (5, None, "x"), (3, "u", "x"), (2, "u", ""), (7, "u", None), (None, "u", "x"), (9, "u", "é" * 100_000), (None, "w", "solo"), (5, None, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    made = warc.archive(pages, frame=1000, bundle=50_000)
    got = warc.read_records(made).collect()
    last = {}
    for i, _, h in rows:
        last[h or ""] = max((x for x in (i, last.get(h or "")) if x is not None), default=None)
    want = [(i, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), "response" if i == last[h or ""] else "revisit", None if i == last[h or ""] else last[h or ""]) for i, _, h in rows]
    assert collections.Counter(tuple(r) for r in got) == collections.Counter(want)
    raw = warc.lookup(made, spark.createDataFrame([(9,), (3,)], "page_id long")).collect()
    assert {warc.parse(r["raw"])[0]["WARC-Type"] for r in raw} == {"response", "revisit"} and len(raw) == 2
    assert warc.read_records(warc.archive(pages.where("false"))).count() == 0
    shared = common.shared_dir(spark) + "/files"
    assert warc.export(made, shared).count() == made.count()
    files = warc.read_files(spark, shared)
    assert collections.Counter(tuple(r) for r in warc.read_records(files).collect()) == collections.Counter(want)
    for r in made.collect():
        assert warc.read_index(r["data"]) == [(x["record"], x["frame"], x["offset"], x["length"]) for x in r["index"]]


def test_shards(spark, odd):
    rng = random.Random(2)
    texts = ["hot"] * 400 + [f"t{rng.randrange(150)}" for _ in range(500)] + [f"single {i}" for i in range(103)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for df in (frame, odd.select("doc_id", "text"), odd.where("false").select("doc_id", "text")):
        got = shards.shard_documents(df).collect()
        n = df.count()
        assert len(got) == n
        by = collections.defaultdict(list)
        for r in got:
            by[r["shard"]].append(r["slot"])
        assert all(sorted(v) == list(range(len(v))) for v in by.values())
        sizes = [len(by.get(s, ())) for s in range(8)]
        assert set(by) <= set(range(8)) and max(sizes) - min(sizes) <= 1
    got = shards.shard_documents(frame).collect()
    groups = collections.defaultdict(collections.Counter)
    for r in got:
        groups[r["hub"]][r["shard"]] += 1
    pairs = lambda n: n * (n - 1) // 2
    links, cut = shards.cut_edges(shards.shard_documents(frame)).first()
    assert links == sum(pairs(sum(g.values())) for g in groups.values()) and cut == links - sum(pairs(n) for g in groups.values() for n in g.values())
    by_hash = shards.cut_edges(frame.select(F.col("text").alias("hub"), (F.xxhash64("doc_id") % 8).alias("shard"))).first()["cut"]
    assert 100 * cut < 95 * by_hash
    small_groups = [g for g in groups.values() if 1 < sum(g.values()) < 100]
    assert np.mean([max(g.values()) / sum(g.values()) for g in small_groups]) > 0.75  # by chance: about a third


def test_lm_scores(spark, docs, odd):
    for df in (docs.select("doc_id", "text"), odd.select("doc_id", "text")):
        train = df.where(common.fold("doc_id", 7) != 2)
        model = lm_score.fit(train, "text", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2)
        got = lm_score.score(df, model).collect()
        counts = collections.Counter(w for r in train.collect() for w in [*words(r["text"]), None])
        n, v = sum(counts.values()), len(counts)
        want = collections.Counter()
        for r in df.collect():
            ws = [*words(r["text"]), None]
            want[r["doc_id"], len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 4)] += 1
        assert collections.Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
        assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert lm_score.score(odd.where("false").select("doc_id", "text"), model).count() == 0
    empty = lm_score.fit(odd.where("false"), "text", F.lit(0))
    assert all(r["n_known"] == 0 for r in lm_score.score(odd.select("doc_id", "text"), empty).collect())


def test_attention_gradient_and_windows():
    rng = np.random.default_rng(0)
    n = 90  # ids; then the start of a text and what stands for no id
    inputs = np.concatenate([rng.integers(0, lm_score.CLASSES, n), [lm_score.CLASSES, lm_score.CLASSES + 1]])
    start = lm_score.initial(rng.normal(0, 1, (lm_score.CLASSES + 2, lm_score.CLASSES)), inputs)
    p = {k: a if k == "inputs" else a.astype(np.float64) for k, a in start.items()}
    stream, sizes = rng.integers(0, n, 75), np.array([40, 1, 34])
    cls = inputs[stream]
    ids, places = lm_score.windows(stream, sizes, n + 1)
    assert sorted(places[places >= 0].tolist()) == list(range(75))  # each id is scored once
    weight, goals = (places >= 0).astype(float), cls[np.maximum(places, 0)]

    def loss():
        z, _ = lm_score.forward(p, ids)
        return -(np.take_along_axis(z, goals[:, :, None], 2)[:, :, 0] * weight).sum() / weight.sum()

    z, saved = lm_score.forward(p, ids)
    g = lm_score.backward(p, ids, goals, weight, z, saved)
    rows, grads, times = g["e"]
    assert times.sum() == ids.size and (np.unique(ids) == rows).all()
    g["e"] = np.zeros_like(p["e"])
    g["e"][rows] = grads
    for k in ("e", "e", "e", "p", "q", "k", "v", "o"):
        at = (int(rng.choice(stream)), 3) if k == "e" else tuple(rng.integers(0, s) for s in p[k].shape)
        was = p[k][at]
        p[k][at] = was + 1e-4
        up = loss()
        p[k][at] = was - 1e-4
        down = loss()
        p[k][at] = was
        assert math.isclose((up - down) / 2e-4, g[k][at], rel_tol=2e-2, abs_tol=1e-5), k
    single = {k: a if k == "inputs" else a.astype(np.float32) for k, a in p.items()}
    probs, opens = lm_score.attention_scores(single, lm_score.attention_tables(single), stream, cls, sizes)
    whole = np.zeros((75, lm_score.CLASSES))
    whole[places[places >= 0]] = np.exp(z)[places >= 0]
    assert np.allclose(probs, whole[np.arange(75), cls], rtol=1e-3)
    assert np.allclose(opens, whole[:, : lm_score.STARTS].sum(1) + whole[:, lm_score.END], rtol=1e-3)
    trainer = lm_score.Trainer(single)
    before = loss()
    for _ in range(30):
        trainer.learn(stream, cls, sizes)
    p = {k: a if k == "inputs" else a.astype(np.float64) for k, a in trainer.p.items()}
    assert loss() < before - 0.3 and trainer.met[stream[:39]].all() and not trainer.met[np.setdiff1d(np.arange(n), stream)].any()


def distributions(model, ids):
    """After the ids of one text: P(each piece or the text's end begins here), and P(each piece goes on), with the word's end; P(a known word's class)."""
    t, p, mix = model["tables"].value, model["params"], model["mix"]
    size = len(p["inputs"]) - 2
    stream = np.array([*ids, 0])
    at, places = lm_score.windows(stream, np.array([len(stream)]), size + 1)
    z, _ = lm_score.forward(p, at)
    row = np.exp(z)[places == len(ids)][0].astype(float)
    cls, begins = t["cls"], np.append(t["cls"][:-1] < lm_score.STARTS, True)

    def pair(a):
        keys, wanted = t["pair_keys"], (a + 1 << 20) + np.arange(size + 1) + 1
        order = np.argsort(keys)
        spot = order[np.minimum(np.searchsorted(keys, wanted, sorter=order), len(keys) - 1)]
        return np.where(keys[spot] == wanted, t["pair_p"][spot], 0.0)

    share = np.where(begins, row[cls] * t["inner"], 0)
    start = pair(-1)
    start[size] = t["end_p"]
    opens = row[: lm_score.STARTS].sum() + row[lm_score.END]
    first = mix[1] * start + (1 - mix[1]) * share / opens
    if not ids:
        return first, None, None, row / opens
    going = mix[0] * pair(ids[-1]) + (1 - mix[0]) * np.where(begins, 0, row[cls] * t["inner"])
    return first, going, mix[0] * t["ends"][ids[-1]] + (1 - mix[0]) * opens, row / opens


def test_probabilities_sum_to_one_and_scores_are_theirs(spark, docs):
    some = docs.select("doc_id", "text").where("doc_id < 80")
    model = lm_score.fit(some.where("doc_id < 60"), "text", F.col("doc_id"))
    use = lm_score.Subwords(model["vocabulary"].value)
    code = lambda text: use.ids([w for w in words(text)])
    for text in ("", "the", "we wrote unfathomable things about der und"):
        first, going, end, _ = distributions(model, [i for w in code(text) for i in w])
        assert math.isclose(first.sum(), 1, rel_tol=1e-4)
        assert going is None or math.isclose(going.sum() + end, 1, rel_tol=1e-4)
    counts = {r["token"]: r["c"] for r in model["counts"].collect()}
    w, once = model["mix"][2], sum(c == 1 for c in counts.values())
    assert math.isclose(w, 1 - once / sum(counts.values()))
    cls = model["tables"].value["cls"]
    of_class = collections.Counter()
    for word, c in counts.items():
        of_class[cls[code(word)[0][0] if word else use.size]] += c
    texts = [(i, t) for i, t in enumerate(["", "the", "zzyx the qqq", "one two three four five six"])] + [(10 + r["doc_id"], " ".join(r["text"].split()[:25])) for r in some.where("doc_id >= 74").collect()]
    got = {r["doc_id"]: r["score"] for r in lm_score.score(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    for i, text in texts:
        seen, total = [], 0.0
        for word, ids in [*zip(words(text), code(text)), ("", [use.size])]:
            spelled, known = 1.0, distributions(model, seen)[3][cls[ids[0]]] * counts.get(word, 0) / max(1, of_class[cls[ids[0]]])
            for k, piece in enumerate(ids):
                first, going, *_ = distributions(model, seen)
                spelled *= (going if k else first)[piece]
                seen.append(piece)
            if word:
                spelled *= distributions(model, seen)[2]
            total += math.log10((1 - w) * spelled + w * known)
        assert math.isclose(got[i], total, rel_tol=1e-3), (i, got[i], total)


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    first = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in cp.STAGES:
        docs, _ = common.write_table(stage(spark, docs, sf_dir), name)
        assert name == "sentencepiece" or docs.columns == columns
    got = {r["doc_id"]: r for r in docs.collect()}
    assert all(r["round_trip"] and r["n_chars"] == len(r["text"]) for r in got.values())
    brute = brute_windows([(i, r["text"]) for i, r in first.items()], [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()])
    dirty = {i for i, n, hit, *_ in brute if hit and 20 * hit >= n}
    fps = simhash.near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).collect()
    lows = {r["component_id"] for r in fps}
    lettered = {i for i, r in first.items() if re.search(r"[^\W\d_]", r["text"])}
    assert set(got) <= lows - dirty
    assert len(lows & lettered - dirty - set(got)) <= 0.01 * len(first)


def test_attention_carries_the_score(docs):
    some = docs.select("doc_id", "text")
    held = common.fold("doc_id", 7) == 2
    model = lm_score.fit(some.where(~held), "text", F.col("doc_id"))
    total = lambda m: [r["s"] for r in lm_score.score(some, m).groupBy((held).alias("h")).agg(F.sum("score").alias("s")).orderBy("h").collect()]
    params = model["params"]
    whole, off = total(model), total(model | {"params": params | {"o": np.zeros_like(params["o"])}})
    assert off[0] < 1.02 * whole[0] and off[1] < 1.02 * whole[1]  # both without the layer are worse by over 2 %


def test_word_starts_are_grouped_by_their_company():
    starts = np.ones(200, dtype=bool)
    counts = np.concatenate([np.full(lm_score.SINGLE_STARTS, 1000.0), np.full(200 - lm_score.SINGLE_STARTS, 10.0)])
    cls, near = lm_score.classes_of(starts, counts), np.zeros((200, lm_score.SINGLE_STARTS))
    rest = np.arange(lm_score.SINGLE_STARTS, 200)
    near[rest, rest % lm_score.SINGLE_STARTS] = 50  # as many kinds of company as single classes
    near[199] = 0
    got = lm_score.regrouped(cls, starts, near)
    assert (got[: lm_score.SINGLE_STARTS] == cls[: lm_score.SINGLE_STARTS]).all() and got[199] == cls[199]
    assert len({got[i] for i in rest[:-1]}) == lm_score.SINGLE_STARTS
    assert all(len({got[i] for i in rest[:-1] if i % lm_score.SINGLE_STARTS == k}) == 1 for k in range(lm_score.SINGLE_STARTS))
    keys = lm_score.company(np.array([0, 30, 1, 47]), np.array([5, 6, 7, 9]), np.array([0, 0, 0, 1]))
    assert sorted(keys.tolist()) == sorted(x * lm_score.SINGLE_STARTS + c for x, c in ((6, 0), (7, 0), (6, 1), (5, 1)))
