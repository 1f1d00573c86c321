"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, html_text, langid, lexical, lm_score, pieces, pii, secret_scan, shards, simhash, topk, turns, warc
from .common import fold, table_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = lm_score.fit(docs.where(fold("doc_id", 7) != 2), "text", F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / 7) % lm_score.SLICES)
    held = F.coalesce(fold("doc_id", 7) == 2, F.lit(False))
    found = lm_score.score(docs.select("doc_id", held.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_ids")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return coded.select("doc_id", "n_ids", "ids", "round_trip", "decoded_crc32")


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), lambda i: i % 50 == 0)


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_groups(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = pii.spans_of(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", ["doc_id"])
    count = lambda k: F.size(F.filter("base", lambda s: s["k"] == k)).cast("long")
    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return marked.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.select("doc_id", "text", "lang"), fold("doc_id", 5) != 0)
    held = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    return langid.predict(docs.select("doc_id", held.alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontam.overlaps(docs.select("doc_id", "text"), bench.select("item_id", "text"), slop=decontam.SLOP)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontam.contaminated().alias("contaminated"), "n_near")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_records(warc.archive(table(spark, sf_dir, "pages").select("page_id", "url", "html")))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shards.shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = secret_scan.Ledger(spark, table_path(spark, "ledger"))
    found = ledger.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    base = F.filter("spans", lambda s: s["rule"].isin([r.name for r in secret_scan.BASE]))
    count = lambda name: F.size(F.filter("spans", lambda s: s["rule"] == name)).cast("long")
    counts = [count(r.name).alias(f"n_{r.name}") for r in secret_scan.BASE]
    return found.select("doc_id", *counts, F.sha2(secret_scan.joined(base), 256).alias("base_sha256"), secret_scan.joined(F.col("spans")).alias("spans"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.damaged_and_repaired(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def queries() -> dict:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def secrets_sql() -> str:
    """Matches of each rule and the text between them give positions."""
    # The rules as DuckDB's patterns, with the group and the length that count.
    rules = [
        ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
        ("access", r"AKIA[A-Z0-9]+", 0, 16), ("hex", r"[0-9a-f]{32,}", 0, 32), ("github", r"gh[oprsu]_[A-Za-z0-9]+", 0, 40),
        ("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20), ("google", r"AIza[A-Za-z0-9_-]+", 0, 39), ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ]
    one = """SELECT rid, {place} AS place, '{name}' AS kind, unnest(list_transform(range(1, len(m) + 1), lambda i: struct_pack(ok := length(v[i]) >= {least},
               first := CAST(list_sum(list_transform(g[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0) AS BIGINT), size := length(m[i])))) AS s
             FROM (SELECT rid, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS v, regexp_split_to_array(t, '{pattern}') AS g FROM d)"""
    parts = [one.format(place=i, name=name, pattern=pattern, group=group, least=least) for i, (name, pattern, group, least) in enumerate(rules)]
    label = "kind || ':' || s.first || ':' || (s.first + s.size)"
    return f"""
            WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
            a AS ({" UNION ALL ".join(parts)}),
            b AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
                  string_agg({label}, ',' ORDER BY s.first, place) FILTER (place < 3) AS base, string_agg({label}, ',' ORDER BY s.first, place) AS spans FROM a WHERE s.ok GROUP BY rid)
            SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
            FROM d LEFT JOIN b USING (rid)"""


def repair_sql() -> str:
    """Forward over rows: the cheapest edits into each state as six digits of cost and the edits, so that the least text is the best."""
    add = lambda p, cost, edit: f"(lpad(CAST(CAST(({p})[1:6] AS INTEGER) + {cost} AS VARCHAR), 6, '0') || ({p})[7:] || '{edit}')"
    # p: the best into states 0 to 3 (nothing, s, u, a); then with insertions, c; then after the row x
    u = f"list_min([p[3], {add('p[1]', 2, 'I')}, {add('p[2]', 2, 'I')}])"
    closed = f"[p[1], p[2], list_min([{u}, {add('p[4]', 2, 'I')}]), list_min([p[4], {add(u, 2, 'I')}])]"
    ua = "list_min([c[1], c[2], c[4]])"
    far = "'900000'"
    live = lambda value: f"CASE WHEN x.fault < 2 THEN {value} ELSE {far} END"
    keep = lambda role, value: f"CASE WHEN x.fault < 2 AND x.role[1] = '{role}' THEN {value} ELSE {far} END"
    row = f"""[{add("c[1]", 3, "D")}, list_min([{add("c[2]", 3, "D")}, {keep("s", add("c[1]", "x.fault", "K"))}]),
        list_min([{add("c[3]", 3, "D")}, {keep("u", add(ua, "x.fault", "K"))}, {live(add(ua, "2 + x.fault", "R"))}]),
        list_min([{add("c[4]", 3, "D")}, {keep("a", add("c[3]", "x.fault", "K"))}, {live(add("c[3]", "2 + x.fault", "R"))}])]"""
    table = "list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, n))"
    return f"""
            WITH o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
            k AS (SELECT *, xor(4294967295, list_reduce(list_transform(range(1, length(key) + 1), lambda i: CAST(ord(key[i]) AS BIGINT)), lambda c, b: xor(c // 256, t[CAST(xor(c, b) % 256 AS BIGINT) + 1]), 4294967295)) % 20 AS kind FROM o, (SELECT {table} AS t)),
            d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                  unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE kind <> 0),
            n AS (SELECT *, sha256(length(role) || ':' || role || text) AS digest, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text), copy) AS i FROM d),
            f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 2 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 3
                  WHEN regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 0 ELSE 1 END AS fault, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM n),
            g AS (SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (fault = 2) AS blank, count(*) FILTER (fault = 3) AS duplicate,
                  count(*) FILTER (fault = 1) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, list(struct_pack(role, text, fault) ORDER BY i) AS xs FROM f GROUP BY conv_id),
            p AS (SELECT *, list_reduce(xs, lambda p, x: list_transform([{closed}], lambda c: {row})[1], ['000000', {far}, {far}, {far}]) AS p FROM g),
            e AS (SELECT *, list_transform([{closed}], lambda c: list_min([c[1], c[4]]))[1] AS best FROM p),
            r AS (SELECT conv_id, list_reduce(string_split(best[7:], ''), lambda a, e: struct_pack(i := a.i + CAST(e <> 'I' AS INTEGER), st := CASE WHEN e = 'D' THEN a.st WHEN e = 'K' AND xs[a.i].role[1] = 's' THEN 1 WHEN e = 'K' AND xs[a.i].role[1] = 'u' THEN 2
                  WHEN e = 'K' THEN 3 WHEN a.st = 2 THEN 3 ELSE 2 END, rows := CASE e WHEN 'D' THEN a.rows ELSE list_append(a.rows, CASE WHEN e = 'K' THEN xs[a.i].role WHEN a.st = 2 THEN 'assistant' ELSE 'user' END || ':' || CASE e WHEN 'I' THEN '' ELSE xs[a.i].text END) END),
                  struct_pack(i := 1, st := 0, rows := CAST([] AS VARCHAR[]))) AS left_ FROM e WHERE length(best) > 6)
            SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
                   coalesce(CAST(e.best[1:6] AS BIGINT), 0) AS cost, coalesce(e.best[7:], '') AS audit, sha256(coalesce(array_to_string(r.left_.rows, chr(10)), '')) AS repaired_sha256
            FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN e ON o.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN r ON o.conv_id IS NOT DISTINCT FROM r.conv_id"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_exact_topk": """
            WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
                       WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
            s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
                  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
            r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
            SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
        "op8_decontamination": r"""
            WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
            b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
            p AS (SELECT item, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i, w FROM b WHERE len(w) > 0),
            t AS (SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS gram FROM p),
            g AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM t) WHERE len(w) >= n)),
            m AS (SELECT doc_id, item, i, n FROM g JOIN t USING (n, gram)),
            h AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM m) GROUP BY doc_id),
            s AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id),
            q AS (SELECT DISTINCT array_to_string(w, ' ') AS body, item, unnest(w) AS term FROM b),
            o AS (SELECT doc_id, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS pos FROM d),
            c AS (SELECT term, count(*) AS cf FROM o GROUP BY term),
            r AS (SELECT body, item, min(struct_pack(cf := coalesce(cf, 0), term := term)) AS low, count(*) AS n FROM q LEFT JOIN c USING (term) GROUP BY body, item),
            k AS (SELECT o.doc_id, o.pos AS here, r.body, r.item, r.n FROM r JOIN o ON o.term = r.low.term WHERE r.low.cf > 0),
            z AS (SELECT k.doc_id, k.item, k.body, k.here FROM k JOIN q USING (body, item) JOIN o ON o.doc_id = k.doc_id AND o.term = q.term AND abs(o.pos - k.here) <= 50
                  GROUP BY k.doc_id, k.item, k.body, k.here HAVING count(DISTINCT q.term) = max(k.n)),
            y AS (SELECT doc_id, count(DISTINCT item) AS n_near FROM z GROUP BY doc_id)
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
                   coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, coalesce(n_near, 0) AS n_near
            FROM d LEFT JOIN h USING (doc_id) LEFT JOIN s USING (doc_id) LEFT JOIN y USING (doc_id)""",
        "op12_secret_scan": secrets_sql(),
        "op13_conversation_repair": repair_sql(),
        "op11_lexical_search": r"""
            WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
            b AS (SELECT row_number() OVER () AS row, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
            s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(w)) AS BIGINT) AS words FROM d WHERE len(w) > 0),
            q AS (SELECT row, item_id, term, count(*) AS c FROM (SELECT row, item_id, unnest(w) AS term FROM b) GROUP BY ALL),
            f AS (SELECT rid, doc_id, term, n, count(*) AS tf FROM (SELECT rid, doc_id, len(w) AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
            v AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM f, s GROUP BY term, docs),
            i AS (SELECT rid, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))) AS impact FROM f JOIN v USING (term), s),
            t AS (SELECT row, item_id, doc_id, CAST(sum(c * impact) AS BIGINT) AS score FROM q JOIN i USING (term) GROUP BY row, item_id, rid, doc_id),
            r AS (SELECT *, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM t WHERE score > 0)
            SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20""",
    }
