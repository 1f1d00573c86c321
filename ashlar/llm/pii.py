"""Personal data: fixed patterns, and bootstrapped contextual extraction, in DataFrame functions only.

Base spans come from four patterns. A span's position is the length of what lies between the
matches before it and of those matches, so split() and regexp_extract_all() give it without a UDF;
the lengths are added up by blocks, so that a text's cost grows with its length.

Bootstrapping: base entities are the seeds. The word to the left of an entity, or of another token
that is shaped like an identifier, is a lexical pattern. In each round a pattern's confidence in a
kind is the score of the instances that follow it over all its occurrences in the corpus, and an
instance's score is 1 - prod(1 - confidence) over its patterns (1 for a seed's own kind). Scores and
confidences only grow from round to round, and rounds end when no confidence changes by TOLERANCE. Patterns
with enough different instances and a high confidence mark the identifiers that follow them, with the
seeds' kind. Common words are not selective, so they never pass.

An identifier is a token without white space, of any length, that has at least TOKEN_DIGITS digits, with the groups
of digits that follow it after single spaces. The word to its left may have any length; it is sought back
to the match before it.

Defined results: a null text is empty and has no span; repeated rows each get their row; where a
discovered span would meet a base span, the base span stays alone; an empty table has no rows. Input columns
pass through whatever their names are, but that `base` and `spans` replace columns of those names in spans_of()."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fits, keyed_join, scratch, write_table

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns. Lookbehinds and possessive runs only save work on long runs:
# a match begins where its run begins or where the match before it ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TOKEN = r"(?<!\S)[^\s0-9]*+[0-9]\S*+(?:\x20[0-9][0-9().-]*+(?!\S))*+"
TOKEN_DIGITS = 4
SUPPORT, CONFIDENCE, TOLERANCE = 3, 0.6, 0.005
#: Discovered spans that are broadcast at most; more are joined by a shuffle.
MANY_SPANS = 500_000
#: Running sums are taken inside blocks of so many values, and over the blocks.
BLOCK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), where value is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, merge: Callable[[Column, Column], Column], zero: Column) -> Column:
    """merge() of each value and all before it."""
    fold = lambda x: F.aggregate(x, zero, merge)

    def whole(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")), lambda b: fold(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))

        def inside(before: Column) -> Column:
            def one(x, i):
                b = F.floor(i / BLOCK).cast("int")
                return merge(F.element_at(before, b + 1), fold(F.slice(v, b * BLOCK + 1, i - b * BLOCK + 1)))

            return F.transform(v, one)

        return let(blocks, lambda s: let(F.transform(s, lambda x, b: fold(F.slice(s, F.lit(1), b))), inside))

    return let(values, lambda v: F.when(F.size(v) > 0, whole(v)).otherwise(v))


def found(text: Column, pattern: str, maybe: Column) -> Column:
    """What matches, and what lies between; null where the text cannot match."""
    return F.when(maybe, F.struct(F.regexp_extract_all(text, F.lit(pattern), 0).alias("m"), F.split(text, pattern, -1).alias("g")))


def positions(pair: str) -> Column:
    """Spans (start, end, value, gap) of a column made by found(); positions in code points; gap: the text since the match before."""
    m, g = F.col(f"{pair}.m"), F.col(f"{pair}.g")
    none = F.array().cast("array<struct<start:int,end:int,value:string,gap:string>>")
    steps = F.transform(m, lambda x, i: F.length(F.element_at(g, i + 1)) + F.when(i > 0, F.length(F.element_at(m, F.greatest(i, F.lit(1))))).otherwise(F.lit(0)))

    def spans(starts: Column) -> Column:
        def one(x, i):
            start = F.element_at(starts, i + 1)
            return F.struct(start.alias("start"), (start + F.length(x)).alias("end"), x.alias("value"), F.element_at(g, i + 1).alias("gap"))

        return F.transform(m, one)

    return F.coalesce(let(running(steps, lambda a, x: a + x, F.lit(0)), spans), none)


def luhn(digits: Column) -> Column:
    def add(a, i):
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return a + F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def only_digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def valid_card(x: Column) -> Column:
    d = only_digits(x)
    return F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False))


def valid_ip(x: Column) -> Column:
    parts = F.transform(F.split(x, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(999)) <= 255))


def valid_phone(x: Column) -> Column:
    return F.length(only_digits(x)).between(9, 15)


def left_word(gap: Column) -> Column:
    """The last word of what stands before a match, in lower case; empty if there is none, or one with digits or without letters."""
    word = F.lower(F.regexp_extract(gap, r"(?<!\S)(\S++)\s*+$", 1))
    return F.when(word.rlike(r"[0-9]") | ~word.rlike(r"\p{L}"), F.lit("")).otherwise(word)


def apart(base: Column, tokens: Column) -> Column:
    """The tokens that meet no base span: of those that begin before a token none ends in it, and the next begins after it."""
    far = 2**31 - 1
    row = lambda x, kind: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), x.alias("token") if kind else F.lit(None).cast("struct<start:int,end:int,value:string,left:string>").alias("token"))

    def pick(all_: Column) -> Column:
        ends = running(F.transform(all_, lambda x: F.when(x["kind"] == 0, x["end"]).otherwise(F.lit(0))), lambda a, x: F.greatest(a, x), F.lit(0))
        nexts = F.reverse(running(F.transform(F.reverse(all_), lambda x: F.when(x["kind"] == 0, x["start"]).otherwise(F.lit(far))), lambda a, x: F.least(a, x), F.lit(far)))

        def checked(e: Column) -> Column:
            return let(nexts, lambda n: F.filter(F.transform(all_, lambda x, i: F.when((x["kind"] == 1) & (F.element_at(e, i + 1) <= x["start"]) & (F.element_at(n, i + 1) >= x["end"]), x["token"])), lambda t: t.isNotNull()))

        return let(ends, checked)

    both = F.array_sort(F.concat(F.transform(base, lambda x: row(x, 0)), F.transform(tokens, lambda x: row(x, 1))))
    return F.when((F.size(base) == 0) | (F.size(tokens) == 0), tokens).otherwise(let(both, pick))


def scan(docs: DataFrame, text: str, keep: Column) -> DataFrame:
    """For each row: rid, `keep` as doc, base spans (start, k, end, value, left) in order, and other
    identifier-shaped tokens (start, end, value, left) that meet no base span, as cands."""
    c = F.col("t")
    read = docs.select(keep.alias("doc"), F.monotonically_increasing_id().alias("rid"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    read = read.select("*", c.rlike("[0-9]").alias("num"))
    paired = read.select(
        "doc", "rid",
        found(c, EMAIL, F.instr(c, "@") > 0).alias("email"),
        found(c, IP, F.col("num") & c.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")).alias("ip"),
        found(c, CARD, F.col("num") & c.rlike(r"[0-9](?:[\x20-]?[0-9]){11}")).alias("card"),
        found(c, PHONE, F.col("num") & c.rlike(r"\+[0-9]")).alias("phone"),
        found(c, TOKEN, F.col("num")).alias("token"),
    )
    spans = paired.select("doc", "rid", *[positions(k).alias(k) for k in (*KINDS, "token")])
    checks = {"ip": valid_ip, "card": valid_card, "phone": valid_phone}

    def base(k, kind):
        kept = F.filter(F.col(kind), lambda s: checks[kind](s["value"])) if kind in checks else F.col(kind)
        return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end"), s["value"].alias("value"), left_word(s["gap"]).alias("left")))

    def core(s):
        lead = F.length(F.regexp_extract(s["value"], r"^[^\p{L}0-9+]*+", 0))
        inner = F.regexp_replace(F.substring(s["value"], lead + 1, F.length(s["value"])), r"[^\p{L}0-9]++$", "")
        return F.struct((s["start"] + lead).alias("start"), (s["start"] + lead + F.length(inner)).alias("end"), inner.alias("value"), left_word(s["gap"]).alias("left"))

    shaped = F.transform(F.filter("token", lambda s: F.length(only_digits(s["value"])) >= TOKEN_DIGITS), core)
    based = spans.select("doc", "rid", F.array_sort(F.concat(*[base(k, kind) for k, kind in enumerate(KINDS)])).alias("base"), shaped.alias("tokens"))
    return based.select("doc", "rid", "base", apart(F.col("base"), F.col("tokens")).alias("cands"))


def learn(scanned: DataFrame, docs: DataFrame, text: str, support: int = SUPPORT, confidence: float = CONFIDENCE, tolerance: float = TOLERANCE) -> DataFrame:
    """High-confidence patterns (left, k, conf) from the pattern-instance graph of the whole corpus."""
    seeds = scanned.select(F.explode("base").alias("s")).select("s.left", "s.value", "s.k")
    others = scanned.select(F.explode("cands").alias("s")).select("s.left", "s.value", F.lit(None).cast("int").alias("k"))
    edges = seeds.unionByName(others).where("left <> ''").groupBy("left", "value", "k").agg(F.count(F.lit(1)).alias("n"))
    edges, _ = write_table(edges, "edges")
    likely = edges.groupBy("left").agg(F.count_distinct("value").alias("d"), F.count("k").alias("seeds")).where(f"d >= {support} AND seeds > 0").select("left")
    likely, _ = write_table(likely, "likely")
    corpus = docs.select(F.explode(F.split(F.lower(F.col(text)), r"\s+")).alias("left"))
    if fits(likely):
        all_of = corpus.join(F.broadcast(likely), "left", "left_semi").groupBy("left").agg(F.count(F.lit(1)).alias("total"))
    else:  # words are counted before they are shuffled
        all_of = corpus.groupBy("left").agg(F.count(F.lit(1)).alias("total")).join(likely, "left", "left_semi")
    all_of, _ = write_table(all_of, "occurrences")
    graph, _ = write_table(keyed_join(edges, all_of.select("left"), ["left"], "left_semi"), "graph")
    pairs, _ = write_table(graph.groupBy("left", "value").agg(F.sum("n").alias("n")), "pairs")
    open_, _ = write_table(graph.where("k IS NULL").select("left", "value"), "open")
    known, _ = write_table(graph.where("k IS NOT NULL").select("value", "k", F.lit(1.0).alias("s")).distinct(), "seeds")
    scores, before = known, None
    while True:
        by = pairs.join(scores, "value").groupBy("left", "k").agg(F.sum(F.col("n") * F.col("s")).alias("w"), F.count(F.lit(1)).alias("d"))
        rated, _ = write_table(by.join(all_of, "left").select("left", "k", "d", (F.col("w") / (F.greatest(F.col("total"), F.col("w")) + 1)).alias("conf")), "rated")
        if before is not None:
            was = before.select("left", "k", F.col("conf").alias("was"))
            moved = rated.join(was, ["left", "k"], "left").agg(F.max(F.col("conf") - F.coalesce("was", F.lit(0.0)))).first()[0]
            if moved is None or moved < tolerance:
                break
        before = rated
        kinds = rated.groupBy("left").agg(F.collect_list(F.struct("k", "conf")).alias("kinds"))  # as many as there are kinds
        kinds, _ = write_table(kinds, "kinds")
        rising = keyed_join(open_, kinds, ["left"]).select("value", F.explode("kinds").alias("x"))
        new = rising.groupBy("value", "x.k").agg((1 - F.exp(F.sum(F.log1p(-F.col("x.conf"))))).alias("s"))
        scores, _ = write_table(known.unionByName(new.join(known, ["value", "k"], "left_anti")), "scores")
    good = rated.where((F.col("conf") >= confidence) & (F.col("d") >= support))
    return write_table(good.groupBy("left").agg(F.max_by("k", F.struct("conf", -F.col("k"))).alias("k"), F.max("conf").alias("conf")), "patterns")[0]


def discovered(scanned: DataFrame, patterns: DataFrame) -> DataFrame:
    """(rid, more): the spans that the patterns add, for rows that have any."""
    at = scanned.select("rid", F.explode("cands").alias("c")).select("rid", "c.start", "c.end", "c.value", "c.left")
    return keyed_join(at, patterns, ["left"]).groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "k", "end", "value", "left"))).alias("more"))


def joined(spans: Column) -> Column:
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def marked(docs: DataFrame, text: str, keep: Column) -> DataFrame:
    """doc (what `keep` gives), base and spans (arrays of start, k, end, value, left) for every row."""
    spark = docs.sparkSession
    scanned, _ = write_table(scan(docs, text, keep), "spans")
    with scratch(spark):
        more, _ = write_table(discovered(scanned, learn(scanned, docs, text)), "discovered", keep=True)
    none = F.array().cast(scanned.schema["base"].dataType)
    if fits(more) and (more.agg(F.sum(F.size("more"))).first()[0] or 0) <= MANY_SPANS:
        more = F.broadcast(more)
    return scanned.join(more, "rid", "left").select("doc", "base", F.array_sort(F.concat("base", F.coalesce("more", none))).alias("spans"))


def spans_of(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (those of the names base and spans aside), base and spans for every row."""
    carry = [c for c in carry or [] if c not in ("base", "spans")]
    found_ = marked(docs, text, F.struct(*carry) if carry else F.lit(None).cast("string"))
    return found_.select(*([f"doc.`{c}`" for c in carry]), "base", "spans")


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every span of its text replaced by its kind in angle brackets; overlapping spans become one.

    The parts between spans are cut by position, block by block of spans, and joined once."""
    c = F.coalesce(F.col("doc").getField(text), F.lit(""))
    tags = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def pieces(spans: Column) -> Column:
        def by(ends: Column) -> Column:  # ends[i]: where the spans up to i end
            at = lambda i: F.when(i > 0, F.element_at(ends, F.greatest(i, F.lit(1)))).otherwise(F.lit(0))

            def block(b):
                first = b * BLOCK
                begin = at(first)
                part = F.substring(c, begin + 1, F.element_at(ends, F.least(first + BLOCK, F.size(spans))) - begin)

                def one(text):
                    def cut(s, j):
                        from_ = at(first + j)
                        return F.when(s["start"] >= from_, F.concat(F.substring(text, from_ - begin + 1, s["start"] - from_), F.element_at(tags, s["k"] + 1))).otherwise(F.lit(""))

                    return F.array_join(F.transform(F.slice(spans, first + 1, F.lit(BLOCK)), cut), "")

                return let(part, one)

            blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / BLOCK).cast("int")), block)
            return F.concat(F.array_join(blocks, ""), F.substring(c, F.element_at(ends, F.size(spans)) + 1, F.length(c)))

        return let(running(F.transform(spans, lambda s: s["end"]), lambda a, x: F.greatest(a, x), F.lit(0)), by)

    clean = F.when(F.size("spans") == 0, F.col("doc").getField(text)).otherwise(let(F.col("spans"), pieces))
    both = marked(docs, text, F.struct(*docs.columns)).select("doc", clean.alias("clean"))
    return both.select(*[F.col("clean").alias(x) if x == text else F.col("doc").getField(x).alias(x) for x in docs.columns])
