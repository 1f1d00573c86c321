"""Conversation structure repair by a run-length dynamic program.

A conversation's rows, in order, are symbols of a role class (system, user, assistant, other) and a fault (none, truncated, blank,
duplicate). Edits turn them into `(s?(ua)+)?`, whose automaton has four states. What one symbol costs from state to
state is a 4 x 4 matrix in min-plus algebra, with insertions before the row closed in. Equal symbols in a row are one run, and
the costs behind it come to its front through cached powers of its matrix (1, 2, 4, ... rows). From the front on, the
cheapest edits, least in ASCII among equals, are unrolled: a power's choices are those of its two halves, cached with the
costs behind it, so that long runs are mostly copied.

Rows are sorted over range partitions of (conversation, turn, content), so that a long conversation lies in many tasks, and packed
into blocks of consecutive rows with one symbol a row. Only the symbols of a conversation meet in one row, where its audit must stand
anyway, which has a byte for each row at least; texts are edited block by block. The SHA-256 of a repaired conversation is of one stream, so
the blocks of one that has several are fed to it in order, a batch at a time; others are hashed where they lie.

Defined results: a null role or text is one space, so is a null part of the key that damage is drawn by; null conversations are
one; null turns come first and count in no gap; rows of one turn are in the order of the SHA-256 of their role and text (digest()),
so that equal rows are adjacent, and all but the first are duplicates; roles are told by their first character, an empty one is other;
texts of any length are read whole; an empty table gives no rows. Other columns of the input play no part."""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed_join, small, write_table

SPACE = " \t\n\x0b\x0c\r"
CLEAN, TRUNCATED, BLANK, DUPLICATE = range(4)
#: A symbol is the letter at 4 * class + fault; classes are the places in CLASSES, or 3.
CLASSES, SYMBOLS = "sua", "ABCDEFGHIJKLMNOP"
#: States of `(s?(ua)+)?`: nothing yet, after s, after u, after a. AHEAD: the state after an inserted or reroled row.
AHEAD, ROLES = (2, 2, 3, 2), {2: "user", 3: "assistant"}
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
FAR = 1 << 60
NO_TURN = -(2**63)
BLOCK_ROWS, BLOCK_CHARS = 4096, 32_768

Matrix = tuple[tuple[int, ...], ...]
Costs = tuple[int, ...]


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) after the contract's damage, which the key `conv:turn` decides."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(conv), F.lit(":"), space(turn)).cast("binary")) % 20
    read = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), space(role).alias("role"), space(text).alias("text"), kind.alias("kind")).where("kind <> 0")
    said = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return read.select("conv", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), said.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def digest(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def next_state(state: int, edit: str, cls: int) -> int:
    return state if edit == "D" else AHEAD[state] if edit in "IR" else cls + 1


@lru_cache(None)
def steps(symbol: str) -> tuple[tuple[tuple[str, int, int], ...], ...]:
    """For each state the edits of a row, (edit, cost, state after it), in ASCII order; insertions aside."""
    cls, fault = divmod(SYMBOLS.index(symbol), 4)
    out = []
    for state in range(4):
        found = [("D", DELETE, state)]
        if fault in (CLEAN, TRUNCATED):
            cut = CUT * (fault == TRUNCATED)
            if (cls == 0 and state == 0) or (cls == 1 and state != 2) or (cls == 2 and state == 2):
                found.append(("K", KEEP + cut, cls + 1))
            found.append(("R", REROLE + cut, AHEAD[state]))
        out.append(tuple(found))
    return tuple(out)


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product."""
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def behind(a: Matrix, costs: Costs) -> Costs:
    return tuple(min(a[i][k] + costs[k] for k in range(4)) for i in range(4))


#: What insertions cost from state to state, and from each state to an accepted end.
INSERTS: Matrix = ((0, FAR, INSERT, 2 * INSERT), (FAR, 0, INSERT, 2 * INSERT), (FAR, FAR, 0, INSERT), (FAR, FAR, INSERT, 0))
END: Costs = (0, 2 * INSERT, INSERT, 0)


@lru_cache(None)
def power(symbol: str, j: int) -> Matrix:
    """The costs of 2**j rows of one symbol."""
    if j:
        return times(power(symbol, j - 1), power(symbol, j - 1))
    row = [[FAR] * 4 for _ in range(4)]
    for state, found in enumerate(steps(symbol)):
        for _, cost, after in found:
            row[state][after] = min(row[state][after], cost)
    return times(INSERTS, tuple(map(tuple, row)))


def level(costs: Costs) -> tuple[Costs, int]:
    """Costs less their minimum; choices depend on no more."""
    low = min(costs)
    return tuple(min(c - low, FAR) for c in costs), low


def unroll(symbol: str, j: int, costs: Costs, state: int) -> tuple[str, int]:
    """The edits of 2**j rows from a state on, and the state after them; costs: what comes behind, levelled."""
    return (short if j <= 8 else halves)(symbol, j, costs, state)


def halves(symbol: str, j: int, costs: Costs, state: int) -> tuple[str, int]:
    between, _ = level(behind(power(symbol, j - 1), costs))
    first, state = unroll(symbol, j - 1, between, state)
    last, state = unroll(symbol, j - 1, costs, state)
    return first + last, state


@lru_cache(100_000)
def short(symbol: str, j: int, costs: Costs, state: int) -> tuple[str, int]:
    """As unroll(), cached: strings of up to 256 rows."""
    if j:
        return halves(symbol, j, costs, state)
    here, edits = behind(power(symbol, 0), costs), ""
    while True:
        for edit, cost, after in steps(symbol)[state]:
            if edit > "I" and INSERT + here[AHEAD[state]] == here[state]:
                break
            if cost + costs[after] == here[state]:
                return edits + edit, after
        edits, state = edits + "I", AHEAD[state]


def repair(symbols: str) -> tuple[int, str]:
    """The least cost of repairing a conversation, and its edits."""
    runs = [(symbol, sum(1 for _ in same)) for symbol, same in groupby(symbols)]
    costs, offset = END, 0
    plan = []  # for each run, from the last to the first: its powers from the last rows on, with the costs behind them
    for symbol, n in reversed(runs):
        for j in range(n.bit_length()):
            if n >> j & 1:
                plan.append((symbol, j, costs))
                costs, low = level(behind(power(symbol, j), costs))
                offset += low
    total, state, edits = costs[0] + offset, 0, []
    for symbol, j, after in reversed(plan):
        text, state = unroll(symbol, j, after, state)
        edits.append(text)
    while END[state]:
        edits.append("I")
        state = AHEAD[state]
    return total, "".join(edits)


def illegal_pairs(symbols: str) -> int:
    """Adjacent roles that aren't su, ua or au."""
    runs = [(cls, sum(1 for _ in same)) for cls, same in groupby(SYMBOLS.index(s) // 4 for s in symbols)]
    legal = {(0, 1), (1, 2), (2, 1)}
    return sum(n - 1 for _, n in runs) + sum((a, b) not in legal for (a, _), (b, _) in zip(runs, runs[1:], strict=False))


BLOCKS = "symbols string, roles array<string>, texts array<string>, first_at long, last_at long, first_digest binary, last_digest binary, low long, high long, turns long"


def packed(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for each block of consecutive rows of a conversation: (known, conv, part, no) is its place."""
    kind = rows.schema["conv"].dataType.simpleString()
    keys = ["known", "conv", "at", "digest", "salt"]
    ranged = rows.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches):
        part, key, no, held, chars, last = TaskContext.get().partitionId(), None, 0, [], 0, None
        for batch in batches:
            known, conv, at, digests, roles, texts, bases, repeats = (batch.column(i).to_pylist() for i in range(8))
            out = []
            for row in zip(zip(known, conv, strict=True), at, digests, roles, texts, bases, repeats, strict=True):
                if row[0] != key or len(held) == block_rows or chars >= BLOCK_CHARS:
                    if held:
                        out.append(block(part, no, held))
                    no = no + 1 if row[0] == key else 0
                    last, key, held, chars = last if row[0] == key else None, row[0], [], 0
                mark = row[1:3]
                fault = row[5] % 4
                if fault != BLANK and (row[6] or mark == last):
                    fault = DUPLICATE
                held.append((*row, SYMBOLS[row[5] - row[5] % 4 + fault]))
                last, chars = mark, chars + len(row[4])
            if out:
                yield as_batch(out)
        if held:
            yield as_batch([block(part, no, held)])

    def block(part, no, held):
        turns = [r[1] for r in held if r[1] != NO_TURN]
        (known, conv), first, end = held[0][0], held[0], held[-1]
        lists = ["".join(r[7] for r in held), [r[3] for r in held], [r[4] for r in held]]
        return (known, conv, part, no, *lists, first[1], end[1], first[2], end[2], min(turns, default=None), max(turns, default=None), len(set(turns)))

    def as_batch(out):
        types = [pa.bool_(), conv_type, pa.int64(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    names = [x.split(" ")[0] for x in f"known boolean, conv x, part long, no int, {BLOCKS}".split(", ")]
    conv_type = pa.string() if kind == "string" else None if kind not in ("bigint", "int") else pa.int64() if kind == "bigint" else pa.int32()
    columns = ["known", "conv", "at", "digest", "role", "text", "base", "repeated"]
    return ranged.select(*columns).mapInArrow(run, f"known boolean, conv {kind}, part long, no int, {BLOCKS}")


def solved(blocks: DataFrame) -> DataFrame:
    """One row for each conversation: its counts, cost and audit, and for each block the edits and the state that it begins in."""
    columns = ["part", "no", "symbols", "first_at", "last_at", "first_digest", "last_digest", "low", "high", "turns"]
    whole = blocks.groupBy("known", "conv").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("blocks"))  # a byte for each row
    kind = blocks.schema["conv"].dataType.simpleString()
    cuts = pa.list_(pa.struct([("part", pa.int64()), ("no", pa.int32()), ("state", pa.int32()), ("edits", pa.string())]))

    def one(parts):
        symbols, before, repeats, turns = [], None, 0, 0
        for b in parts:
            text = b["symbols"]
            if before and (before["last_at"], before["last_digest"]) == (b["first_at"], b["first_digest"]):
                first = SYMBOLS.index(text[0])
                text = SYMBOLS[first - first % 4 + (BLANK if first % 4 == BLANK else DUPLICATE)] + text[1:]
            turns += b["turns"]
            repeats += bool(before) and before["last_at"] == b["first_at"] != NO_TURN
            symbols.append(text)
            before = b
        whole = "".join(symbols)
        cost, audit = repair(whole)
        faults = [0] * 4
        for symbol in set(whole):
            faults[SYMBOLS.index(symbol) % 4] += whole.count(symbol)
        lows, highs = ([b[x] for b in parts if b[x] is not None] for x in ("low", "high"))
        gaps = max(highs) - min(lows) + 1 - (turns - repeats) if lows else 0
        return gaps, faults[BLANK], faults[DUPLICATE], faults[TRUNCATED], illegal_pairs(whole), cost, audit, places(parts, symbols, audit)

    def places(parts, symbols, audit):
        if len(parts) == 1:
            return [{"part": parts[0]["part"], "no": parts[0]["no"], "state": 0, "edits": audit}]
        out, state, i = [], 0, 0
        for b, text in zip(parts, symbols, strict=True):
            begin, entry = i, state
            for symbol in text:
                while audit[i] == "I":
                    state, i = AHEAD[state], i + 1
                state, i = next_state(state, audit[i], SYMBOLS.index(symbol) // 4), i + 1
            out.append({"part": b["part"], "no": b["no"], "state": entry, "edits": audit[begin:i]})
        out[-1]["edits"] += audit[i:]
        return out

    def run(batches):
        for batch in batches:
            found = [one(parts.as_py()) for parts in batch.column(2)]
            types = [pa.int64()] * 6 + [pa.string(), cuts]
            arrays = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)] if found else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["known", "conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "cuts"])

    return whole.mapInArrow(run, f"known boolean, conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, cuts array<struct<part:long,no:int,state:int,edits:string>>")


def edited(roles: list[str], texts: list[str], edits: str, state: int) -> list[tuple[str, str]]:
    """The rows that edits leave, as (role, text)."""
    out, i = [], 0
    for edit in edits:
        if edit == "I":
            out.append((ROLES[AHEAD[state]], ""))
        elif edit == "K":
            out.append((roles[i], texts[i]))
        elif edit == "R":
            out.append((ROLES[AHEAD[state]], texts[i]))
        cls = CLASSES.find(roles[i][:1]) if edit == "K" else 0
        state, i = next_state(state, edit, cls), i + (edit != "I")
    return out


def bodies(blocks: DataFrame, cuts: DataFrame) -> DataFrame:
    """(known, conv, part, no, alone, rows, body): the repaired rows of every block, and them as one text; alone: of a conversation of one block."""
    kind = blocks.schema["conv"].dataType.simpleString()
    both = blocks.select("known", "conv", "part", "no", "roles", "texts").join(small(cuts), ["known", "conv", "part", "no"])

    def run(batches):
        for batch in batches:
            roles, texts, edits, state = (batch.column(i).to_pylist() for i in (4, 5, 6, 7))
            found = [edited(*x) for x in zip(roles, texts, edits, state, strict=True)]
            text = pa.array(["\n".join(f"{role}:{said}" for role, said in rows) for rows in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(3), batch.column(8), pa.array(map(len, found), pa.int64()), text], names=["known", "conv", "part", "no", "alone", "rows", "body"])

    columns = ["known", "conv", "part", "no", "roles", "texts", "edits", "state", "alone"]
    return both.select(*columns).mapInArrow(run, f"known boolean, conv {kind}, part long, no int, alone boolean, rows long, body string")


def hashes(found: DataFrame) -> DataFrame:
    """(known, conv, sha): the SHA-256 of each repaired conversation; blocks of one are fed to it in order."""
    kind = found.schema["conv"].dataType.simpleString()
    many = found.where("NOT alone AND rows > 0").repartition("known", "conv").sortWithinPartitions("known", "conv", "part", "no").select("known", "conv", "body")

    def run(batches):
        key, sha = None, None
        for batch in batches:
            for now in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if now[:2] != key:
                    if sha:
                        yield row(batch, key, sha)
                    key, sha = now[:2], hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(now[2].encode())
            kept = batch
        if sha:
            yield row(kept, key, sha)

    def row(batch, key, sha):
        values = [pa.array([x], batch.column(i).type) for i, x in enumerate(key)]
        return pa.RecordBatch.from_arrays([*values, pa.array([sha.hexdigest()])], names=["known", "conv", "sha"])

    return found.where("alone").select("known", "conv", F.sha2("body", 256).alias("sha")).unionByName(many.mapInArrow(run, f"known boolean, conv {kind}, sha string"))


def prepared(rows: DataFrame) -> DataFrame:
    """damage()'s rows with what sorting and symbols need. repeated: the same role and text stand in an earlier turn."""
    kind = rows.schema["conv"].dataType
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(F.length(trimmed) == 0, BLANK).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), CLEAN).otherwise(TRUNCATED)
    first = F.substring("role", 1, 1)
    cls = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    keyed = rows.select(F.col("conv").isNotNull().alias("known"), F.coalesce("conv", F.lit("0").cast(kind)).alias("conv"), F.coalesce("turn", F.lit(NO_TURN)).alias("at"), digest(F.col("role"), F.col("text")).alias("digest"), "role", "text", (4 * cls + fault).alias("base"))
    again = keyed.groupBy("known", "conv", "digest").agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first < last").drop("last")
    again, _ = write_table(again, "again")
    both = keyed_join(keyed, again, ["known", "conv", "digest"], "left")
    return both.select("known", "conv", "at", "digest", "role", "text", "base", F.coalesce(F.col("at") > F.col("first"), F.lit(False)).alias("repeated"))


def repair_conversations(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Of rows (conv, turn, role, text): one row for each conversation (conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256),
    and the repaired conversations in blocks (conv, part, no, rows, body), in the order of part and no."""
    blocks, _ = write_table(packed(prepared(rows), block_rows), "blocks")
    found, _ = write_table(solved(blocks), "solved")
    cuts = found.select("known", "conv", F.explode("cuts").alias("c"), (F.size("cuts") == 1).alias("alone")).select("known", "conv", "c.part", "c.no", "c.edits", "c.state", "alone")
    text, _ = write_table(bodies(blocks, cuts), "repaired")
    back = F.when(F.col("known"), F.col("conv")).alias("conv")
    whole = found.join(hashes(text), ["known", "conv"], "left").withColumn("repaired_sha256", F.coalesce("sha", F.sha2(F.lit(""), 256)))
    return whole.select(back, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"), text.select(back, "part", "no", "rows", "body")


def damaged_and_repaired(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The report on every conversation of rows (conv_id, turn, role, text) after damage; those without rows are empty."""
    report, _ = repair_conversations(damage(rows), block_rows)
    report, _ = write_table(report.withColumnRenamed("conv", "id"), "report")
    all_ = rows.select(F.col("conv_id")).distinct()
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    joined = all_.join(report, F.col("conv_id").eqNullSafe(F.col("id")), "left")
    return joined.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
