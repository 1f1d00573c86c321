"""Conversation repair against a plain search over edits, row by row."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

from ashlar.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string, part int, symbols string"


def plain_repair(rows):
    """Cheapest edits of (role, fault) rows, least in ASCII: shortest paths over (row, what stands last), audits compared as they are."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, last = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit
        due = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 2, audit + "I", i, due))
        if i < len(rows):
            role, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last))
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, due))
                if role[:1] == due or (role[:1] == "s" and not last):
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, role[:1]))
    raise AssertionError


def plain(rows):
    """The whole report of rows (conv_id, turn, role, text), by the contract's words."""
    text = lambda x: " " if x is None else str(x)
    after = {conv: [] for conv, *_ in rows}
    for conv, turn, role, said in rows:
        kind = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        role, said = text(role), text(said)
        said = "" if kind == 1 else re.sub("[.!?]", "", said) if kind == 2 else said
        after[conv] += [(turn, "user" if kind == 4 else role, said)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, found in after.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        seen, faults = set(), []
        for _, role, said in found:
            body = re.findall(r"[^\x20\x09-\x0D]", said)
            faults.append("blank" if not body else "duplicate" if (role, said) in seen else "" if body[-1] in ".!?" else "truncated")
            seen.add((role, said))
        numbers = [t for t, *_ in found if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(found, found[1:], strict=False))
        cost, audit = plain_repair([(r[1], f) for r, f in zip(found, faults, strict=True)])
        left, i, state = [], 0, 0
        for edit in audit:
            due = "assistant" if state == "u" else "user"
            left += {"I": [(due, "")], "D": [], "K": [found[i][1:]] if i < len(found) else [], "R": [(due, found[i][2])] if i < len(found) else []}[edit]
            state, i = left[-1][0][:1] if edit != "D" else state, i + (edit != "I")
        sha = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in left).encode()).hexdigest()
        c = Counter(faults)
        out.append((conv, gaps, c["blank"], c["duplicate"], c["truncated"], illegal, cost, audit, sha))
    return sorted(out, key=str)


def report(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(4)
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted((tuple(r[c] for c in names) for r in turns.damaged_and_repaired(df, **options).collect()), key=str)


def test_repair_is_that_of_a_search_over_all_edits():
    draw, symbol = random.Random(9), lambda role, fault: turns.SYMBOLS[4 * "suat".index(role) + ["", "truncated", "blank", "duplicate"].index(fault)]
    for n in [*range(9)] * 40 + [30, 60, 200]:
        rows = []
        while len(rows) < n:
            rows += [(draw.choice("suuaaat"), draw.choice(["", "", "truncated", "blank", "duplicate"]))] * draw.choice([1, 1, 2, 5, 17])
        assert turns.repair("".join(symbol(*r) for r in rows)) == plain_repair(rows), rows
    for role, fault in (("u", ""), ("s", ""), ("a", "truncated"), ("t", ""), ("u", "duplicate")):
        for n in (255, 256, 300, 1025):
            assert turns.repair(symbol(role, fault) * n) == plain_repair([(role, fault)] * n)
    cost, audit = turns.repair(symbol("u", "") * 3_000_000)  # copies of cached halves
    assert len(audit) == audit.count("K") + audit.count("R") and cost == 2 * audit.count("R") == 3_000_000


def test_reports(spark):
    draw = random.Random(2)
    rows = [(c, t, draw.choice(["user", "assistant", "system", "tool"]), draw.choice(["Yes.", "No", "Why?", " \t", "Well, well!  ", "etc. \x0b", "fin.\xa0"])) for c in range(60) for t in range(draw.randint(1, 9)) if draw.random() > 0.1]
    rows += [(100, t, ("user", "assistant")[t % 2], f"Line {t}.") for t in range(300)]
    rows += [(101, t // 3, ("user", "assistant")[t % 2], f"Line {t % 7}") for t in range(90)] + [(102, 5, "user", "same text.")] * 150
    wanted = plain(rows)
    assert report(spark, rows) == wanted
    assert report(spark, rows, block_rows=7) == wanted  # conversations over many blocks and tasks


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", "Hi."), (1, None, "user", "Hi."), (1, None, "assistant", None), (1, 7, None, "x"), (2, None, "", ""), (2, None, "S", "."),
        (3, 1, "umpire", "Out!"), (3, 2, "aide", "Long " * 50_000 + "end."), (3, -4, "system", "\U0001f600 ."), (4, 1, "user", "One."), (4, 1, "user", "One."), (4, 1, "assistant", "Two."),
    ]
    assert report(spark, rows) == plain(rows)
    assert report(spark, rows, block_rows=1) == plain(rows)
    assert report(spark, []) == []
    lost = [(c, 0, "user", "Gone.") for c in range(500) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    assert report(spark, lost) == sorted(((c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, *_ in lost), key=str)
