"""Conversation repair: the parser against enumeration, the operator against plain Python, cuts and edge cases."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from recordsync.llm import conversation_repair as C
from recordsync.llm.role_parser import Edit, Parser

VALID = re.compile(r"(s?(ua)+)?\Z")


def enumerated(rows):
    """Least (cost, audit) over all edits, with at most three insertions in a place."""
    best = None
    for edits in itertools.product("KRD", repeat=len(rows)):
        if any(e != "D" and not r.live for e, r in zip(edits, rows)):
            continue
        for gaps in itertools.product(range(4), repeat=len(rows) + 1):
            audit = "I" * gaps[0] + "".join(e + "I" * g for e, g in zip(edits, gaps[1:]))
            cost = 5 * sum(gaps) + sum({"K": 0, "R": 1, "D": 2}[e] + 5 * (r.truncated and e != "D") for e, r in zip(edits, rows))
            if best is not None and (cost, audit) >= best:
                continue
            spots = []
            it = iter(rows)
            for c in audit:
                r = next(it) if c != "I" else None
                if c != "D":
                    spots.append([r.initial or "x"] if c == "K" else ["u", "a"])
            if any(VALID.match("".join(x)) for x in itertools.product(*spots)):
                best = cost, audit
    return best


def test_parser_is_enumeration():
    parser, kinds = Parser(), [Edit(i, True, t) for i in ("s", "u", "a", "") for t in (False, True)] + [Edit("", False, False)]
    for n in range(3):
        for rows in itertools.product(kinds, repeat=n):
            assert parser.repair(rows) == enumerated(rows), rows
    rnd = random.Random(5)
    for _ in range(25):
        rows = [rnd.choice(kinds) for _ in range(3)]
        assert parser.repair(rows) == enumerated(rows), rows


def test_parser_of_long_conversations():
    """Against a table of four states with whole audits; a grammar with more pairs costs no more stacks."""
    rnd, parser = random.Random(6), Parser()
    for n in (10, 60, 300):
        rows = [Edit(rnd.choice("ssuuuaaa") if rnd.random() < 0.9 else "", rnd.random() < 0.9, rnd.random() < 0.2) for _ in range(n)]
        rows = [r if r.live else Edit("", False, False) for r in rows]
        assert parser.repair(rows) == table(rows)
    assert len(parser.vertices()) == 10


READ = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def table(rows):
    def inserted(paths):
        for _ in range(3):
            for here, (cost, audit) in list(paths.items()):
                for t in "ua":
                    to = READ.get((here, t))
                    if to and (cost + 5, audit + "I") < paths.get(to, (1 << 60, "")):
                        paths[to] = cost + 5, audit + "I"
        return paths
    paths = {"0": (0, "")}
    for r in rows:
        made = []
        for here, (cost, audit) in inserted(paths).items():
            made.append((cost + 2, audit + "D", here))
            if r.live:
                cost += 5 * r.truncated
                made += [(cost, audit + "K", READ[here, r.initial])] if (here, r.initial) in READ else []
                made += [(cost + 1, audit + "R", READ[here, t]) for t in "ua" if (here, t) in READ]
        paths = {}
        for cost, audit, to in sorted(made, reverse=True):
            paths[to] = cost, audit
    return min(v for k, v in inserted(paths).items() if k in "0a")


def plain(rows, original):
    """rows (conv, turn, role, text) after damage."""
    out = []
    for conv in {r[0] for r in original}:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1], m[2]))
        seen, edits, counts = set(), [], [0, 0, 0]
        for _, role, text in mine:
            said = text.strip(" \t\n\x0b\f\r")
            fault = 0 if not said else 1 if (role, text) in seen else 2 if said[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            edits.append(Edit(role[:1] if role[:1] in "sua" and role else "", fault not in (0, 1), fault == 2))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        turns = [m[0] for m in mine if m[0] is not None]
        cost, audit = table([e if e.live else Edit("", False, False) for e in edits])
        told, it, last = [], iter(mine), None
        for c in audit:
            row = next(it) if c != "I" else None
            if c != "D":
                role = row[1] if c == "K" else "assistant" if last == "u" else "user"
                last = role[0]
                told.append(f"{role}:{'' if c == 'I' else row[2]}")
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts, illegal, cost, audit,
                    hashlib.sha256("\n".join(told).encode()).hexdigest()))
    return sorted(out, key=repr)


def made_up(seed, convs, longest):
    rnd = random.Random(seed)
    texts = ["Yes.", "No!", "and then", "", " \n", "Why?", "Ok. ", None, "é!", "so?\t"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    return [(c, None if rnd.random() < 0.05 else rnd.randrange(-2, longest), rnd.choice(roles),
             rnd.choice(texts) if rnd.random() < 0.6 else f"say {rnd.random()}.") for c in [None, *range(convs)]
            for _ in range(rnd.randrange(1, longest))]


def unordered_ties(rows):
    """Rows of one turn in other roles or texts: their order is the hash's, which plain() does not know."""
    by = {}
    for c, t, r, x in rows:
        by.setdefault((c, t, " " if r is None else r), set()).add(" " if x is None else x)
    return {k[0] for k, v in by.items() if len(v) > 1}


@pytest.mark.parametrize("part", [1 << 15, 3])
def test_repair_is_plain_python(spark, monkeypatch, part):
    monkeypatch.setattr(C, "PART", part)  # 3: nearly every conversation is put together from parts
    rows = made_up(part, 60, 9)
    ties = unordered_ties(rows)
    rows = [r for r in rows if r[0] not in ties] + [(900, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(200)]
    rows += [(901, 1, "user", "same.")] * 40 + [(901, 2, "assistant", "x" * 100_000 + ".")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumn("audit", F.lit("clash")).withColumn("conv", F.lit(1))
    got = sorted((tuple(r) for r in C.repair(df).collect()), key=repr)
    assert got == plain(rows, rows)


def test_query_damages(spark, tmp_path):
    rows = [r for r in made_up(3, 80, 7)]
    ties = unordered_ties(rows)
    rows = [r for r in rows if r[0] not in ties]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.withColumn("extra", F.lit(1)).write.parquet(f"{tmp_path}/conversations.parquet")
    after = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        after += [(c, t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert not unordered_ties(after) - {c for c, *_ in after if c in unordered_ties(after)}
    again = unordered_ties(after)
    got = sorted((tuple(r) for r in C.op12_conversation_repair(spark, str(tmp_path)).collect() if r[0] not in again), key=repr)
    assert got == [p for p in plain(after, rows) if p[0] not in again]


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "So?"), (1, 2, "user", "So?"), (1, 3, "assistant", "Yes."), (None, 0, "user", "")]
    given = C.rows_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    told = C.repaired_rows(given, C.audits(given)).orderBy("conv_id", "place").collect()
    assert [tuple(r) for r in told] == [(1, 0, "user", "So?", "K"), (1, 1, "assistant", "Yes.", "K")]


def test_empty_table(spark):
    assert C.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
