"""Conversation structure repair by a generalised LR parser (operator 12).

Faults are found on slim rows (ids, turn, role, 128 bits of the text's hash): rows of one key and text are counted before
they are shuffled, so a group of copies is one row.  Conversations are then parsed in ranges of (conversation, turn): a
long one lies in several ranges, where each part is parsed from every stack that can lead into it, and the parts' tables
of (entry, exit, cost, audit) are put together by conversation.  Repaired rows follow from the audits: texts are
shuffled once, and stream through a task in order; no conversation is ever held in memory, save its audit (a letter per
row).  A digest of a whole conversation has to see its rows in one stream, so that last step is one task a conversation.

Defined cases: a null role or text is one space (so such a text is blank, such a role's initial fits no rule), a null
turn comes first and counts in no gap, null conversation ids are one conversation; rows of one turn come in order of
role, then of the text's hash, so equal rows stand side by side; an empty role has an empty initial; very long texts are
hashed as they stream; an empty table gives no rows; columns beside the four named ones play no part, whatever
their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, read, small, written
from .role_parser import ROLES, Edit, Parser, Vertex

#: A conversation by (is null, id), a row in it by (has a turn, turn, role, hash): nulls first, no nulls in keys.
CONV, ROW = ["c0", "conv"], ["t0", "turn", "role", "h1", "h2"]
SPACES = "\x20\x09\x0A\x0B\x0C\x0D"
#: A conversation's part is cut after so many edits; its table has some ten stacks squared of audits as long.
PART = 1 << 15
#: Texts that recur in a conversation are broadcast up to so many (some 60 bytes each); beyond, Spark shuffles.
BROADCAST_REPEATS = 500_000


def rows_of(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows under the names of CONV and ROW, and ``text``."""
    conv, at = F.col(f"`{conv_id}`").cast("long"), F.col(f"`{turn}`").cast("long")
    said = F.coalesce(F.col(f"`{text}`"), F.lit(" "))
    return df.select(conv.isNull().alias("c0"), F.coalesce(conv, F.lit(0)).alias("conv"), at.isNotNull().alias("t0"),
                     F.coalesce(at, F.lit(0)).alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
                     F.xxhash64(F.lit(1), said).alias("h1"), F.xxhash64(F.lit(2), said).alias("h2"), said.alias("text"))


def faults(rows: DataFrame) -> DataFrame:
    """One row per CONV and ROW: ``copies``, and whether the text is ``blank``, ``cut`` short or said ``again``; written."""
    ends = F.right(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(1))
    slim = written(rows.select(*CONV, *ROW, (ends == "").alias("blank"), (~ends.isin(".", "!", "?")).alias("cut")).groupBy(
        *CONV, *ROW).agg(F.count("*").alias("copies"), F.max("blank").alias("blank"), F.max("cut").alias("cut")))
    said = [*CONV, "role", "h1", "h2"]
    place = F.struct("t0", "turn")
    repeated = slim.groupBy(*said).agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    return slim.join(small(repeated, BROADCAST_REPEATS), said, "left").withColumn(
        "again", F.coalesce(place > F.col("first"), F.lit(False))).drop("first")


_PART = ("c0 boolean, conv long, seg long, whole boolean, first string, last string, illegal long, blank long, duplicate long, "
         "truncated long, low long, high long, turns long, "
         "paths array<struct<entry:int,exit:int,cost:long,audit:string>>")
_ADJACENT = {"su", "ua", "au"}


class _Part:
    """What a range holds of one conversation."""

    def __init__(self, key: tuple) -> None:
        self.key, self.edits = key, []
        self.first = self.last = None
        self.illegal = self.blank = self.duplicate = self.truncated = self.turns = 0
        self.low = self.high = None

    def add(self, r: dict, terminals: set) -> None:
        n, initial = r["copies"], r["role"][:1]
        live = not r["blank"] and not r["again"]
        self.illegal += (n - 1) * (2 * initial not in _ADJACENT) + (
            self.last is not None and self.last + initial not in _ADJACENT)
        self.first = initial if self.first is None else self.first
        self.last = initial
        self.blank += n * r["blank"]
        self.duplicate += 0 if r["blank"] else n - live
        self.truncated += live and r["cut"]
        if r["t0"]:
            self.turns += self.high != r["turn"]
            self.low = r["turn"] if self.low is None else self.low
            self.high = r["turn"]
        if live:
            self.edits.append(Edit(initial if initial in terminals else "", True, bool(r["cut"])))
        self.edits += [Edit("", False, False)] * (n - live)

    def row(self, seg: int, whole: bool, paths: list) -> dict:
        return dict(zip(("c0", "conv"), self.key), seg=seg, whole=whole, first=self.first, last=self.last,
                    illegal=int(self.illegal), blank=int(self.blank), duplicate=int(self.duplicate),
                    truncated=int(self.truncated), low=self.low, high=self.high, turns=int(self.turns), paths=paths)


def _parts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a range to its conversations' parts.  Only the first and the last may go on in other ranges."""
    parser, task = Parser(), TaskContext.get().partitionId()
    stacks, terminals = parser.vertices(), set(parser.tables.terminals)
    number = {v: i for i, v in enumerate(stacks)}

    def closed(part: _Part, n: int, inner: bool) -> dict:
        seg = (task << 32) + n
        if inner:
            cost, audit = parser.repair(part.edits)
            return part.row(seg, True, [{"entry": 0, "exit": 0, "cost": cost, "audit": audit}])
        paths = []
        for entry in stacks:
            cost, frontier, steps = parser.run(entry, part.edits)
            paths += [{"entry": number[entry], "exit": number[v], "cost": cost + more, "audit": parser.audit(steps, i)}
                      for i, (v, more, _) in enumerate(frontier)]
        return part.row(seg, False, paths)

    part, outer, number_in_range, out = None, True, 0, []
    for batch in batches:
        for r in batch.to_pylist():
            key = (r["c0"], r["conv"])
            if part is None or part.key != key or len(part.edits) >= size:
                if part is not None:
                    inner = not outer and part.key != key  # began in this range and ended in it, in one part
                    out.append(closed(part, number_in_range, inner))
                    outer, number_in_range = part.key == key, number_in_range + 1
                part = _Part(key)
            part.add(r, terminals)
        if out:
            yield pa.RecordBatch.from_pylist(out, _SCHEMA)
            out = []
    if part is not None:
        yield pa.RecordBatch.from_pylist([closed(part, number_in_range, False)], _SCHEMA)


_SCHEMA = pa.schema([
    ("c0", pa.bool_()), ("conv", pa.int64()), ("seg", pa.int64()), ("whole", pa.bool_()), ("first", pa.string()),
    ("last", pa.string()), ("illegal", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
    ("paths", pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])
_JOINED = "c0 boolean, conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Whole:
    """A conversation put together from its parts in order."""

    def __init__(self, parser: Parser, stacks: list[Vertex], key: tuple) -> None:
        self.parser, self.stacks, self.key = parser, stacks, key
        self.frontier = {0: (0, 0, "")}  # stack: cost, rank, audit
        self.done = None
        self.sums = dict.fromkeys(("illegal", "blank", "duplicate", "truncated", "turns"), 0)
        self.last = self.low = self.high = None

    def add(self, r: dict) -> None:
        for c in self.sums:
            self.sums[c] += r[c]
        self.sums["illegal"] += self.last is not None and self.last + r["first"] not in _ADJACENT
        self.last = r["last"]
        if r["low"] is not None:
            self.sums["turns"] -= self.high == r["low"]
            self.low = r["low"] if self.low is None else self.low
            self.high = r["high"]
        if r["whole"]:
            self.done = r["paths"][0]["cost"], r["paths"][0]["audit"]
            return
        best: dict = {}
        for p in r["paths"]:
            if p["entry"] in self.frontier:
                cost, rank, audit = self.frontier[p["entry"]]
                made = (cost + p["cost"], rank, p["audit"], audit)
                if p["exit"] not in best or made < best[p["exit"]]:
                    best[p["exit"]] = made
        ranks = {key: n for n, key in enumerate(sorted({made[1:3] for made in best.values()}))}
        self.frontier = {v: (made[0], ranks[made[1:3]], made[3] + made[2]) for v, made in best.items()}

    def row(self) -> dict:
        if self.done is None:
            ends = list(self.frontier.items())
            more, i, letters = self.parser.final(tuple((self.stacks[v], cost, rank) for v, (cost, rank, _) in ends))
            self.done = more, ends[i][1][2] + letters
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.sums["turns"]
        return dict(zip(("c0", "conv"), self.key), gaps=gaps, cost=self.done[0], audit=self.done[1],
                    **{c: int(self.sums[c]) for c in ("blank", "duplicate", "truncated", "illegal")})


def _wholes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted parts to conversations."""
    parser = Parser()
    stacks, whole = parser.vertices(), None
    schema = pa.schema([("c0", pa.bool_()), ("audit", pa.string()), *[(c, pa.int64()) for c in (
        "conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]])
    names = [c.split()[0] for c in _JOINED.split(", ")]
    schema = pa.schema([schema.field(c) for c in names])
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if whole is None or whole.key != (r["c0"], r["conv"]):
                if whole is not None:
                    out.append(whole.row())
                whole = _Whole(parser, stacks, (r["c0"], r["conv"]))
            whole.add(r)
        yield pa.RecordBatch.from_pylist(out, schema)
    if whole is not None:
        yield pa.RecordBatch.from_pylist([whole.row()], schema)


def audits(rows: DataFrame) -> DataFrame:
    """(CONV, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation with rows; written out."""
    n, size = partitions(rows.sparkSession), PART
    slim = written(faults(rows))
    parts = written(slim.repartitionByRange(n, *CONV, *ROW).sortWithinPartitions(*CONV, *ROW).mapInArrow(
        lambda batches: _parts(batches, size), _PART))
    return written(parts.repartition(n, *CONV).sortWithinPartitions(*CONV, "seg").mapInArrow(_wholes, _JOINED))


class _Replay:
    """An audit's edits, row by row."""

    def __init__(self, parser: Parser, audit: str) -> None:
        self.parser, self.audit, self.at, self.stack = parser, audit, 0, parser.start

    def _given(self) -> str:
        """The role that a Rerole or Insert gives here."""
        initial, self.stack = next((t, to[0]) for t in ROLES if (to := self.parser.advance(self.stack, t)))
        return ROLES[initial]

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._given(), "", "I"

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """Repaired (role, text, edit) that come before and of this row."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.stack = self.parser.advance(self.stack, role[:1])[0]
            yield role, text, edit
        elif edit == "R":
            yield self._given(), text, edit


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, tuple[str, str, str] | None]]:
    """Per repaired row its conversation and (role, text, edit); (key, None) after a conversation's last."""
    parser, key, replay = Parser(), None, None
    for batch in batches:
        for r in batch.to_pylist():
            if r["audit"] is not None:  # an audit comes before its rows
                if replay is not None:
                    yield from ((key, said) for said in replay.inserted())
                    yield key, None
                key, replay = (r["c0"], r["conv"]), _Replay(parser, r["audit"])
            else:
                yield from ((key, said) for said in replay.row(r["role"], r["text"]))
    if replay is not None:
        yield from ((key, said) for said in replay.inserted())
        yield key, None


def _in_order(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """Audits, each followed by the rows of its conversation."""
    n = partitions(rows.sparkSession)
    heads = audited.select(*CONV, F.lit(0).alias("kind"), "audit")
    said = rows.select(*CONV, F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), *ROW, "text")
    both = heads.unionByName(said, allowMissingColumns=True)
    return both.repartition(n, *CONV).sortWithinPartitions(*CONV, "kind", *ROW).select(*CONV, "audit", "role", "text")


def repaired_rows(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit): the conversations as repaired, places from 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()),
                            ("edit", pa.string())])
        place, out, held = 0, [], 0
        for (null, conv), said in _replayed(batches):
            if said is None:
                place = 0
                continue
            out.append(dict(conv_id=None if null else conv, place=place, role=said[0], text=said[1], edit=said[2]))
            place, held = place + 1, held + len(said[1])
            if len(out) == 4096 or held > 1 << 24:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, held = [], 0
        yield pa.RecordBatch.from_pylist(out, schema)

    return _in_order(rows, audited).mapInArrow(run, "conv_id long, place long, role string, text string, edit string")


def digests(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """(CONV, repaired_sha256): SHA-256 of the repaired rows as ``role:text`` lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("c0", pa.bool_()), ("conv", pa.int64()), ("repaired_sha256", pa.string())])
        digest, some, out = hashlib.sha256(), False, []
        for (null, conv), said in _replayed(batches):
            if said is not None:
                digest.update(("\n" * some + f"{said[0]}:{said[1]}").encode())
                some = True
                continue
            out.append(dict(c0=null, conv=conv, repaired_sha256=digest.hexdigest()))
            digest, some = hashlib.sha256(), False
            if len(out) == 4096:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema)

    return _in_order(rows, audited).mapInArrow(run, "c0 boolean, conv long, repaired_sha256 string")


def repair(df: DataFrame, original: DataFrame | None = None, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """Per conversation of ``original`` (default: of ``df``) what is wrong in ``df``, the cheapest repair and its digest."""
    rows = rows_of(df, conv_id, turn, role, text)
    audited = audits(rows)
    conv = F.col(f"`{conv_id}`").cast("long")
    asked = (df if original is None else original).select(conv.isNull().alias("c0"), F.coalesce(conv, F.lit(0)).alias("conv")).distinct()
    told = asked.join(audited.join(digests(rows, audited), CONV), CONV, "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return told.select(F.when(~F.col("c0"), F.col("conv")).alias("conv_id"), *counts,
                       F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def damaged(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with damage that crc32 of 'conv_id:turn' decides (nulls: one space)."""
    def said(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", said("conv_id"), said("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text"))
    rows = df.where(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(said("role")).alias("role"),
                                      text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))))
    return rows.drop("col")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(damaged(given), given)


OP12_SQL = r"""
    WITH RECURSIVE kinds AS (
        SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
               lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]),
                   lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS kind
        FROM conversations
    ), damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(coalesce(text, ' '), '.!?', '') ELSE coalesce(text, ' ') END AS text,
               unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM kinds WHERE kind <> 0
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth,
               rtrim(text, E'\x20\x09\x0A\x0B\x0C\x0D') AS said
        FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged)
    ), marked AS (
        SELECT *, said = '' AS blank, said <> '' AND nth > 1 AS duplicate,
               said <> '' AND nth = 1 AND right(said, 1) NOT IN ('.', '!', '?') AS truncated,
               left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
        FROM placed
    ), counted AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
               count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
               count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
        FROM marked GROUP BY conv_id
    ), inserts(here, there, letters) AS (VALUES
        ('0', '0', ''), ('0', 'u', 'I'), ('0', 'a', 'II'), ('s', 's', ''), ('s', 'u', 'I'), ('s', 'a', 'II'),
        ('u', 'u', ''), ('u', 'a', 'I'), ('a', 'a', ''), ('a', 'u', 'I')
    ), reads(here, initial, there) AS (VALUES ('0', 's', 's'), ('0', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
    edits AS (
        SELECT DISTINCT m.conv_id, m.i, s.here, s.there, s.letters, s.cost FROM marked m, (
            SELECT here, here AS there, 'D' AS letters, 2 AS cost, NULL AS needs FROM inserts
            UNION ALL SELECT here, there, 'K', 0, initial FROM reads
            UNION ALL SELECT here, there, 'R', 1, NULL FROM reads WHERE initial <> 's') s
        WHERE s.letters = 'D' AND s.here IN ('0', 's', 'u', 'a')
           OR s.letters <> 'D' AND NOT m.blank AND NOT m.duplicate AND (s.needs IS NULL OR s.needs = m.initial)
    ), priced AS (
        SELECT e.conv_id, e.i, e.here, e.there, e.letters, e.cost + CASE WHEN m.truncated AND e.letters <> 'D' THEN 5 ELSE 0 END AS cost
        FROM edits e JOIN marked m ON m.conv_id IS NOT DISTINCT FROM e.conv_id AND m.i = e.i
    ), paths AS (
        SELECT conv_id, 0::BIGINT AS i, '0' AS state, '000000000' AS priced FROM counted
        UNION ALL
        SELECT p.conv_id, p.i + 1, e.there, min(lpad((p.priced[1:9]::BIGINT + 5 * len(n.letters) + e.cost)::VARCHAR, 9, '0')
               || p.priced[10:] || n.letters || e.letters)
        FROM paths p JOIN inserts n ON n.here = p.state
             JOIN priced e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.i = p.i + 1 AND e.here = n.there
        GROUP BY p.conv_id, p.i, e.there
    ), ended AS (
        SELECT p.conv_id, min(lpad((p.priced[1:9]::BIGINT + 5 * len(f.letters))::VARCHAR, 9, '0') || p.priced[10:] || f.letters) AS priced
        FROM paths p JOIN counted c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.i
             JOIN (VALUES ('0', ''), ('s', 'II'), ('u', 'I'), ('a', '')) f(state, letters) ON f.state = p.state
        GROUP BY p.conv_id
    ), audits AS (SELECT conv_id, priced[1:9]::BIGINT AS cost, priced[10:] AS audit FROM ended),
    letters AS (
        SELECT conv_id, place, audit[place] AS edit, place - len(replace(audit[1:place], 'I', '')) AS inserted
        FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS place FROM audits)
    ), staying AS (
        SELECT l.conv_id, l.place, l.edit, m.role, m.text, row_number() OVER (PARTITION BY l.conv_id ORDER BY l.place) AS nth,
               first_value(l.edit = 'K' AND m.initial = 's') OVER (PARTITION BY l.conv_id ORDER BY l.place) AS opened
        FROM letters l LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM l.conv_id AND m.i = l.place - l.inserted AND l.edit <> 'I'
        WHERE l.edit <> 'D'
    ), repaired AS (
        SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (nth - opened::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END
                   || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY place) AS said
        FROM staying GROUP BY conv_id
    )
    SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
           coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
           coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""
