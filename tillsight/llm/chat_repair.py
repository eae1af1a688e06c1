"""Repair of conversation structure by generalised LR parsing with edits.

A conversation must read ``(s?(ua)+)?`` in the initials of its roles. The grammar's stacks end in nothing,
``s``, ``u`` or a finished list of pairs, and what may follow depends on that top alone. Turns are read in
order with a graph-structured stack of these tops: every top can keep, delete or rerole the turn or have
a turn inserted, at a cost, and equal tops merge into the one with the smallest (cost, audit).
No audit of a top is the beginning of another with the same cost, so what follows never changes the choice.

Conversations are range-partitioned by their turns and parsed in segments of bounded size. A segment
that may not start at the beginning is parsed from every top, so a conversation of any length
spreads over many tasks; the few segments of it are then joined by the same merge, without the texts.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.common import spill

#: costs of the edits
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: turns and characters of a segment; characters of a text that order turns with the same number
SEGMENT_TURNS, SEGMENT_CHARS, PREFIX = 512, 1 << 20, 64
#: tops of a stack: nothing, s, u, and pairs; what a shifted (and, after ``a``, reduced) initial makes of them
NOTHING, SYSTEM, USER, PAIRS = range(4)
SHIFT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": PAIRS}, {"u": USER})
ACCEPT = (NOTHING, PAIRS)
LEGAL = ("su", "ua", "au")
#: a turn as the parser sees it: its initial, in capitals if truncated; other initials; must go
OTHER, OTHER_TRUNCATED, GONE = "o", "O", "x"

_TURN = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
_PATHS = T.ArrayType(
    T.StructType(
        [T.StructField(n, t) for n, t in (
            ("enter", T.IntegerType()), ("leave", T.IntegerType()), ("cost", T.LongType()), ("audit", T.StringType())
        )]
    )
)
FAULTS = ("blank", "duplicate", "truncated")
_COUNTS = (*FAULTS, "illegal", "turns", "low", "high")


def damage(conversations: DataFrame) -> DataFrame:
    """The turns (conv_id, turn, role, text, times) with faults set by a hash of their number: ``times``
    is 0 for a dropped turn, 2 for a repeated one. Null roles and texts are one space."""
    space = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    kind = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return conversations.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )


def _better(tops: dict, top: int, cost: int, audit: str) -> bool:
    if top in tops and tops[top] <= (cost, audit):
        return False
    tops[top] = (cost, audit)
    return True


def _inserted(tops: dict) -> dict:
    """The tops with those that inserted turns make of them."""
    fresh = list(tops)
    while fresh:
        top = fresh.pop()
        cost, audit = tops[top]
        for initial in "ua":
            after = SHIFT[top].get(initial)
            if after is not None and _better(tops, after, cost + INSERT, audit + "I"):
                fresh.append(after)
    return tops


def _parse(symbols: str, enter: int) -> tuple[tuple[int, int, str], ...]:
    tops = _inserted({enter: (0, "")})
    for symbol in symbols:
        merged: dict = {}
        initial = symbol.lower()
        extra = TRUNCATED if symbol != initial else 0
        for top, (cost, audit) in tops.items():
            _better(merged, top, cost + DELETE, audit + "D")
            if symbol == GONE:
                continue
            for letter, after in SHIFT[top].items():
                if letter == initial:
                    _better(merged, after, cost + KEEP + extra, audit + "K")
                if letter in "ua":
                    _better(merged, after, cost + REROLE + extra, audit + "R")
        tops = _inserted(merged)
    return tuple((top, cost, audit) for top, (cost, audit) in sorted(tops.items()))


_parse_short = lru_cache(maxsize=20_000)(_parse)


def parse(symbols: str, enter: int = NOTHING) -> tuple[tuple[int, int, str], ...]:
    """Cheapest (top, cost, audit) of each top that a segment can end with when it starts with ``enter``."""
    return (_parse_short if len(symbols) <= 24 else _parse)(symbols, enter)


def cheapest(tops) -> tuple[int, int, str]:
    """The (top, cost, audit) to accept."""
    return min((t for t in tops if t[0] in ACCEPT), key=lambda t: t[1:])


def rebuild(turns: list, audit: str, enter: int = NOTHING) -> list[tuple[str, str]]:
    """The (role, text) that the edits of an audit make of a segment's turns."""
    out, top, rest = [], enter, iter(turns)
    for edit in audit:
        role, text = (None, "") if edit == "I" else next(rest)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if top == USER else "user"
        top = SHIFT[top][role[0]]
        out.append((role, text))
    return out


class _Segment:
    """Turns of one conversation that follow each other, as far as they are parsed together."""

    def __init__(self, conversation, start: bool):
        self.conversation, self.start = conversation, start
        self.symbols, self.turns, self.chars = [], [], 0
        self.count = dict.fromkeys(FAULTS + ("illegal", "turns"), 0)
        self.low = self.high = self.first = self.last = None

    def full(self) -> bool:
        return len(self.symbols) >= SEGMENT_TURNS or self.chars >= SEGMENT_CHARS

    def add(self, turn, role: str, text: str, fault: str | None) -> None:
        initial = role[:1]
        if self.symbols:
            self.count["illegal"] += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.last = initial
        if turn is not None and turn != self.high:
            self.count["turns"] += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        if fault:
            self.count[fault] += 1
        if fault in ("blank", "duplicate"):
            symbol, text = GONE, None
        else:
            symbol = initial if initial in ("s", "u", "a") else OTHER
            symbol = symbol.upper() if fault else symbol
        self.symbols.append(symbol)
        self.turns.append((role, text))
        self.chars += len(text or "")

    def row(self, part: int, number: int, whole: bool) -> dict:
        symbols = "".join(self.symbols)
        paths = [
            {"enter": enter, "leave": top, "cost": cost, "audit": audit}
            for enter in ((NOTHING,) if self.start else range(len(SHIFT)))
            for top, cost, audit in parse(symbols, enter)
        ]
        turns = self.turns
        if whole:
            top, cost, audit = cheapest((p["leave"], p["cost"], p["audit"]) for p in paths)
            paths = [{"enter": NOTHING, "leave": top, "cost": cost, "audit": audit}]
            turns = rebuild(turns, audit)
        return {
            "conv_id": self.conversation, "part": part, "number": number, "whole": whole,
            **self.count, "low": self.low, "high": self.high, "first": self.first, "last": self.last,
            "paths": paths, "items": [{"role": r, "text": t} for r, t in turns],
        }


def _segments(schema: pa.Schema):
    def run(batches):
        part = TaskContext.get().partitionId()
        made: list[dict] = []
        chars = number = 0
        open_: _Segment | None = None
        first_of = None  # the (turn, digest) at which a role and text stand for the first time
        runs = 0  # conversations begun in this partition

        def close(ended: bool) -> None:
            nonlocal number, chars
            # the first and last conversation of a partition may go on in others
            made.append(open_.row(part, number, ended and open_.start))
            number += 1
            chars += open_.chars

        for batch in batches:
            for row in batch.to_pylist():
                conversation, turn = row["conv_id"], row["turn"]
                if open_ is None or open_.conversation != conversation:
                    if open_ is not None:
                        close(True)
                    open_ = _Segment(conversation, start=runs > 0)
                    runs += 1
                here = (conversation, turn, row["digest"])
                if row["mark"]:
                    first_of = here
                    continue
                for i in range(row["n"]):
                    if open_.full():
                        close(False)
                        open_ = _Segment(conversation, start=False)
                    fault = row["fault"]
                    if fault != "blank" and (i or first_of != here):
                        fault = "duplicate"
                    open_.add(turn, row["role"], row["text"], fault)
                if len(made) >= 1000 or chars >= 4 * SEGMENT_CHARS:
                    yield pa.RecordBatch.from_pylist(made, schema)
                    made, chars = [], 0
        if open_ is not None:
            close(False)
        if made:
            yield pa.RecordBatch.from_pylist(made, schema)

    return run


def _fault(text: Column) -> Column:
    return F.when(~text.rlike(r"[^\x20\x09-\x0D]"), "blank").when(
        ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated"
    )


def segments(rows: DataFrame) -> DataFrame:
    """Parsed segments, written to the shared folder.

    Equal turns of a conversation travel as one with a count. Where a role and text stand for the
    first time is found from 128-bit digests, so that repeats need no common task.
    """
    ident, turn = rows.schema["conv_id"], rows.schema["turn"]
    there = F.col("times") > 0
    counted = (
        rows.select(
            "conv_id",
            F.when(there, F.col("turn")).alias("turn"),
            F.when(there, F.col("role")).otherwise("").alias("role"),
            F.when(there, F.col("text")).otherwise("").alias("text"),
            "times",
        )
        .groupBy("conv_id", "turn", "role", "text")
        .agg(F.sum("times").alias("n"))
        .withColumns(
            {
                "fault": _fault(F.col("text")),
                "prefix": F.substring("text", 1, PREFIX),
                "digest": F.unhex(F.md5(F.concat_ws(":", F.length("role"), "role", "text").cast("binary"))),
                "mark": F.lit(False),
            }
        )
    )
    # nulls first, as the turns are ordered
    least = F.min(F.struct(F.col("turn").isNotNull().alias("_known"), F.col("turn")))
    marks = (
        counted.where((F.col("n") > 0) & ~F.col("fault").eqNullSafe("blank"))
        .groupBy("conv_id", "role", "prefix", "digest")
        .agg(least.alias("_least"))
        .select("conv_id", F.col("_least.turn").alias("turn"), "role", "prefix", "digest", F.lit(True).alias("mark"))
    )
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "prefix", "digest")]
    ordered = (
        counted.unionByName(marks, allowMissingColumns=True)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order, F.desc("mark"))
        .select("conv_id", "turn", "role", "text", "n", "fault", "digest", "mark")
    )
    fields = [
        T.StructField("conv_id", ident.dataType), T.StructField("part", T.IntegerType()),
        T.StructField("number", T.IntegerType()), T.StructField("whole", T.BooleanType()),
        *[T.StructField(c, T.LongType()) for c in (*FAULTS, "illegal", "turns")],
        *[T.StructField(c, turn.dataType) for c in ("low", "high")],
        *[T.StructField(c, T.StringType()) for c in ("first", "last")],
        T.StructField("paths", _PATHS), T.StructField("items", _TURN),
    ]
    schema = T.StructType(fields)
    return spill(ordered.mapInArrow(_segments(_arrow(schema)), schema), "segments")


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


class _Joined:
    """The segments of a conversation put together, one after the other."""

    def __init__(self, conversation):
        self.conversation = conversation
        self.count = dict.fromkeys(FAULTS + ("illegal", "turns"), 0)
        self.low = self.high = self.last = None
        self.tops, self.settled = {NOTHING: (0, "")}, []
        self.back: list[tuple[int, int, dict]] = []

    def add(self, row: dict) -> None:
        for c in self.count:
            self.count[c] += row[c]
        if row["first"] is not None:
            if self.last is not None:
                self.count["illegal"] += self.last + row["first"] not in LEGAL
            self.last = row["last"]
        if row["low"] is not None:
            self.count["turns"] -= self.high == row["low"]
            self.low, self.high = row["low"] if self.low is None else self.low, row["high"]
        merged, came = {}, {}
        for p in row["paths"]:
            if p["enter"] in self.tops:
                cost, audit = self.tops[p["enter"]]
                if _better(merged, p["leave"], cost + p["cost"], audit + p["audit"]):
                    came[p["leave"]] = p["enter"]
        # what all audits begin with is settled
        same = len(commonprefix([a for _, a in merged.values()]))
        self.settled.append(next(iter(merged.values()))[1][:same])
        self.tops = {top: (cost, audit[same:]) for top, (cost, audit) in merged.items()}
        self.back.append((row["part"], row["number"], came))

    def row(self) -> dict:
        top, cost, audit = cheapest((t, c, a) for t, (c, a) in self.tops.items())
        chosen = []
        for part, number, came in reversed(self.back):
            chosen.append({"part": part, "number": number, "enter": came[top], "leave": top})
            top = came[top]
        return {
            "conv_id": self.conversation, **self.count, "low": self.low, "high": self.high,
            "cost": cost, "audit": "".join(self.settled) + audit, "chosen": chosen,
        }


def _joining(schema: pa.Schema):
    def run(batches):
        open_ = None
        for batch in batches:
            for row in batch.to_pylist():
                if open_ is None or open_.conversation != row["conv_id"]:
                    if open_ is not None:
                        yield pa.RecordBatch.from_pylist([open_.row()], schema)
                    open_ = _Joined(row["conv_id"])
                open_.add(row)
        if open_ is not None:
            yield pa.RecordBatch.from_pylist([open_.row()], schema)

    return run


def _rebuilding(schema: pa.Schema):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                turns = rebuild([(t["role"], t["text"]) for t in row["items"]], row["audit"], row["enter"])
                out = {"conv_id": row["conv_id"], "part": row["part"], "number": row["number"]}
                yield pa.RecordBatch.from_pylist([{**out, "items": [{"role": r, "text": t} for r, t in turns]}], schema)

    return run


@dataclass(frozen=True)
class Repaired:
    """``conversations``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. ``turns``: the
    repaired turns (conv_id, part, number, items of role and text), a conversation's rows in the order of
    part and number; ``whole`` says that a conversation has just this row."""

    conversations: DataFrame
    turns: DataFrame


def repair(rows: DataFrame) -> Repaired:
    """Every conversation of the rows (conv_id, turn, role, text, times) repaired at the least cost.

    Turns are taken by number, nulls first, turns with the same number by role and then text (its
    first 64 characters, then its digest). ``times`` says how often a turn stands there; a
    conversation of turns that stand nowhere has zeros, an empty audit and no turns. Null roles and texts are
    one space; null conversation ids make one conversation. Blank turns and repeats of a role and text must go.
    Other columns are not read; no rows make no conversations.
    """
    space = F.lit(" ")
    rows = rows.withColumns({"role": F.coalesce("role", space), "text": F.coalesce("text", space)})
    parsed = segments(rows)
    done = parsed.where("whole")
    totals = ["conv_id", *FAULTS, "illegal", "turns", "low", "high"]
    kinds = [T.StructField(c, parsed.schema[c].dataType) for c in totals]
    chosen_type = T.ArrayType(
        T.StructType([T.StructField(c, T.IntegerType()) for c in ("part", "number", "enter", "leave")])
    )
    schema = T.StructType(
        [*kinds, T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
         T.StructField("chosen", chosen_type)]
    )
    parts = parsed.where("NOT whole")
    joined = spill(
        parts.drop("items", "whole")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "number")
        .mapInArrow(_joining(_arrow(schema)), schema),
        "joined",
    )
    path = F.col("paths")[0]
    each = done.select(*totals, path["cost"].alias("cost"), path["audit"].alias("audit")).unionByName(joined.drop("chosen"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long")
    conversations = each.select("conv_id", gaps.alias("gaps"), *FAULTS, "illegal", "cost", "audit")

    ways = joined.select(F.explode("chosen").alias("c")).select("c.*")
    picked = F.filter("paths", lambda p: (p["enter"] == F.col("enter")) & (p["leave"] == F.col("leave")))[0]["audit"]
    turns_schema = T.StructType(
        [parsed.schema[c] for c in ("conv_id", "part", "number")] + [T.StructField("items", _TURN)]
    )
    long = (
        parts.join(ways, ["part", "number"])
        .select("conv_id", "part", "number", "items", "enter", picked.alias("audit"))
        .mapInArrow(_rebuilding(_arrow(turns_schema)), turns_schema)
    )
    turns = done.select(*turns_schema.names, "whole").unionByName(long.withColumn("whole", F.lit(False)))
    return Repaired(conversations, turns)


def _digesting(schema: pa.Schema):
    def run(batches):
        conversation = digest = None
        empty = True
        for batch in batches:
            for row in batch.to_pylist():
                if digest is None or row["conv_id"] != conversation:
                    if digest is not None:
                        yield pa.RecordBatch.from_pylist([{"conv_id": conversation, "sha256": digest.hexdigest()}], schema)
                    conversation, digest, empty = row["conv_id"], hashlib.sha256(), True
                for item in row["lines"]:
                    digest.update((item if empty else "\n" + item).encode())
                    empty = False
        if digest is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conversation, "sha256": digest.hexdigest()}], schema)

    return run


def digests(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, sha256) of the repaired ``role:text``, newline-joined. A conversation in several rows
    is read once, in its order, a batch of rows at a time."""
    lines = F.transform("items", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    told = turns.withColumn("lines", lines)
    whole = told.where("whole").select("conv_id", F.sha2(F.concat_ws("\n", "lines"), 256).alias("sha256"))
    schema = T.StructType([turns.schema["conv_id"], T.StructField("sha256", T.StringType())])
    parts = (
        told.where("NOT whole")
        .select("conv_id", "part", "number", "lines")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "number")
        .mapInArrow(_digesting(_arrow(schema)), schema)
    )
    return whole.unionByName(parts)
