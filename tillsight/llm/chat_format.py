"""Chat formatting: roles of raw transcripts by a hidden Markov model, rendered as canonical turns.

Each line is emitted by a hidden state, a role that begins or goes on. What is seen of a line is its
speaker marker and a few plain features. Viterbi finds the likeliest states, so a turn whose marker
is missing still gets a role from its neighbours, and a marker-like line inside a turn need not end
it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.common import text_values, with_derived

ROLES = ("system", "user", "assistant")
#: a role that begins, then the same role going on
STATES = tuple((r, b) for r in ROLES for b in (True, False))
#: turns of a conversation that make up one transcript; transcripts and characters handed on at once
SEGMENT_TURNS, BATCH_TRANSCRIPTS, BATCH_CHARS = 256, 256, 1 << 22

# Speaker names by role.
SPEAKERS = {
    "system": "system context rules preamble setup".split(),
    "user": "user human question q customer client instruction prompt me you>".split(),
    "assistant": "assistant ai bot answer a response agent model".split(),
}
_ROLE_OF = {name: role for role, names in SPEAKERS.items() for name in names}
_MARKER = re.compile(
    r"^\s{0,3}(?:#{1,6}\s*|\*\*|<\|?|\[)?\s*([A-Za-z][A-Za-z]{0,15})(?: (?:prompt|input|output))?"
    r"\s*(?:\*\*:?|\|?>|\]:?|:)(?:\*\*)?[ \t]*"
)
_QUOTE = re.compile(r"^>[ \t]?")
_LENGTHS = (0, 40, 120, 400)

TURN = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("content", pa.string())]))


def marker(line: str) -> tuple[str, int]:
    """``(kind, length)`` of the marker at the start of a line: a role, ``quote``, ``other`` or none."""
    m = _MARKER.match(line)
    if m:
        return _ROLE_OF.get(m[1].lower(), "other"), m.end()
    m = _QUOTE.match(line)
    return ("quote", m.end()) if m else ("", 0)


_KINDS = {k: i for i, k in enumerate((*ROLES, "quote", "other", ""))}
#: sizes of the features of a line: marker, line before it, length, last character
_SIZES = (len(_KINDS), 3, len(_LENGTHS) + 1, 3)


def markers(lines: list[str]) -> list[tuple[str, int]]:
    """The marker of each line of a transcript; where users have a name, ``>`` only quotes."""
    found = [marker(line) for line in lines]
    if any(kind == "user" for kind, _ in found):
        found = [("", 0) if kind == "quote" else (kind, n) for kind, n in found]
    return found


def observe(lines: list[str]) -> np.ndarray:
    out = np.zeros((len(lines), len(_SIZES)), np.int64)
    before = 2
    for i, (line, (kind, _)) in enumerate(zip(lines, markers(lines))):
        text = line.strip()
        out[i] = (
            _KINDS[kind],
            before,
            sum(len(text) > n for n in _LENGTHS),
            1 if text[-1:] in ("?", "？") else 2 if text[-1:] in (".", "!", "…") else 0,
        )
        before = 0 if text else 1
    return out


@dataclass(frozen=True)
class Model:
    """Log probabilities: of the first state, from state to state, and of each feature by state."""

    start: np.ndarray
    move: np.ndarray
    emit: tuple

    def states(self, seen: np.ndarray) -> np.ndarray:
        """The likeliest state of each line."""
        score = sum(e[:, seen[:, f]] for f, e in enumerate(self.emit)).T
        back = np.zeros(score.shape, np.int64)
        best = self.start + score[0]
        for i in range(1, len(score)):
            through = best[:, None] + self.move
            back[i] = through.argmax(axis=0)
            best = through.max(axis=0) + score[i]
        at = np.empty(len(score), np.int64)
        at[-1] = int(best.argmax())
        for i in range(len(score) - 1, 0, -1):
            at[i - 1] = back[i, at[i]]
        return at


#: cells of the counts a model is made of: first states, moves, then each feature by state
_CELLS = len(STATES) * (1 + len(STATES) + sum(_SIZES))
_NUMBER = {s: i for i, s in enumerate(STATES)}


def count_lines(lines: list[tuple[str, bool, str]]) -> np.ndarray:
    """What one labelled transcript, lines ``(role, begins, line)``, adds to the cells."""
    n, out = len(STATES), np.zeros(_CELLS)
    if not lines:
        return out
    states = np.array([_NUMBER[role, begins] for role, begins, _ in lines])
    out[states[0]] += 1
    np.add.at(out, n + states[:-1] * n + states[1:], 1)
    at = n + n * n
    for values, size in zip(observe([line for _, _, line in lines]).T, _SIZES):
        np.add.at(out, at + states * size + values, 1)
        at += n * size
    return out


def model_of(counts: np.ndarray) -> Model:
    """Log shares of the counts, each smoothed by a half, moves by a twentieth; a turn cannot go on
    in another role."""
    n = len(STATES)
    start, move = 0.5 + counts[:n], 0.05 + counts[n : n + n * n].reshape(n, n)
    for i, (role, begins) in enumerate(STATES):
        start[i] -= 0.0 if begins else 0.49
        for j, (other, new) in enumerate(STATES):
            if not new and other != role:
                move[i, j] -= 0.05 - 1e-9
    emit, at = [], n + n * n
    for size in _SIZES:
        emit.append(0.5 + counts[at : at + n * size].reshape(n, size))
        at += n * size
    return Model(
        np.log(start / start.sum()),
        np.log(move / move.sum(axis=1, keepdims=True)),
        tuple(np.log(e / e.sum(axis=1, keepdims=True)) for e in emit),
    )


def fit_lines(transcripts: list[list[tuple[str, bool, str]]]) -> Model:
    """The model of labelled transcripts."""
    return model_of(sum((count_lines(rows) for rows in transcripts), np.zeros(_CELLS)))


def parse(model: Model, text: str) -> list[dict]:
    """Turns of a transcript in order. A marker that begins a turn and names its role is taken off, ``>``
    from a user's turn; anything else is text. A line without marker below a marker that stands alone goes
    with it, whatever its state. White space around a turn goes; a turn that is empty then stays as an empty
    turn if a marker began it."""
    if not text or not text.strip():
        return []
    lines = text.split("\n")
    turns: list[tuple[str, list[str], bool]] = []
    waits = False  # the turn has a marker and nothing else yet
    for line, (kind, length), s in zip(lines, markers(lines), model.states(observe(lines))):
        role, begins = STATES[s]
        if not turns or begins and not (waits and kind not in ROLES):
            named = kind == role or kind == "quote" and role == "user"
            line = line[length:] if named else line
            turns.append((role, [line], named))
            waits = named
        else:
            turns[-1][1].append(line)
        waits = waits and not line.strip()
    made = [(role, "\n".join(part).strip(), marked) for role, part, marked in turns]
    return [{"role": role, "content": content} for role, content, marked in made if content or marked]


def render(turns: list[dict]) -> str:
    """Canonical text: ``<|role|>``, the content and ``<|end|>`` on lines of their own. ``<|`` in a
    content gets a second bar, so that the text can be read back."""
    return "".join(
        f"<|{t['role']}|>\n{t['content'].replace('<|', '<||')}\n<|end|>\n" for t in turns
    )


_TURN = re.compile(r"<\|(system|user|assistant)\|>\n(.*?)\n<\|end\|>\n", re.S)


def read_back(text: str) -> list[dict]:
    return [{"role": m[1], "content": m[2].replace("<||", "<|")} for m in _TURN.finditer(text)]


def format_chats(df: DataFrame, model: Model, text_col: str = "transcript") -> DataFrame:
    """Every row with ``turns`` (role and content) and ``chat``, their canonical text.

    Null and empty transcripts have no turns and an empty chat. Equal rows stay separate, columns
    named ``turns`` or ``chat`` are replaced, others pass through, an empty table stays empty. The
    step is narrow.
    """

    def make(batch):
        turns = [parse(model, t) for t in text_values(batch.column(text_col))]
        return [pa.array(turns, _TURNS), pa.array([render(t) for t in turns], pa.string())]

    return with_derived(
        df, make, T.StructField("turns", T.ArrayType(TURN)), T.StructField("chat", T.StringType())
    )


def fit(df: DataFrame, turns_col: str = "lines") -> Model:
    """Learn from all labelled transcripts, an array of ``(role, text)`` per row, the text of a turn as it
    stands in the transcript, marker included. Tasks count, Spark adds up, and a table of fixed size comes
    to the driver. Turns of unknown role end a transcript; no transcripts give the smoothed model."""

    def run(batches):
        total = np.zeros(_CELLS)
        for batch in batches:
            for turns in batch.column(0).to_pylist():
                lines: list[tuple[str, bool, str]] = []
                for t in turns or ():
                    if t["role"] not in ROLES:
                        break
                    lines += [(t["role"], i == 0, line) for i, line in enumerate((t["text"] or "").split("\n"))]
                total += count_lines(lines)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    counts = np.zeros(_CELLS)
    sums = df.select(turns_col).mapInArrow(run, "cell long, n double").groupBy("cell").agg(F.sum("n"))
    for cell, n in sums.collect():  # _CELLS rows at most
        counts[cell] = n
    return model_of(counts)


# Ways in which raw transcripts mark their speakers, and what stands between turns.
STYLES = (
    ({"system": "System: ", "user": "User: ", "assistant": "Assistant: "}, "\n"),
    ({"system": "System: ", "user": "Human: ", "assistant": "AI: "}, "\n\n"),
    ({"system": "### Context:\n", "user": "### Instruction:\n", "assistant": "### Response:\n"}, "\n\n"),
    ({"system": "[system] ", "user": "[user] ", "assistant": "[assistant] "}, "\n"),
    ({"system": "**Rules:** ", "user": "**Q:** ", "assistant": "**A:** "}, "\n"),
    ({"system": "System: ", "user": "> ", "assistant": ""}, "\n\n"),
)


_LINES = T.ArrayType(
    T.StructType([T.StructField(c, T.StringType()) for c in ("role", "text", "content")])
)


def _assembling(schema: pa.Schema):
    """Turns in order to transcripts, held one at a time."""

    def run(batches):
        made, chars, said, key, between = [], 0, [], None, ""

        def close():
            last = len(said) - 1
            made.append(
                {
                    "conv_id": key[0], "segment": key[1],
                    "lines": [
                        # with the empty lines before the next turn
                        {"role": r, "text": t + between[1:] if i < last else t, "content": c}
                        for i, (r, t, c) in enumerate(said)
                    ],
                }
            )

        for batch in batches:
            for row in batch.to_pylist():
                own = (row["conv_id"], row["segment"], row["single"])
                if said and (own != key or len(said) == SEGMENT_TURNS):
                    close()
                    said = []
                key, between, text = own, row["between"], row["text"] or ""
                said.append((row["role"], row["mark"] + text, text.strip()))
                chars += len(text)
                if len(made) >= BATCH_TRANSCRIPTS or chars >= BATCH_CHARS:
                    yield pa.RecordBatch.from_pylist(made, schema)
                    made, chars = [], 0
        if said:
            close()
        yield pa.RecordBatch.from_pylist(made, schema)

    return run


def transcripts(df: DataFrame) -> DataFrame:
    """The turns of :func:`transcript_turns` with their ``transcript``."""
    return with_transcript(transcript_turns(df))


def with_transcript(turns: DataFrame) -> DataFrame:
    """Adds the raw text that the turns make up."""
    return turns.withColumn("transcript", F.array_join(F.transform("lines", lambda t: t["text"]), "\n"))


def transcript_turns(df: DataFrame) -> DataFrame:
    """Turns of raw transcripts made from ``(conv_id, turn, role, text)``: ``conv_id, segment, lines``
    (role, text as it stands there, content), in a style chosen by the id; every seventh answer has lost
    its marker.

    A conversation of any length is cut into segments of ``SEGMENT_TURNS`` turn numbers, each a
    transcript. Turns with the same number follow by role and text; where they make a segment longer, it
    gives several transcripts. Rows without conversation id or turn number have no neighbours: each is a
    transcript of its own. Unknown and null roles get no marker; null texts are empty. Rows are read in
    order and a transcript is held at a time, so no group must fit in memory.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES))).cast("int")
    lost = (F.col("role") == "assistant") & (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(7)) == 0)
    mark = F.lit("")
    for i, (names, _) in enumerate(STYLES):
        for role, name in names.items():
            mark = F.when((F.col("style") == i) & (F.col("role") == role), F.lit(name)).otherwise(mark)
    between = F.element_at(F.array(*(F.lit(b) for _, b in STYLES)), F.col("style") + 1)
    alone = F.col("conv_id").isNull() | F.col("turn").isNull()
    schema = T.StructType(
        [df.schema["conv_id"], T.StructField("segment", T.LongType()),
         T.StructField("lines", _LINES)]
    )
    rows = df.select("conv_id", "turn", "role", "text", style.alias("style")).select(
        "conv_id", "turn", "role", "text", between.alias("between"),
        F.floor(F.col("turn") / SEGMENT_TURNS).cast("long").alias("segment"),
        F.when(lost, F.lit("")).otherwise(mark).alias("mark"),
        F.when(alone, F.monotonically_increasing_id()).alias("single"),
    )
    key = ["conv_id", "segment", "single"]
    return (
        rows.repartition(*key)
        .sortWithinPartitions(*key, "turn", "role", "text")
        .mapInArrow(_assembling(to_arrow_schema(schema)), schema)
    )
