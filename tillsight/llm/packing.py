"""Packing of token sequences by harmonic classes.

A document gives full sequences first. What is left, its tail, is of class k if it is longer than
1/(k+1) of the capacity and not longer than 1/k: the classes are the reciprocals 1, 1/2, 1/3, ... A bin
of class k takes exactly k tails, whole, so each worker fills the bins of each class on its own, by
counting. What k tails leave free is filled with the first tokens of the next document, the only
place where a tail is cut, so a bin is full to the last token. At its end a worker joins the tails of
its open bins, in sequences whose lengths are the capacity and then powers of two.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import text_values

CAPACITY = 1024
END_ID = 0
#: sequences of one task; a sequence id is the task's number times this, plus a count
TASK_SEQUENCES = 1 << 40
#: pieces with token bytes held before a batch is handed on
BATCH_TOKENS = 1_000_000

# Fixed value: the pattern by which byte-level tokenizers part a text before merging.
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

OUT = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
    "tokens binary"
)


def _kind(database, c: str) -> str:
    """What the pattern sees of a character: letter, digit, other, or unassigned."""
    category = database.category(c)
    return category if category in ("Cn", "Cs") else category[0] if category[0] in "LN" else "-"


@lru_cache(maxsize=1)
def _unsteady() -> re.Pattern:
    """Characters that are not the same to every version of Unicode since 3.2, and those beyond 16 bits: on
    them two implementations of the pattern may differ."""
    steady = [
        c for c in map(chr, range(0x10000))
        if _kind(unicodedata, c) == _kind(unicodedata.ucd_3_2_0, c) not in ("Cn", "Cs")
    ]
    runs: list[list[str]] = []
    for c in steady:
        if runs and ord(c) == ord(runs[-1][1]) + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return re.compile("[^" + "".join(f"{re.escape(x)}-{re.escape(y)}" for x, y in runs) + "]")


class Tokens:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The vocabulary and the merges of the file are run by a faster implementation of byte-pair merging; a text with
    characters on which the two might part it differently goes to the tokenizer itself.
    """

    def __init__(self, path: str):
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        told = _told(path)
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        written = {c: b for b, c in _byte_letters().items()}
        ranks = {
            bytes(written[c] for c in word): i
            for word, i in told["model"]["vocab"].items() if word not in self.special
        }
        self.fast = Encoding(path, pat_str=_PARTS, mergeable_ranks=ranks, special_tokens=self.special)
        self.unsteady = _unsteady()

    def encode(self, text: str) -> bytes:
        if self.unsteady.search(text):
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        else:
            ids = self.fast.encode_to_numpy(text, allowed_special="all")
        return ids.astype("<u4", copy=False).tobytes()


def _byte_letters() -> dict[int, str]:
    """How byte-level tokenizers write bytes: printable ones as themselves, the others, in their order, as the
    letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def _told(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def require_byte_level(path: str) -> None:
    """Raises unless the file holds a tokenizer of the kind that :class:`Tokens` runs: byte-level, with
    the usual pattern, no normalizer, and ids that rise with the merges."""
    told = _told(path)
    split, model = told.get("pre_tokenizer") or {}, told.get("model") or {}
    plain = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    fits = (
        told.get("normalizer") is None
        and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
        and model.get("type", "BPE") == "BPE" and not any(model.get(name) for name in plain)
        and all(t["special"] and not t["lstrip"] and not t["rstrip"] for t in told.get("added_tokens", ()))
    )
    if fits:
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"].get("".join(pair), -1) for pair in pairs]
        fits = made == sorted(made) and all(
            0 <= model["vocab"].get(c, -1) < (made or [256])[0] for c in _byte_letters().values()
        )
    if not fits:
        raise ValueError(f"{path} is no byte-level tokenizer without normalizer")


@lru_cache(maxsize=2)
def _tokens(path: str) -> Tokens:
    return Tokens(path)


def cut_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of sequences that ``n`` tokens fill: the capacity, then falling powers of two."""
    rest = n % capacity
    return [capacity] * (n // capacity) + [
        1 << b for b in range(capacity.bit_length() - 1, -1, -1) if rest >> b & 1
    ]


class _Bins:
    """The open bin of each class of one worker, and the bins that have their tails and wait to be filled. A
    piece is (document, start, tokens of the document, bytes of the piece)."""

    def __init__(self, first: int, capacity: int):
        self.next, self.capacity = first, capacity
        self.open: dict[int, list] = {}
        self.waiting: deque[list] = deque()

    def place(self, doc, data: bytes) -> list:
        """Pieces whose bin is full now, each with its sequence and offset."""
        n, at, out = len(data) // 4, 0, []

        def piece(length: int) -> tuple:
            nonlocal at
            at += length
            return doc, at - length, n, data[4 * (at - length) : 4 * at]

        while self.waiting and at < n:
            held = self.waiting[0]
            free = self.capacity - _used(held)
            held.append(piece(min(free, n - at)))
            if _used(held) == self.capacity:
                out += self._bin(self.waiting.popleft())
        while n - at >= self.capacity:
            out += self._bin([piece(self.capacity)])
        if at < n:
            tails = self.capacity // (n - at)
            held = self.open.setdefault(tails, [])
            held.append(piece(n - at))
            if len(held) == tails:
                del self.open[tails]
                if _used(held) == self.capacity:
                    out += self._bin(held)
                else:
                    self.waiting.append(held)
        return out

    def close(self) -> list:
        """All that is left, end to end, cut where a sequence is full."""
        left = [p for held in [*self.waiting, *self.open.values()] for p in held]
        self.open, self.waiting, out = {}, deque(), []
        left.reverse()
        for length in cut_lengths(_used(left), self.capacity):
            held: list = []
            while (free := length - _used(held)) > 0:
                doc, start, n, data = left.pop()
                if len(data) > 4 * free:
                    left.append((doc, start + free, n, data[4 * free :]))
                held.append((doc, start, n, data[: 4 * free]))
            out += self._bin(held)
        return out

    def _bin(self, pieces: list) -> list:
        number, self.next = self.next, self.next + 1
        out, at = [], 0
        for p in pieces:
            out.append((p, number, at))
            at += len(p[3]) // 4
        return out


def _used(pieces: list) -> int:
    return sum(len(p[3]) for p in pieces) // 4


def _batch(placed: list) -> pa.RecordBatch:
    pieces = [p for p, _, _ in placed]
    columns = [
        pa.array([p[0] for p in pieces], pa.int64()),
        pa.array([p[1] for p in pieces], pa.int64()),
        pa.array([len(p[3]) // 4 for p in pieces], pa.int64()),
        pa.array([p[2] for p in pieces], pa.int64()),
        pa.array([s for _, s, _ in placed], pa.int64()),
        pa.array([o for _, _, o in placed], pa.int64()),
        pa.array([p[3] for p in pieces], pa.binary()),
    ]
    names = [part.split()[0] for part in OUT.split(", ")]
    return pa.RecordBatch.from_arrays(columns, names)


def pack(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, tokens``.

    A document is its token ids (no special tokens added) and ``end_id``; ``tokens`` holds the ids
    of the piece as little-endian unsigned 32-bit numbers. A sequence is filled without gaps from
    offset 0; its used length is the capacity or, a few times a task, a smaller power of two, so nothing is
    padded. A tail is one piece but where it fills a bin. ``capacity`` must be a power of two, the tokenizer a
    byte-level one with the usual pattern and without normalizer; others are refused. Null and empty texts are the end id alone. Rows without id
    and rows with the same id are documents of their own. Other columns are ignored, and an empty
    table gives no pieces. Nothing is shuffled, and a task holds one open bin per class.

    Sequence ids are unique but follow the tasks: another split of the input gives other bins.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    require_byte_level(tokenizer_path)

    def run(batches):
        tokens = _tokens(tokenizer_path)
        bins = _Bins(TaskContext.get().partitionId() * TASK_SEQUENCES, capacity)
        last = np.array([end_id], "<u4").tobytes()
        placed, held = [], 0
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for doc, text in zip(ids, text_values(batch.column("text"))):
                data = tokens.encode(text) + last
                placed += bins.place(doc, data)
                held += len(data) // 4
                if held >= BATCH_TOKENS:
                    yield _batch(placed)
                    placed, held = [], 0
        placed += bins.close()
        if placed:
            yield _batch(placed)

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, OUT
    )
