"""Removal of word windows that occur earlier in the corpus, by Rabin-Karp hashes.

Documents are dealt into blocks by id. A block hashes every window of its documents; of equal
windows in a block the first is sent on, the others are known to be repeats at once, so a passage
that a third of all documents share costs one row per block. The hashes of all blocks are counted
per hash range, and what comes back to a block is one bit per window sent: an earlier document has
it. Blocks then merge repeated windows into maximal intervals and cut them out.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.common import byte_values, chars, plus

#: characters of text in a block, on average
BLOCK_CHARS = 3_000_000
#: windows counted together in one hash range, on average
RANGE_WINDOWS = 1_000_000
#: a hash range keeps the low seven bytes of a hash, so there are at least so many
LEAST_RANGES = 256
#: bases of the two rolling hashes modulo 2**64: odd, so that their powers can be divided by
BASES = (0x9E3779B97F4A7C13, 0xC2B2AE3D27D4EB4F)
#: bytes of a window's hashes that are sent: all but the first of the one, the last of the other
HASH_BYTES, MORE_BYTES = 7, 2
#: bits of the text's hash, and of the row's, that order rows without id
_TEXT_BITS, _ROW_BITS = 40, 21
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_KNOWN_WORDS = 150_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _WordHashes()
_powers = np.ones((4, 1), np.uint64)


def _power_table(n: int) -> np.ndarray:
    """Powers of the bases and of their inverses, at least ``n`` of each."""
    global _powers
    if _powers.shape[1] < n:
        size = 1 << (n - 1).bit_length()
        start = [x for base in BASES for x in (base, pow(base, -1, 1 << 64))]
        steps = np.repeat(np.array(start, np.uint64)[:, None], size, axis=1)
        steps[:, 0] = 1
        _powers = np.cumprod(steps, axis=1, dtype=np.uint64)
    return _powers


def window_hashes(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hash of every window of ``window`` words: the sum of word hashes times falling
    powers of the base, rolled by prefix sums, then mixed. 64 bits, and 16 bits of another base."""
    n = len(words)
    if n < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint16)
    values = np.fromiter(map(_hashes.__getitem__, words), np.uint64, n)
    table, sums, made = _power_table(n), np.zeros(n + 1, np.uint64), []
    for up, down in (table[:2], table[2:]):
        np.cumsum(values * up[:n], out=sums[1:])
        rolled = (sums[window:] - sums[:-window]) * down[: n - window + 1]
        rolled ^= rolled >> np.uint64(32)
        rolled *= np.uint64(0xD6E8FEB86659FD93)
        rolled ^= rolled >> np.uint64(32)
        made.append(rolled)
    return made[0], (made[1] >> np.uint64(48)).astype(np.uint16)


def runs(hashes: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal windows together, else as they stand, and where each run begins."""
    by = np.argsort(hashes, kind="stable")
    ordered, extra = hashes[by], more[by]
    new, other = ordered[1:] != ordered[:-1], extra[1:] != extra[:-1]
    if (other & ~new).any():  # hardly ever: unlike windows with the same first hash
        by = np.lexsort((more, hashes))
        ordered, extra = hashes[by], more[by]
        new, other = ordered[1:] != ordered[:-1], extra[1:] != extra[:-1]
    return by, np.flatnonzero(np.concatenate([[True], new | other])[: len(by)])


class _Block:
    """Windows of the documents of one block, in the order of ids; equal ids in the order of texts."""

    def __init__(self, ids: list, texts: list[bytes], window: int):
        self.ids, self.texts, self.window = ids, texts, window
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.words, parts = [0] * len(ids), []
        for i in self.order:
            words = texts[i].split()
            self.words[i] = len(words)
            parts.append(window_hashes(words, window))
        counts = [len(p) for p, _ in parts]
        self.starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        hashes, more = (np.concatenate(p) for p in zip(*parts)) if parts else window_hashes([], window)
        self.total = len(hashes)
        # the first of equal windows, in document order
        by, begin = runs(hashes, more)
        self.first = np.sort(by[begin])
        self.sent, self.more = hashes[self.first], more[self.first]
        document = np.searchsorted(self.starts, self.first, side="right") - 1
        keys = np.array([ids[i] for i in self.order], np.int64)
        self.sent_id = keys[document] if len(keys) else np.zeros(0, np.int64)

    def ranges(self, bits: int):
        """``(range, positions among those sent)`` for each hash range that has windows."""
        part = (self.sent >> np.uint64(64 - bits)).astype(np.int64)
        by = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[by])) + 1
        for at in np.split(by, cuts):
            if len(at):
                yield int(part[at[0]]), at

    def repeated(self) -> np.ndarray:
        """Windows that stand earlier in the same block."""
        marks = np.ones(self.total, bool)
        marks[self.first] = False
        return marks

    def covered(self, marks: np.ndarray):
        """``(row, word mask)`` for each document with repeated windows."""
        for place, i in enumerate(self.order):
            own = marks[self.starts[place] : self.starts[place + 1]]
            if own.any():
                edge = np.zeros(self.words[i] + 1, np.int64)
                at = np.flatnonzero(own)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + self.window, -1)
                yield i, np.cumsum(edge[:-1]) > 0


def cut(text: bytes, removed: np.ndarray) -> bytes:
    """``text`` without the removed words. Kept neighbours keep the white space between them; the
    pieces are joined by one space."""
    spans = [m.span() for m in _WORD.finditer(text)]
    change = np.flatnonzero(np.diff(np.concatenate([[True], removed, [True]]).astype(np.int8)))
    return b" ".join(text[spans[a][0] : spans[b - 1][1]] for a, b in zip(change[::2], change[1::2]))


def _block_of(table: pa.Table, window: int) -> _Block:
    return _Block(table.column("__id").to_pylist(), byte_values(table.column("__text")), window)


def _send(window: int, bits: int):
    def run(table: pa.Table) -> pa.Table:
        block = _block_of(table, window)
        number = table.column("__block")[0].as_py() if table.num_rows else 0
        ranges, ids, hashes = [], [], []
        for part, at in block.ranges(bits):
            ranges.append(part)
            own, counts = np.unique(block.sent_id[at], return_counts=True)
            # positions ascend, and ids with them, so ids and how often each is meant suffice
            ids.append(own.tobytes() + counts.astype(np.int64).tobytes())
            raw = np.ascontiguousarray(block.sent[at].astype("<u8")).view(np.uint8).reshape(-1, 8)
            more = np.ascontiguousarray(block.more[at].astype("<u2")).view(np.uint8).reshape(-1, 2)
            hashes.append(np.hstack([raw[:, :HASH_BYTES], more]).tobytes())
        return pa.table(
            {
                "__block": pa.array([number] * len(ranges), pa.int64()),
                "__range": pa.array(ranges, pa.int64()),
                "__ids": pa.array(ids, pa.binary()),
                "__hashes": pa.array(hashes, pa.binary()),
            }
        )

    return run


def _count(table: pa.Table) -> pa.Table:
    """For each block's windows in a hash range: a bit for those that an earlier document has."""
    hashes, extra, ids, sizes = [], [], [], []
    for packed, raw in zip(table.column("__hashes").to_pylist(), table.column("__ids").to_pylist()):
        low = np.frombuffer(packed, np.uint8).reshape(-1, HASH_BYTES + MORE_BYTES)
        wide = np.zeros((len(low), 8), np.uint8)
        wide[:, :HASH_BYTES] = low[:, :HASH_BYTES]
        hashes.append(wide.view("<u8").ravel())
        extra.append(np.ascontiguousarray(low[:, HASH_BYTES:]).view("<u2").ravel())
        own, counts = np.split(np.frombuffer(raw, np.int64), 2)
        ids.append(np.repeat(own, counts))
        sizes.append(len(low))
    all_ids = np.concatenate(ids)
    by, begin = runs(np.concatenate(hashes), np.concatenate(extra))
    least = np.minimum.reduceat(all_ids[by], begin)
    later = np.empty(len(by), bool)
    later[by] = all_ids[by] > np.repeat(least, np.diff(np.append(begin, len(by))))
    ends = np.cumsum(sizes)
    bits = [np.packbits(later[e - n : e]).tobytes() for n, e in zip(sizes, ends)]
    has = np.array([bool(later[e - n : e].any()) for n, e in zip(sizes, ends)])
    return pa.table(
        {
            "__block": table.column("__block").filter(pa.array(has)),
            "__range": table.column("__range").filter(pa.array(has)),
            "__bits": pa.array(bits, pa.binary()).filter(pa.array(has)),
        }
    )


def _remove(window: int, bits: int, schema: T.StructType, text_col: str):
    names = schema.names

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        block = _block_of(table, window)
        marks = block.repeated()
        answer = dict(zip(answers.column("__range").to_pylist(), answers.column("__bits").to_pylist()))
        for part, at in block.ranges(bits):
            if part in answer:
                found = np.unpackbits(np.frombuffer(answer[part], np.uint8), count=len(at))
                marks[block.first[at[found.astype(bool)]]] = True
        kept = table.column("__text").to_pylist()
        removed = [0] * len(kept)
        for i, mask in block.covered(marks):
            removed[i] = int(mask.sum())
            kept[i] = cut(block.texts[i], mask).decode("utf-8")
        made = {
            text_col: pa.array(kept, pa.string()),
            "n_words": pa.array(block.words, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
        }
        return pa.table({n: made[n] if n in made else table.column(n) for n in names})

    return run


def remove_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20
) -> DataFrame:
    """Every row of ``df`` with the repeated words cut out of its text, ``n_words`` and ``n_removed``.

    A word goes if some window of ``window`` consecutive words covers it whose words also stand
    earlier: in a document with a smaller id, or earlier in the same document. Windows are judged on
    the input. Words are what stands between ASCII white space, unchanged. Texts without removal
    stay as they are, null included; a text whose words all go is empty. The id must be a whole
    number, those of rows without id excepted: these come before all others, each a document of its own, in the
    order of a hash of their texts (of equal texts any may be the first). Rows with the same id, in the
    order of their texts, count as one document whose parts follow each other, without a window across
    two rows. Columns named ``n_words`` or ``n_removed`` are replaced; others pass
    through. An empty table gives an empty result.

    Windows are told apart by 80 bits of two hashes. Of n different windows, n * n / 2**81 pairs are
    taken for equal on average: none to be expected up to 10**12 windows, some forty in 10**13.
    """
    amount = chars(df, text_col)
    blocks = max(1, -(-amount // BLOCK_CHARS))
    windows = max(1, amount // 6)
    bits = max(LEAST_RANGES, windows // RANGE_WINDOWS).bit_length() - 1
    schema = plus(
        df.schema, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())
    )
    # rows without id are spread, and ordered before the ids, by text and then by row
    text = F.shiftrightunsigned(F.xxhash64(F.col(text_col)), 64 - _TEXT_BITS)
    row = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - _ROW_BITS)
    nameless = F.shiftleft(text, _ROW_BITS) + row + F.lit(-(1 << 63))
    # the text moves once, under a name of its own; its column keeps its place in the result
    dealt = df.select(
        *(c for c in df.columns if c not in (text_col, "n_words", "n_removed")),
        F.coalesce(F.col(id_col).cast("long"), nameless).alias("__id"),
        F.col(text_col).alias("__text"),
    ).withColumn("__block", F.pmod(F.xxhash64("__id"), F.lit(blocks)))
    sent = dealt.groupBy("__block").applyInArrow(
        _send(window, bits), "__block long, __range long, __ids binary, __hashes binary"
    )
    answers = sent.groupBy("__range").applyInArrow(_count, "__block long, __range long, __bits binary")
    return (
        dealt.groupBy("__block")
        .cogroup(answers.groupBy("__block"))
        .applyInArrow(_remove(window, bits, schema, text_col), schema)
    )
