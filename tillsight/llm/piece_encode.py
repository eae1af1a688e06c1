"""SentencePiece byte-pair encoding by a prefix table.

Every prefix of a text has one encoding, and that encoding ends in one token. The last token of a
prefix is the only piece among the automaton's matches ending there that is compatible with the last
token of the prefix before it: two tokens are compatible if their joined text encodes to just these
two. So one pass fills the table of last tokens, and walking it backwards gives the ids, without
merging anything. Pair tests are remembered.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillsight.llm.common import Known, text_values, with_derived

SPACE = "▁"
_KNOWN_WORDS = 250_000
_KNOWN_PAIRS = 1_000_000
_KNOWN_STEPS = 500_000
#: before keys that are a word without space mark; a lone surrogate cannot stand in a text
_BORDER = "\ud802"
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Automaton:
    """Aho-Corasick automaton over pieces: after each character, the pieces that end there, the
    longest first. Transitions that go through failure links are remembered."""

    def __init__(self, pieces):
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[tuple] = [()]
        for piece in pieces:
            state = 0
            for c in piece:
                to = self.next[state].get(c)
                if to is None:
                    to = self.next[state][c] = len(self.next)
                    self.next.append({})
                    self.ends.append(())
                state = to
            self.ends[state] = ((piece, len(piece)),)
        self.fail = [0] * len(self.next)
        self.room = _KNOWN_STEPS
        level = list(self.next[0].values())
        while level:
            below = []
            for state in level:
                self.ends[state] += self.ends[self.fail[state]]
                for c, to in self.next[state].items():
                    self.fail[to] = self._after(self.fail[state], c)
                    below.append(to)
            level = below

    def _after(self, state: int, c: str) -> int:
        while True:
            to = self.next[state].get(c)
            if to is not None:
                return to
            if not state:
                return 0
            state = self.fail[state]

    def step(self, state: int, c: str) -> int:
        """The state after a character that the state has no transition for."""
        to = self._after(self.fail[state], c) if state else 0
        if self.room:
            self.room -= 1
            self.next[state][c] = to
        return to


@dataclass
class Encoder:
    """Tables of one model; see :func:`load`."""

    pieces: list[str]
    scores: dict[str, float]
    ids: dict[str, int]
    byte_ids: list[int]
    unknown: int
    whole: bool
    automaton: Automaton
    prefix: bool
    pairs: dict = field(default_factory=dict)
    #: marks that no piece joins to a letter before them
    apart: frozenset = frozenset()
    #: whether texts can be cut at spaces and line breaks without looking further
    plain: bool = False

    def merge(self, text: str) -> list[str]:
        """Pieces by merging the best-scored pair first, leftmost among equals; for short texts."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= _KNOWN_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.merge(left + right) == [left, right]
        return known

    def table(self, text: str) -> list[str]:
        """The last piece of each prefix of ``text``; a character without a piece stands alone."""
        last: list[str] = []
        pairs, follow, ends = self.pairs, self.automaton.next, self.automaton.ends
        state = 0
        for i, c in enumerate(text):
            to = follow[state].get(c)
            state = self.automaton.step(state, c) if to is None else to
            for piece, size in ends[state]:
                if size > i:
                    last.append(piece)
                    break
                left = last[i - size]
                fits = pairs.get((left, piece))
                if fits or fits is None and self.compatible(left, piece):
                    last.append(piece)
                    break
            else:
                last.append(c)
        return last

    def encode_word(self, text: str) -> list[int]:
        last, end, out = self.table(text), len(text) - 1, []
        while end >= 0:
            piece = last[end]
            known = self.ids.get(piece)
            if known is not None:
                out.append(known)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in reversed(piece.encode("utf-8"))]
            else:
                out.append(self.unknown)
            end -= len(piece)
        out.reverse()
        return out

    def words(self, text: str) -> list[str]:
        """Parts of a text that no piece reaches across, as keys: a word without mark has one space
        mark before it, a word that begins with a line break or a space mark is itself."""
        if not text:
            return []
        if self.plain and SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            parts = text.replace("\n", " \n").split(" ")
            # a space before a line break, or a text that begins with one, is a space mark alone
            return [w or SPACE for w in parts] if "" in parts else parts
        text = text.replace(" ", SPACE)
        if self.prefix:
            text = SPACE + text
        if self.whole:
            return [_BORDER + text]
        out = []
        for w in _WORD.findall(text):
            single = self.plain and len(w) > 1 and w[0] == SPACE and w[1] not in (SPACE, "\n")
            out.append(w[1:] if single else w if w[0] == SPACE else _BORDER + w)
        return out

    def make(self, key: str) -> bytes:
        """Ids of the word that a key stands for, as 32-bit numbers. A mark that stands apart from the
        letters before it is cut off first, since merging never crosses that border."""
        if len(key) > 2 and key[-1] in self.apart and key[-2].isalpha():
            return self.known[key[:-1]] + self.known[_BORDER + key[-1]]
        if key[0] == _BORDER:
            word = key[1:]
        else:
            word = key if key[0] in (SPACE, "\n") else SPACE + key
        return np.array(self.encode_word(word), np.int32).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit numbers; words that return are looked up."""
        out = []
        for text in texts:
            out.append(b"".join(map(self.known.__getitem__, self.words(text))))
            self.known.tidy()
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of a sequence of ids: runs of byte pieces are read as UTF-8, each byte that cannot be
        read becomes a replacement character, and the space mark put before the text goes."""
        parts = self._parts
        text = "".join(map(parts.__getitem__, ids))
        if self._byte_mark in text:
            text = _BYTES.sub(_read_bytes, text)
        if _CONTROL in text:
            text = text.replace(_CONTROL, "")
        if self.prefix and text.startswith(SPACE):
            text = text[1:]
        return text.replace(SPACE, " ")

    def __post_init__(self):
        self.known = Known(self.make, _KNOWN_WORDS)
        # byte pieces as private marks, two per byte, until the run they stand in is known
        first = {i: b for b, i in enumerate(self.byte_ids)}
        self._byte_mark = _MARK
        self._parts = [
            f"{_MARK}{chr(0xDC00 + first[i])}" if i in first else p for i, p in enumerate(self.pieces)
        ]


# lone surrogates cannot stand in a text, so they can mark bytes, and what ends a run of them
_MARK, _CONTROL = "\ud800", "\ud801"
_BYTES = re.compile("(?:\ud800[\udc00-\udcff])+")


def _read_bytes(m: re.Match) -> str:
    raw = bytes(ord(c) - 0xDC00 for c in m[0][1::2])
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[at : at + n].decode("utf-8"))
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


@lru_cache(maxsize=2)
def load(path: str) -> Encoder:
    """Read a byte-pair model. Its normalizer must leave texts alone but for the space marks."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as messages

    proto = messages.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    spec = proto.normalizer_spec
    if proto.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces:
        raise ValueError("only byte-pair models with an identity normalizer")
    if proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only models that mark spaces before words")
    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    n = processor.get_piece_size()
    pieces = [processor.id_to_piece(i) for i in range(n)]
    normal = [
        i for i in range(n)
        if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i) or processor.is_unused(i))
    ]
    if any(p.type == 4 for p in proto.pieces):
        raise ValueError("user-defined pieces are not supported")
    scores = {pieces[i]: processor.get_score(i) for i in normal}
    ids = {pieces[i]: i for i in normal}
    byte_ids = [processor.piece_to_id(f"<0x{b:02X}>") for b in range(256)] if proto.trainer_spec.byte_fallback else []
    made = Encoder(
        [" ⁇ " if processor.is_unknown(i) else _CONTROL if processor.is_control(i) else p for i, p in enumerate(pieces)],
        scores, ids, byte_ids, processor.unk_id(),
        any(a != SPACE and b == SPACE for p in ids for a, b in zip(p, p[1:])),
        Automaton(()), spec.add_dummy_prefix,
    )
    # a piece that merging never makes cannot end a prefix
    made.automaton = Automaton(p for p in ids if len(p) == 1 or made.merge(p) == [p])
    joined = {c for p in ids for a, c in zip(p, p[1:]) if a.isalpha()}
    made.plain = made.prefix and not made.whole and not any("\n" in p for p in ids)
    made.apart = frozenset(",.;:!?") - joined
    return made


_IDS = T.ArrayType(T.IntegerType())


def encode(df: DataFrame, model_path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """Every row with the ids of its whole text, as the sentencepiece library gives them without
    begin and end ids. Null and empty texts have no ids. An input column of the same name is
    replaced, others pass through, an empty table stays empty. The step is narrow.
    """

    def make(batch):
        made = load(model_path).encode(text_values(batch.column(text_col)))
        sizes = np.concatenate([[0], np.cumsum([len(m) // 4 for m in made])]).astype(np.int32)
        values = pa.array(np.frombuffer(b"".join(made), np.int32))
        return [pa.ListArray.from_arrays(pa.array(sizes), values)]

    return with_derived(df, make, T.StructField(out_col, _IDS))


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Every row with the text of its ids. Null and empty lists give an empty text."""

    def make(batch):
        model = load(model_path)
        column = batch.column(ids_col)
        flat = column.flatten().to_numpy(zero_copy_only=False)
        sizes = np.array([0 if x is None else x for x in column.value_lengths().to_pylist()], np.int64)
        ends = np.cumsum(sizes)
        return [pa.array([model.decode(flat[e - n : e].tolist()) for n, e in zip(sizes, ends)], pa.string())]

    return with_derived(df, make, T.StructField(out_col, T.StringType()))
