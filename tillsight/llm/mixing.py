"""Mixing sources to target weights by a low-discrepancy schedule.

A mix is a row of 2**m slots. Every source owns as many neighbouring van der Corput points as its
share of the words asks for, so point ``j`` is the slot whose number is ``j`` with its bits
reversed: the slots of a source lie evenly over the whole mix. The slots of a source are ranked by
number, and its ``r``-th slot takes the ``r``-th of its equal blocks of words. The words of a source
stand in a line of shuffled documents, read again from the start when they run out.

Only DataFrame functions are used: counts, one range partition of narrow rows, one equi-join of
slots with pieces of documents. Texts are read once and never moved. The rank of a slot follows
from its number alone, so a source with most of the rows is never sorted or counted in one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.ordering import cumulative_counts, with_position
from tillsight.llm.common import spill

WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2
#: words of a slot, at most; every source has one slot at least
SLOT_WORDS = 256
SEED = 13
#: points of a source that one row makes; parts of one source on the side that is joined to it
CHUNK, SALTS = 4096, 64
_WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """``documents`` (doc_id, source, size, source_size, target, row), ``sources`` (source, place,
    weight, source_size, target, slots) and ``pieces`` (row, slot, start, words): which words of a
    document each slot takes, ``start`` counted from the document's first word."""

    documents: DataFrame
    sources: DataFrame
    pieces: DataFrame
    slots: int


def word_count(text: Column) -> Column:
    """Words between white space, null as none."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def _targets(sizes: DataFrame, weight: Callable[[Column], Column], share: float, cap: int) -> DataFrame:
    """Adds place, weight and target to the rows (source, source_size, first).

    Sources in the order of what they can take for a unit of weight: those before the level take all
    they can, the others their weight times the level.
    """
    placed = with_position(sizes, F.asc_nulls_last("source"), key="source", name="place")
    placed = spill(
        placed.withColumn("weight", weight(F.col("place")).cast("long"))
        .withColumn("_most", F.col("source_size") * cap)
        .withColumn("_ratio", F.col("_most") / F.col("weight")),
        "sources",
    )
    order = ("_ratio", "place")
    most = cumulative_counts(placed.select(*order, F.col("_most").alias("n")), order)
    heavy = cumulative_counts(placed.select(*order, F.col("weight").alias("n")), order)
    total = placed.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, weights = share * (total[0] or 0), total[1] or 0
    level = (
        most.select(*order, F.col("before").alias("_taken"))
        .join(heavy.select("place", F.col("before").alias("_gone")), "place")
        .select("_ratio", ((budget - F.col("_taken")) / (weights - F.col("_gone"))).alias("_level"))
        .agg(F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))))
        .first()[0]
    )
    # no level: everything is taken as often as it may
    target = F.col("_most").cast("double")
    if level is not None:
        target = F.least(target, F.lit(level) * F.col("weight"))
    return placed.withColumn("target", target).drop("_most", "_ratio")


def _owned(sources: DataFrame, share: float, cap: int, slot_words: int) -> tuple[DataFrame, int]:
    """Adds slots and the first own point of every source; also m, for 2**m points in all."""
    words, count = sources.agg(F.sum("source_size"), F.count("*")).first()
    total = min(share, cap) * (words or 0)  # what all targets add up to
    bits = max(math.ceil(total / slot_words + count) - 1, 0).bit_length()
    free = float(2**bits - count)
    part = F.floor(free * F.col("target") / total) if total else F.lit(0)
    sources = sources.withColumn("slots", 1 + part.cast("long"))
    before = cumulative_counts(sources.select("place", F.col("slots").alias("n")), ("place",))
    points = before.select("place", F.col("before").alias("point"))
    return spill(sources.join(points, "place"), "sources"), bits


def slot_number(point: Column, bits: int) -> Column:
    """The slot of a van der Corput point: its bits in reverse."""
    slot = F.lit(0).cast("long")
    for p in range(bits):
        slot = slot + F.shiftleft(F.shiftright(point, p).bitwiseAND(F.lit(1)), bits - 1 - p)
    return slot


def slot_rank(point: Column, first: Column, until: Column, bits: int) -> Column:
    """How many slots before that of ``point`` belong to the points ``first`` up to, without, ``until``.

    An earlier slot agrees with this one in its leading digits, has 0 where this one has 1, and any
    digits behind. Reversed, these are points that agree in the low ``p`` bits, every 2**(p+1)-th.
    """
    found = F.lit(0).cast("long")
    for p in range(bits):
        same = point.bitwiseAND(F.lit((1 << p) - 1).cast("long")) - ((1 << (p + 1)) - 1)
        count = F.shiftright(until - same, p + 1) - F.shiftright(first - same, p + 1)
        found = found + F.shiftright(point, p).bitwiseAND(F.lit(1)) * count
    return found


def slots(sources: DataFrame, bits: int) -> DataFrame:
    """Rows (place, block, slot): the ``block``-th slot of a source, its slots in their order."""
    last = F.col("point") + F.col("slots") - 1
    # a number, so that the few rows stay spread: each makes many
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = sources.select(
        "place", "point", last.alias("last"),
        F.explode(F.sequence(F.floor(F.col("point") / CHUNK), F.floor(last / CHUNK))).alias("chunk"),
    ).repartition(parts, "place", "chunk")
    first = F.greatest("point", F.col("chunk") * CHUNK)
    until = F.least("last", F.col("chunk") * CHUNK + (CHUNK - 1))
    points = pieces.select("place", "point", "last", F.explode(F.sequence(first, until)).alias("j"))
    rank = slot_rank(F.col("j"), F.col("point"), F.col("last") + 1, bits)
    return points.select("place", rank.alias("block"), slot_number(F.col("j"), bits).alias("slot"))


def _with_source(documents: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with the columns of their source; a source with most of the rows is dealt out."""
    parts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    right = sources.select(
        F.col("source").alias("_source"), "place", "source_size", "target", "slots", "first",
        F.explode(parts).alias("_part"),
    )
    left = documents.withColumn("_salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_salt") == F.col("_part"))
    return left.join(right, same).drop("_source", "_part", "_salt")


def _pieces(documents: DataFrame) -> DataFrame:
    """Rows (row, place, block, start, words): the parts of a document that a block holds.

    The line of a source is read until its target is full; ``row`` numbers the documents.
    """
    line, slots_ = F.floor("target").cast("long"), F.col("slots")
    least, more = F.call_function("div", line, slots_), line % slots_
    begin = F.col("before") - F.col("first")
    rounds = F.call_function("div", line - 1 - begin, F.col("source_size"))
    read = (
        documents.where((F.col("size") > 0) & (line > begin))
        .select(
            "row", "place", "size", line.alias("line"), "slots", least.alias("least"), more.alias("more"),
            "source_size", begin.alias("begin"),
            F.explode(F.sequence(F.lit(0).cast("long"), rounds)).alias("round"),
        )
        .withColumn("lo", F.col("begin") + F.col("round") * F.col("source_size"))
        .withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("line")))
    )
    # the first ``more`` blocks have a word more than the others
    large = F.col("more") * (F.col("least") + 1)

    def block_of(word: Column) -> Column:
        small = F.call_function("div", word - large, F.greatest("least", F.lit(1)))
        return F.when(word < large, F.call_function("div", word, F.col("least") + 1)).otherwise(F.col("more") + small)

    def start_of(block: Column) -> Column:
        return block * F.col("least") + F.least(block, F.col("more"))

    cut = read.select(
        "*", F.explode(F.sequence(block_of(F.col("lo")), block_of(F.col("hi") - 1))).alias("block")
    )
    low = F.greatest(F.col("lo"), start_of(F.col("block")))
    high = F.least(F.col("hi"), start_of(F.col("block") + 1))
    return cut.select("row", "place", "block", (low - F.col("lo")).alias("start"), (high - low).alias("words"))


def alternating(weights: Sequence[int]) -> Callable[[Column], Column]:
    """Weights given to the sources in turn."""
    return lambda place: F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))


def mix(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight: Callable[[Column], Column] = alternating(WEIGHTS),
    share: float = SHARE,
    cap: int = CAP,
    slot_words: int = SLOT_WORDS,
    seed: int = SEED,
) -> Mix:
    """A mix of ``share`` times all words. ``weight`` gives a source's whole, positive weight from its
    place in code-point order, null last. No source is read more than ``cap`` times; what it cannot
    take goes to the others by weight.

    Every source gives the whole part of its target, to the word, and no document more than
    ``cap`` times its size. Null and empty texts, and texts of white space, have no words and are
    taken nowhere. Null ids are ids like any other; rows that share an id and a size may change
    places, which no result shows. Reruns over the same files agree. Other columns, whatever their
    names, are not read. An empty table makes an empty mix.
    """
    ident = F.col(id_col)
    rows = documents.select(
        ident.alias("doc_id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), ident.cast("string"))).alias("shuffled"),
        F.monotonically_increasing_id().alias("row"),
    )
    # the texts are read once: the range partition looks at its input twice
    rows = spill(rows, "sizes").withColumn("n", F.col("size"))
    lined = cumulative_counts(rows, ("source", "shuffled", "doc_id", "size", "row")).drop("n", "shuffled")
    sizes = lined.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("before").alias("first"))
    sources, bits = _owned(_targets(sizes, weight, share, cap), share, cap, slot_words)
    held = _with_source(lined, sources)
    pieces = (
        _pieces(held)
        .join(slots(sources, bits).hint("merge"), ["place", "block"])  # both sides grow
        .select("row", "slot", "start", "words")
    )
    return Mix(
        held.select("doc_id", "source", "size", "source_size", "target", "row"),
        sources.select("source", "place", "weight", "source_size", "target", "slots"),
        pieces,
        2**bits,
    )


def taken(mixed: Mix) -> DataFrame:
    """Per document, the words that the mix takes, repeats counted, and the first slot that does
    (null if none): doc_id, size, source_size, target, taken, first_slot, one row per row of the input."""
    known = ["doc_id", "size", "source_size", "target"]
    none = {"slot": F.lit(None).cast("long"), "words": F.lit(0).cast("long")}
    rows = mixed.documents.select("row", *known).withColumns(none)
    both = rows.unionByName(mixed.pieces.select("row", "slot", "words"), allowMissingColumns=True)
    return both.groupBy("row").agg(
        *[F.max(c).alias(c) for c in known],  # one row of the group has them
        F.sum("words").alias("taken"),
        F.min("slot").alias("first_slot"),
    ).drop("row")
