"""Near-duplicate documents by SimHash: segment bit counts as a grid, exact bit distance after.

A fingerprint of 64 bits is cut into 32 segments of two bits; the number of set bits of each
segment is a point in 32 dimensions, and the Manhattan distance of two points never exceeds the bit
distance of their fingerprints. If the whole distance is at most three, it is at most one in the
first or in the last 16 dimensions. So each half is a grid with one cell per point: a point stands
in its own cell and visits the cells one step up, and only points that meet in a cell are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.common import byte_values, discard, forest, run_ends, spill, with_derived
from tillsight.llm.components import components

SEED = 42
MAX_BITS = 3
#: members of one cell that are compared in one task; larger cells are cut into tiles
TILE = 4096
#: links held at once while a tile is compared
HELD_LINKS = 500_000
_LOW = np.uint64(0x5555555555555555)
_BITS_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of a UTF-8 text: a bit is set if over half of the shingle hashes have it.

    Only A-Z are lowered, words are what stands between ASCII white space, repeated shingles count
    each time, fewer words than a shingle are one shingle, no words give zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist())]
    values = np.array(hashes, dtype="<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(values), _BITS_AT_ONCE):
        part = values[i : i + _BITS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(values), bitorder="little").view("<u8")[0])


def with_fingerprint(
    df: DataFrame, text_col: str = "text", shingle: int = 3, out_col: str = "fingerprint"
) -> DataFrame:
    """Every row with the SimHash of its text as a signed 64-bit number; null text counts as empty."""

    def make(batch):
        marks = [fingerprint(t, shingle) for t in byte_values(batch.column(text_col))]
        return [pa.array(np.array(marks, np.uint64).view(np.int64))]

    return with_derived(df, make, T.StructField(out_col, T.LongType()))


def segment_counts(marks: np.ndarray) -> np.ndarray:
    """Set bits of each two-bit segment, as two-bit fields of one number."""
    return marks - ((marks >> np.uint64(1)) & _LOW)


def manhattan(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Manhattan distance of two points given as two-bit fields: 0, 1, 2 differ as 01, 10, 11."""
    x = p ^ q
    low = x & _LOW
    high = (x >> np.uint64(1)) & _LOW
    return np.bitwise_count(low) + 2 * np.bitwise_count(high & ~low)


def _cells(batches):
    for batch in batches:
        marks = batch.column("mark").to_numpy().view(np.uint64)
        point = segment_counts(marks)
        cell, mark, home = [], [], []
        for half in range(2):
            own = (point >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
            base = np.uint64(half << 32)
            cell.append(own | base)
            mark.append(marks)
            home.append(np.ones(len(marks), bool))
            for i in range(16):
                step = np.uint64(1 << (2 * i))
                up = ((own >> np.uint64(2 * i)) & np.uint64(3)) < 2
                cell.append((own[up] + step) | base)
                mark.append(marks[up])
                home.append(np.zeros(int(up.sum()), bool))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(cell).view(np.int64)),
                pa.array(np.concatenate(mark).view(np.int64)),
                pa.array(np.concatenate(home)),
            ],
            ["cell", "mark", "home"],
        )


def _compare(max_bits: int):
    """Links inside each run of equal (cell, i, j), as stars; a run that a batch cuts is carried on."""

    def stars(links):
        a, b = forest(*(np.concatenate(x) for x in zip(*links)))
        return a, b

    def block(marks, home, slot, key, tile):
        point, end = segment_counts(marks), run_ends(key)
        at, step, links, held = np.arange(len(marks)), 0, [], 0
        while True:
            step += 1
            at = at[end[at] > at + step]
            if not len(at):
                break
            other = at + step
            # the two parts of a tile off the diagonal are compared across, not each in itself
            met = (home[at] | home[other]) & (~tile[at] | (slot[at] != slot[other]))
            p, q = at[met], other[met]
            near = manhattan(point[p], point[q]) <= max_bits
            p, q = p[near], q[near]
            near = np.bitwise_count(marks[p] ^ marks[q]) <= max_bits
            if near.any():
                links.append((marks[p[near]], marks[q[near]]))
                held += int(near.sum())
                if held > HELD_LINKS:
                    links = [stars(links)]
                    held = len(links[0][0])
        return stars(links) if links else None

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            yield from out(rest, False)
            rest = tail(rest)
        if rest is not None:
            yield from out(rest, True)

    def keys(table):
        cell, i, j = (table.column(n).to_numpy() for n in ("cell", "i", "j"))
        change = np.ones(len(cell), bool)
        change[1:] = (cell[1:] != cell[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        return np.cumsum(change), i != j

    def last_run(table):
        key, _ = keys(table)
        return int(np.searchsorted(key, key[-1]))

    def tail(table):
        return table.slice(last_run(table)) if table.num_rows else table

    def out(table, all_runs):
        n = table.num_rows if all_runs else (last_run(table) if table.num_rows else 0)
        if not n:
            return
        table = table.slice(0, n)
        key, tile = keys(table)
        found = block(
            table.column("mark").to_numpy().view(np.uint64),
            table.column("home").to_numpy(zero_copy_only=False),
            table.column("slot").to_numpy(),
            key,
            tile,
        )
        if found is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.view(np.int64)) for x in found], ["a", "b"]
            )

    return run


def near_links(marks: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """Links ``(a, b)`` that join all fingerprints within ``max_bits`` (at most three) of each other.

    ``marks`` has one column ``mark``, each fingerprint once. Of the pairs found in one tile a star
    per component is kept, so the links of a tile are fewer than its members; no connection is
    lost. Cells with more than ``tile`` members are cut into tiles that are compared in pairs.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the grid of halves holds for at most three bits")
    rows = marks.mapInArrow(_cells, "cell long, mark long, home boolean")
    sizes = (
        rows.groupBy("cell")
        .agg(F.count("*").alias("n"), F.max("home").alias("some"))
        .where("n > 1 and some")
        .select("cell", F.ceil(F.col("n") / tile).cast("int").alias("parts"))
    )
    dealt = (
        rows.join(sizes, "cell")
        .withColumn("slot", F.pmod(F.xxhash64("mark"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "cell", "mark", "home", "slot",
            F.least("slot", "other").alias("i"), F.greatest("slot", "other").alias("j"),
        )
    )
    return (
        dealt.repartition("cell", "i", "j")
        .sortWithinPartitions("cell", "i", "j", "mark")
        .mapInArrow(_compare(max_bits), "a long, b long")
    )


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per input row: ``id_col``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id of all documents reachable through links. Documents with
    equal fingerprints, copies among them, are one point of the grid, so a group of copies costs
    one comparison. Null and empty texts have fingerprint zero and link like any other; rows with
    equal ids stay separate rows; a row without id takes part but cannot name its component (null
    only if no member has an id). An empty table gives an empty result. Other columns are ignored.
    """
    return _grouped(df, id_col, text_col, shingle, max_bits).select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _grouped(df: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """``(id, mark, root, component_id)`` of every row; ``root`` is one fingerprint of the group."""
    marked = spill(
        with_fingerprint(
            df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
            "text", shingle, "mark",
        ).select("id", "mark"),
        "marks",
    )
    points = spill(marked.groupBy("mark").agg(F.min("id").alias("first")), "points")
    reach = components(near_links(points.select("mark"), max_bits))
    rooted = (
        points.join(reach, points["mark"] == reach["node"], "left")
        .select("mark", "first", F.coalesce("root", "mark").alias("root"))
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = spill(rooted.join(least, "root").select("mark", "root", "component_id"), "named")
    discard(points, reach)
    return marked.join(named, "mark").select("id", "mark", "root", "component_id")


def keep_first(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row of each near-duplicate group, with all columns: the one with the smallest id.

    Of several rows of a group with that same id, or of a group without any id, the one with the
    smallest text stays. Rows with equal ids in different groups do not touch each other.
    """
    found = spill(_grouped(df, id_col, text_col, shingle, max_bits), "found")
    rows = found.groupBy("id").agg(F.count("*").alias("rows"))
    least = (
        found.where(F.col("id").eqNullSafe(F.col("component_id")))
        .groupBy("id", "mark", "root").agg(F.count("*").alias("n"))
        .select(F.col("id").alias("__id"), F.col("mark").alias("__least"), F.col("root").alias("__root"), "n")
        .join(rows.withColumnRenamed("id", "__of"), F.col("__id").eqNullSafe(F.col("__of")))
        .withColumn("__once", F.col("__id").isNotNull() & (F.col("rows") == 1))
        .drop("__of", "rows")
    )
    least = spill(least, "least")
    # an id that one row bears tells the row; of others the fingerprint is made again
    once = least.where("__once").select("__id", "__root")
    alone = df.join(once, df[id_col] == once["__id"]).select(*df.columns, "__root")
    more = least.where(~F.col("__once")).select("__id", "__least", "__root")
    first = alone
    if not more.isEmpty():
        ids = more.select("__id").distinct()
        among = df.join(ids, df[id_col].eqNullSafe(ids["__id"]), "left_semi")
        marked = with_fingerprint(among, text_col, shingle, "__mark")
        # equal id and fingerprint mean equal group, so a row meets one row of the other side
        others = marked.join(
            more, marked[id_col].eqNullSafe(more["__id"]) & (marked["__mark"] == more["__least"])
        ).select(*df.columns, "__root")
        first = alone.unionByName(others)
    repeated = least.groupBy("__root").agg(F.sum("n").alias("n")).where("n > 1")
    if repeated.isEmpty():
        return first.drop("__root")
    one = first.groupBy("__root").agg(
        F.min(F.struct(text_col, *(c for c in df.columns if c != text_col))).alias("__row")
    )
    return one.select("__row.*").select(*df.columns)
