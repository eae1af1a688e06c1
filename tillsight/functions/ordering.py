"""Exact order statistics that stay spread over the cluster.

Places: keys are range-partitioned in the wanted order and written with the place each has in its own
partition; the number of rows in the partitions before, one small table, turns the local place
into a global one. Quantiles: histograms that merge are refined around the wanted ranks until one value
is left. No step sorts or buffers a whole column in one task.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence

import pyarrow as pa
import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.sources.storage import materialize

# Bins of the first histogram for every power of two, and equal parts that a bin is cut into when it is refined.
POWERS, BINS = 32, 4096

_LOCAL_BITS = 33  # monotonically_increasing_id: partition above, place in the partition below


def _before(total: str, *groups: str, order: str | Sequence[str]) -> Column:
    columns = [order] if isinstance(order, str) else list(order)
    window = Window.partitionBy(*groups).orderBy(*columns)
    running = F.sum(total).over(window.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(running, F.lit(0))


def _offsets(stored: DataFrame) -> DataFrame:
    """Rows (_part, _rows, _before): one per partition of the range exchange."""
    return (
        stored.groupBy(F.shiftright("_place", _LOCAL_BITS).alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .withColumn("_before", _before("_rows", order="_part"))
    )


def ordered(df: DataFrame, *order: Column | str, keep: Sequence[str]) -> DataFrame:
    """Stored rows of the columns ``keep`` with the place that each has in its own partition.

    The order must end in a unique key: that fixes the answer and lets a value shared by very many
    rows spread over several partitions.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(
        ranged.select(*keep, F.monotonically_increasing_id().alias("_place")), "ordered"
    )


def global_place(stored: DataFrame, name: str = "position") -> DataFrame:
    """The stored rows with their 0-based place among all."""
    local = F.col("_place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        stored.withColumn("_part", F.shiftright("_place", _LOCAL_BITS))
        .join(F.broadcast(_offsets(stored).select("_part", "_before")), "_part")
        .withColumn(name, F.col("_before") + local)
        .drop("_part", "_before", "_place")
    )


def with_position(df: DataFrame, *order: Column | str, key: str, name: str = "position") -> DataFrame:
    """Adds the 0-based place of each row in the global order, which must end in the unique ``key``.

    Only the key and its place are written; they are joined back to the row.
    """
    placed = global_place(ordered(df, *order, keep=[key]), name)
    return joined_back(df, placed, key)


def joined_back(df: DataFrame, made: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` with what was made for their key, a NULL key included."""
    made = made.withColumnRenamed(key, "_key")
    return df.join(made, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def quantile_cuts(rows: int, buckets: int) -> list[float]:
    """Where equally spaced quantiles of the ranks 1..rows fall, in the floating-point steps of
    linear interpolation: some cuts that should be a whole rank miss it by a rounding."""
    at = np.linspace(0, 1, buckets + 1) * 100 / 100 * (rows - 1)
    part = at - np.floor(at)
    return list(np.floor(at) + np.where(part < 0.5, 1 + part, 2 - (1 - part)))


def quantile_bucket(position: Column, rows: int, buckets: int) -> Column:
    """Bucket 1..buckets of a 0-based place: how many of the inner cuts its rank has passed."""
    bucket = F.lit(1)
    for cut in quantile_cuts(rows, buckets)[1:-1]:
        bucket = bucket + (position + 1 > float(cut)).cast("int")
    return bucket


def cumulative_counts(counts: DataFrame, order: Sequence[str] = ("value",)) -> DataFrame:
    """Adds ``before``: the number of rows earlier in the order, from distinct rows (..., n).

    The rows are range-partitioned, and each partition's running total starts at the total of the
    partitions before it.
    """
    ranged = materialize(
        counts.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged"
    )
    offsets = (
        ranged.groupBy("_part")
        .agg(F.sum("n").alias("_rows"))
        .withColumn("_offset", _before("_rows", order="_part"))
        .select("_part", "_offset")
    )
    return (
        ranged.withColumn("_inside", _before("n", "_part", order=order))
        .join(F.broadcast(offsets), "_part")
        .withColumn("before", F.col("_offset") + F.col("_inside"))
        .drop("_part", "_inside", "_offset")
    )


def average_ranks(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Stored rows (metric, value, rank) of the distinct values of named columns, as doubles, without
    NULL; ties share their mean rank.

    All columns are ranked in one pass: places over all of them together, less the first place of
    each.
    """
    entries = [
        F.struct(F.lit(name).alias("metric"), column.cast("double").alias("value"))
        for name, column in columns.items()
    ]
    counts = (
        df.select(F.inline(F.array(*entries)))
        .filter(F.col("value").isNotNull())
        .groupBy("metric", "value")
        .agg(F.count("*").alias("n"))
    )
    placed = cumulative_counts(counts, ("metric", "value"))
    first = placed.groupBy("metric").agg(F.min("before").alias("_first"))  # one row per column
    rank = F.col("before") - F.col("_first") + (F.col("n") + 1) / 2
    ranks = placed.join(F.broadcast(first), "metric").select("metric", "value", rank.alias("rank"))
    return materialize(ranks, "ranks")


def spearman_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rank correlation with average ranks for ties: rows ``a``, ``b``, ``n``, ``correlation``.

    ``df`` is read more than once, so it should be a stored table. A pair leaves out the rows in
    which either value is NULL. Each column is ranked once, all in one pass; only a partner with NULLs
    makes another ranking, of the rows that are left. Equal pairs of values are counted first, so copies travel as
    one row; whether a rank table is broadcast follows from its stored size, and where it is not,
    adaptive execution splits a value that very many pairs share.
    """
    columns = sorted({c for pair in pairs for c in pair})
    both = [F.col(a).isNotNull() & F.col(b).isNotNull() for a, b in pairs]
    held = df.agg(
        F.count("*").alias("rows"),
        *[F.count(c).alias(f"held_{c}") for c in columns],
        *[F.count_if(kept).alias(f"pair_{i}") for i, kept in enumerate(both)],
    ).first()
    wanted: dict[str, Column] = {}

    def ranking(column: str, other: str) -> str:
        """Name of the ranking of a column beside another one."""
        if held[f"held_{other}"] == held["rows"]:
            wanted[column] = F.col(column)
            return column
        name = f"{column} where {other}"
        wanted[name] = F.when(F.col(other).isNotNull(), F.col(column))
        return name

    named = [(ranking(a, b), ranking(b, a)) for a, b in pairs]
    ranks = average_ranks(df, wanted)

    def ranked(name: str, side: str) -> DataFrame:
        rows = ranks.filter(F.col("metric") == name)
        return rows.select(F.col("value").alias(side), F.col("rank").alias(f"{side}_rank"))

    table = None
    n = F.col("n")
    for i, (a, b) in enumerate(pairs):
        counted = (
            df.filter(both[i])
            .groupBy(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))
            .agg(F.count("*").alias("n"))
        )
        # ranks are centred before they are multiplied: their sums would otherwise cancel
        middle = F.lit((held[f"pair_{i}"] + 1) / 2)
        x, y = F.col("a_rank") - middle, F.col("b_rank") - middle
        row = (
            counted.join(ranked(named[i][0], "a"), "a")
            .join(ranked(named[i][1], "b"), "b")
            .agg(
                F.sum("n").alias("n"),
                F.sum(n * x * y).alias("xy"),
                F.sum(n * x * x).alias("xx"),
                F.sum(n * y * y).alias("yy"),
            )
            .select(
                F.lit(a).alias("a"), F.lit(b).alias("b"), "n",
                F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy"))).alias("correlation"),
            )
        )
        table = row if table is None else table.unionByName(row)
    return table


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rank correlation of two columns, as one row ``n``, ``correlation``."""
    return spearman_pairs(df, [(a, b)]).select("n", "correlation")


def melt(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., metric, value) for each of the columns, as doubles."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
            for c in columns
        ]
    )
    return df.select(*by, F.inline(pairs))


def _power(value: Column) -> Column:
    """First bin of a value: its sign and its size by parts of a power of two, in the order of the values."""
    size = 1100 * POWERS + F.floor(F.least(F.log2(F.abs(value)), F.lit(1100.0)) * POWERS)
    return (
        F.when(F.isnan(value), 3000 * POWERS).when(value == 0, 0).when(value > 0, size).otherwise(-size).cast("int")
    )


def _part(value: Column) -> Column:
    """Bin of a value within a range: the ends never share one, so every step narrows."""
    share = (value - F.col("_low")) / (F.col("_high") - F.col("_low"))
    return F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")


def _histogram(rows: DataFrame, *groups: Column | str) -> DataFrame:
    return rows.groupBy(*groups).agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )


def _found(histogram: DataFrame, groups: list[str], ranks: Column) -> DataFrame:
    """Rows (groups..., _total, rank, below, low, high): the bin that holds each wanted rank.

    A group has a bounded number of bins, so its running total is a small window.
    """
    counted = histogram.withColumns(
        {"below": _before("n", *groups, order="bin"), "_total": F.sum("n").over(Window.partitionBy(*groups))}
    )
    inside = (F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("n"))
    return (
        counted.withColumn("rank", F.explode(ranks))
        .where(inside)
        .select(*groups, "_total", "rank", "below", "low", "high")
    )


def _neighbours(prob: float, total) -> tuple:
    at = prob * (total - 1)
    return at, math.floor(at), math.ceil(at)


def _settled(low: float, high: float) -> bool:
    return low == high or (math.isnan(low) and math.isnan(high))


def order_statistics(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> dict[tuple, tuple[int, dict[int, float]]]:
    """Exact values at the ranks around each quantile: (by..., column) to the number of values and
    a value per rank.

    Round by round a histogram of the rows that still matter is counted, which combines on the
    map side, and the bins that hold a wanted rank become the ranges of the next round. The first bins are
    parts of powers of two, later ones equal parts, so a handful of rounds reaches one value whatever the
    distribution; bins keep their least and greatest value, so few values end it sooner. Only the bins
    with a wanted rank reach the driver, a few per group, column and quantile.
    """
    keys = [*by, "metric"]
    long = melt(df, columns, by).filter(F.col("value").isNotNull())
    total = F.col("_total")
    wanted = F.array_distinct(
        F.flatten(
            F.array(
                *[F.array(F.floor(at).cast("long"), F.ceil(at).cast("long")) for at in (F.lit(float(p)) * (total - 1) for p in probs)]
            )
        )
    )
    first = _histogram(long, *keys, _power(F.col("value")).alias("bin"))
    totals: dict[tuple, int] = {}
    values: dict[tuple, dict[int, float]] = defaultdict(dict)
    ranges: dict[tuple, list[tuple[int, int]]] = defaultdict(list)

    def sort_in(group: tuple, rank: int, row) -> None:
        """A rank is known, or looked for in the range of its bin; ``below`` counts what lies before it."""
        if _settled(row["low"], row["high"]):
            values[group][rank] = row["low"] + 0.0  # one zero
        else:
            ranges[group, row["low"], row["high"]].append((rank, row["below"]))

    for row in _found(first, keys, wanted).collect():
        group = tuple(row[k] for k in keys)
        totals[group] = row["_total"]
        sort_in(group, row["rank"], row)
    group_types = [df.schema[c] for c in by]
    while ranges:
        open_, ranges = list(ranges.items()), defaultdict(list)
        table = small_table(
            df,
            [
                (*group, low, high, i, [rank - below for rank, below in ranks])
                for i, ((group, low, high), ranks) in enumerate(open_)
            ],
            [
                *[T.StructField(f"_{f.name}", f.dataType) for f in group_types],
                T.StructField("_metric", T.StringType()), T.StructField("_low", T.DoubleType()),
                T.StructField("_high", T.DoubleType()), T.StructField("_id", T.IntegerType()),
                T.StructField("_ranks", T.ArrayType(T.LongType())),
            ],
        )
        left = sorted({group[-1] for (group, _, _), _ in open_})
        rows = melt(df, left, by).filter(F.col("value").isNotNull())
        same = F.col("metric") == F.col("_metric")
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        within = F.col("value").between(F.col("_low"), F.col("_high"))
        # a few ranges per group and column
        inside = rows.join(F.broadcast(table.drop("_ranks")), same & within)
        refined = _histogram(inside, "_id", _part(F.col("value")).alias("bin")).join(
            F.broadcast(table.select("_id", "_ranks")), "_id"
        )
        for row in _found(refined, ["_id"], F.col("_ranks")).collect():
            (group, _, _), ranks = open_[row["_id"]]
            for rank, below in ranks:
                if rank - below == row["rank"]:
                    sort_in(group, rank, {**row.asDict(), "below": below + row["below"]})
    return {group: (total, values[group]) for group, total in totals.items()}


def small_table(df: DataFrame, rows: list[tuple], fields: list[T.StructField]) -> DataFrame:
    """Rows of the driver as a table of the session of ``df``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType(fields)
    names = schema.names
    table = pa.Table.from_pylist([dict(zip(names, row)) for row in rows], to_arrow_schema(schema))
    return df.sparkSession.createDataFrame(table, schema=schema)


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles: rows by..., ``metric``, ``q`` (an array). NULLs are left out.

    ``by`` holds labels with few distinct combinations. ``df`` is read a few times, so it should be
    a stored table or close to one. See :func:`order_statistics`; the way is the same at every size.
    """
    rows = []
    for group, (total, values) in order_statistics(df, columns, probs, by).items():
        found = []
        for prob in probs:
            at, below, above = _neighbours(float(prob), total)
            low, high = values[below], values[above]
            found.append(low if low == high else (above - at) * low + (at - below) * high)
        rows.append((*group, found))
    fields = [T.StructField(c, df.schema[c].dataType) for c in by]
    fields += [T.StructField("metric", T.StringType()), T.StructField("q", T.ArrayType(T.DoubleType()))]
    return small_table(df, rows, fields)


def count_quantiles(counts: DataFrame, wanted: dict[str, float]) -> DataFrame:
    """One row of named, linearly interpolated quantiles from stored value counts ``(value, n)``.

    A column that repeats a lot is counted by value first, which combines on the map side; places
    come from running totals over its distinct values, range-partitioned whatever their number.
    """
    placed = cumulative_counts(counts.filter(F.col("value").isNotNull()).select("value", "n"))
    total = counts.agg(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("_total"))
    found, value = [], F.col("value").cast("double")
    for i, prob in enumerate(wanted.values()):
        at = F.lit(float(prob)) * (F.col("_total") - 1)
        for side, place in (("low", F.floor(at)), ("high", F.ceil(at))):
            held = (place >= F.col("before")) & (place < F.col("before") + F.col("n"))
            found.append(F.max(F.when(held, value)).alias(f"_{side}{i}"))
        found.append(F.max(at).alias(f"_at{i}"))

    def between(i: int) -> Column:
        low, high, at = (F.col(f"_{c}{i}") for c in ("low", "high", "at"))
        middle = (F.ceil(at) - at) * low + (at - F.floor(at)) * high
        return F.when(low == high, low).otherwise(middle)

    return placed.crossJoin(F.broadcast(total)).agg(*found).select(  # one row
        *[between(i).alias(name) for i, name in enumerate(wanted)]
    )


def quantile_columns(
    df: DataFrame, wanted: dict[str, tuple[str, float]], by: Sequence[str] = ()
) -> DataFrame:
    """One row per group with named quantiles: ``wanted`` maps a name to (column, probability)."""
    columns = sorted({column for column, _ in wanted.values()})
    probs = sorted({prob for _, prob in wanted.values()})
    long = quantiles(df, columns, probs, by)
    picked = [
        F.first(
            F.when(F.col("metric") == column, F.col("q")[probs.index(prob)]), ignorenulls=True
        ).alias(name)
        for name, (column, prob) in wanted.items()
    ]
    return long.groupBy(*by).agg(*picked) if by else long.agg(*picked)
