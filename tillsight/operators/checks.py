"""Constraint checks and reconciliations. Each returns violations or differences as a table;
``require_none`` turns a table of violations into an error. ``Watch`` checks rows while they are written."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from tillsight.functions.columns import count_where


def imported_row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("imported_rows"))


# bits of the whole-number types, which SQL catalogs list as their precision
WHOLE_NUMBER_BITS = {"smallint": 16, "int": 32, "bigint": 64}


def _precision(kind) -> tuple[int | None, int | None]:
    if isinstance(kind, DecimalType):
        return kind.precision, kind.scale
    bits = WHOLE_NUMBER_BITS.get(kind.simpleString()) if kind else None
    return bits, 0 if bits else None


def check_schema(df: DataFrame, declared: StructType) -> DataFrame:
    """One row per declared or extra column: its type, whether that is the declared one, values held."""
    actual = {field.name: field.dataType for field in df.schema}
    expected = {field.name: field.dataType for field in declared}
    names = list(actual) + [name for name in expected if name not in actual]
    present = [name for name in names if name in actual]
    counts = df.agg(*[F.count(name).alias(name) for name in present])

    def entry(ordinal: int, name: str) -> Column:
        kind = actual.get(name)
        precision, scale = _precision(kind)
        return F.struct(
            F.lit(ordinal).alias("ordinal_position"),
            F.lit(name).alias("column_name"),
            F.lit(kind.simpleString() if kind else None).cast("string").alias("data_type"),
            F.lit(precision).cast("int").alias("numeric_precision"),
            F.lit(scale).cast("int").alias("numeric_scale"),
            F.lit(kind is not None and kind == expected.get(name)).alias("as_declared"),
            (F.col(name) if kind else F.lit(0).cast("bigint")).alias("non_null_rows"),
        )

    entries = F.array(*[entry(i, name) for i, name in enumerate(names, start=1)])
    return counts.select(F.inline(entries))


def check_primary_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are NULL or held by more than one row, with their row counts."""
    has_null = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    return (
        df.groupBy(*keys).agg(F.count("*").alias("rows")).filter((F.col("rows") > 1) | has_null)
    )


def check_foreign_key(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per required column, one row."""
    return df.agg(*[count_where(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def check_predicate(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows that break a CHECK constraint. As in SQL, an unknown result does not break it."""
    return df.filter(~predicate)


class Watch:
    """Rules that rows must keep, and values they hold, observed in the pass that reads the rows.

    Use ``rows`` in place of the frame, run the one action that reads it, then ask. A rule is a condition
    that no row may fulfil; values should be least or greatest ones. A task that runs again is seen twice,
    so counts are only told from zero.
    """

    def __init__(
        self, df: DataFrame, rules: Mapping[str, Column], values: Mapping[str, Column] | None = None
    ):
        self._seen, self._rules, self._values = Observation(), list(rules), list(values or {})
        counts = [count_where(rule).alias(f"rule_{i}") for i, rule in enumerate(rules.values())]
        self.rows = df.observe(
            self._seen, *counts, *[column.alias(name) for name, column in (values or {}).items()]
        )

    def require(self) -> None:
        """Raises, naming the rules, when rows broke some."""
        seen = self._seen.get
        broken = [rule for i, rule in enumerate(self._rules) if seen[f"rule_{i}"]]
        if broken:
            raise ValueError("; ".join(broken))

    def values(self) -> dict:
        return {name: self._seen.get[name] for name in self._values}


def require_none(violations: DataFrame, rule: str) -> None:
    """Raises, naming a few of them, when there are violations."""
    found = violations.take(3)
    if found:
        raise ValueError(f"{rule}: {[row.asDict() for row in found]}")


def reconcile(left: DataFrame, right: DataFrame, measures: dict[str, tuple[str, str]]) -> DataFrame:
    """Two one-row totals side by side, with ``right - left`` for each named measure.

    ``measures`` maps the name of the difference to the (left, right) column pair.
    """
    columns: list[Column] = []
    for difference, (a, b) in measures.items():
        columns += [F.col(a), F.col(b), (F.col(b) - F.col(a)).alias(difference)]
    return left.crossJoin(F.broadcast(right)).select(*columns)
