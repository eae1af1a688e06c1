"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.sources.storage import shared_folder, write_table

BATCH_ROWS = 1000


def plus(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    """``schema`` with ``fields`` at the end; a column of the same name gives way to the new one."""
    names = {f.name for f in fields}
    return T.StructType([f for f in schema.fields if f.name not in names] + list(fields))


def byte_values(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def text_values(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Values of a text column, null as empty."""
    return [t if t is not None else "" for t in column.to_pylist()]


def with_derived(df: DataFrame, make, *fields: T.StructField) -> DataFrame:
    """Every row of ``df`` with columns that ``make`` derives from its Arrow batch.

    ``make(batch)`` returns one Arrow array per field. The step is narrow: no row moves. Batches are
    cut to ``BATCH_ROWS`` rows first, so that what is made of them stays small.
    """
    schema = plus(df.schema, *fields)
    names = schema.names

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                made = dict(zip((f.name for f in fields), make(batch)))
                yield pa.RecordBatch.from_arrays(
                    [made[n] if n in made else batch.column(n) for n in names], names
                )

    return df.mapInArrow(run, schema)


#: characters of a key from which on its value is not kept, and of an entry on average
LONG_KEY, KEY_CHARS = 32, 12


class Known(dict):
    """Values made on demand and looked up when they return. Two generations are kept, each of at most
    about ``most`` entries, whose keys have ``KEY_CHARS`` characters on average; what is not used during a
    whole generation is forgotten. Values of long keys are made anew: such keys seldom return."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}
        self.chars = 0

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > LONG_KEY:
                return value
        self[key] = value
        self.chars += len(key)
        return value

    def tidy(self) -> None:
        if len(self) > self.most or self.chars > self.most * KEY_CHARS:
            self.old = dict(self)
            self.clear()
            self.chars = 0


def run_ends(keys: np.ndarray) -> np.ndarray:
    """For each position of a sorted array, the end of its run of equal keys."""
    if not len(keys):
        return np.zeros(0, np.int64)
    last = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    bounds = np.append(last, len(keys))
    return np.repeat(bounds, np.diff(np.concatenate([[0], bounds])))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each connected component of the links: one link fewer than it has members."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        # hook the roots of both ends below the smaller one, then shorten the paths
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        while True:
            shorter = new[new]
            if np.array_equal(shorter, new):
                break
            new = shorter
        if np.array_equal(new, label):
            break
        label = new
    member = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[member], nodes[label[member]]


def spill(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back, so that later steps neither repeat the work nor
    depend on executors. What a result still reads stays until the session's tables are released."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    made = write_table(df, path)
    made.spilled_to = path
    return made


def discard(*tables: DataFrame) -> None:
    """Delete spilled tables that nothing reads any more."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.spilled_to)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def chars(df: DataFrame, text_col: str) -> int:
    """Characters of a text column over all rows."""
    return df.agg(F.coalesce(F.sum(F.length(text_col)), F.lit(0))).first()[0]
