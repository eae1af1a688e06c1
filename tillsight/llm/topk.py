"""Exact top-k search by inner product with a uniform threshold in three phases.

The components of a vector are dealt to slices, and a slice's score list ranks all candidates by
their partial product. Phase one gathers the head of every list and scores its candidates in full:
the k-th best of these is a cutoff that the k-th best of all cannot be below. A candidate that
reaches the cutoff must reach an equal share of it in some slice, so phase two sends the cutoff of
each query out and collects only entries at or above that share. Phase three resolves the full
scores of these entries and ranks them.

Queries and candidates are held in blocks. Candidate blocks are dealt to groups once; query blocks are sent
to every group and stream past its candidates, so a task holds one group and a batch of queries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillsight.llm.common import spill

SLICES = 4
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 4096
SCALE = 256
#: products in double precision are exact while no sum can pass this
_EXACT = float(1 << 53)
#: vectors with a component from here on are kept apart: their products may need whole numbers of any size
_WIDE = float(1 << 20)
#: scores lie between these; one that does not raises an error
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_TOO_LARGE = "a score does not fit 64 bits"

_HIT = "query_id long, vec_id long, score long"
_BLOCK = "block long, dim int, ids binary, vecs binary"


def sound(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, vec)`` of the vectors whose components are all finite numbers."""
    finite = F.forall(
        vec_col,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return df.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")
    )


def _blocks(rows: DataFrame, size: int, scale: int) -> DataFrame:
    """Rows of a block number, ids and vectors: up to ``size`` vectors of one length, wide ones apart, as
    ``floor(scale * x)``."""

    def run(batches):
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids = batch.column("id").to_numpy()
            lists = batch.column("vec")
            dims = lists.value_lengths().to_numpy()
            with np.errstate(over="ignore"):
                flat = np.floor(scale * lists.flatten().to_numpy())
            if np.isinf(flat).any():
                raise OverflowError("a component times the scale is no finite number")
            begin = np.concatenate([[0], np.cumsum(dims)])
            # the widest component of each vector; an empty one has none
            wide = np.zeros(len(dims), bool)
            held = np.flatnonzero(dims)
            if len(held):
                wide[held] = np.maximum.reduceat(np.abs(flat), begin[:-1][held]) >= _WIDE
            out = []
            for dim, apart in sorted(set(zip(dims.tolist(), wide.tolist()))):
                at = np.flatnonzero((dims == dim) & (wide == apart))
                for i in range(0, len(at), size):
                    own = at[i : i + size]
                    index = begin[own][:, None] + np.arange(dim)
                    out.append((number, dim, ids[own].tobytes(), flat[index].tobytes()))
                    number += 1
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)],
                ["block", "dim", "ids", "vecs"],
            )

    return rows.mapInArrow(run, _BLOCK)


def _matrix(raw: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(raw, float).reshape(rows, dim)


def _whole(x: np.ndarray) -> np.ndarray:
    """Whole numbers of any size."""
    return np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)


def _product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows: 64 bits where double precision is exact, else of any size."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if most < _EXACT:
        return (q @ c.T).astype(np.int64)
    return _whole(q) @ _whole(c).T


def _lists(q: np.ndarray, c: np.ndarray, slices: int) -> list[np.ndarray]:
    """Score lists of the slices of the components: what each adds to every score. Vectors of length
    0 have one, of zeros."""
    parts = [s for s in np.array_split(np.arange(q.shape[1]), slices) if len(s)]
    lists = [_product(q[:, s], c[:, s]) for s in parts] or [np.zeros((len(q), len(c)), np.int64)]
    # whole numbers of any size if one slice needs them, so that sums cannot overflow
    return [x.astype(object) for x in lists] if any(x.dtype == object for x in lists) else lists


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best scores, ties by the smaller id."""
    if len(scores) > k:
        limit = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > limit)
        equal = np.flatnonzero(scores == limit)
        equal = equal[np.argsort(ids[equal], kind="stable")][: k - len(above)]
        at = np.concatenate([above, equal])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))]


def _fitting(scores: np.ndarray) -> np.ndarray:
    """Best scores as 64 bits; what lies below them becomes the least number, which may still drop out."""
    if scores.dtype == object:
        if any(int(x) > _MOST for x in scores):
            raise OverflowError(_TOO_LARGE)
        scores = np.array([max(int(x), _LEAST) for x in scores], np.int64)
    return scores


def _heads(k: int, slices: int):
    """Phase one in one block: the heads of its score lists, and the k best of what they name, which alone
    is scored in full."""

    def body(q_ids, q, c_ids, c, _):
        lists = _lists(q, c, slices)
        out = []
        for i, query in enumerate(q_ids):
            others = np.flatnonzero(c_ids != query)
            if not len(others):
                continue
            named = np.unique(
                np.concatenate([others[_top(part[i, others], k)] for part in lists])
            )
            full = sum(part[i, named] for part in lists)
            at = _best(full, c_ids[named], k)
            out.append((np.full(len(at), query), c_ids[named][at], _fitting(full[at])))
        return out

    return body


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    return np.argpartition(scores, len(scores) - k)[-k:] if len(scores) > k else np.arange(len(scores))


def _collect(k: int, slices: int):
    """Phases two and three in one block: entries at or above the share of the cutoff in some slice,
    resolved in full, the k best of those at or above the cutoff."""

    def body(q_ids, q, c_ids, c, cuts):
        lists = _lists(q, c, slices)
        out = []
        for i, query in enumerate(q_ids):
            # whole numbers: some slice reaches the cutoff's share if its multiple reaches the cutoff
            # without a cutoff all are wanted
            reach = np.full(len(c_ids), cuts[i] == _LEAST)
            for part in lists:
                reach |= (part[i] >= -(-int(cuts[i]) // len(lists))).astype(bool)
            at = np.flatnonzero((c_ids != query) & reach)
            full = sum(part[i, at] for part in lists)
            good = (full >= int(cuts[i])).astype(bool) | (cuts[i] == _LEAST)
            at, full = at[good], full[good]
            best = _best(full, c_ids[at], k)
            out.append((np.full(len(best), query), c_ids[at][best], _fitting(full[best])))
        return out

    return body


def _search(candidates: DataFrame, queries: DataFrame, groups: int, body) -> DataFrame:
    """Hits that ``body(query ids, query vectors, candidate ids, candidate vectors, cutoffs)`` gives for
    every query block and every candidate block of the same length.

    Candidate blocks are dealt to the groups by their number, each query block goes to all of them. In a group
    the candidates come first and are held, the queries stream past.
    """
    none = F.lit(None).cast("binary")
    held = candidates.select(
        F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("group"), F.lit(0).alias("asks"),
        "dim", "ids", "vecs", none.alias("cutoffs"),
    )
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(1).alias("asks"),
        "dim", "ids", "vecs", "cutoffs",
    )

    def run(batches):
        group, kept = None, []
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                vecs = _matrix(row["vecs"], len(ids), row["dim"])
                if row["group"] != group:
                    group, kept = row["group"], []
                if not row["asks"]:
                    kept.append((row["dim"], ids, vecs))
                    continue
                cuts = None if row["cutoffs"] is None else np.frombuffer(row["cutoffs"], np.int64)
                hits = [h for dim, c_ids, c in kept if dim == row["dim"] for h in body(ids, vecs, c_ids, c, cuts)]
                if hits:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in zip(*hits)], ["query_id", "vec_id", "score"]
                    )

    return (
        held.unionByName(asked)
        .repartition("group")
        .sortWithinPartitions("group", "asks")
        .mapInArrow(run, _HIT)
    )


def _k_best(hits: DataFrame, k: int) -> DataFrame:
    """The ``k`` best hits of each query with their rank; each task drops its others first."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    df: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = SCALE,
    slices: int = SLICES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``k`` best other rows of ``df``.

    Components become ``floor(scale * x)``, the score is their integer inner product, ties go to the
    smaller id, a query with fewer than ``k`` candidates gets all of them. Rows with null id or
    vector, or with null or non-finite components, take no part; vectors meet only vectors of their
    own length, and those of length 0 score 0. Scores are whole numbers however large the components; one
    among the best that does not fit 64 bits raises an OverflowError. Rows with equal ids are one vector to a
    query with that id (none of them is its candidate) and else candidates of their own; a repeated query id is
    asked once, with its smallest vector. Other columns are ignored; empty tables give no rows.
    """
    asked = sound(queries, id_col, vec_col).groupBy("id").agg(F.min("vec").alias("vec"))
    q_blocks = spill(_blocks(asked, QUERY_BLOCK, scale), "queries")
    c_blocks = spill(_blocks(sound(df, id_col, vec_col), CANDIDATE_BLOCK, scale), "candidates")
    groups = max(1, c_blocks.count())
    heads = _search(
        c_blocks, q_blocks.withColumn("cutoffs", F.lit(None).cast("binary")), groups, _heads(k, slices)
    )
    cutoffs = spill(
        _k_best(heads, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("cutoff")),
        "cutoffs",
    )
    hits = _search(c_blocks, _with_cutoffs(q_blocks, cutoffs), groups, _collect(k, slices))
    score = F.when(F.col("score") == F.lit(_LEAST), F.raise_error(F.lit(_TOO_LARGE))).otherwise(F.col("score"))
    return _k_best(hits, k).select("query_id", "rank", "vec_id", score.alias("score"))


def _with_cutoffs(q_blocks: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """The query blocks with the cutoffs of their queries, in their order; the least number where fewer than
    k candidates exist."""

    def ids(batches):
        for batch in batches:
            for number, raw in zip(batch.column("block").to_pylist(), batch.column("ids").to_pylist()):
                own = np.frombuffer(raw, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), number)), pa.array(np.arange(len(own))), pa.array(own)],
                    ["block", "place", "query_id"],
                )

    rows = q_blocks.select("block", "ids").mapInArrow(ids, "block long, place long, query_id long")

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        by = np.argsort(table.column("place").to_numpy())
        cuts = table.column("cutoff").to_numpy()[by].astype(np.int64)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "cutoffs": pa.array([cuts.tobytes()], pa.binary())})

    packed = (
        rows.join(cutoffs, "query_id", "left")
        .select("block", "place", F.coalesce("cutoff", F.lit(_LEAST)).alias("cutoff"))
        .groupBy("block").applyInArrow(pack, "block long, cutoffs binary")  # a block of queries
    )
    return q_blocks.join(packed, "block")
