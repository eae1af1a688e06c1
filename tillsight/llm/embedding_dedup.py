"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one representative kept.

Vectors are compared only within their label. A label with many vectors is cut into cells by
spherical k-means on a bounded sample. A vector stands in the cell of its nearest centroid and visits
every later cell in which a vector close enough to link could stand: one that lies on the near side
of the plane between the two centroids moved by the link angle, and within the cell's widest angle
plus the link angle. So every link is found, in one place, however good the clustering is; how much
is compared depends on it. Cells of any size are cut into tiles of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import discard, forest, spill
from tillsight.llm.components import components

LEAST_COSINE = 0.93
#: vectors of a cell on average, and the bound of all centroids together
CELL = 4096
MAX_CELLS = 4096
#: bounds of the fitting sample: vectors of a cell, and of all labels together
SAMPLE_OF_CELL = 64
MAX_SAMPLE = 100_000
ROUNDS = 12
TILE = 2048
_STRIP = 512
#: vectors held against all centroids at once, and visits handed on at once
HELD, SENT = 1000, 2000
#: scores this close to the threshold are computed again pair by pair
_NEAR = 1e-9
_SLACK = 1e-9


def fit_cells(vectors: np.ndarray, cells: int, seed: int = 0) -> np.ndarray:
    """Centroids of spherical k-means: unit vectors, the normalized sums of their members."""
    rng = np.random.default_rng(seed)
    centroids = vectors[rng.permutation(len(vectors))[:cells]].copy()
    for _ in range(ROUNDS):
        near = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, vectors)
        norms = np.linalg.norm(sums, axis=1)
        moved = norms > 0
        centroids[moved] = sums[moved] / norms[moved, None]
    return centroids


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def linked(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Whether the cosine of each row of ``x`` with each row of ``y`` reaches ``least``."""
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    scores = (x / nx[:, None]) @ (y / ny[:, None]).T
    out = scores >= least
    for i, j in zip(*np.nonzero(np.abs(scores - least) < _NEAR)):
        out[i, j] = float(np.dot(x[i], y[j])) / float(nx[i] * ny[j]) >= least
    return out


def _packed(batches):
    """``vec`` as packed double numbers, times the power of two that brings its largest component near one:
    that is exact, and squares neither overflow nor vanish."""
    for batch in batches:
        lists = batch.column("vec")
        flat = lists.flatten().to_numpy().astype("<f8")
        sizes = lists.value_lengths().to_numpy()
        ends = np.cumsum(sizes)
        power = np.frexp(np.maximum.reduceat(np.abs(flat), ends - sizes))[1] if len(sizes) else np.zeros(0, int)
        flat = np.ldexp(flat, -np.repeat(power, sizes))
        raw = [flat[e - n : e].tobytes() for n, e in zip(lists.value_lengths().to_numpy(), ends)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(raw, pa.binary()) if n == "vec" else batch.column(n) for n in batch.schema.names],
            batch.schema.names,
        )


def _centroids(points: DataFrame, cell: int) -> dict:
    """Centroids of each group with over ``cell`` members: ``MAX_CELLS`` at most over all groups, those
    of the largest groups first. Groups without centroids are one cell."""
    sizes = (
        points.groupBy("group").agg(F.count("*").alias("n"))
        .where(F.col("n") > cell).orderBy(F.desc("n"), "group").limit(MAX_CELLS // 2).collect()
    )
    wanted, left = {}, MAX_CELLS
    for row in sizes:
        k = min(-(-row["n"] // cell), left)
        if k >= 2:
            wanted[row["group"]], left = k, left - k
    if not wanted:
        return {}
    total = sum(wanted.values())
    most = {g: min(SAMPLE_OF_CELL * k, MAX_SAMPLE * k // total) for g, k in wanted.items()}
    share = {r["group"]: min(1.0, 2.0 * most[r["group"]] / r["n"]) for r in sizes if r["group"] in wanted}
    # the least hashes of each group, after a cut by hash that leaves about twice as many
    place = F.pmod(F.xxhash64("rep", "vec"), F.lit(1 << 30))
    limits = F.create_map(*(F.lit(v) for g in wanted for v in (g, int(share[g] * (1 << 30)) + 1)))
    sample = points.where(F.col("group").isin(list(wanted)) & (place <= limits[F.col("group")]))

    def fit(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        table = table.sort_by([("place", "ascending")]).slice(0, most[group])
        x = _unit(table.column("vec").to_pylist())
        made = fit_cells(x, min(wanted[group], len(x)), seed=0)
        return pa.table({"group": pa.array([group], pa.int64()), "rows": pa.array([made.tobytes()], pa.binary()),
                         "dim": pa.array([x.shape[1]], pa.int32())})

    made = sample.select("group", "vec", place.alias("place")).groupBy("group").applyInArrow(
        fit, "group long, rows binary, dim int"
    ).collect()
    return {r["group"]: np.frombuffer(r["rows"], float).reshape(-1, r["dim"]) for r in made}


def _slices(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, HELD):
            yield batch.slice(at, HELD)


def _home(centroids: dict):
    """Cell of the nearest centroid, and the cosine with it."""

    def run(batches):
        for batch in _slices(batches):
            groups = batch.column("group").to_numpy()
            raw = batch.column("vec").to_pylist()
            cell, cosine = np.zeros(len(groups), np.int32), np.ones(len(groups))
            for g in np.unique(groups):
                if int(g) in centroids:
                    at = np.flatnonzero(groups == g)
                    scores = _unit([raw[i] for i in at]) @ centroids[int(g)].T
                    cell[at] = np.argmax(scores, axis=1)
                    cosine[at] = scores.max(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(cosine)], [*batch.schema.names, "cell", "cosine"]
            )

    return run


def visited(scores: np.ndarray, own: np.ndarray, apart: np.ndarray, widest: np.ndarray, least: float) -> np.ndarray:
    """Which later cells a vector visits, from its cosine with all centroids, its own cell, the distances
    of its centroid from all, and the widest angle in each cell (below zero: the cell is empty)."""
    angle = np.arccos(np.clip(least, -1, 1))
    sine = np.sin(min(angle, np.pi / 2)) + _SLACK
    near = scores[np.arange(len(own)), own][:, None] - scores <= sine * apart + _SLACK
    near &= np.arccos(np.clip(scores, -1, 1)) <= np.minimum(widest + angle, np.pi)[None, :] + 1e-7
    return near & (np.arange(scores.shape[1])[None, :] > own[:, None])


def _visits(centroids: dict, widest: dict, least: float):
    """Rows of every vector for its own cell and for each later cell where it could have a link."""

    def sent(batch, rows, cells, home):
        for at in range(0, len(rows), SENT):
            picked = batch.take(pa.array(rows[at : at + SENT]))
            into = cells[at : at + SENT].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [picked.column("group"), pa.array(into), pa.array(np.full(len(into), home)),
                 picked.column("rep"), picked.column("n"), picked.column("vec")],
                ["group", "cell", "home", "rep", "n", "vec"],
            )

    def run(batches):
        for batch in _slices(batches):
            groups, cells = batch.column("group").to_numpy(), batch.column("cell").to_numpy()
            yield from sent(batch, np.arange(len(groups)), cells, True)
            raw = batch.column("vec").to_pylist()
            for g in np.unique(groups):
                c = centroids.get(int(g))
                if c is None:
                    continue
                at = np.flatnonzero(groups == g)
                own = cells[at]
                angles = np.array([widest.get((int(g), k), -1.0) for k in range(len(c))])
                near = visited(_unit([raw[i] for i in at]) @ c.T, own, _apart(c, own), angles, least)
                row, cell = np.nonzero(near)
                yield from sent(batch, at[row], cell, False)

    return run


def _apart(c: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Distances of some centroids from all, never too small."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (c[own] @ c.T))) + 1e-7


def _tile(least: float):
    """Link weights of each vector of a tile and a star for each of its components."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        reps, n = table.column("rep").to_numpy(), table.column("n").to_numpy()
        side = table.column("side").to_numpy()
        raw = table.column("vec").to_pylist()
        x = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
        left, right = np.flatnonzero(side != 2), np.flatnonzero(side >= 2)
        # side 1: a tile with itself; sides 0 and 2: two parts or homes and visitors, across
        alone = bool((side == 1).any())
        if alone:
            left = right = np.arange(len(side))
        weight = np.zeros(len(side), np.int64)
        found: list = []
        for i in range(0, len(left), _STRIP):
            own = left[i : i + _STRIP]
            for j in range(i if alone else 0, len(right), _STRIP):
                other = right[j : j + _STRIP]
                met = linked(x[own], x[other], least)
                if alone and i == j:
                    met &= np.triu(np.ones(met.shape, bool), 1)
                a, b = np.nonzero(met)
                if len(a):
                    np.add.at(weight, own[a], n[other[b]])
                    np.add.at(weight, other[b], n[own[a]])
                    found.append(forest(own[a], other[b]))
                    if len(found) > 64:
                        found = [forest(*(np.concatenate(f) for f in zip(*found)))]
        a, b = forest(*(np.concatenate(f) for f in zip(*found))) if found else (np.zeros(0, int),) * 2
        has = np.flatnonzero(weight)
        return pa.table(
            {
                "a": pa.array(np.concatenate([reps[has], reps[a]])),
                "b": pa.array(np.concatenate([np.full(len(has), -1), reps[b]]).astype(np.int64)),
                "links": pa.array(np.concatenate([weight[has], np.zeros(len(a), np.int64)])),
            }
        )

    return run


def _tiles(placed: DataFrame, tile: int) -> DataFrame:
    """Rows dealt to tiles: parts of a cell's homes in pairs, and homes' parts with visitors' parts."""
    parts = placed.groupBy("group", "cell").agg(
        F.ceil(F.count_if("home") / tile).cast("int").alias("homes"),
        F.ceil(F.count_if(~F.col("home")) / tile).cast("int").alias("guests"),
    ).where("homes > 0")
    rows = placed.join(parts, ["group", "cell"]).withColumn(
        "slot", F.pmod(F.xxhash64("rep"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("guests"))).cast("int")
    )
    # (i, j, side): 1 a part with itself, 0 the first and 2 the second of two parts
    slot = F.col("slot")
    others = F.transform(
        F.sequence(F.lit(0), F.col("homes") - 1),
        lambda o: F.struct(
            F.lit(0).alias("kind"), F.least(slot, o).alias("i"), F.greatest(slot, o).alias("j"),
            F.when(slot == o, F.lit(1)).when(slot < o, F.lit(0)).otherwise(F.lit(2)).alias("side"),
        ),
    )
    hosts = F.when(
        F.col("guests") > 0,
        F.transform(
            F.sequence(F.lit(0), F.col("guests") - 1),
            lambda o: F.struct(F.lit(1).alias("kind"), slot.alias("i"), o.alias("j"), F.lit(0).alias("side")),
        ),
    ).otherwise(F.slice(others, 1, 0))
    visits = F.transform(
        F.sequence(F.lit(0), F.col("homes") - 1),
        lambda o: F.struct(F.lit(1).alias("kind"), o.alias("i"), slot.alias("j"), F.lit(2).alias("side")),
    )
    where = F.explode(F.when(F.col("home"), F.concat(others, hosts)).otherwise(visits)).alias("at")
    return rows.select("group", "cell", "rep", "n", "vec", where).select(
        "group", "cell", "rep", "n", "vec", "at.*"
    )


def near_duplicates(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    least: float = LEAST_COSINE,
    cell: int = CELL,
    tile: int = TILE,
) -> DataFrame:
    """One row per vector: ``id_col, n_links, component_id, kept``.

    Vectors link if their labels are equal and not null and their cosine, in double precision, is at
    least ``least`` (over 0). A vector that is null, empty, zero or holds null or non-finite
    components links with nothing and is kept, as is one without label; so do vectors of different
    length with each other. ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest id reachable (its own without links), ``kept`` marks the representative: the row
    that bears this id. Equal vectors of a label are compared once, so a group of copies costs no more
    than one of them; rows with the same id are vectors of their own. A row without id links like
    any other, is never kept, and has no component id unless a linked row has an id. Other columns
    are ignored, and an empty table gives an empty result.
    """
    if not 0 < least <= 1:
        raise ValueError("the least cosine must be over 0")
    vec = F.transform(vec_col, lambda x: x.cast("double"))
    sound = F.coalesce(
        F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
        & F.exists(vec_col, lambda x: x.cast("double") != F.lit(0.0))
        & F.col(label_col).isNotNull(),
        F.lit(False),
    )
    rows = df.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.when(sound, vec).alias("vec")
    )
    alone = rows.where("vec is null").select(
        F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
        F.col("id").isNotNull().alias("kept"),
    )
    some = rows.where("vec is not null")
    distinct = some.groupBy("label", "vec").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    points = spill(
        distinct.select(
            F.monotonically_increasing_id().alias("rep"), "label", "vec", "first", "n",
            F.xxhash64("label", F.size("vec")).alias("group"),
        ),
        "points",
    )
    packed = spill(
        points.select("group", "rep", "n", "vec").mapInArrow(
            _packed, "group long, rep long, n long, vec binary"
        ),
        "packed",
    )
    centroids = _centroids(packed, cell)
    schema = "group long, rep long, n long, vec binary, cell int, cosine double"
    homes = packed.select("group", "rep", "n", "vec").mapInArrow(_home(centroids), schema)
    widest: dict = {}
    if centroids:
        homes = spill(homes, "homes")
        far = homes.where(F.col("group").isin(list(centroids))).groupBy("group", "cell").agg(F.min("cosine"))
        widest = {(g, c): float(np.arccos(np.clip(w, -1, 1))) for g, c, w in far.collect()}
    placed = homes.mapInArrow(
        _visits(centroids, widest, least), "group long, cell int, home boolean, rep long, n long, vec binary"
    )
    found = spill(
        _tiles(placed, tile).groupBy("group", "cell", "kind", "i", "j").applyInArrow(
            _tile(least), "a long, b long, links long"
        ),
        "found",
    )
    weights = found.where("b < 0").groupBy("a").agg(F.sum("links").alias("links"))
    reach = components(found.where("b >= 0").select("a", "b"))
    rooted = (
        points.select("rep", "first", "n")
        .join(reach, F.col("rep") == F.col("node"), "left")
        .select("rep", "first", "n", F.coalesce("root", "rep").alias("root"))
    )
    least_id = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = (
        rooted.join(least_id, "root").join(weights, rooted["rep"] == weights["a"], "left")
        .select("rep", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    )
    named = spill(named, "named")
    discard(packed, found, reach, *([homes] if centroids else []))
    told = points.select("rep", F.col("label").alias("l"), F.col("vec").alias("v")).join(named, "rep")
    joined = some.join(told, (some["label"] == told["l"]) & (some["vec"] == told["v"])).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
    return joined.unionByName(alone)
