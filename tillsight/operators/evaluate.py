"""Predictions against the holdout: the rate baseline, accuracy, ranking, bootstrap."""

from __future__ import annotations

import math
import sys
from hashlib import md5
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.ordering import global_place, ordered, quantile_columns, spearman_pairs
from tillsight.operators.bgnbd import BgnbdParams, expected_purchases, probability_alive
from tillsight.operators.describe import rank_bucket
from tillsight.sources.storage import materialize

ACTUAL = "actual_holdout_baskets"
# fixed values: the two models and their prediction columns
MODELS = {
    "Historical-rate baseline": "predicted_holdout_baskets_baseline",
    "BG/NBD": "predicted_holdout_baskets_bgnbd",
}
# Households of a block whose draws one task makes, replicates drawn at once, and households weighted at once.
BLOCK_ROWS, DRAWN_REPLICATES, WEIGHT_ROWS = 8192, 100, 128
# Draws that one hash serves, and replicates whose hashed draws are sent together: a draw is a replicate of
# these and a place in a block, in 16 bits.
DRAWS_PER_HASH, SENT_REPLICATES = 4, 8
# Places that are dealt together, so that draws of one hash are made together.
DEALT_PLACES = 256


def rate_baseline(mi: DataFrame) -> DataFrame:
    rate = F.col("frequency").cast("double") / F.col("observation_days").cast("double")
    return mi.withColumn("historical_repeat_rate_per_day", rate).withColumn(
        MODELS["Historical-rate baseline"],
        F.col("historical_repeat_rate_per_day") * F.col("prediction_horizon_days"),
    )


def score(mi: DataFrame, theta: BgnbdParams) -> DataFrame:
    """Baseline, P(alive) and expected holdout baskets per household. No shuffle."""
    return rate_baseline(mi).withColumns(
        {
            "probability_alive": probability_alive(theta),
            MODELS["BG/NBD"]: expected_purchases(theta, F.col("prediction_horizon_days")),
        }
    )


def prediction_errors(scored: DataFrame) -> DataFrame:
    actual = F.col(ACTUAL).cast("double")
    baseline = F.col(MODELS["Historical-rate baseline"]) - actual
    model = F.col(MODELS["BG/NBD"]) - actual
    return scored.withColumns(
        {
            "baseline_error": baseline,
            "bgnbd_error": model,
            "baseline_absolute_error": F.abs(baseline),
            "bgnbd_absolute_error": F.abs(model),
        }
    )


def _by_model(scored: DataFrame) -> DataFrame:
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("model"), F.col(c).alias("predicted"))
            for name, c in MODELS.items()
        ]
    )
    return scored.select(F.col(ACTUAL).cast("double").alias("actual"), F.inline(pairs))


def evaluate_predictions(scored: DataFrame) -> DataFrame:
    """Accuracy measures of both models: one aggregation, and a rank correlation for each."""
    error = F.col("predicted") - F.col("actual")
    measures = (
        _by_model(scored)
        .groupBy("model")
        .agg(
            F.avg(F.abs(error)).alias("MAE"),
            F.sqrt(F.avg(error * error)).alias("RMSE"),
            F.try_divide(F.sum(F.abs(error)), F.sum("actual")).alias("WAPE"),
            F.avg(error).alias("mean_bias"),
            F.sum("actual").alias("actual_baskets_total"),
            F.sum("predicted").alias("predicted_baskets_total"),
            F.try_divide(F.sum("predicted") - F.sum("actual"), F.sum("actual")).alias(
                "aggregate_pct_error"
            ),
        )
    )
    names = F.create_map(*[F.lit(v) for name, column in MODELS.items() for v in (column, name)])
    ranks = spearman_pairs(scored, [(ACTUAL, column) for column in MODELS.values()]).select(
        names[F.col("b")].alias("model"), F.col("correlation").alias("spearman_correlation")
    )
    return measures.join(F.broadcast(ranks), "model")


def model_comparison(scored: DataFrame) -> DataFrame:
    return evaluate_predictions(scored).withColumns(
        {"WAPE": F.col("WAPE") * 100, "aggregate_pct_error": F.col("aggregate_pct_error") * 100}
    )


def improvement_pct(scored: DataFrame) -> DataFrame:
    """How much lower the model's errors are than the baseline's, in percent."""
    base, model = (F.abs(F.col(c) - F.col(ACTUAL)) for c in MODELS.values())
    sums = scored.agg(
        F.avg(base).alias("base_mae"),
        F.avg(model).alias("model_mae"),
        F.sqrt(F.avg(base * base)).alias("base_rmse"),
        F.sqrt(F.avg(model * model)).alias("model_rmse"),
    )
    return sums.select(
        *[
            F.try_divide(F.col(f"base_{m}") - F.col(f"model_{m}"), F.col(f"base_{m}"))
            .__mul__(100)
            .alias(f"{m}_improvement_pct")
            for m in ("mae", "rmse")
        ]
    )


def activity_decile(scored: DataFrame) -> DataFrame:
    return rank_bucket(scored, MODELS["BG/NBD"], 10, "household_baskets_decile")


def decile_calibration(with_decile: DataFrame) -> DataFrame:
    predicted, actual = F.col("mean_predicted_baskets"), F.col("mean_actual_baskets")
    return (
        with_decile.groupBy("household_baskets_decile")
        .agg(
            F.count("*").alias("households_count"),
            F.avg(MODELS["BG/NBD"]).alias("mean_predicted_baskets"),
            F.avg(ACTUAL).alias("mean_actual_baskets"),
            F.sum(ACTUAL).alias("total_actual_baskets"),
        )
        .withColumn("mean_error", predicted - actual)
        .withColumn("pct_error", F.try_divide(F.col("mean_error"), actual) * 100)
        .orderBy("household_baskets_decile")
    )


def top_share_capture(df: DataFrame, score_column: str, share: float = 0.20) -> DataFrame:
    """Share of the actual baskets held by the best-scored households; equal scores in key order."""
    stored = ordered(df, F.desc_nulls_last(score_column), F.asc("household_key"), keep=[ACTUAL])
    chosen = math.ceil(stored.count() * share)
    held = F.sum(F.when(F.col("position") < chosen, F.col(ACTUAL)).otherwise(0))
    return global_place(stored).agg(
        F.lit(chosen).cast("bigint").alias("households_chosen"),
        F.try_divide(held.cast("double"), F.sum(ACTUAL).cast("double")).alias("captured_share"),
    )


def top_share_table(scored: DataFrame, share: float = 0.20) -> DataFrame:
    table = None
    for name, column in MODELS.items():
        row = top_share_capture(scored, column, share).select(F.lit(name).alias("model"), "*")
        table = row if table is None else table.unionByName(row)
    return table


def poisson_bounds() -> list[int]:
    """Numbers of 32 bits from which on a draw gives 1, 2, ... by the Poisson(1) distribution."""
    bounds, below, mass = [], 0.0, math.exp(-1.0)
    while not bounds or bounds[-1] < 2**32 - 1:
        below += mass
        bounds.append(min(int(below * 2**32), 2**32 - 1))
        mass /= len(bounds)
    return bounds


def mixed(x: np.ndarray) -> np.ndarray:
    """32-bit numbers mixed so that neighbours have nothing in common."""
    mask, factor = np.uint64(0xFFFFFFFF), np.uint64(0x45D9F3B)
    for _ in range(2):
        x = ((x >> np.uint64(16)) ^ x) * factor & mask
    return (x >> np.uint64(16)) ^ x


def counter_draws(keys: np.ndarray, replicates: int, seed: int) -> np.ndarray:
    """A 32-bit draw for every key (rows) and replicate (columns), from their numbers alone."""
    mask, shift = np.uint64(0xFFFFFFFF), np.uint64(32)
    start = mixed(np.array([seed], np.uint64) & mask)
    keys = keys.astype(np.int64).view(np.uint64)
    low = mixed((keys & mask) + start & mask)
    rows = mixed(low ^ (keys >> shift))
    columns = mixed(np.arange(replicates, dtype=np.uint64) + np.uint64(1))
    return mixed(rows[:, None] + columns[None, :] & mask)


def _weighted_sums(replicates: int, seed: int):
    """Sums of weights, and of gains times weights, of every replicate: a row per replicate and task."""
    bounds = np.array(poisson_bounds(), np.uint64)

    def run(batches):
        total, weight = np.zeros(replicates), np.zeros(replicates)
        for batch in batches:
            held = batch.filter(batch.column("gain").is_valid())
            keys = held.column("household_key").to_numpy(zero_copy_only=False)
            gains = held.column("gain").to_numpy(zero_copy_only=False)
            for at in range(0, len(keys), WEIGHT_ROWS):
                draws = counter_draws(keys[at : at + WEIGHT_ROWS], replicates, seed)
                w = np.searchsorted(bounds, draws.ravel(), side="right").reshape(draws.shape).astype(np.float64)
                total += gains[at : at + WEIGHT_ROWS] @ w
                weight += w.sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(replicates)), pa.array(total), pa.array(weight)],
            ["replicate", "total", "weight"],
        )

    return run


def block_draws(block: int, rows: int, replicates: int, seed: int) -> np.ndarray:
    """How many of the ``rows`` draws of each replicate fall on the rows of a block.

    The draws are split in halves of the blocks, and again, by binomials whose generator is set by
    the seed and the blocks in question: every block finds its counts alone, and all add up.
    """
    first, last = 0, -(-rows // BLOCK_ROWS)
    draws = np.full(replicates, rows, np.int64)
    while last - first > 1:
        middle = (first + last) // 2
        here = min(last * BLOCK_ROWS, rows) - first * BLOCK_ROWS
        left = (middle - first) * BLOCK_ROWS
        generator = np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, first, last])))
        taken = generator.binomial(draws, left / here)
        if block < middle:
            draws, last = taken, middle
        else:
            draws, first = draws - taken, middle
    return draws


def block_sums(block: int, gains: np.ndarray, rows: int, replicates: int, seed: int) -> np.ndarray:
    """Sum of the gains that each replicate draws from a block, which holds them in order."""
    draws = block_draws(block, rows, replicates, seed)
    generator = np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, block])))
    sums = np.zeros(replicates)
    for at in range(0, replicates, DRAWN_REPLICATES):
        ends = np.cumsum(draws[at : at + DRAWN_REPLICATES])
        drawn = gains[generator.integers(0, len(gains), ends[-1])]
        running = np.concatenate([[0.0], np.cumsum(drawn)])
        sums[at : at + DRAWN_REPLICATES] = np.diff(running[np.concatenate([[0], ends])])
    return sums


def _drawn_sums(rows: int, replicates: int, seed: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ordered_ = table.sort_by("position")
        gains = ordered_.column("gain").to_numpy()
        sums = block_sums(key[0].as_py(), gains, rows, replicates, seed)
        return pa.table({"replicate": np.arange(replicates), "total": sums})

    return run


def hashed_draws(numbers: np.ndarray, rows: int, replicates: int, seed: int):
    """Places of the draws with these numbers, replicate by replicate, by hashes of four draws each."""
    hashes, at = np.unique(numbers // DRAWS_PER_HASH, return_inverse=True)
    ends = [f"|{h}|{seed}".encode() for h in hashes.tolist()]
    for replicate in range(replicates):
        start = str(replicate).encode()
        raw = b"".join([md5(start + end).digest() for end in ends])
        draws = np.frombuffer(raw, ">u4").reshape(-1, DRAWS_PER_HASH)[at, numbers % DRAWS_PER_HASH]
        yield np.floor(draws / 4294967296.0 * rows).astype(np.int64)


def _sent_draws(rows: int, replicates: int, seed: int):
    """The draws numbered as the places of the rows, a row per block drawn from and few replicates."""

    def run(batches):
        for batch in batches:
            numbers = np.sort(batch.column("position").to_numpy())
            if not len(numbers):
                continue
            drawn = hashed_draws(numbers, rows, replicates, seed)
            for first in range(0, replicates, SENT_REPLICATES):
                some = list(islice(drawn, SENT_REPLICATES))
                places = np.concatenate(some)
                codes = np.repeat(np.arange(len(some)) * BLOCK_ROWS, len(numbers)) + places % BLOCK_ROWS
                order = np.argsort(places // BLOCK_ROWS, kind="stable")
                blocks, starts = np.unique((places // BLOCK_ROWS)[order], return_index=True)
                parts = np.split(codes[order].astype("<u2"), starts[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(blocks, pa.int64()),
                        pa.array(np.full(len(blocks), first), pa.int64()),
                        pa.array([part.tobytes() for part in parts], pa.binary()),
                    ],
                    ["block", "first", "draws"],
                )

    return run


def _sums_of_sent_draws(replicates: int):
    """Sums of the gains drawn from a block, and how many draws met one, by replicate."""

    def run(key: tuple[pa.Scalar, ...], held: pa.Table, sent: pa.Table) -> pa.Table:
        gains = held.sort_by("position").column("gain").to_numpy()
        known = ~np.isnan(gains)
        gains = np.where(known, gains, 0.0)
        total, drawn = np.zeros(replicates + SENT_REPLICATES), np.zeros(replicates + SENT_REPLICATES, np.int64)
        for first, draws in zip(sent.column("first").to_pylist(), sent.column("draws")):
            codes = np.frombuffer(draws.as_buffer(), "<u2").astype(np.int64)
            replicate, place = codes // BLOCK_ROWS, codes % BLOCK_ROWS
            some = slice(first, first + SENT_REPLICATES)
            total[some] += np.bincount(replicate, gains[place], SENT_REPLICATES)
            drawn[some] += np.bincount(replicate[known[place]], minlength=SENT_REPLICATES)
        return pa.table(
            {"replicate": np.arange(replicates), "total": total[:replicates], "drawn": drawn[:replicates]}
        )

    return run


def hashed_means(scored: DataFrame, replicates: int, seed: int) -> DataFrame:
    """Mean gain of each replicate: rows ``replicate``, ``value``. Draw ``i`` of a replicate is a number hashed
    from the two, so any engine draws the same households.

    There are as many draws as households: the household at place ``i`` makes the draws ``i`` of all replicates.
    They are sent, two bytes each, to the block of households that holds the place drawn. Households without a gain
    are drawn, but do not count.
    """
    # the functions travel to the executors with the job
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    base, model = (F.abs(F.col(c) - F.col(ACTUAL)) for c in MODELS.values())
    gains = scored.select("household_key", (base - model).alias("gain"))
    stored = ordered(gains, F.asc_nulls_last("household_key"), F.asc("gain"), keep=["gain"])
    rows = stored.count()
    placed = global_place(stored)
    block = F.call_function("div", F.col("position"), F.lit(BLOCK_ROWS)).alias("block")
    sent = (
        # a household makes as many draws as there are replicates: runs of places are dealt to all tasks
        placed.select("position").repartition(
            3 * placed.sparkSession.sparkContext.defaultParallelism,
            F.call_function("div", F.col("position"), F.lit(DEALT_PLACES)),
        )
        .mapInArrow(_sent_draws(rows, replicates, seed), "block long, first long, draws binary")
        .groupBy("block")
    )
    held = placed.select(block, "position", F.coalesce("gain", F.lit(math.nan)).alias("gain")).groupBy("block")
    return (
        held.cogroup(sent)
        .applyInArrow(_sums_of_sent_draws(replicates), "replicate long, total double, drawn long")
        .groupBy("replicate")
        .agg(F.try_divide(F.sum("total"), F.sum("drawn")).alias("value"))
    )


def bootstrap_means(scored: DataFrame, replicates: int, seed: int, method: str) -> DataFrame:
    """Mean gain of each replicate: rows ``replicate``, ``value``."""
    # the functions travel to the executors with the job
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    base, model = (F.abs(F.col(c) - F.col(ACTUAL)) for c in MODELS.values())
    gains = scored.select("household_key", (base - model).alias("gain")).filter(F.col("gain").isNotNull())
    if method == "multinomial":
        stored = ordered(gains, F.asc("household_key"), keep=["gain"])
        rows = stored.count()
        block = F.call_function("div", F.col("position"), F.lit(BLOCK_ROWS))
        return (
            global_place(stored)
            .groupBy(block.alias("block"))
            .applyInArrow(_drawn_sums(rows, replicates, seed), "replicate long, total double")
            .groupBy("replicate")
            .agg((F.sum("total") / rows).alias("value"))
        )
    if method == "poisson":
        return (
            gains.mapInArrow(
                _weighted_sums(replicates, seed), "replicate long, total double, weight double"
            )
            .groupBy("replicate")
            .agg(F.try_divide(F.sum("total"), F.sum("weight")).alias("value"))
        )
    raise ValueError(f"unknown method {method!r}")


def bootstrap_mae_improvement(
    scored: DataFrame,
    replicates: int = 2000,
    seed: int = 42,
    method: str = "multinomial",
    hashed: bool = False,
) -> DataFrame:
    """2.5, 50 and 97.5% points of the MAE gain over resampled households.

    The gain of a resample is the mean of one column, the difference of the absolute errors. With
    ``method`` "multinomial" every replicate draws as many households as there are, with replacement; the
    draws are split over blocks of households, so that no draw is looked up and no task holds more
    than a block; if ``hashed``, each draw is a hash of its number instead, which any engine can repeat
    (:func:`hashed_means`). With "poisson" each household is given a Poisson(1) weight per replicate, and the size of a
    replicate varies slightly around n. Either way a task hands on one row per replicate, and the
    answer does not depend on how the rows are dealt out. The caller chooses.
    """
    if hashed and method != "multinomial":
        raise ValueError(f"no hashed draws for method {method!r}")
    means = hashed_means(scored, replicates, seed) if hashed else bootstrap_means(scored, replicates, seed, method)
    points = quantile_columns(
        materialize(means.select("value"), "replicates"),
        {"p2_5": ("value", 0.025), "p50": ("value", 0.50), "p97_5": ("value", 0.975)},
    )
    return points.withColumn("method", F.lit(method))


def bootstrap_in_errors(scored: DataFrame, points: DataFrame) -> DataFrame:
    """The points of a bootstrap as whole standard errors from the mean gain, beside both numbers:
    what a check without the same random numbers can tell."""
    base, model = (F.abs(F.col(c) - F.col(ACTUAL)) for c in MODELS.values())
    gain = base - model
    moments = scored.agg(
        F.count(gain).alias("households"),
        F.avg(gain).alias("mean_gain"),
        (F.stddev_pop(gain) / F.sqrt(F.count(gain))).alias("standard_error"),
    )
    told = {"p2_5": "lower_errors", "p50": "median_errors", "p97_5": "upper_errors"}
    return moments.crossJoin(F.broadcast(points)).select(  # one row each
        "method", "households", "mean_gain", "standard_error",
        *[
            F.round((F.col(c) - F.col("mean_gain")) / F.col("standard_error")).cast("bigint").alias(name)
            for c, name in told.items()
        ],
    )


def lowest_alive(scored: DataFrame, n: int = 20) -> DataFrame:
    return (
        scored.select(
            "household_key", "frequency", "recency_days", "observation_days",
            "days_since_last_purchase", "probability_alive", MODELS["BG/NBD"], ACTUAL,
        )
        .orderBy(F.asc_nulls_last("probability_alive"), "household_key")
        .limit(n)
    )


def largest_errors(scored: DataFrame, n: int = 20) -> DataFrame:
    return (
        prediction_errors(scored)
        .select(
            "household_key", "frequency", "recency_days", "observation_days", MODELS["BG/NBD"],
            ACTUAL, "bgnbd_error", "bgnbd_absolute_error",
        )
        .orderBy(F.desc_nulls_last("bgnbd_absolute_error"), "household_key")
        .limit(n)
    )
