"""The BG/NBD purchase-count model (Fader, Hardie and Lee, 2005) on Spark.

Fitting runs one aggregation per iteration, over the distinct histories with their counts: each task
adds up the likelihood of its histories with its first and second derivatives, for a batch of candidate
parameters, in whole arrays, and hands on one row per candidate. The best candidate's derivatives give
the next batch, by steps the driver takes over four numbers.
"""

from __future__ import annotations

import math
import sys
from dataclasses import asdict, astuple, dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions import gamma
from tillsight.functions.gamma import (
    SHIFT,
    digamma,
    log_gamma_rise,
    log_gamma_tail,
    rise_of,
    tail,
    trigamma,
)
from tillsight.functions.ordering import quantile_columns
from tillsight.sources.storage import materialize

NAMES = ["r", "alpha", "a", "b"]
LOWER, UPPER = math.log(1e-6), math.log(1e8)
# steepest slope per household, in log parameters, at which a fit counts as converged
CONVERGED_SLOPE = 1e-4
# scale of the longest observation under which the penalty on the parameters is applied
PENALTY_TIME = 10.0


@dataclass(frozen=True)
class BgnbdParams:
    r: float
    alpha: float
    a: float
    b: float


@dataclass(frozen=True)
class BgnbdFit:
    params: BgnbdParams
    log_likelihood: float
    households: int
    iterations: int
    converged: bool
    at_bound: bool


def _history(df: DataFrame) -> DataFrame:
    """Distinct histories (x, tx, t) and how many households have each."""
    return df.groupBy(
        F.col("frequency").cast("double").alias("x"),
        F.col("recency_days").cast("double").alias("tx"),
        F.col("observation_days").cast("double").alias("t"),
    ).agg(F.count("*").alias("n"))


def _candidate(position: int, theta) -> str:
    """A parameter set with everything that depends on it alone, as a SQL struct literal."""
    r, alpha, a, b = (float(v) for v in theta)
    values = {
        "r": r,
        "alpha": alpha,
        "a": a,
        "b": b,
        "log_a": math.log(a),
        "tail_r": float(log_gamma_tail(r)),
        "base": float(log_gamma_rise(b, a)) + r * math.log(alpha),
    }
    fields = ", ".join(f"'{name}', {value!r}D" for name, value in values.items())
    return f"named_struct('candidate', {position}, {fields})"


@cache
def _steps() -> tuple[list[dict[str, Column]], Column]:
    """Columns added one after the other, then the total likelihood.

    Over x, tx, t, n and the fields of a candidate.
    """
    c = F.col
    arguments = ["rx", "bx", "abx"]
    steps = [
        {
            "rx": c("r") + c("x"),
            "bx": c("b") + c("x"),
            "abx": c("a") + c("b") + c("x"),
            "log_t": F.log(c("alpha") + c("t")),
            "log_tx": F.log(c("alpha") + c("tx")),
        },
        {
            **{f"{z}_l": F.log(c(z) + float(SHIFT)) for z in arguments},
            **{f"{z}_i": 1.0 / (c(z) + float(SHIFT)) for z in arguments},
            # log odds of having dropped out; a one-time buyer has not
            "gap": F.when(
                c("x") > 0,
                c("log_a") - F.log(c("bx") - 1.0) + c("rx") * (c("log_t") - c("log_tx")),
            ),
        },
        {
            **{f"{z}_tail": tail(c(f"{z}_i"), c(f"{z}_i") * c(f"{z}_i")) for z in arguments},
            # log of the sum of both branches, less the branch of staying alive
            "extra": F.coalesce(
                F.greatest(c("gap"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("gap"))), F.lit(0.0)
            ),
        },
    ]
    value = (
        c("base")
        + rise_of(c("r"), c("x"), c("rx_l"), c("tail_r"), c("rx_tail"))
        - rise_of(c("bx"), c("a"), c("abx_l"), c("bx_tail"), c("abx_tail"))
        - c("rx") * c("log_t")
        + c("extra")
    )
    return steps, F.sum(c("n") * value).alias("log_likelihood")


def _expanded(history: DataFrame, candidates) -> DataFrame:
    """Each history once per candidate, with the columns the likelihood is made of.

    The candidates are one literal array: their values are not part of the generated code.
    """
    literal = ", ".join(_candidate(i, theta) for i, theta in enumerate(candidates))
    rows = history.select("x", "tx", "t", "n", F.expr(f"inline(array({literal}))"))
    for columns in _steps()[0]:
        rows = rows.withColumns(columns)
    return rows


#: what is added up per candidate: the likelihood, its slopes by r, alpha, a, b, the upper half of its Hessian
UPPER_HALF = [(i, j) for i in range(4) for j in range(i, 4)]


def terms(theta, x: np.ndarray, tx: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Log-likelihood of histories, its first derivatives and its second ones, one row each."""
    r, alpha, a, b = theta
    rx, bx, abx = r + x, b + x, a + b + x
    end, last, after = alpha + t, alpha + tx, b + np.maximum(x, 1.0) - 1.0
    # log odds of having dropped out; a one-time buyer has not
    gap = np.where(x > 0, np.log(a) - np.log(after) + rx * (np.log(end) - np.log(last)), -np.inf)
    gone = np.where(gap > 0, 1.0 / (1.0 + np.exp(-np.abs(gap))), 1.0 - 1.0 / (1.0 + np.exp(-np.abs(gap))))
    value = (
        log_gamma_rise(r, x) + log_gamma_rise(b, a) - log_gamma_rise(bx, a)
        + r * np.log(alpha) - rx * np.log(end) + np.maximum(gap, 0.0) + np.log1p(np.exp(-np.abs(gap)))
    )
    gaps = [np.log(end) - np.log(last), rx * (1.0 / end - 1.0 / last), 1.0 / a, -1.0 / after]
    dropout, turn = digamma(a + b) - digamma(abx), trigamma(a + b) - trigamma(abx)
    slopes = [
        digamma(rx) - digamma(r) + np.log(alpha) - np.log(end),
        r / alpha - rx / end,
        dropout,
        dropout + digamma(bx) - digamma(b),
    ]
    # second derivatives of the branch of staying alive, and of the log odds
    bends = {
        (0, 0): (trigamma(rx) - trigamma(r), 0.0),
        (0, 1): (1.0 / alpha - 1.0 / end, 1.0 / end - 1.0 / last),
        (1, 1): (rx / end**2 - r / alpha**2, -rx * (1.0 / end**2 - 1.0 / last**2)),
        (2, 2): (turn, -1.0 / a**2),
        (2, 3): (turn, 0.0),
        (3, 3): (turn + trigamma(bx) - trigamma(b), 1.0 / after**2),
    }
    out = [value] + [slope + gone * by for slope, by in zip(slopes, gaps)]
    for i, j in UPPER_HALF:
        here, there = bends.get((i, j), (0.0, 0.0))
        out.append(here + gone * there + gone * (1.0 - gone) * gaps[i] * gaps[j])
    return np.array(np.broadcast_arrays(*out))


def _sums(thetas):
    """The terms of every candidate added up over a task's histories: a row per candidate."""

    def run(batches):
        total = np.zeros((len(thetas), 5 + len(UPPER_HALF)))
        for batch in batches:
            x, tx, t, n = (batch.column(c).to_numpy().astype(float) for c in ("x", "tx", "t", "n"))
            for i, theta in enumerate(thetas):
                total[i] += terms(theta, x, tx, t) @ n
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(thetas))), pa.array(list(total))], ["candidate", "sums"]
        )

    return run


def _evaluate(history: DataFrame, candidates) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Total log-likelihood, its derivatives by r, alpha, a, b and its Hessian, for each candidate."""
    # the functions travel to the executors with the job, where this package need not be installed
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    cloudpickle.register_pickle_by_value(gamma)
    thetas = [tuple(float(v) for v in theta) for theta in candidates]
    sums = history.mapInArrow(_sums(thetas), "candidate long, sums array<double>")
    width = 5 + len(UPPER_HALF)
    rows = (
        sums.groupBy("candidate").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
        .orderBy("candidate").collect()  # one row per candidate
    )
    total = np.array([[row[f"s{i}"] for i in range(width)] for row in rows])
    bends = np.zeros((len(rows), 4, 4))
    for k, (i, j) in enumerate(UPPER_HALF):
        bends[:, i, j] = bends[:, j, i] = total[:, 5 + k]
    return total[:, 0], total[:, 1:5], bends


def log_likelihood(df: DataFrame, theta: BgnbdParams) -> DataFrame:
    """The objective at fixed parameters."""
    return (
        _expanded(_history(df), [astuple(theta)])
        .agg(F.sum("n").alias("households"), _steps()[1])
        .withColumn("mean_log_likelihood", F.col("log_likelihood") / F.col("households"))
    )


class _Objective:
    """Mean negative log-likelihood over log parameters, with an optional square penalty."""

    def __init__(self, history: DataFrame, penalizer: float):
        self.history = history
        self.penalizer = penalizer
        n = F.col("n")
        self.rows, self.sum_x, self.sum_t, longest = history.agg(
            F.coalesce(F.sum(n), F.lit(0)), F.sum(n * F.col("x")), F.sum(n * F.col("t")), F.max("t")
        ).first()
        self.weights = np.array([1.0, PENALTY_TIME / longest if longest else 1.0, 1.0, 1.0])

    def __call__(self, points: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Value, gradient and Hessian at each point, in one aggregation."""
        thetas = [np.exp(u) for u in points]
        f, g, h = [], [], []
        for theta, value, slope, bend in zip(thetas, *_evaluate(self.history, thetas)):
            square = (theta * self.weights) ** 2
            f.append(-value / self.rows + self.penalizer * float(square.sum()))
            g.append(-slope * theta / self.rows + 2 * self.penalizer * square)
            curved = bend * np.outer(theta, theta) + np.diag(slope * theta)
            h.append(-curved / self.rows + np.diag(4 * self.penalizer * square))
        return np.array(f), np.array(g), np.array(h)


def _at_bound(u: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Parameters that would leave their range downhill."""
    return ((u <= LOWER) & (g > 0)) | ((u >= UPPER) & (g < 0))


def _downhill(
    g: np.ndarray, hessian: np.ndarray, free: np.ndarray, reach: float, damping: float = 0.0
) -> np.ndarray:
    """Newton step over the free parameters with curvature made positive.

    Each principal direction is held to ``reach`` on its own, so that a flat direction cannot
    shorten the step along the well-determined ones.
    """
    step = np.zeros(4)
    if free.any():
        values, vectors = np.linalg.eigh(hessian[np.ix_(free, free)])
        along = (vectors.T @ g[free]) / (np.maximum(np.abs(values), 1e-12) + damping)
        step[free] = -vectors @ np.clip(along, -reach, reach)
    return step


def fit(
    df: DataFrame, penalizer: float = 0.0, max_iterations: int = 60, tolerance: float = 1e-7
) -> BgnbdFit:
    """Maximum likelihood over the households. One aggregation per iteration: a batch of steps is
    tried, and the derivatives at the best of them give the next batch."""
    history = materialize(_history(df), "history")
    objective = _Objective(history, penalizer)
    if not objective.rows:
        raise ValueError("no households to fit")
    # a start with the observed mean rate; one-time buyers only give no rate to start from
    rate = max(objective.sum_x, 1.0) / objective.sum_t
    u = np.log([1.0, 1.0 / rate, 0.5, 5.0])
    f, g, hessian = (part[0] for part in objective([u]))
    iteration = 0
    for iteration in range(1, max_iterations + 1):
        stuck = _at_bound(u, g)
        if np.max(np.abs(np.where(stuck, 0.0, g))) < tolerance:
            break
        steps = [_downhill(g, hessian, ~stuck, reach) for reach in (8.0, 3.0, 1.0, 0.1)]
        steps.append(_downhill(g, hessian, ~stuck, 3.0, damping=1e-2))
        # the plain Newton direction as well, at most three long, and stretched
        newton = _downhill(g, hessian, ~stuck, np.inf)
        newton *= 3.0 / max(3.0, np.max(np.abs(newton)))
        steps += [newton, 2 * newton, 4 * newton]
        tries = [np.clip(u + step, LOWER, UPPER) for step in steps]
        values, slopes, hessians = objective(tries)
        best = int(np.nanargmin(values))
        gain = f - values[best]
        if gain > 0:
            u, f, g, hessian = tries[best], values[best], slopes[best], hessians[best]
        if not gain > tolerance * 1e-2 * abs(f):
            break
    slope = np.max(np.abs(np.where(_at_bound(u, g), 0.0, g)))
    theta = np.exp(u)
    penalty = penalizer * float((theta * objective.weights) @ (theta * objective.weights))
    return BgnbdFit(
        params=BgnbdParams(*[float(v) for v in theta]),
        log_likelihood=float(-(f - penalty) * objective.rows),
        households=int(objective.rows),
        iterations=iteration,
        converged=bool(slope < CONVERGED_SLOPE),
        at_bound=bool(np.any((u <= LOWER + 1e-9) | (u >= UPPER - 1e-9))),
    )


def fit_table(df: DataFrame, result: BgnbdFit) -> DataFrame:
    """A fit as one row."""
    values = {**asdict(result.params), **{k: v for k, v in asdict(result).items() if k != "params"}}
    return df.sparkSession.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


def reached(df: DataFrame, result: BgnbdFit, others: list[BgnbdParams]) -> DataFrame:
    """One row per other parameter set: its log-likelihood, and whether the fit is at least as good."""
    level = result.log_likelihood + 1e-9 * abs(result.log_likelihood)
    return (
        _expanded(_history(df), [astuple(theta) for theta in others])
        .groupBy(*NAMES)
        .agg(_steps()[1])
        .withColumn("reached", F.col("log_likelihood") <= F.lit(level))
    )


def standard_errors(df: DataFrame, theta: BgnbdParams, penalizer: float = 0.0) -> np.ndarray:
    """From the observed information in log parameters; NaN where it is not positive."""
    history = materialize(_history(df), "history")
    objective = _Objective(history, penalizer)
    values = np.array(astuple(theta))
    hessian = objective([np.log(values)])[2][0]
    try:
        covariance = np.linalg.inv(hessian * objective.rows)
    except np.linalg.LinAlgError:
        return np.full(4, np.nan)
    with np.errstate(invalid="ignore"):
        return np.sqrt(np.diag(covariance)) * values


def summary(df: DataFrame, theta: BgnbdParams, penalizer: float = 0.0) -> DataFrame:
    """Coefficient, standard error and 95% interval per parameter."""
    errors = standard_errors(df, theta, penalizer)
    half_width = 1.959963984540054
    rows = []
    for i, (name, value, error) in enumerate(zip(NAMES, astuple(theta), errors)):
        known = bool(np.isfinite(error))

        def number(v):
            return F.lit(float(v) if known else None).cast("double")

        rows.append(
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(name).alias("parameter"),
                F.lit(float(value)).alias("coefficient"),
                number(error).alias("standard_error"),
                number(value - half_width * error).alias("lower_95"),
                number(value + half_width * error).alias("upper_95"),
            )
        )
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def probability_alive(theta: BgnbdParams) -> Column:
    """Chance that the household still buys, from its frequency, recency and observed time."""
    x = F.col("frequency").cast("double")
    tx = F.col("recency_days").cast("double")
    t = F.col("observation_days").cast("double")
    odds = F.lit(theta.a) / (F.lit(theta.b) + x - 1.0) * F.exp(
        (F.lit(theta.r) + x) * F.log((F.lit(theta.alpha) + t) / (F.lit(theta.alpha) + tx))
    )
    return F.when(x > 0, 1.0 / (1.0 + odds)).otherwise(1.0)


def hypergeometric(p, q, c: np.ndarray, z: np.ndarray, limit: int = 200_000) -> np.ndarray:
    """Gauss series 2F1(p, q; c; z) over arrays, until every term is below rounding."""
    total = np.ones_like(z)
    term = np.ones_like(z)
    for k in range(limit):
        term = term * ((p + k) * (q + k) / ((c + k) * (k + 1)) * z)
        total = total + term
        if not np.any(np.abs(term) > 1e-17 * np.abs(total)):
            return total
    raise ArithmeticError("hypergeometric series did not settle")


def expected_while_alive(
    theta: BgnbdParams, x: np.ndarray, t: np.ndarray, horizon: np.ndarray
) -> np.ndarray:
    """Expected purchases of a household known to be alive.

    The published form multiplies a vanishing power by a 2F1 that overflows for frequent buyers.
    Euler's transformation turns the product into (1-z)^(a-1) 2F1(a+b-1-r, a-1; a+b+x-1; z).
    """
    a = theta.a if abs(theta.a - 1.0) > 1e-6 else 1.0 + 1e-6
    z = horizon / (theta.alpha + t + horizon)
    c = a + theta.b + x - 1.0
    product = (1.0 - z) ** (a - 1.0) * hypergeometric(a + theta.b - 1.0 - theta.r, a - 1.0, c, z)
    return c / (a - 1.0) * (1.0 - product)


def expected_purchases(theta: BgnbdParams, horizon: Column) -> Column:
    """Expected purchases within the horizon given the household's history."""
    # the functions travel to the executors with the job, where this package need not be installed
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    @F.pandas_udf("double")
    def while_alive(x: pd.Series, t: pd.Series, h: pd.Series) -> pd.Series:
        known = (x.notna() & t.notna() & h.notna()).to_numpy()
        out = np.full(len(x), np.nan)
        out[known] = expected_while_alive(
            theta, x.to_numpy()[known], t.to_numpy()[known], h.to_numpy()[known]
        )
        return pd.Series(out).where(known, None)

    alive = while_alive(
        F.col("frequency").cast("double"),
        F.col("observation_days").cast("double"),
        horizon.cast("double"),
    )
    return alive * probability_alive(theta)


def rate_check(df: DataFrame, theta: BgnbdParams) -> DataFrame:
    """Purchase rates observed over households beside the means the model implies."""
    rates = df.select(
        (F.col("frequency").cast("double") / F.col("observation_days").cast("double")).alias("rate")
    )
    spread = quantile_columns(
        rates,
        {
            "observed_rate_q25": ("rate", 0.25),
            "observed_rate_median": ("rate", 0.5),
            "observed_rate_q75": ("rate", 0.75),
        },
    )
    model = {
        "model_mean_purchase_rate": theta.r / theta.alpha,
        "model_mean_days_between_purchases": theta.alpha / theta.r,
        "model_mean_dropout_probability": theta.a / (theta.a + theta.b),
    }
    return (
        rates.agg(F.avg("rate").alias("observed_rate_mean"))
        .crossJoin(F.broadcast(spread))
        .withColumns({name: F.lit(value) for name, value in model.items()})
    )
