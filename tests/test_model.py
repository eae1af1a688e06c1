"""The purchase-count model against direct evaluation, and the fit on data with known parameters."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillsight.functions.gamma import digamma, log_gamma_rise, trigamma
from tillsight.operators import bgnbd, evaluate
from tillsight.operators.bgnbd import BgnbdParams

THETA = BgnbdParams(0.8, 6.0, 0.7, 3.0)


def histories(n, theta, seed=7, longest=400.0):
    """Households that buy at a gamma-distributed rate and may drop out after any purchase."""
    rng = np.random.default_rng(seed)
    rows = []
    for key in range(n):
        t = rng.uniform(longest / 2, longest)
        rate, drop = rng.gamma(theta.r, 1 / theta.alpha), rng.beta(theta.a, theta.b)
        x, last, now = 0, 0.0, 0.0
        while True:
            now += rng.exponential(1 / rate)
            if now > t:
                break
            x, last = x + 1, now
            if rng.random() < drop:
                break
        rows.append((key, x, last, t))
    return pd.DataFrame(rows, columns=["household_key", "frequency", "recency_days", "observation_days"])


@pytest.fixture(scope="module")
def data(spark):
    pdf = histories(6000, THETA)
    return pdf, spark.createDataFrame(pdf).withColumn("prediction_horizon_days", F.lit(167))


def direct_log_likelihood(theta, x, tx, t):
    r, alpha, a, b = theta.r, theta.alpha, theta.a, theta.b
    g = math.lgamma
    first = -(r + x) * math.log(alpha + t)
    both = math.exp(first)
    if x > 0:
        both += a / (b + x - 1) * (alpha + tx) ** -(r + x)
    return (
        g(r + x) - g(r) + r * math.log(alpha) + g(a + b) + g(b + x) - g(b) - g(a + b + x) + math.log(both)
    )


def test_gamma_functions():
    for z in (1e-6, 0.3, 1.0, 7.5, 60.0, 1e4):
        for d in (0.0, 0.2, 3.0, 900.0):
            expected = math.lgamma(z + d) - math.lgamma(z)
            assert log_gamma_rise(z, d) == pytest.approx(expected, rel=1e-11, abs=1e-11)
    # large arguments, where the difference of two log-gammas cancels
    assert log_gamma_rise(1e8, 1.0) == pytest.approx(math.log(1e8), rel=1e-14)
    assert digamma(1.0) == pytest.approx(-0.5772156649015329, rel=1e-13)
    for z in (0.01, 0.5, 3.0, 200.0):
        assert digamma(z + 1) - digamma(z) == pytest.approx(1 / z, rel=1e-10)
        assert trigamma(z) - trigamma(z + 1) == pytest.approx(1 / z**2, rel=1e-9)
    assert trigamma(1.0) == pytest.approx(math.pi**2 / 6, rel=1e-13)


def test_log_likelihood(data):
    pdf, df = data
    row = bgnbd.log_likelihood(df, THETA).collect()[0]
    few = pdf[pdf.frequency < 60]
    rest = bgnbd.log_likelihood(df.filter("frequency < 60"), THETA).collect()[0]
    expected = sum(
        direct_log_likelihood(THETA, x, tx, t)
        for x, tx, t in zip(few.frequency, few.recency_days, few.observation_days)
    )
    assert rest["log_likelihood"] == pytest.approx(expected, rel=1e-11)
    assert row["households"] == len(pdf)


def test_derivatives(data):
    _, df = data
    history = bgnbd._history(df)
    theta, step = np.array([0.9, 5.0, 0.6, 2.5]), 1e-5
    points = [theta]
    for i in range(4):
        for sign in (1, -1):
            moved = theta.copy()
            moved[i] += sign * step
            points.append(moved)
    values, slopes, bends = bgnbd._evaluate(history, points)
    for i in range(4):
        numeric = (values[1 + 2 * i] - values[2 + 2 * i]) / (2 * step)
        assert slopes[0][i] == pytest.approx(numeric, rel=1e-4, abs=1e-2)
        numeric = (slopes[1 + 2 * i] - slopes[2 + 2 * i]) / (2 * step)
        np.testing.assert_allclose(bends[0][i], numeric, rtol=1e-5, atol=1e-3)
    np.testing.assert_array_equal(bends[0], bends[0].T)


def test_fit_takes_one_aggregation_an_iteration(spark, data, monkeypatch):
    """Equal histories travel as one with a count, and an iteration is one call."""
    _, df = data
    calls, made = [], bgnbd._evaluate
    monkeypatch.setattr(bgnbd, "_evaluate", lambda history, points: calls.append(len(points)) or made(history, points))
    small = df.where("household_key < 300")
    once = bgnbd.fit(small)
    assert once.converged and len(calls) <= once.iterations + 1 and set(calls[1:]) == {8}
    often = bgnbd.fit(small.union(small).union(small))
    assert often.households == 900 and bgnbd._history(small.union(small)).count() == bgnbd._history(small).count()
    assert often.log_likelihood == pytest.approx(3 * once.log_likelihood, rel=1e-9)


def test_fit_recovers_parameters(data):
    _, df = data
    fit = bgnbd.fit(df)
    assert fit.converged and not fit.at_bound and fit.households == 6000
    assert fit.log_likelihood >= bgnbd.log_likelihood(df, THETA).collect()[0]["log_likelihood"]
    errors = bgnbd.standard_errors(df, fit.params)
    got = np.array([fit.params.r, fit.params.alpha, fit.params.a, fit.params.b])
    true = np.array([THETA.r, THETA.alpha, THETA.a, THETA.b])
    assert (np.abs(got - true) < 4 * errors).all()
    table = {r["parameter"]: r for r in bgnbd.summary(df, fit.params).collect()}
    assert table["r"]["lower_95"] < table["r"]["coefficient"] < table["r"]["upper_95"]
    shrunk = bgnbd.fit(df, penalizer=0.05)
    assert shrunk.params.b < fit.params.b
    assert shrunk.log_likelihood < fit.log_likelihood


def test_fit_is_compared_with_other_parameters(data):
    _, df = data
    fit = bgnbd.fit(df)
    worse = bgnbd.BgnbdFit(THETA, fit.log_likelihood - 50, 6000, 1, True, False)
    assert [r.reached for r in bgnbd.reached(df, fit, [THETA, fit.params]).collect()] == [True, True]
    assert [r.reached for r in bgnbd.reached(df, worse, [THETA]).collect()] == [False]


def test_fit_of_no_households(data):
    with pytest.raises(ValueError):
        bgnbd.fit(data[1].limit(0))


def test_probability_alive(data):
    pdf, df = data
    got = df.select("household_key", bgnbd.probability_alive(THETA).alias("p")).toPandas()
    assert got["p"].between(0, 1).all()
    merged = pdf.merge(got, on="household_key")
    assert (merged[merged.frequency == 0]["p"] == 1).all()
    row = merged[merged.frequency > 0].iloc[0]
    odds = THETA.a / (THETA.b + row.frequency - 1) * (
        (THETA.alpha + row.observation_days) / (THETA.alpha + row.recency_days)
    ) ** (THETA.r + row.frequency)
    assert row["p"] == pytest.approx(1 / (1 + odds), rel=1e-12)


def exact_bracket(theta, x, t, horizon):
    """The published form, with the series summed in exact fractions."""
    r, alpha, a, b = (Fraction(v) for v in (theta.r, theta.alpha, theta.a, theta.b))
    z = Fraction(horizon) / (alpha + Fraction(t) + Fraction(horizon))
    p, q, c = r + x, b + x, a + b + x - 1
    term, total = 1.0, 1.0
    scale = 0.0  # log of a common factor taken out, so that the sum stays in range
    log_terms = []
    log_term = 0.0
    for k in range(60_000):
        log_terms.append(log_term)
        log_term += math.log((p + k) * (q + k) * z / ((c + k) * (k + 1)))
        if k > 10 * x + 200 and log_term < max(log_terms) - 50:
            break
    top = max(log_terms)
    log_sum = top + math.log(math.fsum(math.exp(v - top) for v in log_terms))
    power = float(r + x) * math.log(float((alpha + Fraction(t)) / (alpha + Fraction(t) + Fraction(horizon))))
    return float(c / (a - 1)) * (1 - math.exp(power + log_sum))


@pytest.mark.parametrize("theta", [THETA, BgnbdParams(1.2, 60.0, 0.6, 8.0), BgnbdParams(2.5, 15.0, 1.7, 40.0)])
@pytest.mark.parametrize("x, t", [(0, 30.0), (1, 500.0), (57, 475.0), (436, 30.0), (1096, 540.0)])
def test_expected_purchases(theta, x, t):
    got = bgnbd.expected_while_alive(theta, np.array([float(x)]), np.array([t]), np.array([167.0]))[0]
    assert got == pytest.approx(exact_bracket(theta, x, t, 167), rel=1e-7)


def test_expected_purchases_near_a_equal_one():
    x, t, h = np.array([5.0]), np.array([300.0]), np.array([167.0])
    at = bgnbd.expected_while_alive(BgnbdParams(1.0, 8.0, 1.0, 4.0), x, t, h)[0]
    near = bgnbd.expected_while_alive(BgnbdParams(1.0, 8.0, 1.001, 4.0), x, t, h)[0]
    assert at == pytest.approx(near, rel=1e-2) and at > 0


def test_scores_and_evaluation(spark, data):
    pdf, df = data
    rng = np.random.default_rng(0)
    actual = pd.DataFrame({"household_key": pdf.household_key, "actual_holdout_baskets": rng.poisson(3, len(pdf))})
    scored = evaluate.score(df.join(spark.createDataFrame(actual), "household_key"), THETA)
    local = scored.toPandas()
    base, model, y = (
        local["predicted_holdout_baskets_baseline"], local["predicted_holdout_baskets_bgnbd"],
        local["actual_holdout_baskets"],
    )
    assert (model >= 0).all()
    got = {r["model"]: r for r in evaluate.evaluate_predictions(scored).collect()}["BG/NBD"]
    assert got["MAE"] == pytest.approx((model - y).abs().mean())
    assert got["RMSE"] == pytest.approx(math.sqrt(((model - y) ** 2).mean()))
    assert got["WAPE"] == pytest.approx((model - y).abs().sum() / y.sum())
    assert got["spearman_correlation"] == pytest.approx(model.rank().corr(y.rank()), abs=1e-9)
    share = evaluate.top_share_capture(scored, "predicted_holdout_baskets_bgnbd").collect()[0]
    chosen = local.sort_values("household_key").nlargest(
        math.ceil(len(local) * 0.2), "predicted_holdout_baskets_bgnbd"
    )
    assert share["captured_share"] == pytest.approx(chosen["actual_holdout_baskets"].sum() / y.sum())
    gain = (base - y).abs() - (model - y).abs()
    exact = evaluate.bootstrap_mae_improvement(scored, replicates=200).collect()[0]
    weighted = evaluate.bootstrap_mae_improvement(scored, replicates=200, method="poisson").collect()[0]
    assert (exact["method"], weighted["method"]) == ("multinomial", "poisson")
    error = gain.std() / math.sqrt(len(gain))
    for row in (exact, weighted):
        assert row["p50"] == pytest.approx(gain.mean(), abs=0.5 * error)
        assert row["p97_5"] - row["p2_5"] == pytest.approx(2 * 1.96 * error, rel=0.25)


def test_draws_split_over_blocks_add_up(monkeypatch):
    """Every block finds its draws alone; together each replicate has as many as there are rows, spread
    as a multinomial."""
    monkeypatch.setattr(evaluate, "BLOCK_ROWS", 10)
    rows, replicates = 137, 4000
    counts = np.array([evaluate.block_draws(b, rows, replicates, 5) for b in range(14)])
    assert (counts.sum(0) == rows).all() and (counts >= 0).all()
    sizes = np.array([10] * 13 + [7])
    np.testing.assert_allclose(counts.mean(1), sizes, atol=0.25)
    np.testing.assert_allclose(counts.var(1), sizes * (1 - sizes / rows), rtol=0.12)
    together = np.cov(counts)[0, 1:13]
    np.testing.assert_allclose(together.mean(), -100 / rows, atol=0.2)


def test_sums_of_a_block_are_those_of_its_draws(monkeypatch):
    monkeypatch.setattr(evaluate, "DRAWN_REPLICATES", 7)
    draws = evaluate.block_draws(0, 40, 50, 3)
    ones = evaluate.block_sums(0, np.ones(40), 40, 50, 3)
    np.testing.assert_array_equal(ones, draws)
    gains = np.arange(40.0) ** 2
    sums = np.array([evaluate.block_sums(0, gains, 40, 50, s) for s in range(80)]).ravel()
    assert sums.mean() / 40 == pytest.approx(gains.mean(), rel=0.02)
    assert sums.std() == pytest.approx(gains.std() * math.sqrt(40), rel=0.05)


def test_counter_draws_are_uniform_and_unrelated():
    keys = np.array([1, 2, 3, -1, 2**33 + 1, 2**33 + 2] + list(range(1000, 1200)))
    draws = evaluate.counter_draws(keys, 3000, 42).astype(float) / 2**32
    assert len(np.unique(draws)) > 0.999 * draws.size
    np.testing.assert_allclose(draws.mean(1), 0.5, atol=0.03)
    related = np.corrcoef(draws) - np.eye(len(keys))
    assert np.abs(related).max() < 0.1 and abs(related.mean()) < 0.002
    assert not (evaluate.counter_draws(keys, 10, 43) == evaluate.counter_draws(keys, 10, 42)).any()
    bounds = np.array(evaluate.poisson_bounds(), float) / 2**32
    weights = np.searchsorted(bounds, draws, side="right")
    assert weights.mean() == pytest.approx(1, abs=0.01) and weights.var() == pytest.approx(1, abs=0.02)


def test_hashed_bootstrap_makes_every_draw(spark, monkeypatch):
    """All draws of all replicates, over several blocks, as a loop over the hashes makes them; a household
    without a gain is drawn and does not count, repeated and NULL keys have their places."""
    monkeypatch.setattr(evaluate, "BLOCK_ROWS", 16)
    keys = [*range(150), 149, None]
    pdf = [(k, float(i % 7), float(i % 5), None if i == 3 else i % 11) for i, k in enumerate(keys)]
    scored = spark.createDataFrame(pdf, (
        "household_key int, predicted_holdout_baskets_baseline double, "
        "predicted_holdout_baskets_bgnbd double, actual_holdout_baskets int"
    ))
    gains = sorted(
        ((k is None, k or 0, math.nan if y is None else abs(b - y) - abs(m - y)) for k, b, m, y in pdf),
    )
    gains = np.array([gain for _, _, gain in gains])
    got = {r["replicate"]: r["value"] for r in evaluate.hashed_means(scored.repartition(5), 21, 42).collect()}
    assert sorted(got) == list(range(21))
    for replicate, value in got.items():
        drawn = []
        for i in range(len(gains)):
            digits = hashlib.md5(f"{replicate}|{i // 4}|42".encode()).hexdigest()[8 * (i % 4) :][:8]
            drawn.append(gains[math.floor(int(digits, 16) / 2**32 * len(gains))])
        assert value == pytest.approx(np.nanmean(drawn), rel=1e-12)
    again = evaluate.bootstrap_mae_improvement(scored, replicates=21, hashed=True).collect()[0]
    assert again["p50"] == pytest.approx(np.median(list(got.values())), rel=1e-9)


@pytest.mark.parametrize("method", ["multinomial", "poisson"])
def test_bootstrap_does_not_depend_on_partitions(spark, data, method, monkeypatch):
    monkeypatch.setattr(evaluate, "BLOCK_ROWS", 64)
    pdf, df = data
    scored = evaluate.score(df, THETA).withColumn("actual_holdout_baskets", F.col("frequency") % 7)
    got = [
        evaluate.bootstrap_mae_improvement(frame, replicates=50, method=method).collect()[0].asDict()
        for frame in (scored.repartition(2), scored.repartition(9).orderBy(F.rand(1)))
    ]
    for name, value in got[0].items():
        assert got[1][name] == (value if isinstance(value, str) else pytest.approx(value, rel=1e-9))
    plan = evaluate.bootstrap_means(scored, 50, 42, method)._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "SortMergeJoin" not in plan and "NestedLoop" not in plan
