"""Check SQL for description, model, evaluation and profiles."""

from __future__ import annotations

import math

from tillsight.operators.describe import numeric_columns
from tillsight.plans.oracle_base import half_up, scaled
from tillsight.plans.stages import RULE_GRID, RULE_THETA, THETA

SERIES_TERMS = 200

# fixed values, typed here so that the code under test is not compared with itself
QUINTILE_LABELS = ["Q1 - Lowest", "Q2", "Q3", "Q4", "Q5 - Highest"]
_SHARE = ("%", "percentage points")
_MONEY = ("$ per basket", "$ per basket")
CATALOG = [
    ("retail_discount_basket_rate", "Retail discount basket rate", "Primary", *_SHARE),
    ("retail_discount_share_of_pre_discount_value", "Retail discount share of pre-discount value",
     "Primary", *_SHARE),
    ("manufacturer_coupon_basket_rate", "Manufacturer coupon basket rate", "Primary", *_SHARE),
    ("manufacturer_coupon_value_per_basket", "Manufacturer coupon value per basket", "Primary", *_MONEY),
    ("retail_coupon_match_basket_rate", "Retail coupon-match basket rate", "Secondary", *_SHARE),
]
METRICS = [row[0] for row in CATALOG]

r, alpha, a, b = (f"{float(v)!r}::DOUBLE" for v in (THETA.r, THETA.alpha, THETA.a, THETA.b))
P, Q = f"({a} + {b} - 1.0 - {r})", f"({a} - 1.0)"
_X, _TX, _T = "frequency::DOUBLE", "recency_days::DOUBLE", "observation_days::DOUBLE"
_ALIVE = (
    f"CASE WHEN frequency > 0 THEN 1.0 / (1.0 + {a} / ({b} + {_X} - 1.0)"
    f" * pow(({alpha} + {_T}) / ({alpha} + {_TX}), {r} + {_X})) ELSE 1.0 END"
)
ACTUAL = "actual_holdout_baskets"
PRED, BASE = "predicted_holdout_baskets_bgnbd", "predicted_holdout_baskets_baseline"

TABLES: dict[str, str] = {}
TABLES["argument"] = f"""
SELECT household_key, prediction_horizon_days / ({alpha} + {_T} + prediction_horizon_days) AS z,
  {a} + {b} + {_X} - 1.0 AS c FROM mi"""
TABLES["series"] = f"""
SELECT household_key, z, c, 0 AS k, 1.0::DOUBLE AS term, 1.0::DOUBLE AS total FROM argument
UNION ALL
SELECT household_key, z, c, k + 1, term * (({P} + k) * ({Q} + k) / ((c + k) * (k + 1)) * z),
  total + term * (({P} + k) * ({Q} + k) / ((c + k) * (k + 1)) * z)
FROM series WHERE k < {SERIES_TERMS}"""
TABLES["sc"] = f"""
SELECT *, {BASE} - {ACTUAL} AS baseline_error, {PRED} - {ACTUAL} AS bgnbd_error,
  abs({BASE} - {ACTUAL}) AS baseline_absolute_error, abs({PRED} - {ACTUAL}) AS bgnbd_absolute_error
FROM (
  SELECT mi.*, {_X} / {_T} AS historical_repeat_rate_per_day,
    {_X} / {_T} * prediction_horizon_days AS {BASE}, {_ALIVE} AS probability_alive,
    c / ({a} - 1.0) * (1.0 - pow(1.0 - z, {a} - 1.0) * total) * ({_ALIVE}) AS {PRED},
    CASE WHEN estimated_pre_retail_discount_value > 0 THEN total_retail_discount::DOUBLE
      / estimated_pre_retail_discount_value::DOUBLE END AS retail_discount_share_of_pre_discount_value,
    CASE WHEN estimated_pre_retail_discount_value > 0 THEN
      (total_retail_discount + total_retail_coupon_match)::DOUBLE
      / estimated_pre_retail_discount_value::DOUBLE END
      AS retailer_funded_discount_share_of_pre_discount_value,
    total_manufacturer_coupon::DOUBLE / in_sample_baskets AS manufacturer_coupon_value_per_basket
  FROM mi JOIN series USING (household_key) WHERE k = {SERIES_TERMS}
)"""
TABLES["thinned"] = """
SELECT o_custkey AS household_key, date_diff('day', DATE '1995-01-01', o_orderdate::DATE) AS day,
  (o_orderkey * 53 + 11) % 100 < CASE o_custkey // 3 % 4 WHEN 0 THEN 2 WHEN 1 THEN 10 WHEN 2 THEN 25 ELSE 60 END
    AS stops,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE, o_orderkey) AS turn
FROM orders WHERE (o_orderkey * 31 + o_custkey * 17) % 100
  < CASE o_custkey % 3 WHEN 0 THEN 25 WHEN 1 THEN 60 ELSE 100 END"""
TABLES["rule_history"] = """
SELECT household_key, count(DISTINCT day) - 1 AS frequency, max(day) - min(day) AS recency_days,
  2405 - min(day) AS observation_days
FROM thinned LEFT JOIN (SELECT household_key, min(turn) AS final FROM thinned WHERE stops AND turn > 1 GROUP BY ALL)
  USING (household_key)
WHERE final IS NULL OR turn <= final GROUP BY household_key"""


def _likelihoods(points: list[tuple[str, list[float]]]) -> str:
    """Log-likelihood of the rule-made histories at named points."""
    values = ", ".join(
        f"('{name}', " + ", ".join(f"{v!r}::DOUBLE" for v in theta) + ")" for name, theta in points
    )
    return f"""
SELECT point, r, alpha, a, b, sum(
    lgamma(r + {_X}) - lgamma(r) + r * ln(alpha)
    + lgamma(a + b) + lgamma(b + {_X}) - lgamma(b) - lgamma(a + b + {_X}) - (r + {_X}) * ln(alpha + {_T})
    + CASE WHEN frequency > 0 THEN ln(1 + a / (b + {_X} - 1) * pow((alpha + {_T}) / (alpha + {_TX}), r + {_X}))
      ELSE 0 END) AS ll
FROM rule_history CROSS JOIN (VALUES {values}) AS g(point, r, alpha, a, b) GROUP BY ALL"""


def _determinant(rows: list[int], columns: list[int]) -> str:
    """Of a part of the matrix with entries h00 to h33."""
    if not rows:
        return "1"
    return "(" + " ".join(
        f"{'-' if i % 2 else '+'} h{rows[0]}{c} * {_determinant(rows[1:], columns[:i] + columns[i + 1:])}"
        for i, c in enumerate(columns)
    ) + ")"


def _errors() -> str:
    """Standard errors from second differences in log parameters, two widths extrapolated."""
    at, step = (RULE_THETA.r, RULE_THETA.alpha, RULE_THETA.a, RULE_THETA.b), 0.01

    def point(name: str, moves: dict[int, int]) -> tuple[str, list[float]]:
        return name, [v * math.exp(step * moves.get(i, 0)) for i, v in enumerate(at)]

    def value(name: str) -> str:
        return f"any_value(ll) FILTER (WHERE point = '{name}')"

    points, entries = [point("o", {})], []
    for i in range(4):
        points += [point(f"{i}:{k}", {i: k}) for k in (-2, -1, 1, 2)]
        near = " + ".join(value(f"{i}:{k}") for k in (-1, 1))
        wide = " + ".join(value(f"{i}:{k}") for k in (-2, 2))
        entries.append(f"-(16 * ({near}) - ({wide}) - 30 * {value('o')}) / {12 * step**2!r} AS h{i}{i}")
        for j in range(i):
            crossed = []
            for k in (1, 2):
                corners = [(k, k, "+"), (-k, -k, "+"), (k, -k, "-"), (-k, k, "-")]
                points += [point(f"{i}:{m},{j}:{n}", {i: m, j: n}) for m, n, _ in corners]
                total = " ".join(f"{sign} {value(f'{i}:{m},{j}:{n}')}" for m, n, sign in corners)
                crossed.append(f"({total}) / {4 * (k * step)**2!r}")
            entry = f"-(4 * {crossed[0]} - {crossed[1]}) / 3"
            entries += [f"{entry} AS h{i}{j}", f"{entry} AS h{j}{i}"]
    every = [0, 1, 2, 3]
    rows = []
    for i, (name, v) in enumerate(zip(("r", "alpha", "a", "b"), at)):
        others = [k for k in every if k != i]
        error = f"sqrt({_determinant(others, others)} / {_determinant(every, every)}) * {v!r}::DOUBLE"
        rows.append(
            f"SELECT CAST({i + 1} AS INTEGER) AS position, '{name}' AS parameter, {v!r}::DOUBLE AS coefficient, "
            f"round({error}, 3) AS standard_error, round({v!r} - 1.959963984540054::DOUBLE * {error}, 3) AS lower_95, "
            f"round({v!r} + 1.959963984540054::DOUBLE * {error}, 3) AS upper_95 FROM hessian"
        )
    TABLES["hessian"] = f"SELECT {', '.join(entries)} FROM ({_likelihoods(points)})"
    return " UNION ALL ".join(rows)


def _bucket(order: str, buckets: int) -> str:
    """How many of the inner cuts a rank has passed. The cuts are the quantiles of the ranks 1..n in
    the floating-point steps of linear interpolation."""
    rank = f"row_number() OVER (ORDER BY {order})"
    rows = "count(*) OVER ()"
    passed = []
    for k in range(1, buckets):
        at = f"(({k}::DOUBLE * (1.0::DOUBLE / {buckets})) * 100::DOUBLE / 100::DOUBLE * ({rows} - 1))"
        part = f"({at} - floor({at}))"
        cut = f"(floor({at}) + CASE WHEN {part} < 0.5 THEN 1 + {part} ELSE 2 - (1 - {part}) END)"
        passed.append(f"({rank} > {cut})::INTEGER")
    return f"(1 + {' + '.join(passed)})"


_LABELS = "[" + ", ".join(f"'{x}'" for x in QUINTILE_LABELS) + "]"
TABLES["qt"] = f"""
SELECT *, {_LABELS}[coalesce(bucket, 1)] AS historical_sales_quintile
FROM (SELECT *, {_bucket('historical_sales, household_key', 5)} AS bucket FROM sc)"""
TABLES["pf"] = f"""
SELECT *, CASE WHEN {PRED} >= within_median THEN 'Higher predicted baskets'
    ELSE 'Lower predicted baskets' END AS relative_predicted_baskets,
  CASE WHEN v THEN 'Higher historical value' ELSE 'Lower historical value' END
    AS historical_value_level,
  CASE WHEN f THEN 'Higher predicted activity' ELSE 'Lower predicted activity' END
    AS future_activity_level,
  CASE WHEN v THEN 'Higher' ELSE 'Lower' END || ' sales / '
    || CASE WHEN f THEN 'Higher' ELSE 'Lower' END || ' activity' AS customer_profile
FROM (
  SELECT qt.*, within_median, qt.historical_sales::DOUBLE >= sales_cut AS v, {PRED} >= activity_cut AS f
  FROM qt JOIN (SELECT historical_sales_quintile, quantile_cont({PRED}, 0.5) AS within_median
      FROM qt GROUP BY ALL) USING (historical_sales_quintile),
    (SELECT quantile_cont(historical_sales::DOUBLE, 0.5) AS sales_cut,
      quantile_cont({PRED}, 0.5) AS activity_cut FROM qt)
)"""


def _quantile(column: str, prob: float, digits: int) -> str:
    return f"round(quantile_cont({column}::DOUBLE, {prob}), {digits})"


def _describe(table: str, columns, probs=(0.25, 0.5, 0.75), digits: int = 8) -> str:
    rows = []
    for c in columns:
        points = ", ".join(
            f"{_quantile(c, p, digits)} AS p{round(p * 100):02d}" for p in probs
        )
        rows.append(
            f"SELECT '{c}' AS metric, count({c}) AS count, round(avg({c}::DOUBLE), 6) AS mean, "
            f"round(stddev_samp({c}::DOUBLE), 6) AS std, round(min({c}::DOUBLE), {digits}) AS min, "
            f"{points}, round(max({c}::DOUBLE), {digits}) AS max FROM {table}"
        )
    return " UNION ALL ".join(rows)


def _histogram(table: str, bins: dict[str, int], value="{}::DOUBLE", digits: int | None = None) -> str:
    def kept(edge: str) -> str:
        return edge if digits is None else f"round({edge}, {digits})"

    parts = []
    for c, n in bins.items():
        v = value.format(c)
        parts.append(f"""
SELECT '{c}' AS metric, bin::INTEGER AS bin, {kept(f"low + (bin - 1) * ((high - low) / {n})")} AS lower,
  {kept(f"low + bin * ((high - low) / {n})")} AS upper, coalesce(households, 0) AS households
FROM (SELECT unnest(range(1, {n} + 1)) AS bin) CROSS JOIN
  (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS low, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS high
   FROM (SELECT min({v}) AS lo, max({v}) AS hi FROM {table}))
LEFT JOIN (SELECT least(floor(({v} - lo) / (hi - lo) * {n})::INTEGER + 1, {n}) AS bin, count(*) AS households
  FROM {table}, (SELECT min({v}) AS lo, max({v}) AS hi FROM {table}) WHERE {v} IS NOT NULL GROUP BY 1)
  USING (bin)""")
    return " UNION ALL ".join(parts)


def _ranks(table: str, pairs) -> str:
    parts = []
    for x, y in pairs:
        ranked = ", ".join(
            f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS {n}"
            for c, n in ((x, "rx"), (y, "ry"))
        )
        parts.append(
            f"SELECT '{x} ~ {y}' AS pair, count(*) AS n, round(corr(rx, ry), 6) AS correlation "
            f"FROM (SELECT {ranked} FROM {table})"
        )
    return " UNION ALL ".join(parts)


QUERIES: dict[str, str] = {}

# description
QUERIES["coerce_numeric"] = (
    "SELECT * REPLACE ("
    + ", ".join(f"{c}::DOUBLE AS {c}" for c in numeric_columns())
    + ") FROM mi"
)
QUERIES["assert_cohort"] = (
    "SELECT count(*) AS rows, count(DISTINCT household_key) AS unique_households FROM mi"
)
# fixed values: the columns, points and bins that the checks ask for, written out apart from the queries
_MODEL_COLUMNS = "frequency recency_days observation_days actual_holdout_baskets".split()
_HISTORY = (
    "in_sample_baskets active_weeks days_since_last_purchase observation_days historical_sales "
    "average_basket_value"
).split()
_PROMOTION = (
    "retail_discount_basket_rate retail_discount_per_basket manufacturer_coupon_basket_rate "
    "manufacturer_coupon_amount_per_redeeming_basket retail_coupon_match_basket_rate "
    "retail_coupon_match_per_basket"
).split()
_NORMALIZED = (
    "retail_discount_share_of_pre_discount_value retailer_funded_discount_share_of_pre_discount_value "
    "manufacturer_coupon_value_per_basket"
).split()
_SPREAD = [0.25, 0.50, 0.75, 0.90, 0.95, 0.99]
_CENTERED = ["historical_sales", "in_sample_baskets", "days_since_last_purchase"]
_HISTOGRAM = dict.fromkeys(["frequency", *_CENTERED], 50) | dict.fromkeys(
    (
        "retail_discount_basket_rate", "manufacturer_coupon_basket_rate", "retail_coupon_match_basket_rate",
    ),
    40,
)
_RANKED_PAIRS = [
    ("historical_sales", c)
    for c in ("in_sample_baskets", "average_basket_value", "observation_days", "actual_holdout_baskets")
]
_SCORED_PAIRS = [(c, "predicted_holdout_baskets_bgnbd") for c in ("historical_sales", "actual_holdout_baskets")]

QUERIES["model_null_counts"] = "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}"
    for c in ("frequency", "recency_days", "observation_days", "prediction_horizon_days", ACTUAL)
) + " FROM mi"
_BROKEN = {
    "negative_frequency": "frequency < 0",
    "frequency_not_baskets_minus_one": "frequency <> in_sample_baskets - 1",
    "negative_recency": "recency_days < 0", "nonpositive_observation": "observation_days <= 0",
    "recency_above_observation": "recency_days > observation_days",
    "one_time_with_recency": "frequency = 0 AND recency_days <> 0",
    "repeat_without_recency": "frequency > 0 AND recency_days <= 0",
}
QUERIES["assert_relationships"] = "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c}) AS {n}" for n, c in _BROKEN.items()
) + " FROM mi"
_GAP = "(observation_days::DOUBLE - recency_days::DOUBLE)"
QUERIES["recency_allclose"] = f"""
SELECT count(*) FILTER (WHERE abs(days_since_last_purchase::DOUBLE - {_GAP})
  > 0.00001 + 0.0000001 * abs({_GAP})) AS not_close FROM mi"""
QUERIES["describe"] = _describe("mi", _MODEL_COLUMNS, [0.01, 0.25, 0.50, 0.75, 0.99])
QUERIES["describe_history"] = _describe("mi", _HISTORY, _SPREAD)
QUERIES["describe_observation"] = _describe(
    "mi", ["observation_days"], [0.25, 0.50, 0.75, 0.90, 0.99]
)
QUERIES["describe_promotions"] = _describe("mi", _PROMOTION, _SPREAD)
QUERIES["describe_normalized"] = _describe("sc", _NORMALIZED, _SPREAD)
QUERIES["describe_predictions"] = _describe("sc", ["probability_alive", PRED], digits=6)
QUERIES["describe_errors"] = _describe(
    "sc",
    ["baseline_error", "bgnbd_error", "baseline_absolute_error", "bgnbd_absolute_error"],
    digits=6,
)
QUERIES["histogram"] = _histogram("mi", _HISTOGRAM)
QUERIES["histogram_up_to_p99"] = _histogram(
    "(SELECT * FROM mi WHERE frequency <= (SELECT quantile_cont(frequency::DOUBLE, 0.99) FROM mi))",
    {"frequency": 50},
)
QUERIES["log1p_histogram"] = _histogram(
    "mi", {c: 50 for c in _CENTERED}, "ln(1 + {}::DOUBLE)", 6
)
QUERIES["between_median_and_mean"] = f"""
SELECT count(*) FILTER (WHERE s > median AND s < mean) AS households,
  {scaled(half_up("100 * count(*) FILTER (WHERE s > median AND s < mean)", "count(*)", 2), 2, 9)}
    AS percentage
FROM (SELECT historical_sales::DOUBLE AS s FROM mi),
  (SELECT quantile_cont(historical_sales::DOUBLE, 0.5) AS median,
    sum(historical_sales)::DOUBLE / count(historical_sales) AS mean FROM mi)"""
QUERIES["center_lines"] = " UNION ALL ".join(
    f"SELECT '{c}' AS metric, round(avg({c}::DOUBLE), 6) AS mean, {_quantile(c, 0.5, 8)} AS median FROM mi"
    for c in _CENTERED
)
QUERIES["spearman"] = _ranks("mi", _RANKED_PAIRS)
QUERIES["spearman_predicted"] = _ranks("sc", _SCORED_PAIRS)


def _log_pair(table: str, x: str, y: str) -> str:
    return (
        f"SELECT household_key, round(ln(1 + {x}::DOUBLE), 6) AS log1p_{x}, "
        f"round(ln(1 + {y}::DOUBLE), 6) AS log1p_{y} FROM {table}"
    )


QUERIES["log1p_pairs"] = _log_pair("mi", "in_sample_baskets", "historical_sales")
QUERIES["log1p_pairs_predicted"] = _log_pair("sc", "historical_sales", PRED)
QUERIES["promotion_incidence"] = " UNION ALL ".join(
    f"SELECT '{name}' AS promotion, count(*) FILTER (WHERE {c} > 0) AS households, "
    f"round(count(*) FILTER (WHERE {c} > 0)::DOUBLE / count(*), 8) AS share, "
    f"{scaled(half_up(f'100 * count(*) FILTER (WHERE {c} > 0)', 'count(*)', 1), 1, 8)} AS share_pct FROM mi"
    for name, c in (
        ("Retail loyalty-card discount", "retail_discount_basket_rate"),
        ("Manufacturer coupon", "manufacturer_coupon_basket_rate"),
        ("Retail coupon match", "retail_coupon_match_basket_rate"),
    )
)
QUERIES["normalized_promotion"] = (
    "SELECT household_key, " + ", ".join(_NORMALIZED) + " FROM sc"
)
_RS, _FS = _NORMALIZED[:2]
QUERIES["normalized_promotion_checks"] = f"""
SELECT count(*) FILTER (WHERE estimated_pre_retail_discount_value <= 0) AS nonpositive_pre_discount_value,
  count(*) FILTER (WHERE {_RS} IS NULL) AS missing_retail_share,
  count(*) FILTER (WHERE {_FS} IS NULL) AS missing_retailer_funded_share,
  count(*) FILTER (WHERE {_RS} < 0 OR {_RS} > 1) AS retail_share_outside,
  count(*) FILTER (WHERE {_FS} < 0 OR {_FS} > 1) AS retailer_funded_share_outside FROM sc"""
_QS = "historical_sales_quintile"
QUERIES["sales_quintile"] = f"SELECT household_key, {_QS} FROM qt"
QUERIES["sales_quintile_sizes"] = f"SELECT {_QS}, count(*) AS households FROM qt GROUP BY ALL"
QUERIES["quintile_activity"] = f"""
SELECT {_QS}, count(*) AS customers, {_quantile('historical_sales', 0.5, 8)} AS historical_sales_median,
  round(avg({ACTUAL}), 8) AS {ACTUAL}_mean, {_quantile(ACTUAL, 0.5, 8)} AS {ACTUAL}_median,
  {_quantile(ACTUAL, 0.25, 8)} AS {ACTUAL}_q25, {_quantile(ACTUAL, 0.75, 8)} AS {ACTUAL}_q75
FROM qt GROUP BY ALL"""
_POINTS = {"p10": 0.1, "q25": 0.25, "median": 0.5, "q75": 0.75, "p90": 0.9}
QUERIES["quintile_dispersion"] = (
    f"SELECT {_QS}, min({ACTUAL}) AS min, max({ACTUAL}) AS max, "
    + ", ".join(f"{_quantile(ACTUAL, p, 8)} AS {n}" for n, p in _POINTS.items())
    + " FROM qt GROUP BY ALL"
)
QUERIES["box_stats"] = f"""
SELECT {_QS}, round(least(min(y) FILTER (WHERE y >= p10), any_value(q25)), 8) AS whisker_low,
  round(any_value(q25), 8) AS q1, round(any_value(median), 8) AS median, round(any_value(q75), 8) AS q3,
  round(greatest(max(y) FILTER (WHERE y <= p90), any_value(q75)), 8) AS whisker_high
FROM (SELECT {_QS}, {ACTUAL}::DOUBLE AS y FROM qt)
  JOIN (SELECT {_QS}, {", ".join(f"quantile_cont({ACTUAL}::DOUBLE, {p}) AS {n}" for n, p in _POINTS.items())}
    FROM qt GROUP BY ALL) USING ({_QS}) GROUP BY {_QS}"""

# model and evaluation
QUERIES["rate_baseline"] = f"""
SELECT household_key, frequency, observation_days,
  {_X} / {_T} AS historical_repeat_rate_per_day,
  {_X} / {_T} * prediction_horizon_days AS {BASE}, {ACTUAL} FROM mi"""
QUERIES["bgnbd_log_likelihood"] = f"""
SELECT households, round(ll, 3) AS log_likelihood, round(ll / households, 6) AS mean_log_likelihood
FROM (SELECT count(*) AS households, sum(
    lgamma({r} + {_X}) - lgamma({r}) + {r} * ln({alpha})
    + lgamma({a} + {b}) + lgamma({b} + {_X}) - lgamma({b}) - lgamma({a} + {b} + {_X})
    - ({r} + {_X}) * ln({alpha} + {_T})
    + CASE WHEN frequency > 0 THEN ln(1 + {a} / ({b} + {_X} - 1)
        * pow(({alpha} + {_T}) / ({alpha} + {_TX}), {r} + {_X})) ELSE 0 END) AS ll FROM mi)"""
_GRID = [(str(i), [p.r, p.alpha, p.a, p.b]) for i, p in enumerate(RULE_GRID)]
QUERIES["bgnbd_fit_reached"] = f"""
SELECT round(r, 6) AS r, round(alpha, 6) AS alpha, round(a, 6) AS a, round(b, 6) AS b,
  round(ll, 3) AS log_likelihood, true AS reached FROM ({_likelihoods(_GRID)})"""
QUERIES["bgnbd_summary_fixed"] = _errors()
QUERIES["probability_alive"] = f"SELECT household_key, round({_ALIVE}, 6) AS probability_alive FROM mi"
QUERIES["rate_check"] = f"""
SELECT round(avg(rate), 6) AS observed_rate_mean, {_quantile('rate', 0.25, 6)} AS observed_rate_q25,
  {_quantile('rate', 0.5, 6)} AS observed_rate_median, {_quantile('rate', 0.75, 6)} AS observed_rate_q75,
  round({r} / {alpha}, 6) AS model_mean_purchase_rate,
  round({alpha} / {r}, 6) AS model_mean_days_between_purchases,
  round({a} / ({a} + {b}), 6) AS model_mean_dropout_probability
FROM (SELECT {_X} / {_T} AS rate FROM mi)"""
QUERIES["expected_purchases"] = f"SELECT household_key, round({PRED}, 6) AS {PRED} FROM sc"


def _evaluation(factor: int) -> str:
    parts = []
    for name, c in (("Historical-rate baseline", BASE), ("BG/NBD", PRED)):
        parts.append(f"""
SELECT '{name}' AS model, round(avg(abs({c} - {ACTUAL})), 6) AS MAE,
  round(sqrt(avg(({c} - {ACTUAL}) * ({c} - {ACTUAL}))), 6) AS RMSE,
  round(sum(abs({c} - {ACTUAL})) / sum({ACTUAL}) * {factor}, 6) AS WAPE,
  round(avg({c} - {ACTUAL}), 6) AS mean_bias, sum({ACTUAL})::DOUBLE AS actual_baskets_total,
  round(sum({c}), 6) AS predicted_baskets_total,
  round((sum({c}) - sum({ACTUAL})) / sum({ACTUAL}) * {factor}, 6) AS aggregate_pct_error,
  (SELECT correlation FROM ({_ranks('sc', [(ACTUAL, c)])})) AS spearman_correlation FROM sc""")
    return " UNION ALL ".join(parts)


QUERIES["evaluate_predictions"] = _evaluation(1)
QUERIES["model_comparison"] = _evaluation(100)
QUERIES["improvement_pct"] = """
SELECT round((b1 - m1) / b1 * 100, 6) AS mae_improvement_pct,
  round((b2 - m2) / b2 * 100, 6) AS rmse_improvement_pct
FROM (SELECT avg(abs(baseline_error)) AS b1, avg(abs(bgnbd_error)) AS m1,
  sqrt(avg(baseline_error * baseline_error)) AS b2, sqrt(avg(bgnbd_error * bgnbd_error)) AS m2 FROM sc)"""
QUERIES["prediction_errors"] = "SELECT household_key, " + ", ".join(
    f"round({c}, 6) AS {c}"
    for c in ("baseline_error", "bgnbd_error", "baseline_absolute_error", "bgnbd_absolute_error")
) + " FROM sc"
_DECILE = f"CAST({_bucket(f'{PRED}, household_key', 10)} AS INTEGER) AS household_baskets_decile"
QUERIES["activity_decile"] = f"SELECT household_key, {_DECILE} FROM sc"
QUERIES["decile_calibration"] = f"""
SELECT household_baskets_decile, households_count, round(mp, 6) AS mean_predicted_baskets,
  round(ma, 6) AS mean_actual_baskets, total_actual_baskets, round(mp - ma, 6) AS mean_error,
  round((mp - ma) / ma * 100, 6) AS pct_error
FROM (SELECT household_baskets_decile, count(*) AS households_count, avg({PRED}) AS mp,
    avg({ACTUAL}) AS ma, sum({ACTUAL})::BIGINT AS total_actual_baskets
  FROM (SELECT *, {_DECILE} FROM sc) GROUP BY household_baskets_decile)"""
QUERIES["top_share_capture"] = " UNION ALL ".join(
    f"""
SELECT '{name}' AS model, ceil(any_value(n) * 0.2::DOUBLE)::BIGINT AS households_chosen,
  round(sum({ACTUAL}) FILTER (WHERE place <= ceil(n * 0.2::DOUBLE))::DOUBLE / sum({ACTUAL})::DOUBLE, 8)
    AS captured_share
FROM (SELECT {ACTUAL}, row_number() OVER (ORDER BY {c} DESC, household_key) AS place,
  count(*) OVER () AS n FROM sc)"""
    for name, c in (("Historical-rate baseline", BASE), ("BG/NBD", PRED))
)
QUERIES["bootstrap_mae_improvement"] = """
SELECT 'multinomial' AS method, round(quantile_cont(v, 0.025), 6) AS p2_5,
  round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.975), 6) AS p97_5
FROM (
  SELECT replicate, avg(gain) AS v
  FROM (SELECT replicate, floor(('0x' || substr(md5(replicate || '|' || draw // 4 || '|42'),
        1 + 8 * (draw % 4), 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE * n)::BIGINT AS place
      FROM (SELECT count(*) AS n FROM sc),
        (SELECT replicate, unnest(range((SELECT count(*) FROM sc))) AS draw
          FROM (SELECT unnest(range(2000)) AS replicate)))
    JOIN (SELECT row_number() OVER (ORDER BY household_key) - 1 AS place,
      baseline_absolute_error - bgnbd_absolute_error AS gain FROM sc) USING (place)
  GROUP BY replicate)"""
# resampled means lie around the mean gain by its standard error: -1.96, 0 and 1.96 of them, rounded
QUERIES["bootstrap_in_errors"] = """
SELECT 'multinomial' AS method, count(gain) AS households, round(avg(gain), 6) AS mean_gain,
  round(stddev_pop(gain) / sqrt(count(gain)), 6) AS standard_error,
  round(-1.96)::BIGINT AS lower_errors, 0::BIGINT AS median_errors, round(1.96)::BIGINT AS upper_errors
FROM (SELECT baseline_absolute_error - bgnbd_absolute_error AS gain FROM sc)"""


def _mixed(x: str) -> str:
    """32 bits mixed as a chain of single-variable steps."""
    for _ in range(2):
        x = f"list_transform([{x}], lambda x: (xor(x >> 16, x) * 73244475) % 4294967296)[1]"
    return f"list_transform([{x}], lambda x: xor(x >> 16, x))[1]"


QUERIES["bootstrap_poisson"] = f"""
SELECT * FROM (WITH h AS (
  SELECT baseline_absolute_error - bgnbd_absolute_error AS gain,
    {_mixed(_mixed(f"(household_key::BIGINT + {_mixed('42::BIGINT')}) % 4294967296"))} AS start FROM sc
),
r AS (
  SELECT replicate, {_mixed('replicate + 1')} AS step FROM (SELECT unnest(range(2000)) AS replicate)
),
-- 1/e times the sums of 1/k!: from which draw on the weight is 1, 2, ...
b AS (
  SELECT list(least(floor(exp(-1) * e * 4294967296::DOUBLE), 4294967295::DOUBLE)::BIGINT) AS bounds
  FROM (SELECT sum(1 / factorial(k::INTEGER)::DOUBLE) OVER (ORDER BY k) AS e FROM range(13) x(k))
),
w AS (
  SELECT replicate, gain, len(list_filter(bounds, lambda c: draw >= c)) AS w
  FROM (SELECT replicate, gain, {_mixed('(start + step) % 4294967296')} AS draw FROM h, r), b
)
SELECT 'poisson' AS method, round(quantile_cont(v, 0.025), 6) AS p2_5,
  round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.975), 6) AS p97_5
FROM (SELECT replicate, sum(gain * w) / sum(w) AS v FROM w GROUP BY replicate))"""
QUERIES["lowest_alive"] = f"""
SELECT household_key, frequency, recency_days, observation_days, days_since_last_purchase,
  round(probability_alive, 6) AS probability_alive, round({PRED}, 6) AS {PRED}, {ACTUAL}
FROM sc ORDER BY sc.probability_alive, household_key LIMIT 20"""
QUERIES["largest_errors"] = f"""
SELECT household_key, frequency, recency_days, observation_days, round({PRED}, 6) AS {PRED}, {ACTUAL},
  round(bgnbd_error, 6) AS bgnbd_error, round(bgnbd_absolute_error, 6) AS bgnbd_absolute_error
FROM sc ORDER BY sc.bgnbd_absolute_error DESC, household_key LIMIT 20"""

# profiles
QUERIES["within_quintile_split"] = f"""
SELECT household_key, {_QS}, round(within_median, 6) AS median_predicted_baskets_within_sales_quintile,
  relative_predicted_baskets FROM pf"""
QUERIES["quintile_split_counts"] = f"""
SELECT {_QS},
  count(*) FILTER (WHERE relative_predicted_baskets LIKE 'Higher%') AS higher_predicted_baskets,
  count(*) FILTER (WHERE relative_predicted_baskets LIKE 'Lower%') AS lower_predicted_baskets
FROM pf GROUP BY {_QS}"""
QUERIES["within_quintile_summary"] = f"""
SELECT {_QS}, relative_predicted_baskets, count(*) AS households,
  round(sum(historical_sales)::DOUBLE / count(*), 6) AS historical_sales_mean,
  {_quantile('historical_sales', 0.5, 6)} AS historical_sales_median,
  round(avg({PRED}), 6) AS predicted_baskets_mean, {_quantile(PRED, 0.5, 6)} AS predicted_baskets_median,
  round(avg({ACTUAL}), 6) AS {ACTUAL}_mean, {_quantile(ACTUAL, 0.5, 6)} AS {ACTUAL}_median,
  round(avg(was_active_in_holdout::INTEGER), 6) AS share_active_in_holdout
FROM pf GROUP BY ALL"""
_TWO = f"""(SELECT {_QS}, avg({ACTUAL}) FILTER (WHERE relative_predicted_baskets LIKE 'Lower%') AS lo,
  avg({ACTUAL}) FILTER (WHERE relative_predicted_baskets LIKE 'Higher%') AS hi FROM pf GROUP BY {_QS})"""
QUERIES["within_quintile_difference"] = f"""
SELECT {_QS}, round(lo, 2) AS mean_actual_lower_predicted, round(hi, 2) AS mean_actual_higher_predicted,
  round(hi - lo, 2) AS difference FROM {_TWO}"""
QUERIES["within_quintile_uplift"] = f"""
SELECT {_QS}, round(hi, 8) AS higher_mean, round(lo, 8) AS lower_mean,
  round(hi - lo, 8) AS actual_basket_difference, round((hi - lo) / lo * 100, 8) AS actual_basket_uplift_pct
FROM {_TWO}"""
QUERIES["single_quintile_ratio"] = f"""
SELECT {_QS}, round(lo, 8) AS lower_actual_mean, round(hi, 8) AS higher_actual_mean,
  round(hi - lo, 8) AS difference, round(hi / lo, 8) AS ratio,
  (SELECT {_quantile('historical_sales', 0.5, 8)} FROM pf
    WHERE {_QS} = 'Q3' AND relative_predicted_baskets LIKE 'Lower%') AS lower_sales_median,
  (SELECT {_quantile('historical_sales', 0.5, 8)} FROM pf
    WHERE {_QS} = 'Q3' AND relative_predicted_baskets LIKE 'Higher%') AS higher_sales_median
FROM {_TWO} WHERE {_QS} = 'Q3'"""
QUERIES["profile_cutoffs"] = f"""
SELECT {_quantile('historical_sales', 0.5, 6)} AS historical_sales_median,
  {_quantile(PRED, 0.5, 6)} AS predicted_baskets_median FROM sc"""
QUERIES["profile_levels"] = """
SELECT household_key, historical_value_level, future_activity_level,
  historical_value_level || ' / ' || future_activity_level AS profile_label,
  CAST(CASE WHEN v THEN 1 ELSE 3 END + CASE WHEN f THEN 0 ELSE 1 END AS INTEGER) AS profile_order
FROM pf"""
QUERIES["customer_profile"] = "SELECT household_key, customer_profile FROM pf"
QUERIES["assert_profiles"] = """
SELECT count(*) AS households, count(*) FILTER (WHERE customer_profile IS NULL) AS without_profile,
  count(*) FILTER (WHERE customer_profile = 'Unclassified') AS unclassified FROM pf"""
QUERIES["profile_crosstab"] = """
SELECT coalesce(historical_value_level, 'All') AS historical_value_level,
  count(*) FILTER (WHERE f) AS higher_predicted_activity,
  count(*) FILTER (WHERE NOT f) AS lower_predicted_activity, count(*) AS all_levels
FROM pf GROUP BY GROUPING SETS ((historical_value_level), ())"""
_SHARE = scaled(half_up("100 * count(*)", "(SELECT count(*) FROM pf)", 1), 1, 8)
QUERIES["profile_sizes"] = f"""
SELECT customer_profile, count(*) AS households,
  round(count(*)::DOUBLE / (SELECT count(*) FROM pf), 8) AS customer_share, {_SHARE} AS share_pct
FROM pf GROUP BY customer_profile"""
QUERIES["level_sizes"] = """
SELECT historical_value_level AS level, count(*) AS households FROM pf GROUP BY 1
UNION ALL SELECT future_activity_level, count(*) FROM pf GROUP BY 1"""
_RELEVANCE = f"""
  round(count(*)::DOUBLE / (SELECT count(*) FROM pf), 6) AS customer_share,
  round(sum(historical_sales)::DOUBLE / (SELECT sum(historical_sales)::DOUBLE FROM pf), 6)
    AS historical_sales_share,
  round(sum({PRED}) / (SELECT sum({PRED}) FROM pf), 6) AS predicted_future_baskets_share"""
QUERIES["profile_relevance"] = f"""
SELECT customer_profile, count(*) AS households,
  round(sum(historical_sales)::DOUBLE, 6) AS historical_sales_total,
  {_quantile('historical_sales', 0.5, 6)} AS historical_sales_median,
  round(sum({PRED}), 6) AS predicted_future_baskets_total,
  {_quantile(PRED, 0.5, 6)} AS predicted_future_baskets_median, {_RELEVANCE}
FROM pf GROUP BY customer_profile"""
QUERIES["profile_commercial_weight"] = f"""
SELECT customer_profile, count(*) AS households, {_RELEVANCE} FROM pf GROUP BY customer_profile"""
QUERIES["sales_within_groups"] = f"""
SELECT historical_value_level, future_activity_level, count(*) AS households,
  round(sum(historical_sales)::DOUBLE / count(*), 8) AS historical_sales_mean,
  {_quantile('historical_sales', 0.5, 8)} AS historical_sales_median FROM pf GROUP BY ALL"""

_NAMES = ("metric_column", "metric", "priority", "value_unit", "difference_unit")


def _literals(row, names=_NAMES) -> str:
    return ", ".join(f"'{v}' AS {n}" for v, n in zip(row, _NAMES) if n in names)


QUERIES["promotion_metric_catalog"] = " UNION ALL ".join(
    f"SELECT {_literals(row)}, count({row[0]}) AS households_with_value FROM pf" for row in CATALOG
)


def _overview(by: str) -> str:
    means = ", ".join(f"round(avg({m}::DOUBLE), 6) AS {m}" for m in METRICS)
    return f"SELECT {by}, count(*) AS households, {means} FROM pf GROUP BY {by}"


QUERIES["profile_promotion_overview"] = _overview("customer_profile")
QUERIES["level_promotion_overview"] = _overview("historical_value_level, future_activity_level")
QUERIES["promotion_benchmark"] = " UNION ALL ".join(
    f"SELECT {_literals(row, ('metric_column', 'metric'))}, "
    f"round(avg({row[0]}::DOUBLE) * {100 if row[3] == '%' else 1}, 3) AS customer_base_mean, "
    f"'{row[3]}' AS unit FROM pf"
    for row in CATALOG
)


def _compared(row) -> str:
    m, k = f"{row[0]}::DOUBLE", "100.0::DOUBLE" if row[3] == "%" else "1.0::DOUBLE"
    high, low = "FILTER (WHERE f)", "FILTER (WHERE NOT f)"
    return f"""
SELECT historical_value_level, {_literals(row)},
  count(*) {high} AS higher_activity_households, count(*) {low} AS lower_activity_households,
  count({row[0]}) {high} AS higher_activity_metric_n, count({row[0]}) {low} AS lower_activity_metric_n,
  round(avg({m}) {high} * {k}, 6) AS higher_activity_mean,
  round(avg({m}) {low} * {k}, 6) AS lower_activity_mean,
  round(avg({m}) {high} * {k} - avg({m}) {low} * {k}, 6) AS difference_high_minus_low,
  round((quantile_cont({m}, 0.5) {high}) * {k}, 6) AS higher_activity_median,
  round((quantile_cont({m}, 0.5) {low}) * {k}, 6) AS lower_activity_median
FROM pf GROUP BY historical_value_level"""


_COMPARISON = " UNION ALL ".join(_compared(row) for row in CATALOG)
_MEANS = "higher_activity_mean, lower_activity_mean, difference_high_minus_low"
_UNITS = "value_unit, difference_unit"
QUERIES["within_level_promotion_comparison"] = _COMPARISON
for _priority in ("Primary", "Secondary"):
    QUERIES[f"comparison_{_priority.lower()}"] = f"""
SELECT historical_value_level, metric, higher_activity_households, lower_activity_households,
  {_MEANS}, {_UNITS} FROM ({_COMPARISON}) WHERE priority = '{_priority}'"""
for _level in ("Higher", "Lower"):
    QUERIES[f"comparison_{_level.lower()}_value"] = f"""
SELECT metric, priority, {_MEANS}, {_UNITS} FROM ({_COMPARISON})
WHERE historical_value_level = '{_level} historical value'"""
QUERIES["comparison_coupon_distribution"] = f"""
SELECT historical_value_level, metric, higher_activity_mean, higher_activity_median,
  lower_activity_mean, lower_activity_median, difference_high_minus_low, value_unit
FROM ({_COMPARISON})
WHERE metric_column IN ('manufacturer_coupon_basket_rate', 'manufacturer_coupon_value_per_basket')"""
