"""Check SQL for sources, audit, baskets, features and holdout."""

from __future__ import annotations

from tillsight.plans.oracle_base import average, cents, half_up, scaled

TX = (
    "household_key, basket_id, day, product_id, quantity, sales_value, store_id, retail_disc, "
    "trans_time, week_no, coupon_disc, coupon_match_disc"
)
LISTED = (
    "household_key, basket_id, day, product_id, quantity, sales_value, retail_disc, coupon_disc, "
    "coupon_match_disc, store_id"
)
MONEY = "DECIMAL(38,2)"


def _schema_row(i, name, kind, precision, scale):
    return (
        f"SELECT CAST({i} AS INTEGER) AS ordinal_position, '{name}' AS column_name, '{kind}' AS data_type, "
        f"CAST({precision} AS INTEGER) AS numeric_precision, CAST({scale} AS INTEGER) AS numeric_scale, "
        f"true AS as_declared, count({name}) AS non_null_rows FROM tx"
    )


_KINDS = {
    "household_key": "int", "basket_id": "bigint", "day": "smallint", "product_id": "int",
    "quantity": "int", "sales_value": "decimal(12,2)", "store_id": "int",
    "retail_disc": "decimal(12,2)", "trans_time": "smallint", "week_no": "smallint",
    "coupon_disc": "decimal(12,2)", "coupon_match_disc": "decimal(12,2)",
}
_PARAMETERS = (
    "parameter_id", "in_sample_end_week", "holdout_start_week", "holdout_end_week",
    "in_sample_end_day", "holdout_start_day", "holdout_end_day", "holdout_weeks",
)
_PRECISION = {"smallint": (16, 0), "int": (32, 0), "bigint": (64, 0), "decimal(12,2)": (12, 2)}


def _q(prob: float, column: str) -> str:
    return f"round(quantile_cont(({column})::DOUBLE, {prob}), 8)"


def _pct(n: str) -> str:
    return scaled(half_up(f"100 * ({n})", "count(*)", 2), 2, 9)


def _difference(pairs: list[tuple[str, str, str]]) -> str:
    return ", ".join(f"{a}, {b}, {b} - {a} AS {d}" for a, b, d in pairs)


def _where(conditions: dict[str, str]) -> str:
    return ", ".join(f"count(*) FILTER (WHERE {c}) AS {name}" for name, c in conditions.items())


QUERIES: dict[str, str] = {}

# sources, checks
QUERIES["load_transactions"] = f"SELECT {TX} FROM tx"
QUERIES["load_transactions_csv"] = QUERIES["load_transactions"]
QUERIES["imported_row_count"] = "SELECT count(*) AS imported_rows FROM tx"
QUERIES["preview_rows"] = f"SELECT {TX} FROM tx ORDER BY {TX} LIMIT 20"
QUERIES["check_schema"] = " UNION ALL ".join(
    _schema_row(i, name, kind, *_PRECISION[kind])
    for i, (name, kind) in enumerate(_KINDS.items(), start=1)
)
QUERIES["write_table"] = "SELECT * FROM fb"
QUERIES["register_view"] = "SELECT count(*) AS rows, sum(frequency)::BIGINT AS repeat_baskets FROM mi"
QUERIES["read_model_input"] = "SELECT * FROM mi"
QUERIES["check_primary_key"] = """
SELECT household_key, basket_id, count(*) AS rows FROM tx GROUP BY household_key, basket_id
HAVING count(*) > 1 OR household_key IS NULL OR basket_id IS NULL"""
QUERIES["check_primary_key_fact_basket"] = """
SELECT household_key, basket_id, count(*) AS rows FROM fb GROUP BY household_key, basket_id
HAVING count(*) > 1 OR household_key IS NULL OR basket_id IS NULL"""
QUERIES["check_foreign_key"] = """
SELECT household_key, actual_holdout_baskets FROM activity
WHERE household_key IS NOT NULL AND household_key NOT IN (SELECT household_key FROM cf)"""
QUERIES["check_not_null"] = "SELECT " + _where(
    {f"null_{c}": f"{c} IS NULL" for c in _KINDS}
) + " FROM tx"
QUERIES["check_predicate"] = f"SELECT {TX} FROM tx WHERE NOT (retail_disc <= 0)"
QUERIES["check_not_null_parameters"] = "SELECT " + _where(
    {f"null_{c}": f"{c} IS NULL" for c in _PARAMETERS}
) + " FROM p"
QUERIES["check_predicate_parameters"] = "SELECT * FROM p WHERE NOT (parameter_id = 1)"
QUERIES["upsert_parameters"] = "SELECT * FROM p"
QUERIES["project_parameters"] = "SELECT * FROM p"

# audit
QUERIES["dataset_overview"] = """
SELECT count(*) AS transaction_rows, count(DISTINCT household_key) AS households,
  count(DISTINCT basket_id) AS baskets, count(DISTINCT product_id) AS products,
  count(DISTINCT store_id) AS stores, min(day) AS first_day, max(day) AS last_day,
  min(week_no) AS first_week, max(week_no) AS last_week FROM tx"""
QUERIES["null_counts"] = QUERIES["check_not_null"]
QUERIES["weekly_coverage"] = """
SELECT week_no, min(day) AS minimum_day, max(day) AS maximum_day,
  count(DISTINCT day) AS observed_days, count(*) AS product_lines,
  count(DISTINCT basket_id) AS baskets, count(DISTINCT household_key) AS households
FROM tx GROUP BY week_no"""
QUERIES["day_week_violations"] = """
SELECT day, count(DISTINCT week_no) AS week_count FROM tx GROUP BY day
HAVING count(DISTINCT week_no) > 1"""
QUERIES["boundary_weeks"] = """
SELECT week_no, min(day) AS minimum_day, max(day) AS maximum_day,
  count(DISTINCT day) AS observed_days FROM tx WHERE week_no BETWEEN 76 AND 81 GROUP BY week_no"""
_ATTR = {
    "household_key": "household", "day": "day", "week_no": "week", "store_id": "store",
    "trans_time": "trans_time",
}
QUERIES["basket_attribute_consistency"] = (
    "SELECT count(*) AS baskets_checked, "
    + _where({f"multi_{n}_baskets": f"n_{c} > 1" for c, n in _ATTR.items()})
    + " FROM (SELECT basket_id, "
    + ", ".join(f"count(DISTINCT {c}) AS n_{c}" for c in _ATTR)
    + " FROM tx GROUP BY basket_id)"
)
QUERIES["baskets_with_repeated_product"] = """
SELECT count(*) AS baskets_with_repeated_product FROM (
  SELECT basket_id FROM tx GROUP BY basket_id HAVING count(*) > count(DISTINCT product_id))"""
QUERIES["basket_size_distribution"] = f"""
SELECT min(n) AS min_product_lines, round(sum(n)::DOUBLE / count(*)::DOUBLE, 8) AS avg_product_lines,
  {_q(0.5, "n")} AS median_product_lines, {_q(0.9, "n")} AS p90_product_lines,
  {_q(0.99, "n")} AS p99_product_lines, max(n) AS max_product_lines
FROM (SELECT count(*) AS n FROM tx GROUP BY basket_id)"""
QUERIES["exact_duplicates"] = f"""
SELECT count(*) AS duplicated_patterns, coalesce(sum(n - 1), 0)::BIGINT AS extra_rows
FROM (SELECT {TX}, count(*) AS n FROM tx GROUP BY ALL HAVING count(*) > 1)"""
QUERIES["quantity_profile"] = "SELECT " + _where({
    "negative_quantity_rows": "quantity < 0", "zero_quantity_rows": "quantity = 0",
    "positive_quantity": "quantity > 0", "quantity_over_100": "quantity > 100",
    "negative_sales_rows": "sales_value < 0", "zero_sales_rows": "sales_value = 0",
}) + f""", min(quantity) AS minimum_quantity,
  {scaled(half_up("sum(quantity)", "count(quantity)", 2), 2, 14)} AS average_quantity,
  {_q(0.5, "quantity")} AS median_quantity, {_q(0.99, "quantity")} AS p99_quantity,
  max(quantity) AS maximum_quantity FROM tx"""
QUERIES["sales_profile"] = "SELECT " + _where({
    "negative_sales": "sales_value < 0", "zero_sales": "sales_value = 0",
    "positive_sales": "sales_value > 0",
}) + f""", min(sales_value) AS min_sales,
  {average(f"sum({cents('sales_value')})", "count(sales_value)", 2, 14)} AS average_sales,
  {_q(0.01, "sales_value")} AS p01_sales, {_q(0.5, "sales_value")} AS median_sales,
  {_q(0.99, "sales_value")} AS p99_sales, max(sales_value) AS max_sales FROM tx"""
QUERIES["zero_quantity_summary"] = """
SELECT count(*) AS zero_quantity_rows, count(DISTINCT basket_id) AS affected_baskets,
  count(DISTINCT household_key) AS affected_households,
  count(DISTINCT product_id) AS affected_products,
  count(*) FILTER (WHERE sales_value < 0) AS negative_sales,
  count(*) FILTER (WHERE sales_value = 0) AS zero_sales,
  count(*) FILTER (WHERE sales_value > 0) AS positive_sales,
  min(sales_value) AS min_sales, max(sales_value) AS max_sales FROM tx WHERE quantity = 0"""
QUERIES["zero_quantity_discount_mix"] = "SELECT count(*) AS zero_quantity_rows, " + _where({
    "retail_discount_rows": "retail_disc <> 0", "coupon_discount_rows": "coupon_disc <> 0",
    "coupon_match_rows": "coupon_match_disc <> 0",
    "no_discount_rows": "retail_disc = 0 AND coupon_disc = 0 AND coupon_match_disc = 0",
}) + " FROM tx WHERE quantity = 0"
QUERIES["zero_quantity_positive_sales"] = (
    f"SELECT {LISTED} FROM tx WHERE quantity = 0 AND sales_value > 0"
)
_EMPTY = "SELECT basket_id FROM tx GROUP BY basket_id HAVING max(quantity) = 0"
QUERIES["zero_quantity_only_baskets"] = (
    f"SELECT count(*) AS zero_quantity_only_baskets FROM ({_EMPTY})"
)
QUERIES["zero_quantity_only_profile"] = f"""
SELECT count(DISTINCT basket_id) AS baskets, count(DISTINCT household_key) AS households,
  count(*) AS zero_quantity_rows, count(*) FILTER (WHERE sales_value = 0) AS zero_sales_rows,
  count(*) FILTER (WHERE sales_value > 0) AS positive_sales_rows,
  count(DISTINCT basket_id) FILTER (WHERE sales_value > 0) AS baskets_with_positive_sales,
  CAST(sum(sales_value) AS {MONEY}) AS total_sales
FROM tx JOIN ({_EMPTY}) USING (basket_id)"""
QUERIES["discount_incidence"] = "SELECT " + _where({
    "retail_disc_rows": "retail_disc <> 0", "manufacturer_coupon_disc_rows": "coupon_disc <> 0",
    "retail_coupon_match_disc_rows": "coupon_match_disc <> 0",
}) + " FROM tx"
QUERIES["discount_sign_audit"] = " UNION ALL ".join(
    f"SELECT '{c}' AS discount_type, "
    + _where({"negative_rows": f"{c} < 0", "zero_rows": f"{c} = 0", "positive_rows": f"{c} > 0"})
    + f", min({c}) AS minimum_value, max({c}) AS maximum_value FROM tx"
    for c in ("retail_disc", "coupon_disc", "coupon_match_disc")
)
QUERIES["positive_retail_discounts"] = f"SELECT {LISTED} FROM tx WHERE retail_disc > 0"
_POSITIVE = "basket_id IN (SELECT basket_id FROM tx WHERE retail_disc > 0)"
QUERIES["baskets_with_positive_retail"] = f"SELECT {TX} FROM tx WHERE {_POSITIVE}"
QUERIES["positive_retail_basket_summary"] = f"""
SELECT basket_id, count(*) AS total_rows,
  count(*) FILTER (WHERE quantity > 0) AS positive_quantity_rows,
  count(*) FILTER (WHERE quantity = 0) AS zero_quantity_rows,
  sum(quantity)::BIGINT AS total_quantity, CAST(sum(sales_value) AS {MONEY}) AS basket_sales
FROM tx WHERE {_POSITIVE} GROUP BY basket_id"""
QUERIES["discount_relationships"] = "SELECT " + _where({
    "product_lines_with_any_discount":
        "retail_disc <> 0 OR coupon_disc <> 0 OR coupon_match_disc <> 0",
    "match_without_manufacturer_coupon": "coupon_match_disc <> 0 AND coupon_disc = 0",
    "match_greater_than_manufacturer_coupon": "abs(coupon_match_disc) > abs(coupon_disc)",
}) + " FROM tx"
QUERIES["coupon_match_exceptions"] = (
    f"SELECT {TX} FROM tx WHERE abs(coupon_match_disc) > abs(coupon_disc)"
)
QUERIES["trans_time_range"] = """
SELECT min(trans_time) AS min_trans_time, max(trans_time) AS max_trans_time,
  count(*) FILTER (WHERE trans_time IS NULL) AS null_trans_times,
  count(DISTINCT trans_time) AS distinct_trans_times FROM tx"""
QUERIES["invalid_hhmm"] = "SELECT " + _where({
    "invalid_hhmm_values": "trans_time < 0 OR trans_time > 2359 OR trans_time % 100 > 59"
}) + " FROM tx"
QUERIES["multi_time_baskets"] = """
SELECT count(*) AS baskets_with_multiple_trans_times FROM (
  SELECT basket_id FROM tx GROUP BY basket_id HAVING count(DISTINCT trans_time) > 1)"""
QUERIES["baskets_without_time"] = """
SELECT count(*) AS baskets_without_trans_time FROM (
  SELECT basket_id FROM tx GROUP BY basket_id HAVING count(trans_time) = 0)"""
QUERIES["extreme_lines"] = f"""
SELECT {TX} FROM tx
WHERE quantity <= 0 OR sales_value <= 0 OR quantity > 100 OR sales_value > 1000
ORDER BY abs(sales_value) DESC NULLS FIRST, abs(quantity) DESC NULLS FIRST, {TX} LIMIT 100"""
_RATES = {
    "zero_quantity": "quantity = 0", "quantity_over_100": "quantity > 100",
    "zero_sales": "sales_value = 0", "sales_over_1000": "sales_value > 1000",
}
QUERIES["unusual_value_rates"] = "SELECT count(*) AS total_rows, " + ", ".join(
    f"count(*) FILTER (WHERE {c}) AS {n}_rows, {_pct(f'count(*) FILTER (WHERE {c})')} AS {n}_pct"
    for n, c in _RATES.items()
) + " FROM tx"

# parameters and baskets
QUERIES["parameter_validation"] = """
SELECT *, (holdout_start_week - in_sample_end_week - 1)::INTEGER AS unobserved_gap_weeks,
  (holdout_start_day - in_sample_end_day - 1)::INTEGER AS unobserved_gap_days,
  (holdout_end_week - holdout_start_week + 1)::INTEGER AS calculated_holdout_weeks,
  (holdout_end_day - holdout_start_day + 1)::INTEGER AS observed_holdout_days,
  (holdout_end_day - in_sample_end_day)::INTEGER AS prediction_horizon_days
FROM p WHERE parameter_id = 1"""
QUERIES["fact_basket"] = "SELECT * FROM fb"
QUERIES["reconcile_basket_count"] = "SELECT " + _difference(
    [("raw_distinct_baskets", "fact_basket_rows", "difference")]
) + """ FROM (SELECT count(DISTINCT basket_id) AS raw_distinct_baskets FROM tx),
  (SELECT count(*) AS fact_basket_rows FROM fb)"""
QUERIES["reconcile_line_count"] = "SELECT " + _difference(
    [("raw_transaction_lines", "fact_transaction_lines", "difference")]
) + """ FROM (SELECT count(*) AS raw_transaction_lines FROM tx),
  (SELECT sum(basket_product_lines_count)::BIGINT AS fact_transaction_lines FROM fb)"""
_MEASURES = {
    "quantity": ("quantity", "basket_total_quantity", 1, "BIGINT"),
    "sales": ("sales_value", "basket_sales_value", 1, MONEY),
    "retail_discount": ("retail_disc", "retail_discount_amount", -1, MONEY),
    "manufacturer_coupon": ("coupon_disc", "manufacturer_coupon_amount", -1, MONEY),
    "retail_coupon_match": ("coupon_match_disc", "retail_coupon_match_amount", -1, MONEY),
}
QUERIES["reconcile_measures"] = (
    "SELECT "
    + ", ".join(
        f"raw_{m}, fact_{m}, (fact_{m} - raw_{m})::{t} AS {m}_difference"
        for m, (_, _, _, t) in _MEASURES.items()
    )
    + " FROM (SELECT "
    + ", ".join(
        f"CAST({sign} * sum({raw}) AS {t}) AS raw_{m}" for m, (raw, _, sign, t) in _MEASURES.items()
    )
    + " FROM tx), (SELECT "
    + ", ".join(f"CAST(sum({f}) AS {t}) AS fact_{m}" for m, (_, f, _, t) in _MEASURES.items())
    + " FROM fb)"
)
QUERIES["negative_discount_baskets"] = "SELECT " + _where({
    "negative_retail_discount_amounts": "retail_discount_amount < 0",
    "negative_manufacturer_coupon_amounts": "manufacturer_coupon_amount < 0",
    "negative_retail_coupon_match_amounts": "retail_coupon_match_amount < 0",
}) + " FROM fb"
QUERIES["valid_basket_summary"] = f"""
SELECT is_valid_purchase_basket, count(*) AS baskets,
  CAST(sum(basket_sales_value) AS {MONEY}) AS recorded_sales,
  sum(basket_total_quantity)::BIGINT AS recorded_quantity
FROM fb GROUP BY is_valid_purchase_basket"""
QUERIES["invalid_basket_listing"] = """
SELECT household_key, basket_id, basket_day, basket_week, basket_trans_time,
  basket_product_lines_count, basket_unique_product_count, basket_total_quantity,
  basket_sales_value, manufacturer_coupon_amount, retail_discount_amount
FROM fb WHERE NOT is_valid_purchase_basket
ORDER BY basket_sales_value DESC, basket_id, household_key LIMIT 100"""
QUERIES["period_activity"] = """
SELECT CASE WHEN basket_day <= in_sample_end_day THEN 'In-sample'
    WHEN basket_day BETWEEN holdout_start_day AND holdout_end_day THEN 'Holdout'
    ELSE 'Outside analysis' END AS period,
  count(*) AS purchase_baskets, count(DISTINCT household_key) AS active_households,
  CAST(sum(basket_sales_value) AS DECIMAL(18,2)) AS recorded_sales
FROM fb, p WHERE is_valid_purchase_basket GROUP BY period"""
QUERIES["customer_overlap"] = f"""
SELECT count(*) AS total_households_observed, count(a) AS in_sample_households,
  count(b) AS holdout_households, count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL)
    AS households_in_both_periods,
  count(*) FILTER (WHERE b IS NULL) AS in_sample_only_households,
  count(*) FILTER (WHERE a IS NULL) AS holdout_only_households,
  {scaled(half_up("100 * count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL)", "count(a)", 1), 1, 8)}
    AS pct_in_sample_active_in_holdout
FROM (SELECT DISTINCT household_key AS a FROM past)
  FULL OUTER JOIN (SELECT DISTINCT household_key AS b FROM future) ON a = b"""
_FULL = "(sales_value - retail_disc - coupon_match_disc)"
QUERIES["estimated_customer_payment"] = f"""
SELECT household_key, basket_id, product_id, quantity, sales_value,
  CAST(sales_value + coupon_disc AS DECIMAL(14,2)) AS estimated_customer_payment,
  CAST({_FULL} AS DECIMAL(14,2)) AS pre_retail_discount_value,
  {average(cents(_FULL), "quantity", 4, 18)} AS pre_discount_value_per_unit,
  {average(cents("sales_value"), "quantity", 4, 18)} AS discounted_value_per_unit
FROM tx"""

# household features
QUERIES["same_day_baskets"] = """
SELECT count(*) AS household_days_with_multiple_baskets,
  count(DISTINCT household_key) AS households_with_same_day_multiple_baskets,
  max(n) AS max_baskets_same_day
FROM (SELECT household_key, basket_day, count(*) AS n FROM past GROUP BY ALL) WHERE n > 1"""
_TIED = """(SELECT household_key, basket_day, basket_trans_time, count(*) AS n
  FROM past GROUP BY ALL HAVING count(*) > 1)"""
QUERIES["same_minute_baskets"] = f"""
SELECT count(*) AS duplicate_timestamp_groups, count(DISTINCT household_key) AS households_affected,
  sum(n)::BIGINT AS baskets_in_duplicate_timestamp_groups,
  sum(n - 1)::BIGINT AS additional_baskets_due_to_timestamp_ties,
  max(n) AS max_baskets_at_same_timestamp FROM {_TIED}"""
QUERIES["same_minute_listing"] = f"""
SELECT household_key, basket_day, basket_trans_time, basket_id, store_id, basket_sales_value,
  basket_total_quantity
FROM fb JOIN {_TIED} USING (household_key, basket_day, basket_trans_time)
ORDER BY household_key, basket_day, basket_trans_time, basket_id LIMIT 100"""
QUERIES["purchase_time_days"] = f"""
SELECT household_key, basket_id, basket_day, basket_trans_time,
  {scaled("((minute * 1000000 + 720) // 1440)", 6, 14)} AS purchase_time_days FROM past"""
QUERIES["bgnbd_features"] = """
SELECT household_key, in_sample_baskets, first_purchase_time_days, last_purchase_time_days,
  frequency, recency_days, observation_days, days_since_last_purchase FROM cf"""
QUERIES["customer_profile_features"] = """
SELECT household_key, active_weeks, historical_sales, average_basket_value, historical_quantity,
  retail_discount_basket_rate, retail_discount_per_basket, total_retail_discount,
  manufacturer_coupon_basket_rate, total_manufacturer_coupon,
  manufacturer_coupon_amount_per_redeeming_basket, retail_coupon_match_basket_rate,
  retail_coupon_match_per_basket, total_retail_coupon_match, estimated_pre_retail_discount_value
FROM cf"""
QUERIES["customer_features"] = "SELECT * FROM cf"
QUERIES["reconcile_features"] = f"""
SELECT *, customer_rows - fact_households AS household_difference,
  customer_baskets - fact_baskets AS basket_difference,
  CAST(customer_sales - fact_sales AS {MONEY}) AS sales_difference,
  customer_quantity - fact_quantity AS quantity_difference
FROM (SELECT count(DISTINCT household_key) AS fact_households, count(*) AS fact_baskets,
    CAST(sum(basket_sales_value) AS {MONEY}) AS fact_sales,
    sum(basket_total_quantity)::BIGINT AS fact_quantity FROM past),
  (SELECT count(*) AS customer_rows, sum(in_sample_baskets)::BIGINT AS customer_baskets,
    CAST(sum(historical_sales) AS {MONEY}) AS customer_sales,
    sum(historical_quantity)::BIGINT AS customer_quantity FROM cf)"""
QUERIES["bgnbd_relationship_checks"] = (
    "SELECT count(*) AS customers, count(DISTINCT household_key) AS unique_households, "
    + _where({
        "no_in_sample_baskets": "in_sample_baskets < 1",
        "invalid_frequency": "frequency <> in_sample_baskets - 1",
        "negative_frequency": "frequency < 0", "negative_recency": "recency_days < 0",
        "nonpositive_observation_time": "observation_days <= 0",
        "recency_greater_than_observation": "recency_days > observation_days",
        "invalid_one_time_customers": "frequency = 0 AND recency_days <> 0",
        "invalid_repeat_customers": "frequency > 0 AND recency_days <= 0",
        "bgnbd_eligible_customers": "is_bgnbd_eligible",
    }) + " FROM cf"
)
QUERIES["one_time_purchasers"] = """
SELECT count(*) AS one_time_purchasers, min(recency_days) AS minimum_recency_days,
  max(recency_days) AS maximum_recency_days, min(observation_days) AS minimum_observation_days,
  max(observation_days) AS maximum_observation_days FROM cf WHERE frequency = 0"""


def _five(column: str, full: bool) -> str:
    parts = [f"min({column}) AS min_{column}"]
    if full:
        parts.append(f"{_q(0.25, column)} AS q1_{column}")
    parts.append(f"{_q(0.5, column)} AS median_{column}")
    if full:
        parts.append(f"{_q(0.75, column)} AS q3_{column}")
    return ", ".join(parts + [f"max({column}) AS max_{column}"])


QUERIES["feature_distribution_short"] = (
    f"SELECT {_five('frequency', True)}, {_five('recency_days', False)}, "
    f"{_five('observation_days', False)} FROM cf"
)
QUERIES["feature_distribution"] = (
    f"SELECT {_five('frequency', True)}, {_five('recency_days', True)}, "
    f"{_five('observation_days', True)} FROM cf"
)
QUERIES["recency_identity"] = "SELECT " + _where({
    "invalid_recency_identity":
        "abs(days_since_last_purchase - (observation_days - recency_days)) > 0.000001"
}) + " FROM cf"
QUERIES["required_null_checks"] = "SELECT " + _where({
    "null_frequency": "frequency IS NULL", "null_recency": "recency_days IS NULL",
    "null_observation_time": "observation_days IS NULL",
}) + " FROM cf"
QUERIES["rate_bounds"] = "SELECT " + _where({
    f"invalid_{k}_rates": f"{k}_basket_rate NOT BETWEEN 0 AND 1"
    for k in ("retail_discount", "manufacturer_coupon", "retail_coupon_match")
}) + " FROM cf"
_RATE, _MEAN = "manufacturer_coupon_basket_rate", "manufacturer_coupon_amount_per_redeeming_basket"
QUERIES["coupon_average_consistency"] = "SELECT " + _where({
    "nonusers_with_coupon_average": f"{_RATE} = 0 AND {_MEAN} IS NOT NULL",
    "users_without_coupon_average": f"{_RATE} > 0 AND {_MEAN} IS NULL",
}) + " FROM cf"
QUERIES["negative_totals"] = "SELECT " + _where({
    "customers_with_negative_retail_discount": "total_retail_discount < 0",
    "customers_with_negative_manufacturer_coupon": "total_manufacturer_coupon < 0",
    "customers_with_negative_retail_coupon_match": "total_retail_coupon_match < 0",
    "customers_with_negative_pre_discount_value": "estimated_pre_retail_discount_value < 0",
}) + " FROM cf"
QUERIES["top_by_baskets"] = """
SELECT household_key, in_sample_baskets, frequency, recency_days, observation_days,
  days_since_last_purchase, active_weeks, historical_sales, average_basket_value
FROM cf ORDER BY in_sample_baskets DESC, household_key LIMIT 20"""
QUERIES["top_by_sales"] = """
SELECT household_key, in_sample_baskets, historical_sales, average_basket_value,
  historical_quantity, retail_discount_basket_rate, manufacturer_coupon_basket_rate,
  retail_coupon_match_basket_rate
FROM cf ORDER BY historical_sales DESC, household_key LIMIT 20"""

# holdout and model input
QUERIES["holdout_activity"] = "SELECT * FROM activity"
QUERIES["customer_holdout"] = "SELECT * FROM ch"
_B, _D, _W, _S = (
    "actual_holdout_baskets", "actual_holdout_purchase_days", "actual_holdout_active_weeks",
    "actual_holdout_sales",
)
QUERIES["holdout_structure_checks"] = (
    "SELECT count(*) AS rows, count(DISTINCT household_key) AS unique_households, "
    + _where({
        "null_household_keys": "household_key IS NULL", "negative_basket_counts": f"{_B} < 0",
        "negative_purchase_day_counts": f"{_D} < 0", "negative_active_week_counts": f"{_W} < 0",
        "negative_sales_values": f"{_S} < 0", "purchase_days_greater_than_baskets": f"{_D} > {_B}",
        "active_weeks_greater_than_purchase_days": f"{_W} > {_D}",
        "inconsistent_active_flags": f"was_active_in_holdout <> ({_B} > 0)",
        "inconsistent_zero_purchase_rows":
            f"{_B} = 0 AND ({_D} <> 0 OR {_W} <> 0 OR {_S} <> 0)",
    }) + " FROM ch"
)
QUERIES["holdout_cohort"] = "SELECT count(*) AS holdout_rows, " + _where({
    "purchasing_households": f"{_B} > 0", "zero_purchase_households": f"{_B} = 0",
}) + " FROM ch"
QUERIES["reconcile_holdout"] = f"""
SELECT *, customer_holdout_baskets - fact_basket_holdout_baskets AS basket_difference,
  CAST(customer_holdout_sales - fact_basket_holdout_sales AS {MONEY}) AS sales_difference
FROM (SELECT count(*) AS fact_basket_holdout_baskets,
    CAST(sum(basket_sales_value) AS {MONEY}) AS fact_basket_holdout_sales
    FROM future WHERE household_key IN (SELECT household_key FROM cf)),
  (SELECT sum({_B})::BIGINT AS customer_holdout_baskets,
    CAST(sum({_S}) AS {MONEY}) AS customer_holdout_sales FROM ch)"""
QUERIES["holdout_only_households"] = """
SELECT count(DISTINCT household_key) AS holdout_only_households FROM future
WHERE household_key NOT IN (SELECT household_key FROM cf)"""
QUERIES["bgnbd_model_input"] = "SELECT * FROM mi"
QUERIES["model_input_checks"] = (
    "SELECT count(*) AS model_rows, count(DISTINCT household_key) AS unique_households, "
    + _where({
        "null_frequency": "frequency IS NULL", "null_recency": "recency_days IS NULL",
        "null_observation_time": "observation_days IS NULL",
        "null_prediction_horizon": "prediction_horizon_days IS NULL",
        "null_holdout_baskets": f"{_B} IS NULL", "negative_holdout_baskets": f"{_B} < 0",
    }) + " FROM mi"
)
QUERIES["horizon_uniqueness"] = """
SELECT count(DISTINCT prediction_horizon_days) AS distinct_horizons,
  min(prediction_horizon_days) AS min_horizon_days,
  max(prediction_horizon_days) AS max_horizon_days FROM mi"""
QUERIES["model_input_sample"] = """
SELECT household_key, frequency, recency_days, observation_days, prediction_horizon_days,
  actual_holdout_baskets, in_sample_baskets, historical_sales, retail_discount_basket_rate,
  manufacturer_coupon_basket_rate, retail_coupon_match_basket_rate
FROM mi ORDER BY household_key LIMIT 20"""
