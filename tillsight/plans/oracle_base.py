"""Named table expressions for the check SQL, and the composer that adds those a query needs."""

from __future__ import annotations

import re


def half_up(numerator: str, denominator: str, shift: int) -> str:
    """numerator / denominator in units of 10^-shift, rounded half away from zero, as HUGEINT."""
    n, d = f"({numerator})::HUGEINT", f"NULLIF(({denominator})::HUGEINT, 0)"
    return (
        f"((CASE WHEN {n} < 0 THEN -1 ELSE 1 END)"
        f" * ((2 * abs({n}) * {10**shift} + {d}) // (2 * {d})))"
    )


def scaled(units: str, scale: int, precision: int) -> str:
    unit = "0." + "0" * (scale - 1) + "1"
    return (
        f"CAST(CAST({units} AS DECIMAL(18,0)) * CAST({unit} AS DECIMAL({scale + 1},{scale}))"
        f" AS DECIMAL({precision},{scale}))"
    )


def average(cents: str, count: str, scale: int, precision: int) -> str:
    return scaled(half_up(cents, count, scale - 2), scale, precision)


def ratio(part: str, whole: str, scale: int, precision: int) -> str:
    return scaled(half_up(part, whole, scale), scale, precision)


def cents(amount: str) -> str:
    return f"CAST({amount} * 100 AS BIGINT)"


TABLES: dict[str, str] = {}

TABLES["tx"] = f"""
SELECT CAST(o_custkey AS INTEGER) AS household_key, o_orderkey AS basket_id,
  CAST(day AS SMALLINT) AS day, CAST(l_partkey AS INTEGER) AS product_id,
  CAST(quantity AS INTEGER) AS quantity,
  {scaled("CASE WHEN quantity = 0 AND k % 358 <> 0 THEN 0 ELSE price - disc END", 2, 12)} AS sales_value,
  CAST(o_orderkey % 25 AS INTEGER) AS store_id,
  {scaled("CASE WHEN k % 997 = 0 THEN disc ELSE -disc END", 2, 12)} AS retail_disc,
  CAST((o_orderkey * 37 % 24) * 100 + o_orderkey * 53 % 60 AS SMALLINT) AS trans_time,
  CAST((day + 1) // 7 + 1 AS SMALLINT) AS week_no,
  {scaled("CASE WHEN k % 17 = 0 THEN -50 * (1 + k % 4) ELSE 0 END", 2, 12)} AS coupon_disc,
  {scaled("CASE WHEN k % 2023 = 0 THEN -300 WHEN k % 34 = 0 THEN -25 * (1 + k % 4) ELSE 0 END", 2, 12)}
    AS coupon_match_disc
FROM (
  SELECT *, (price * pct + 50) // 100 AS disc,
    CASE WHEN o_orderkey % 97 = 0 OR k % 179 = 0 THEN 0 ELSE ordered END AS quantity
  FROM (
    SELECT o_custkey, o_orderkey, l_partkey,
      l_orderkey * 7 + l_linenumber * 13 + l_partkey * 3 AS k,
      CAST(l_quantity AS INTEGER) AS ordered,
      CAST(round(l_extendedprice * 100) AS BIGINT) AS price,
      CAST(round(l_discount * 100) AS BIGINT) AS pct,
      date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) * 711 // 2405 + 1 AS day
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  )
)"""

TABLES["p"] = """
SELECT CAST(1 AS SMALLINT) AS parameter_id,
  CAST(78 AS SMALLINT) AS in_sample_end_week, CAST(79 AS SMALLINT) AS holdout_start_week,
  CAST(102 AS SMALLINT) AS holdout_end_week,
  max(day) FILTER (WHERE week_no = 78) AS in_sample_end_day,
  min(day) FILTER (WHERE week_no = 79) AS holdout_start_day,
  max(day) FILTER (WHERE week_no = 102) AS holdout_end_day,
  CAST(24 AS SMALLINT) AS holdout_weeks
FROM tx"""

TABLES["fb"] = """
SELECT household_key, basket_id,
  min(day) AS basket_day, min(week_no) AS basket_week, min(store_id) AS store_id,
  min(trans_time) AS basket_trans_time,
  CAST(count(*) AS INTEGER) AS basket_product_lines_count,
  CAST(count(DISTINCT product_id) AS INTEGER) AS basket_unique_product_count,
  CAST(sum(quantity) AS BIGINT) AS basket_total_quantity,
  CAST(sum(sales_value) AS DECIMAL(14,2)) AS basket_sales_value,
  CAST(-sum(retail_disc) AS DECIMAL(14,2)) AS retail_discount_amount,
  CAST(-sum(coupon_disc) AS DECIMAL(14,2)) AS manufacturer_coupon_amount,
  CAST(-sum(coupon_match_disc) AS DECIMAL(14,2)) AS retail_coupon_match_amount,
  CAST(sum(sales_value) - sum(retail_disc) - sum(coupon_match_disc) AS DECIMAL(14,2))
    AS estimated_pre_retail_discount_value,
  bool_or(retail_disc < 0) AS has_retail_discount,
  bool_or(coupon_disc < 0) AS has_manufacturer_coupon,
  bool_or(coupon_match_disc < 0) AS has_retail_coupon_match,
  bool_or(quantity > 0) AS is_valid_purchase_basket
FROM tx GROUP BY household_key, basket_id"""

TABLES["past"] = """
SELECT fb.*, in_sample_end_day,
  ((basket_day - 1)::BIGINT * 1440 + (basket_trans_time // 100) * 60 + basket_trans_time % 100) AS minute
FROM fb, p WHERE basket_day <= in_sample_end_day AND is_valid_purchase_basket"""

TABLES["future"] = """
SELECT fb.* FROM fb, p
WHERE basket_day BETWEEN holdout_start_day AND holdout_end_day AND is_valid_purchase_basket"""

_TIME = "((minute * 1000000 + 720) // 1440)"
_SALES = f"sum({cents('basket_sales_value')})"

TABLES["cf"] = f"""
SELECT household_key, CAST(n AS INTEGER) AS in_sample_baskets,
  {scaled("t0", 6, 14)} AS first_purchase_time_days, {scaled("t1", 6, 14)} AS last_purchase_time_days,
  CAST(n - 1 AS INTEGER) AS frequency, {scaled("t1 - t0", 6, 14)} AS recency_days,
  {scaled("te - t0", 6, 14)} AS observation_days,
  {scaled("te - t1", 6, 14)} AS days_since_last_purchase,
  CAST(weeks AS INTEGER) AS active_weeks,
  {scaled("sales", 2, 16)} AS historical_sales, {average("sales", "n", 2, 14)} AS average_basket_value,
  CAST(units AS BIGINT) AS historical_quantity,
  {ratio("ru", "n", 6, 12)} AS retail_discount_basket_rate,
  {average("retail", "n", 4, 14)} AS retail_discount_per_basket,
  {scaled("retail", 2, 16)} AS total_retail_discount,
  {ratio("cu", "n", 6, 12)} AS manufacturer_coupon_basket_rate,
  {scaled("coupon", 2, 16)} AS total_manufacturer_coupon,
  {average("coupon", "cu", 4, 14)} AS manufacturer_coupon_amount_per_redeeming_basket,
  {ratio("mu", "n", 6, 12)} AS retail_coupon_match_basket_rate,
  {average("matched", "n", 4, 14)} AS retail_coupon_match_per_basket,
  {scaled("matched", 2, 16)} AS total_retail_coupon_match,
  {scaled("pre", 2, 16)} AS estimated_pre_retail_discount_value,
  (t1 >= t0 AND te > t0 AND t1 <= te AND ((n = 1 AND t1 = t0) OR (n > 1 AND t1 > t0)))
    AS is_bgnbd_eligible
FROM (
  SELECT household_key, count(*) AS n, min({_TIME}) AS t0, max({_TIME}) AS t1,
    max(in_sample_end_day)::BIGINT * 1000000 AS te, count(DISTINCT basket_week) AS weeks,
    {_SALES} AS sales, sum(basket_total_quantity) AS units,
    sum(has_retail_discount::INTEGER) AS ru, sum({cents('retail_discount_amount')}) AS retail,
    sum(has_manufacturer_coupon::INTEGER) AS cu, sum({cents('manufacturer_coupon_amount')}) AS coupon,
    sum(has_retail_coupon_match::INTEGER) AS mu,
    sum({cents('retail_coupon_match_amount')}) AS matched,
    sum({cents('estimated_pre_retail_discount_value')}) AS pre
  FROM past GROUP BY household_key
)"""

TABLES["activity"] = """
SELECT household_key, CAST(count(*) AS INTEGER) AS actual_holdout_baskets,
  CAST(count(DISTINCT basket_day) AS INTEGER) AS actual_holdout_purchase_days,
  CAST(count(DISTINCT basket_week) AS INTEGER) AS actual_holdout_active_weeks,
  CAST(sum(basket_sales_value) AS DECIMAL(16,2)) AS actual_holdout_sales
FROM future GROUP BY household_key"""

TABLES["ch"] = """
SELECT household_key, coalesce(actual_holdout_baskets, 0) AS actual_holdout_baskets,
  coalesce(actual_holdout_purchase_days, 0) AS actual_holdout_purchase_days,
  coalesce(actual_holdout_active_weeks, 0) AS actual_holdout_active_weeks,
  CAST(coalesce(actual_holdout_sales, 0) AS DECIMAL(16,2)) AS actual_holdout_sales,
  coalesce(actual_holdout_baskets, 0) > 0 AS was_active_in_holdout
FROM (SELECT household_key FROM cf) LEFT JOIN activity USING (household_key)"""

TABLES["mi"] = """
SELECT household_key, frequency, recency_days, observation_days,
  CAST(holdout_end_day - in_sample_end_day AS INTEGER) AS prediction_horizon_days,
  actual_holdout_baskets, actual_holdout_purchase_days, actual_holdout_active_weeks,
  actual_holdout_sales, was_active_in_holdout, in_sample_baskets, active_weeks,
  days_since_last_purchase, historical_sales, average_basket_value, historical_quantity,
  retail_discount_basket_rate, retail_discount_per_basket, total_retail_discount,
  manufacturer_coupon_basket_rate, total_manufacturer_coupon,
  manufacturer_coupon_amount_per_redeeming_basket, retail_coupon_match_basket_rate,
  retail_coupon_match_per_basket, total_retail_coupon_match, estimated_pre_retail_discount_value
FROM cf JOIN ch USING (household_key), p WHERE is_bgnbd_eligible"""


def compose(query: str, tables: dict[str, str] = TABLES) -> str:
    """The query under a WITH clause of the table expressions it mentions, in dependency order."""
    needed: list[str] = []
    seen: set[str] = set()

    def add(text: str) -> None:
        words = set(re.findall(r"\b[a-z_][a-z0-9_]*\b", text))
        for name, body in tables.items():
            if name in words and name not in seen:
                seen.add(name)
                add(body)
                needed.append(name)

    add(query)
    if not needed:
        return query.strip()
    # a table expression that names itself is recursive, and cannot be marked as materialized
    own = {name for name in needed if re.search(rf"\bFROM {name}\b", tables[name])}
    parts = [
        f"{name} AS {'' if name in own else 'MATERIALIZED '}({tables[name].strip()})"
        for name in needed
    ]
    return f"WITH {'RECURSIVE ' if own else ''}" + ",\n".join(parts) + "\n" + query.strip()
