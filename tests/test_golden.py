"""Worked examples with known answers."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.lines import lines, one, week_of
from tillsight.operators import audit, baskets, checks, describe, evaluate, features, holdout, profiles
from tillsight.schema import (
    CUSTOMER_FEATURES,
    CUSTOMER_HOLDOUT,
    FACT_BASKET,
    PROJECT_PARAMETERS,
    TRANSACTIONS,
    Params,
)
from tillsight.sources.storage import preview_rows, upsert, write_table
from tillsight.sources.transactions import load_transactions

PARAMS = Params(78, 79, 102, 544, 545, 711, 24)


def fact(spark, *rows):
    return baskets.fact_basket(lines(spark, *rows))


def test_grouping(spark):
    rows = [dict(household_key=2375, basket_id=1, product_id=p) for p in (1, 2, 3)]
    rows += [dict(household_key=2375, basket_id=2, product_id=p) for p in (4, 5)]
    counts = [r[0] for r in fact(spark, *rows).orderBy("basket_id").select("basket_product_lines_count").collect()]
    assert counts == [3, 2]


def test_declared_schemas(spark):
    fb = fact(spark, dict())
    cf = features.customer_features(fb, PARAMS)
    ch = holdout.customer_holdout(cf, holdout.holdout_activity(fb, PARAMS))
    for df, declared in ((fb, FACT_BASKET), (cf, CUSTOMER_FEATURES), (ch, CUSTOMER_HOLDOUT)):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in declared]


def test_money(spark):
    row = one(fact(spark, dict(sales_value="8.00", retail_disc="-2.00", coupon_match_disc="-1.00")))
    assert row["estimated_pre_retail_discount_value"] == Decimal("11.00")
    assert row["retail_discount_amount"] == Decimal("2.00")
    paid = one(
        baskets.estimated_customer_payment(
            lines(spark, dict(quantity=2, sales_value="2.89", coupon_disc="-0.55", coupon_match_disc="-0.45"))
        )
    )
    assert paid["pre_retail_discount_value"] == Decimal("3.34")
    assert paid["estimated_customer_payment"] == Decimal("2.34")
    loyal = one(
        baskets.estimated_customer_payment(
            lines(spark, dict(quantity=2, sales_value="2.00", retail_disc="-1.34"))
        )
    )
    assert loyal["pre_discount_value_per_unit"] == Decimal("1.6700")
    assert loyal["discounted_value_per_unit"] == Decimal("1.0000")
    plain = one(baskets.estimated_customer_payment(lines(spark, dict(sales_value="1.67"))))
    assert plain["estimated_customer_payment"] == Decimal("1.67")
    nothing = one(baskets.estimated_customer_payment(lines(spark, dict(quantity=0))))
    assert nothing["discounted_value_per_unit"] is None


def test_positive_retail_discount_reduces_amount_but_sets_no_flag(spark):
    row = one(fact(spark, dict(retail_disc="0.50")))
    assert row["retail_discount_amount"] == Decimal("-0.50")
    assert row["has_retail_discount"] is False


def test_all_null_discount_gives_null_flag(spark):
    row = one(fact(spark, dict(retail_disc=None), dict(retail_disc=None, product_id=2)))
    assert row["has_retail_discount"] is None
    assert row["retail_discount_amount"] is None


@pytest.mark.parametrize(
    "day, time, expected",
    [(1, 0, "0.000000"), (1, 1200, "0.500000"), (2, 0, "1.000000"), (545, 0, "544.000000"),
     (1, 1430, "0.604167")],
)
def test_purchase_time(spark, day, time, expected):
    params = Params(78, 79, 102, 600, 601, 711, 24)
    row = one(
        features.purchase_time_days(
            fact(spark, dict(day=day, trans_time=time, week_no=week_of(day))), params
        )
    )
    assert row["purchase_time_days"] == Decimal(expected)


def test_same_minute_ties(spark):
    rows = [dict(household_key=101, basket_id=b, day=20, trans_time=1435) for b in (1, 2)]
    rows += [dict(household_key=102, basket_id=b, day=21, trans_time=910) for b in (3, 4, 5)]
    fb = fact(spark, *rows)
    assert list(one(features.same_minute_baskets(fb, PARAMS)).values()) == [2, 2, 5, 3, 3]
    assert features.same_minute_listing(fb, PARAMS).count() == 5
    assert one(features.same_day_baskets(fb, PARAMS))["max_baskets_same_day"] == 3


def test_duplicates(spark):
    row = one(audit.exact_duplicates(lines(spark, {}, {}, {}, dict(product_id=2))))
    assert row == {"duplicated_patterns": 1, "extra_rows": 2}


def test_eligibility(spark):
    same_minute = [dict(household_key=2, basket_id=b, day=5, trans_time=100) for b in (2, 3)]
    apart = [dict(household_key=3, basket_id=b, day=b, trans_time=100) for b in (4, 5)]
    cf = features.customer_features(fact(spark, dict(trans_time=30), *same_minute, *apart), PARAMS)
    got = {r["household_key"]: r.asDict() for r in cf.collect()}
    assert got[1]["frequency"] == 0 and got[1]["recency_days"] == 0
    assert got[1]["is_bgnbd_eligible"] is True
    assert got[2]["is_bgnbd_eligible"] is False
    assert got[3]["is_bgnbd_eligible"] is True
    assert got[1]["manufacturer_coupon_amount_per_redeeming_basket"] is None


def test_averages_round_once(spark):
    rows = [dict(basket_id=b, sales_value=v) for b, v in enumerate(["0.01", "0.00", "0.01", "0.00"])]
    cf = one(features.customer_features(fact(spark, *rows), PARAMS))
    assert cf["average_basket_value"] == Decimal("0.01")  # 0.005, half up
    rows = [dict(basket_id=b, sales_value=v) for b, v in enumerate(["0.01", "0.00", "0.00"])]
    cf = one(features.customer_features(fact(spark, *rows), PARAMS))
    assert cf["average_basket_value"] == Decimal("0.00")


def test_zero_quantity_basket_is_kept_but_invalid(spark):
    fb = fact(spark, dict(quantity=0), dict(basket_id=2))
    assert fb.count() == 2
    assert [r[0] for r in fb.orderBy("basket_id").select("is_valid_purchase_basket").collect()] == [False, True]
    assert one(features.customer_features(fb, PARAMS))["in_sample_baskets"] == 1


def test_weeks_far_apart_use_a_distinct_count(spark):
    rows = [dict(basket_id=w, day=w % 500 + 1, week_no=w) for w in (1, 2, 2000)]
    cf = one(features.customer_features(fact(spark, *rows), PARAMS))
    assert cf["active_weeks"] == 3


def test_empty_input(spark):
    empty = lines(spark, {}).limit(0)
    fb = baskets.fact_basket(empty)
    cf = features.customer_features(fb, PARAMS)
    ch = holdout.customer_holdout(cf, holdout.holdout_activity(fb, PARAMS))
    mi = holdout.bgnbd_model_input(cf, ch, PARAMS)
    assert fb.count() == cf.count() == ch.count() == mi.count() == 0
    assert one(audit.dataset_overview(empty))["transaction_rows"] == 0
    assert one(audit.exact_duplicates(empty))["extra_rows"] == 0
    assert one(audit.unusual_value_rates(empty))["zero_sales_pct"] is None
    assert describe.sales_quintile(mi).count() == 0
    assert describe.histogram(mi, {"frequency": 5}).count() == 0


def test_one_household(spark):
    fb = fact(spark, dict(day=3), dict(basket_id=2, day=600, week_no=86))
    cf = features.customer_features(fb, PARAMS)
    ch = holdout.customer_holdout(cf, holdout.holdout_activity(fb, PARAMS))
    mi = holdout.bgnbd_model_input(cf, ch, PARAMS)
    row = one(mi)
    assert row["actual_holdout_baskets"] == 1 and row["prediction_horizon_days"] == 167
    assert one(describe.sales_quintile(mi))["historical_sales_quintile"] == "Q1 - Lowest"
    scored = evaluate.rate_baseline(mi)
    assert one(scored)["predicted_holdout_baskets_baseline"] == 0.0


def test_sources(spark, tmp_path):
    tx = lines(spark, dict(sales_value="2.50"), dict(basket_id=2))
    csv = str(tmp_path / "tx.csv")
    tx.coalesce(1).write.option("header", True).csv(csv)
    assert sorted(load_transactions(spark, csv, "csv").collect()) == sorted(tx.collect())
    back = write_table(tx, str(tmp_path / "tx"))
    assert back.schema == TRANSACTIONS and sorted(back.collect()) == sorted(tx.collect())
    assert sorted(load_transactions(spark, str(tmp_path / "tx")).collect()) == sorted(tx.collect())
    (tmp_path / "bad.csv").write_text(",".join(TRANSACTIONS.fieldNames()) + "\nx,1,1,1,1,1,1,1,1,1,1,1\n")
    with pytest.raises(Exception):
        load_transactions(spark, str(tmp_path / "bad.csv"), "csv").collect()
    assert preview_rows(tx, 1).count() == 1
    with pytest.raises(ValueError):
        load_transactions(spark, csv, "orc")


def test_parameters_and_upsert(spark):
    tx = lines(spark, *[dict(day=d, week_no=week_of(d)) for d in (538, 544, 545, 551, 705, 711)])
    parameters = baskets.project_parameters(tx)
    assert [(f.name, f.dataType) for f in parameters.schema] == [
        (f.name, f.dataType) for f in PROJECT_PARAMETERS
    ]
    assert baskets.read_params(parameters) == PARAMS
    changed = parameters.withColumn("holdout_weeks", F.lit(9).cast("smallint"))
    assert upsert(parameters, changed, "parameter_id").collect() == changed.collect()


def test_profile_labels(spark):
    data = [(k, Decimal(s), p) for k, s, p in [(1, "1", 1.0), (2, "2", 4.0), (3, "3", 2.0), (4, "4", 3.0)]]
    df = spark.createDataFrame(
        data, "household_key int, historical_sales decimal(16,2), predicted_holdout_baskets_bgnbd double"
    )
    got = {r["household_key"]: r["customer_profile"] for r in profiles.profile_levels(df).collect()}
    assert got == {
        1: "Lower sales / Lower activity", 2: "Lower sales / Higher activity",
        3: "Higher sales / Lower activity", 4: "Higher sales / Higher activity",
    }
    missing = df.withColumn("predicted_holdout_baskets_bgnbd", F.lit(None).cast("double"))
    assert profiles.profile_levels(missing).select("customer_profile").distinct().collect()[0][0] == "Unclassified"


def test_checks_find_violations(spark):
    tx = lines(spark, {}, {}, dict(household_key=None, basket_id=3))
    assert checks.check_primary_key(tx, ["household_key", "basket_id"]).count() == 2
    parents = lines(spark, dict(household_key=9))
    assert checks.check_foreign_key(tx, parents, "household_key").count() == 2
    assert one(checks.check_not_null(tx, ["household_key", "day"])) == {"null_household_key": 1, "null_day": 0}
    assert checks.check_predicate(tx, F.col("household_key") > 1).count() == 2
    odd = tx.withColumn("day", F.col("day").cast("int")).withColumn("more", F.lit(1)).drop("store_id")
    report = {r["column_name"]: r for r in checks.check_schema(odd, TRANSACTIONS).collect()}
    assert not report["day"]["as_declared"] and not report["more"]["as_declared"]
    assert not report["store_id"]["as_declared"] and report["store_id"]["data_type"] is None
    assert report["basket_id"]["as_declared"]


def test_audit_finds_violations(spark):
    tx = lines(
        spark,
        dict(household_key=2, week_no=2, store_id=2, trans_time=1, day=1),
        dict(day=1), dict(day=2, trans_time=2400), dict(basket_id=2, trans_time=None),
        dict(basket_id=3, trans_time=1260, product_id=None), dict(basket_id=4, quantity=0, sales_value="0.43"),
        dict(basket_id=5, coupon_match_disc="-1.00"),
    )
    consistency = one(audit.basket_attribute_consistency(tx))
    assert consistency == {
        "baskets_checked": 5, "multi_household_baskets": 1, "multi_day_baskets": 1,
        "multi_week_baskets": 1, "multi_store_baskets": 1, "multi_trans_time_baskets": 1,
    }
    assert audit.day_week_violations(tx).count() == 1
    assert one(audit.invalid_hhmm(tx))["invalid_hhmm_values"] == 2
    assert one(audit.baskets_without_time(tx))["baskets_without_trans_time"] == 1
    assert one(audit.multi_time_baskets(tx))["baskets_with_multiple_trans_times"] == 1
    assert one(audit.baskets_with_repeated_product(tx))["baskets_with_repeated_product"] == 2
    assert one(audit.zero_quantity_only_baskets(tx))["zero_quantity_only_baskets"] == 1
    assert one(audit.zero_quantity_only_profile(tx))["total_sales"] == Decimal("0.43")
    assert one(audit.discount_relationships(tx))["match_without_manufacturer_coupon"] == 1
    assert audit.coupon_match_exceptions(tx).count() == 1
    assert one(audit.null_counts(tx))["null_trans_time"] == 1


def test_reconciliations_find_lost_rows(spark):
    tx = lines(spark, *[dict(basket_id=b, sales_value="2.00") for b in range(4)])
    fb = baskets.fact_basket(tx)
    lost = fb.filter(F.col("basket_id") > 0)
    assert one(baskets.reconcile_basket_count(tx, fb))["difference"] == 0
    assert one(baskets.reconcile_basket_count(tx, lost))["difference"] == -1
    assert one(baskets.reconcile_line_count(tx, lost))["difference"] == -1
    assert one(baskets.reconcile_measures(tx, lost))["sales_difference"] == Decimal("-2.00")
    cf = features.customer_features(lost, PARAMS)
    assert one(features.reconcile_features(fb, cf, PARAMS))["basket_difference"] == -1
    late = lines(spark, *[dict(basket_id=b, day=d, week_no=week_of(d)) for b, d in ((1, 1), (2, 600), (3, 601))])
    fb = baskets.fact_basket(late)
    cf = features.customer_features(fb, PARAMS)
    short = fb.filter(F.col("basket_id") < 3)
    ch = holdout.customer_holdout(cf, holdout.holdout_activity(short, PARAMS))
    assert one(holdout.reconcile_holdout(ch, fb, cf, PARAMS))["basket_difference"] == -1


def test_feature_checks_find_violations(spark):
    cf = features.customer_features(
        fact(spark, dict(), dict(basket_id=2, day=9), dict(household_key=2, basket_id=3, coupon_disc="-1.00")),
        PARAMS,
    )
    assert one(features.rate_bounds(cf)) == {
        "invalid_retail_discount_rates": 0, "invalid_manufacturer_coupon_rates": 0,
        "invalid_retail_coupon_match_rates": 0,
    }
    bad = (
        cf.withColumn("recency_days", F.lit("-1").cast("decimal(14,6)"))
        .withColumn("retail_discount_basket_rate", F.lit("1.5").cast("decimal(12,6)"))
        .withColumn("total_retail_discount", F.lit("-1").cast("decimal(16,2)"))
        .withColumn("manufacturer_coupon_amount_per_redeeming_basket", F.lit(None).cast("decimal(14,4)"))
    )
    assert one(features.bgnbd_relationship_checks(bad))["negative_recency"] == 2
    assert one(features.rate_bounds(bad))["invalid_retail_discount_rates"] == 2
    assert one(features.negative_totals(bad))["customers_with_negative_retail_discount"] == 2
    assert one(features.coupon_average_consistency(bad))["users_without_coupon_average"] == 1
    assert one(features.recency_identity(bad))["invalid_recency_identity"] == 2
    null = cf.withColumn("frequency", F.lit(None).cast("int"))
    assert one(features.required_null_checks(null))["null_frequency"] == 2


def test_model_input_checks_find_violations(spark):
    fb = fact(spark, dict(), dict(basket_id=2, day=9))
    cf = features.customer_features(fb, PARAMS)
    ch = holdout.customer_holdout(cf, holdout.holdout_activity(fb, PARAMS))
    mi = holdout.bgnbd_model_input(cf, ch, PARAMS)
    describe.assert_cohort(mi, 1)
    describe.assert_relationships(mi)
    with pytest.raises(ValueError):
        describe.assert_cohort(mi.unionByName(mi))
    with pytest.raises(ValueError):
        describe.assert_cohort(mi, 2)
    with pytest.raises(ValueError):
        describe.assert_relationships(mi.withColumn("in_sample_baskets", F.lit(9)))
    assert one(describe.recency_allclose(mi.withColumn("recency_days", F.lit(1.0))))["not_close"] == 1
    broken = ch.withColumn("actual_holdout_purchase_days", F.lit(3)).withColumn("was_active_in_holdout", F.lit(True))
    found = one(holdout.holdout_structure_checks(broken))
    assert found["purchase_days_greater_than_baskets"] == 1
    assert found["inconsistent_active_flags"] == 1 and found["inconsistent_zero_purchase_rows"] == 1
    assert one(holdout.model_input_checks(mi.withColumn("recency_days", F.lit(None))))["null_recency"] == 1
