"""Hot keys give the same answers, and plans keep the shape that large tables need."""

import os
import re
from dataclasses import replace
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.lines import lines, week_of
from tillsight.functions import columns
from tillsight.operators import audit, baskets, checks, features, holdout
from tillsight.plans.stages import Stages, stages
from tillsight.sources import storage

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the lines in one basket, a third of the rest with one household."""
    rows = [dict(household_key=7, basket_id=7, product_id=i % 50, quantity=i % 3) for i in range(1000)]
    rows += [dict(household_key=8, basket_id=1000 + i, day=i % 540 + 1, week_no=week_of(i % 540 + 1)) for i in range(700)]
    rows += [dict(household_key=i % 200, basket_id=5000 + i, product_id=None) for i in range(1300)]
    return storage.materialize(lines(spark, *rows), "hot")


def test_hot_basket_in_any_order(hot):
    usual = baskets.fact_basket(hot)
    key = ["household_key", "basket_id"]
    mixed = baskets.fact_basket(hot.repartition(16, F.rand(3)))
    assert usual.orderBy(*key).collect() == mixed.orderBy(*key).collect()
    row = usual.filter("basket_id = 7").collect()[0]
    assert (row["basket_unique_product_count"], row["basket_product_lines_count"]) == (50, 1000)
    assert usual.filter("basket_id = 5000").collect()[0]["basket_unique_product_count"] == 0
    assert plan(usual).count("FileScan") == 1 and "collect_set" not in plan(usual)


def test_basket_without_a_household(spark):
    tx = lines(spark, *[dict(household_key=None, product_id=i % 4) for i in range(30)], dict(basket_id=2))
    row = baskets.fact_basket(tx).filter("household_key is null").collect()[0]
    assert (row["basket_unique_product_count"], row["basket_product_lines_count"]) == (4, 30)


def test_duplicates_take_one_scan_and_one_exchange_of_lines(hot):
    text = plan(audit.exact_duplicates(hot))
    assert text.count("FileScan") == 1 and "Join" not in text


def test_quantiles_of_lines_from_value_counts(spark, tmp_path):
    """One scan of the lines: afterwards the profile needs them no more."""
    values = [(i * 37) % 101 for i in range(1000)]
    tx = lines(spark, *[dict(quantity=v, sales_value=f"{v}.25") for v in values], dict(quantity=None))
    stored = storage.write_table(tx, str(tmp_path / "lines"))
    quantity, sales = audit.quantity_profile(stored), audit.sales_profile(stored)
    for df in (quantity, sales):
        assert str(tmp_path) not in df._jdf.queryExecution().optimizedPlan().toString()
        assert str(tmp_path) not in plan(df)
    ordered = sorted(values)
    row = quantity.collect()[0]
    assert row["median_quantity"] == (ordered[499] + ordered[500]) / 2
    assert row["p99_quantity"] == pytest.approx(ordered[989] + 0.01 * (ordered[990] - ordered[989]))
    assert (row["minimum_quantity"], row["maximum_quantity"]) == (0, 100)
    assert row["zero_quantity_rows"] == values.count(0)


def test_copies_are_listed_whole(spark):
    tx = lines(spark, *[dict(quantity=0, sales_value="1.00")] * 500, dict())
    assert audit.zero_quantity_positive_sales(tx).count() == 500


def test_literal_period_reaches_the_scan(spark):
    s = stages(spark, FOLDER)
    assert "LessThanOrEqual(basket_day,544)" in plan(features.customer_features(s.fact_basket, s.params))
    text = plan(holdout.holdout_activity(s.fact_basket, s.params))
    assert "GreaterThanOrEqual(basket_day,545)" in text
    assert re.search(r"DataFilters: .*basket_day#\d+ >= 545", text)
    assert re.search(r"Filter .*basket_day#\d+ <= 711", text)


def test_features_combine_by_bucket_and_by_household(spark):
    """Two exchanges of rows that are combined before them; nothing runs while the plan is made."""
    s = stages(spark, FOLDER)
    s.fact_basket, s.params
    for build in (features.customer_features, holdout.holdout_activity):
        text = plan(build(s.fact_basket, s.params))
        exchanges = re.findall(r"Exchange hashpartitioning\((.*?), 8\)", text)
        assert ["_groupingexpression" in e or "bucket" in e for e in exchanges] == [False, True]
        assert "Expand" not in text and "collect_set" not in text and text.count("FileScan") == 1


def test_weeks_and_days_have_no_range(spark):
    """Bitmaps count weeks 1 to 10,000 and negative ones, and days beyond 16 bits."""
    days = [(d, (d - 1) // 7 + 1) for d in range(1, 70_001, 5)] + [(-3, -40), (-3, -40), (0, 0), (None, None)]
    rows = [(i, h, d, w) for h in (1, 2) for i, (d, w) in enumerate(days) if h == 1 or i % 3 == 0]
    df = spark.createDataFrame(rows, "basket_id long, household_key int, basket_day int, basket_week int")
    day, week = F.col("basket_day"), F.col("basket_week")
    for value in (day, week):
        got = (
            df.groupBy("household_key", columns.bitmap_bucket(value).alias("bucket"))
            .agg(columns.bitmap(value).alias("bits"))
            .groupBy("household_key").agg(columns.bitmap_values("bits").alias("n"))
        )
        expected = df.groupBy("household_key").agg(F.countDistinct(value).alias("n"))
        assert sorted(got.collect()) == sorted(expected.collect())
    fact = stages(spark, FOLDER).fact_basket
    wide = df.where("basket_day > 0 AND basket_day <= 32767").select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(True) if f.dataType.typeName() == "boolean" else F.lit(1))
            .cast(f.dataType).alias(f.name)
            for f in fact.schema
        ]
    )
    params = replace(
        stages(spark, FOLDER).params, in_sample_end_day=20_000, holdout_start_day=20_001, holdout_end_day=32_767
    )
    cf = {r["household_key"]: r["active_weeks"] for r in features.customer_features(wide, params).collect()}
    ha = {r["household_key"]: r for r in holdout.holdout_activity(wide, params).collect()}
    for h in (1, 2):
        held = {(d, w) for _, k, d, w in rows if k == h and d}
        assert cf[h] == len({w for d, w in held if 0 < d <= 20_000})
        late = [(d, w) for d, w in held if 20_000 < d <= 32_767]
        assert ha[h]["actual_holdout_purchase_days"] == len({d for d, _ in late})
        assert ha[h]["actual_holdout_active_weeks"] == len({w for _, w in late})
        assert ha[h]["actual_holdout_baskets"] == len(late)


def test_basket_fact_spreads_a_basket_by_product_first(spark):
    text = plan(baskets.fact_basket(stages(spark, FOLDER).transactions))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert ["product_id" in e for e in exchanges] == [False, True]


def test_lines_move_once_to_the_basket_fact(spark, tmp_path, monkeypatch):
    """Lines are joined and grouped where the join put them, and are not written; the period days are those of
    the lines. Repeated orders, orders without lines and NULL keys give what the plain way gives."""
    monkeypatch.setattr("tillsight.plans.stages.LINES_PER_PARTITION", 100)
    orders = [(i, i % 40, i * 5) for i in range(481)] + [(7, 3, 2400), (8, 8, 40), (None, 1, 50), (9000, 2, 2404)]
    rows = [(i % 479, i % 30, i % 6, float(i % 9), i * 1.25, i % 11 / 100) for i in range(1500)]
    rows += [(None, 1, 1, 2.0, 3.0, 0.1), (8, None, None, None, None, None)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, days int").selectExpr(
        "o_orderkey", "o_custkey", "timestamp(date_add(date'1995-01-01', days)) o_orderdate"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(rows, (
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double"
    )).write.parquet(f"{tmp_path}/lineitem.parquet")
    s = Stages(spark, str(tmp_path))
    key = ["household_key", "basket_id"]
    assert s.fact_basket.orderBy(key).collect() == baskets.fact_basket(s.receipt_lines).orderBy(key).collect()
    assert s.params == baskets.read_params(baskets.project_parameters(s.receipt_lines))
    assert "transactions" not in vars(s)
    text = plan(baskets.fact_basket(s.lines_by_basket))
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#\w+, (\d+)\), (\w+)", text)
    assert sorted(moved) == [(k, "16", "REPARTITION_BY_NUM") for k in ("l_orderkey", "o_orderkey")]
    assert text.count("Exchange hashpartitioning") == 2


def test_scan_reads_only_needed_columns(spark):
    s = stages(spark, FOLDER)
    schema = re.search(r"ReadSchema: (\S+)", plan(baskets.project_parameters(s.transactions))).group(1)
    assert schema == "struct<day:smallint,week_no:smallint>"


def test_steps_have_no_nested_loop_join(spark):
    s = stages(spark, FOLDER)
    frames = [
        baskets.fact_basket(s.transactions),
        baskets.customer_overlap(s.fact_basket, s.params),
        baskets.period_activity(s.fact_basket, s.params),
        features.customer_features(s.fact_basket, s.params),
        features.same_minute_listing(s.fact_basket, s.params),
        holdout.customer_holdout(s.customer_features, s.holdout_activity),
        holdout.holdout_only_households(s.fact_basket, s.customer_features, s.params),
        s.model_view,
    ]
    for df in frames:
        assert "NestedLoop" not in plan(df) and "CartesianProduct" not in plan(df)


def test_audit_does_not_multiply_lines(spark):
    """A count of several distinct columns expands basket rows, not receipt lines."""
    s = stages(spark, FOLDER)
    for build in (audit.dataset_overview, audit.weekly_coverage):
        text = plan(build(s.transactions))
        below = text[text.index("Expand"):].split("FileScan")[0]
        assert "HashAggregate" in below and "Exchange" in below
    assert "Expand" not in plan(audit.basket_attribute_consistency(s.transactions))


def test_listing_is_a_top_k(spark):
    s = stages(spark, FOLDER)
    assert "TakeOrderedAndProject" in plan(features.top_by_baskets(s.customer_features))
    assert "TakeOrderedAndProject" in plan(audit.extreme_lines(s.transactions))


class Session:
    """Just enough of a session to ask for its folder."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{master}")


def test_shared_folder(spark):
    assert storage.shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert storage.shared_folder(Session("hdfs://x/y/", "yarn")) == "hdfs://x/y/tillsight-app-yarn"
    with pytest.raises(RuntimeError):
        storage.shared_folder(Session(None, "yarn"))
    own = storage.shared_folder(Session(None, "local[2]"))
    assert own == storage.shared_folder(Session(None, "local[2]"))


def test_materialized_table_has_no_lineage(spark):
    df = storage.materialize(spark.range(10).withColumn("x", F.col("id") * 2))
    assert "Range" not in plan(df) and df.count() == 10


def test_release_deletes_the_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "shared_folder", lambda session: str(tmp_path / "app"))
    storage.materialize(spark.range(3))
    assert (tmp_path / "app").exists()
    before = stages(spark, "/root/testdata/sf0.001")
    assert stages(spark, "/root/testdata/sf0.001/") is before
    storage.release(spark)
    assert not (tmp_path / "app").exists()
    assert stages(spark, "/root/testdata/sf0.001") is not before


def test_a_table_is_switched_at_once(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        storage.read_table(spark, path)
    first = storage.write_table(spark.range(5), path)
    second = storage.write_table(spark.range(7), path)
    assert (first.count(), second.count(), storage.read_table(spark, path).count()) == (5, 7, 7)
    broken = spark.range(9).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no"))))
    with pytest.raises(Exception, match="no"):
        storage.write_table(broken, path)
    with pytest.raises(ValueError, match="refused"):
        storage.write_table(spark.range(3), path, lambda df: checks.require_none(df, "refused"))
    assert sorted(r.id for r in storage.read_table(spark, path).collect()) == list(range(7))
    # what a writer left that died before the switch is not read, and goes with the next write
    spark.range(2).write.parquet(f"{path}/v00000009-0123abcd")
    assert storage.read_table(spark, path).count() == 7
    assert storage.write_table(spark.range(11), path).count() == 11
    assert storage.read_table(spark, path).count() == 11 and second.count() == 7
    assert len([p for p in os.listdir(path) if p.startswith("v")]) == 2


def test_upsert_onto_the_table_itself(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = "k int, v string"
    storage.write_table(spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], schema), path)
    new = spark.createDataFrame([(2, "B"), (3, "c"), (None, "N")], schema)
    got = storage.upsert_table(new, path, "k")
    expected = [(None, "N"), (None, "n"), (1, "a"), (2, "B"), (3, "c")]
    for df in (got, storage.read_table(spark, path)):
        assert sorted((tuple(r) for r in df.collect()), key=str) == sorted(expected, key=str)
    bad = new.withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        storage.upsert_table(bad, path, "k")
    assert storage.read_table(spark, path).count() == 5
    # and from the table itself
    storage.upsert_table(storage.read_table(spark, path).where("k = 3").withColumn("v", F.lit("C")), path, "k")
    assert {r.k: r.v for r in storage.read_table(spark, path).where("k > 1").collect()} == {2: "B", 3: "C"}


def test_rules_are_observed_while_rows_are_written(spark, tmp_path):
    watch = checks.Watch(
        spark.range(10), {"no sevens": F.col("id") == 7, "no twenties": F.col("id") > 19}, {"most": F.max("id")}
    )
    storage.write_table(watch.rows, str(tmp_path / "t"))
    assert watch.values() == {"most": 9}
    with pytest.raises(ValueError, match="^no sevens$"):
        watch.require()
