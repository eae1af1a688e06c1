"""From a CSV of receipt lines to the profile table."""

import pytest
from pyspark.sql import functions as F

from tests.lines import lines
from tillsight.operators import checks, profiles
from tillsight.plans.build import build
from tillsight.plans.stages import stages
from tillsight.schema import TRANSACTIONS
from tillsight.sources import storage
from tillsight.sources.transactions import load_transactions


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("build"))
    lines_of_all = stages(spark, "/root/testdata/sf0.001").transactions
    lines_of_all.write.option("header", True).csv(f"{folder}/lines")
    return build(spark, f"{folder}/lines", f"{folder}/out", "csv")


def test_tables_equal_the_steps(spark, built):
    s = stages(spark, "/root/testdata/sf0.001")
    for name, step in (
        ("fact_basket", s.fact_basket),
        ("customer_features", s.customer_features),
        ("customer_holdout", s.customer_holdout),
        ("bgnbd_model_input", s.model_input),
    ):
        assert built[name].exceptAll(step).isEmpty() and step.exceptAll(built[name]).isEmpty()


def test_lines_are_read_once(spark, tmp_path, monkeypatch):
    """Audits, parameters and baskets come out of one pass over the lines."""
    tx = stages(spark, "/root/testdata/sf0.001").transactions
    tx.write.parquet(f"{tmp_path}/lines")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    def load(*args):
        loaded = load_transactions(*args)
        return loaded.mapInArrow(counted, loaded.schema)

    monkeypatch.setattr("tillsight.plans.build.load_transactions", load)
    tables = build(spark, f"{tmp_path}/lines", f"{tmp_path}/out")
    assert read.value == tx.count()
    params = storage.read_table(spark, f"{tmp_path}/out/project_parameters")
    assert params.collect() == tables["project_parameters"].collect()
    expected = stages(spark, "/root/testdata/sf0.001").params
    assert tables["project_parameters"].first()["holdout_end_day"] == expected.holdout_end_day


def test_a_failed_build_leaves_the_tables(spark, tmp_path):
    lines(spark, dict(), dict(store_id=9)).write.parquet(f"{tmp_path}/lines")
    before = storage.write_table(spark.range(4), f"{tmp_path}/out/fact_basket")
    with pytest.raises(ValueError, match="basket of several"):
        build(spark, f"{tmp_path}/lines", f"{tmp_path}/out")
    assert storage.read_table(spark, f"{tmp_path}/out/fact_basket").count() == before.count() == 4


def test_profiles_are_complete(built):
    households = built["bgnbd_model_input"].count()
    assert built["profiles"].count() == households
    profiles.assert_profiles(built["profiles"], households)
    with pytest.raises(ValueError):
        profiles.assert_profiles(built["profiles"], households + 1)
    with pytest.raises(ValueError):
        profiles.assert_profiles(
            built["profiles"].withColumn("customer_profile", F.lit(None).cast("string"))
        )
    deciles = built["profiles"].groupBy("household_baskets_decile").count().collect()
    assert len(deciles) == 10


def test_broken_input_stops_the_build(spark, tmp_path):
    lines(spark, dict(day=3)).select(*TRANSACTIONS.fieldNames()).write.parquet(f"{tmp_path}/short")
    with pytest.raises(ValueError, match="bounds a period"):
        build(spark, f"{tmp_path}/short", f"{tmp_path}/out")
    bounds = [dict(household_key=None, basket_id=d, day=d, week_no=(d + 1) // 7 + 1) for d in (544, 545, 711)]
    lines(spark, *bounds).write.parquet(f"{tmp_path}/keyless")
    with pytest.raises(ValueError, match="fact_basket key"):
        build(spark, f"{tmp_path}/keyless", f"{tmp_path}/out")


@pytest.mark.parametrize(
    "second,message",
    [
        (dict(basket_id=2, week_no=2), "several weeks"),
        (dict(store_id=9), "basket of several"),
        (dict(basket_id=2, trans_time=1260), "clock time"),
    ],
)
def test_audit_stops_the_build(spark, tmp_path, second, message):
    lines(spark, dict(), second).write.parquet(f"{tmp_path}/lines")
    with pytest.raises(ValueError, match=message):
        build(spark, f"{tmp_path}/lines", f"{tmp_path}/out")


def test_require_none_names_rows(spark):
    checks.require_none(spark.range(0), "nothing")
    with pytest.raises(ValueError, match="'id': 0"):
        checks.require_none(spark.range(1), "something")


def test_loader_reads_what_it_wrote(spark, tmp_path):
    tx = stages(spark, "/root/testdata/sf0.001").transactions
    tx.write.parquet(str(tmp_path / "p"))
    tx.write.option("header", True).csv(str(tmp_path / "c"))
    for fmt, name in (("parquet", "p"), ("csv", "c")):
        got = load_transactions(spark, str(tmp_path / name), fmt)
        assert got.exceptAll(tx).isEmpty() and tx.exceptAll(got).isEmpty()


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
@pytest.mark.parametrize(
    "change",
    [
        lambda tx: tx.drop("coupon_disc"),
        lambda tx: tx.withColumn("more", F.lit(1)),
        lambda tx: tx.select("basket_id", "household_key", *tx.columns[2:]),
        lambda tx: tx.withColumnRenamed("day", "days"),
    ],
)
def test_loader_refuses_other_columns(spark, tmp_path, fmt, change):
    tx = lines(spark, dict(), dict(quantity=2))
    change(tx).write.option("header", True).format(fmt).save(str(tmp_path / "x"))
    with pytest.raises(ValueError, match="does not hold receipt lines"):
        load_transactions(spark, str(tmp_path / "x"), fmt)
    with pytest.raises(ValueError):
        build(spark, str(tmp_path / "x"), str(tmp_path / "out"), fmt)


def test_loader_refuses_other_types(spark, tmp_path):
    tx = lines(spark, dict())
    tx.withColumn("quantity", F.col("quantity").cast("string")).write.parquet(str(tmp_path / "x"))
    with pytest.raises(ValueError, match="quantity string instead of quantity int"):
        load_transactions(spark, str(tmp_path / "x"))


def test_local_folder_is_for_local_sessions_only():
    class Session:
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: None)})
        sparkContext = type("X", (), {"applicationId": "a", "master": "local-cluster[3,2,1024]"})

    with pytest.raises(RuntimeError):
        storage.shared_folder(Session)
