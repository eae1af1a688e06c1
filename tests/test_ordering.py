"""Order statistics against pandas, on random, skewed and odd data."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillsight.functions import ordering
from tillsight.operators import describe

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]


def skewed(n, seed=1):
    """A third of the rows share one value."""
    rng = np.random.default_rng(seed)
    values = rng.integers(0, n // 3 + 2, n).astype(float)
    values[: n // 3] = 7.0
    rng.shuffle(values)
    return values


def frame(spark, **columns):
    n = len(next(iter(columns.values())))
    return spark.createDataFrame(pd.DataFrame({"household_key": np.arange(n, dtype="int32"), **columns}))


@pytest.mark.parametrize("bins", [2, 16, 4096])
def test_quantiles(spark, monkeypatch, bins):
    """However finely a round divides, the answer is exact."""
    monkeypatch.setattr(ordering, "BINS", bins)
    groups = np.array(["a", "b", None])[np.arange(9000) % 3]
    values, other = skewed(9000), np.random.default_rng(3).normal(size=9000)
    other[::50] = np.nan
    df = frame(spark, g=groups, v=values, w=other).withColumn("w", F.nanvl("w", F.lit(None)))
    got = ordering.quantiles(df.repartition(6), ["v", "w"], PROBS, ["g"]).collect()
    assert len(got) == 6
    source = pd.DataFrame({"g": groups, "v": values, "w": other}).fillna({"g": "none"})
    for row in got:
        expected = source[source.g == (row["g"] or "none")][row["metric"]].quantile(PROBS).to_numpy()
        np.testing.assert_allclose(row["q"], expected, rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize(
    "values",
    [
        [3.0], [2.0, 1.0, 5.0], [0.0, -0.0, 0.0], [7.0] * 40,
        [1e308, -1e308, 5e-324, -5e-324, 0.0, 1.0, np.inf, -np.inf],
        list(2.0 ** np.arange(-1000, 1000, 7)), list(-(2.0 ** np.arange(-30, 30))),
        list(np.nextafter(8.0, [0, 9]).repeat(5)) + [8.0], list(1 + np.arange(3000) * 2.0**-52),
    ],
)
def test_quantiles_of_few_and_odd_values(spark, values):
    got = ordering.quantiles(frame(spark, v=np.array(values)), ["v"], [0.0, 0.25, 0.5, 1.0]).collect()[0]["q"]
    at = np.array([0.0, 0.25, 0.5, 1.0]) * (len(values) - 1)
    ordered = np.sort(values)
    low, high = ordered[np.floor(at).astype(int)], ordered[np.ceil(at).astype(int)]
    with np.errstate(invalid="ignore"):
        between = np.where(low == high, low, (np.ceil(at) - at) * low + (at - np.floor(at)) * high)
    np.testing.assert_array_equal(got, between)


def test_quantiles_of_millions(spark):
    """The same way as for three rows: a few passes, nothing sorted, nothing ranked."""
    df = spark.range(3_000_000).select(
        (F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 3_000_000 / 7).alias("v"),
        F.when(F.col("id") % 5 == 0, F.log1p("id")).alias("w"),
    )
    got = {(r["g"], r["metric"]): r["q"] for r in ordering.quantiles(df, ["v", "w"], [0.1, 0.5], ["g"]).collect()}
    i = np.arange(3_000_000)
    v, w = (i * 7919) % 3_000_000 / 7, np.log1p(i)
    for g in range(3):
        np.testing.assert_allclose(got[g, "v"], np.quantile(v[i % 3 == g], [0.1, 0.5]), rtol=1e-14)
        np.testing.assert_allclose(got[g, "w"], np.quantile(w[(i % 3 == g) & (i % 5 == 0)], [0.1, 0.5]), rtol=1e-12)


def test_quantiles_of_nothing(spark):
    df = frame(spark, v=np.array([1.0])).withColumn("v", F.lit(None).cast("double"))
    assert ordering.quantiles(df, ["v"], [0.5], ["household_key"]).collect() == []
    assert ordering.quantile_columns(df, {"m": ("v", 0.5)}).collect()[0]["m"] is None


def test_position(spark):
    values = skewed(5000)
    df = frame(spark, v=values).repartition(7)
    key = "household_key"
    got = ordering.with_position(df, F.asc("v"), F.asc(key), key=key).orderBy(key).toPandas()
    np.testing.assert_array_equal(got["position"], pd.Series(values).rank(method="first").astype(int) - 1)
    back = ordering.with_position(df, F.desc("v"), F.asc(key), key=key).toPandas()
    assert sorted(back["position"]) == list(range(5000))
    top = back.sort_values("position").head(1700)["household_key"]
    expected = pd.DataFrame({"v": values}).nlargest(1700, "v").index
    assert list(top) == list(expected)


def test_only_key_and_place_are_written(spark, monkeypatch):
    written, made = [], ordering.materialize

    def kept(df, label):
        written.append(sorted(df.columns))
        return made(df, label)

    monkeypatch.setattr(ordering, "materialize", kept)
    df = frame(spark, v=skewed(50), w=np.arange(50.0), x=np.ones(50))
    got = describe.rank_bucket(df, "v", 5, "b")
    assert got.columns == [*df.columns, "b"] and written == [["_place", "household_key"]]
    named = df.withColumn("household_key", F.when(F.col("household_key") > 0, F.col("household_key")))
    placed = ordering.with_position(named, F.asc_nulls_first("household_key"), key="household_key").collect()
    assert {r["household_key"]: r["position"] for r in placed} == {None: 0, **{i: i for i in range(1, 50)}}


def test_position_of_a_hot_value_spreads(spark):
    """Rows that share one value still end up in several partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = frame(spark, v=np.zeros(4000)).repartition(4)
        ranged = df.repartitionByRange(F.asc("v"), F.asc("household_key"))
        sizes = ranged.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("n, q", [(2498, 5), (2498, 10), (171, 10), (13, 5), (7, 10), (3, 5)])
def test_bucket_follows_pandas(spark, n, q):
    values = np.random.default_rng(n).permutation(n).astype(float)
    got = describe.rank_bucket(frame(spark, v=values), "v", q, "b").orderBy("household_key").toPandas()
    expected = pd.qcut(pd.Series(values).rank(method="first"), q, labels=range(1, q + 1))
    assert list(got["b"]) == list(expected.astype(int))


@settings(max_examples=300, deadline=None)
@given(st.integers(2, 5000), st.integers(2, 12))
def test_bucket_cuts(n, q):
    ranks = np.arange(n) + 1.0
    ours = 1 + sum((ranks > cut).astype(int) for cut in ordering.quantile_cuts(n, q)[1:-1])
    theirs = pd.qcut(pd.Series(ranks), q, labels=range(1, q + 1)).astype(int)
    assert (ours == theirs).all()


def test_spearman(spark):
    a = skewed(3000, 1)
    b = a * 0.5 + skewed(3000, 2)
    row = ordering.spearman(frame(spark, a=a, b=b).repartition(5), "a", "b").collect()[0]
    expected = pd.Series(a).rank().corr(pd.Series(b).rank())
    assert row["n"] == 3000
    assert row["correlation"] == pytest.approx(expected, abs=1e-12)


def test_spearman_ranks_each_column_once(spark, monkeypatch):
    rng = np.random.default_rng(4)
    values = {c: np.round(rng.normal(size=400), 1) for c in "abcd"}
    values["d"][::7] = np.nan
    df = frame(spark, **values).withColumn("d", F.when(~F.isnan("d"), F.col("d")))
    ranked, made = [], ordering.average_ranks

    def counted(rows, columns):
        ranked.append(sorted(columns))
        return made(rows, columns)

    monkeypatch.setattr(ordering, "average_ranks", counted)
    got = ordering.spearman_pairs(df, [("a", "b"), ("a", "c"), ("b", "c"), ("a", "d"), ("d", "c")]).collect()
    # a and c again for the rows that d leaves
    assert ranked == [["a", "a where d", "b", "c", "c where d", "d"]]
    local = pd.DataFrame(values)
    for r in got:
        both = local[[r.a, r.b]].dropna()
        assert r.n == len(both)
        assert r.correlation == pytest.approx(both[r.a].rank().corr(both[r.b].rank()), abs=1e-12)
    empty = ordering.spearman(df.limit(0), "a", "b").collect()
    assert [tuple(r) for r in empty] == [(None, None)]


def test_spearman_of_a_constant_is_null(spark):
    df = frame(spark, a=np.ones(5), b=np.arange(5.0))
    assert ordering.spearman(df, "a", "b").collect()[0]["correlation"] is None


def test_describe_follows_pandas(spark):
    v = np.random.default_rng(2).gamma(2.0, 50.0, 700)
    v[3] = np.nan
    df = frame(spark, v=v).withColumn("v", F.nanvl("v", F.lit(None)))
    row = describe.describe(df, ["v"], [0.25, 0.5, 0.99]).collect()[0]
    expected = pd.Series(v).describe([0.25, 0.5, 0.99])
    got = [row[c] for c in ("count", "mean", "std", "min", "p25", "p50", "p99", "max")]
    np.testing.assert_allclose(got, expected.to_numpy(), rtol=1e-12)


def test_histogram_follows_numpy(spark):
    v = np.random.default_rng(4).normal(size=900)
    rows = describe.histogram(frame(spark, v=v), {"v": 17}).orderBy("bin").collect()
    counts, edges = np.histogram(v, 17)
    assert [r["households"] for r in rows] == list(counts)
    np.testing.assert_allclose([r["lower"] for r in rows], edges[:-1], rtol=1e-9)
    same = describe.histogram(frame(spark, v=np.full(6, 3.0)), {"v": 4}).collect()
    assert [r["households"] for r in same] == list(np.histogram(np.full(6, 3.0), 4)[0])


def test_row_order_does_not_matter(spark):
    v = skewed(2000)
    shuffled = frame(spark, v=v).repartition(9, "v").orderBy(F.rand(3))
    for build in (
        lambda df: describe.describe(df, ["v"]).drop("mean", "std").collect(),
        lambda df: describe.rank_bucket(df, "v", 5, "b").orderBy("household_key").collect(),
    ):
        assert build(frame(spark, v=v)) == build(shuffled)
