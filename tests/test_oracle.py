"""Every query against its check SQL: names, types and all values."""

import re

import pytest

import __spark_entry__ as entry
from pyspark.sql import functions as F
from tests.compare import connect, differences
from tillsight.functions.ordering import quantile_bucket
from tillsight.plans.oracle_model import _bucket

FOLDER = "/root/testdata/sf0.001"
# the queries op1_ to op10_ and the pipeline have tests of their own
OTHERS = re.compile(r"op\d+_|pipeline$")
QUERIES = {n: q for n, q in entry.queries().items() if not OTHERS.match(n)}
SQL = {n: q for n, q in entry.oracle_sql().items() if not OTHERS.match(n)}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_check_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"bgnbd_fit", "bgnbd_summary", "bootstrap_points"}


def test_entry(spark):
    assert entry.entry(spark).count() == 20


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    result = QUERIES[name](spark, FOLDER).toArrow()
    expected = con.sql(SQL[name]).to_arrow_table()
    assert differences(result, expected) == []


@pytest.mark.parametrize("rows", [2, 5, 11, 91, 171, 181, 331, 361, 500])
@pytest.mark.parametrize("buckets", [5, 10])
def test_bucket_of_the_check_is_that_of_interpolated_cuts(spark, con, rows, buckets):
    expected = con.sql(
        f"SELECT i, {_bucket('i', buckets)} AS b FROM (SELECT unnest(range({rows})) AS i) ORDER BY i"
    ).fetchall()
    got = spark.range(rows).select("id", quantile_bucket(F.col("id"), rows, buckets).alias("b"))
    assert [tuple(r) for r in got.orderBy("id").collect()] == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_unchecked_query_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
