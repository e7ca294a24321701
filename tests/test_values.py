import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataloom.functions import values as V
from strataloom.functions.rng import uniform
from strataloom.operators import profile as P


def one(spark, *columns, rows=((0,),), schema="a long"):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_digits_are_cut_off_not_rounded(spark):
    got = one(spark, V.digit_text(F.col("a")), V.digit(F.col("a"), -8), rows=[(1.000000005,), (0.29,), (1e7,), (-123.45,), (None,)], schema="a double")
    assert [g[0] and (int(g[0][:19]), g[0][19:]) for g in got] == [(1, "00000000"), (0, "29000000"), (10**7, "00000000"), (123, "45000000"), None]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.sampled_from([V.RARE, V.NULL, V.ESCAPE, V.ESCAPE + V.RARE]), st.text(max_size=5)), min_size=1, max_size=8))
def test_escape_is_undone(spark, texts):
    got = one(spark, "a", V.escape_tokens(F.col("a")), V.unescape_tokens(V.escape_tokens(F.col("a"))), rows=[(t,) for t in texts], schema="a string")
    assert all(a == c and b not in (V.RARE, V.NULL) for a, b, c in got)


def test_doubles_as_text(spark):
    xs = [0.0, -0.0, 1.5, -2.0, 9999999.5, 1e7, 12345678.0, -1234567890.125, 1e15, 123456789012345680.0, 1e16, 2.5e-3, 1e-4, 0.00012345, 1e-5, -1.25e-7, 1e100, 3.0e-300]
    assert [g[0] for g in one(spark, V.to_text(F.col("a"), "double"), rows=[(x,) for x in xs], schema="a double")] == [repr(x) for x in xs]


def test_numbers_in_text(spark):
    texts = ["$-1,234.5e3", "x 12.50 y", "", "none", ".5", "1e3", None]
    assert [g[0] for g in one(spark, V.to_number(F.col("a")), rows=[(t,) for t in texts], schema="a string")] == [-1.0, 12.5, None, None, 0.5, 1000.0, None]


def test_dates_in_text(spark):
    got = one(spark, V.to_datetime(F.col("a")).cast("string"), rows=[("2024-02-29",), ("02/01/2024",), ("31/12/2024",), ("2024-01-02 03:04:05",), ("no",), (None,)], schema="a string")
    assert [g[0] for g in got] == ["2024-02-29 00:00:00", "2024-02-01 00:00:00", "2024-12-31 00:00:00", "2024-01-02 03:04:05", None, None]


def test_log_buckets_match_edges(spark):
    xs = [0.0, 0.5, 1.0, 1.99, 2.0, 1e30, -0.5, -1.0, -1.5, -2.0, -2.1, -1e30]
    for (x, b), _ in zip(one(spark, "a", V.log2_bucket(F.col("a")), rows=[(x,) for x in xs], schema="a double"), xs):
        lo, hi = V.bucket_bounds(b)
        assert lo <= x < hi or b in (0, 127)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 20, 101, 1000])
def test_closest_observation(n):
    x = np.arange(n, dtype=float)
    for q in np.linspace(0, 1, 41):
        assert x[P.closest_rank(n, float(q))] == np.quantile(x, q, method="closest_observation")


def test_uniform_is_uniform_and_stable(spark):
    df = spark.range(5000).select(uniform(3, "id").alias("u"))
    u = np.array([r.u for r in df.collect()])
    assert (np.array([r.u for r in df.repartition(7).orderBy("u").collect()]) == np.sort(u)).all()
    assert 0 <= u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.02 and math.isclose(u.std(), 12**-0.5, rel_tol=0.05)


def test_infinite_and_missing_numbers(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.5,), (float("inf"),)], "x double")
    r = P.numeric_ranges(df.where("x is null or isnan(x) or x < 10"), F.col("x")).first()
    assert (r.n, r.n_null, r.low, r.min_digit) == (1, 2, 1.5, -1)
    assert P.log_histogram(df, F.col("x")).count() == 1


def test_floats_as_text_have_the_form_of_doubles(spark):
    said = ["0.1", "1.5", "10000000.0", "123456.79", "0.0001", "3.3e-05", "-0.25", "16777216.0"]
    df = spark.createDataFrame([(float(x),) for x in said], "x float")
    assert [r.t for r in df.select(V.to_text(F.col("x"), "float").alias("t")).collect()] == said
    assert all(np.float32(t) == np.float32(r.x) for t, r in zip(said, df.collect(), strict=True))
