"""describe / null shares / exact quantiles against pandas and numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from revlens.operators.profile import describe, null_percentage
from revlens.operators.quantiles import exact_quantiles


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 2.0, 7.0, None, 3.5], "b": [5, 1, 1, 1, 9, 2]})
    got = describe(spark.createDataFrame(pdf, "a double, b long")).toPandas()
    want = pdf.describe()
    for r in got.itertuples():
        assert r.value == pytest.approx(want.loc[r.stat, r.metric]), (r.metric, r.stat)


def test_describe_rounding_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.125,)], "x double")
    got = {r.stat: r.value for r in describe(df, ["x"], ["mean", "max"], places=2).collect()}
    assert got == {"mean": 0.12, "max": 0.12}


def test_describe_one_row_std_null(spark):
    got = {r.stat: r.value for r in describe(spark.createDataFrame([(4.0,)], "x double")).collect()}
    assert got["std"] is None and got["50%"] == 4.0 and got["count"] == 1.0


def test_null_percentage(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    got = {r.column: r.null_pct for r in null_percentage(df).collect()}
    assert got == {"a": 33.33, "b": 66.67}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=60))
def test_exact_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    qs = exact_quantiles(df, "v", [0.25, 0.5, 0.75]).first()["qs"]
    assert qs == pytest.approx(list(np.percentile(values, [25, 50, 75])))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=80),
       st.sampled_from([2, 1 << 18]))
def test_counting_quantiles_grouped_match_numpy(spark, values, parts):
    rows = [(float(v), i % 2) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "v double, g int")
    got = {r.g: r.qs for r in exact_quantiles(df, "v", [0.0, 0.3, 0.5, 1.0], ["g"],
                                              parts=parts, known_groups=[0, 1]).collect()}
    for g in (0, 1):
        xs = [v for v, gg in rows if gg == g]
        if xs:
            assert got[g] == pytest.approx(list(np.percentile(xs, [0, 30, 50, 100])), rel=1e-12, abs=1e-9)


def test_counting_quantiles_of_hard_values(spark):
    # All distinct, over the whole range of doubles, neighbouring doubles,
    # both zeros, and a value that a third of the rows hold.
    rng = np.random.default_rng(1)
    near = np.nextafter(np.full(50, 1e8), np.inf) + np.arange(50) * np.spacing(1e8)
    wide = np.concatenate([rng.normal(size=300) * 10.0 ** rng.integers(-300, 300, 300), near, [0.0, -0.0, 5e-324, -5e-324]])
    ties = np.concatenate([np.full(1000, 7.25), rng.random(2000) * 1e-9 + 7.25])
    probs = [0.0, 0.01, 0.25, 0.4999, 0.5, 0.9, 1.0]
    for values in (wide, ties, rng.permutation(200_000) / 3):
        df = spark.createDataFrame(pd.DataFrame({"v": values}))
        for parts in (4, 1 << 18):
            got = exact_quantiles(df, "v", probs, discrete=True, parts=parts).first()["qs"]
            ordered = np.sort(values)
            assert got == [ordered[max(0, int(np.ceil(p * len(values))) - 1)] for p in probs]


def test_quantiles_of_many_groups_and_special_values(spark):
    rows = [(g, float(v)) for g in range(40) for v in range(g + 1)] + [(99, None), (5, None), (7, float("nan")), (8, float("inf"))]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: r.qs for r in exact_quantiles(df, "v", [0.5, 1.0], ["g"], keep_empty_groups=True).collect()}
    assert got[99] == [None, None] and got[5] == [2.5, 5.0] and got[39] == [19.5, 39.0]
    assert np.isnan(got[7][1]) and got[8] == [4.5, float("inf")]
    assert 99 not in {r.g for r in exact_quantiles(df, "v", [0.5], ["g"]).collect()}
    assert exact_quantiles(df.where("false"), "v", [0.5]).first()["qs"] == [None]


def test_quantiles_never_sort_values(spark):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        exact_quantiles(spark.range(10).select(F.col("id").cast("double").alias("v")), "v", [0.5]).explain()
    windows = [line for line in buf.getvalue().splitlines() if "Window [" in line]
    # The last pass orders by value, inside a part of a part of a bucket only.
    assert windows and all("_b#" in w or "_total" in w for w in windows)


def test_frequency_method_matches_bracket(spark):
    df = spark.createDataFrame([(float(i % 7), i % 3) for i in range(100)], "v double, g int")
    a = {r.g: r.qs for r in exact_quantiles(df, "v", [0.25, 0.5], ["g"], method="frequency").collect()}
    b = {r.g: r.qs for r in exact_quantiles(df, "v", [0.25, 0.5], ["g"], known_groups=[0, 1, 2]).collect()}
    assert a == b


def test_discrete_median_matches_percentile_disc(spark):
    from revlens.operators.quantiles import exact_lower_median
    for n in (1, 2, 5, 10, 37):
        df = spark.createDataFrame([(float((i * 7) % 11),) for i in range(n)], "v double")
        want = df.selectExpr("percentile_disc(0.5) within group (order by v)").first()[0]
        assert exact_lower_median(df, "v").first()["median"] == want


def test_describe_treats_nan_as_missing(spark):
    pdf = pd.DataFrame({"a": [1.0, float("nan"), 3.0, None, 10.0]})
    got = {r.stat: r.value for r in describe(spark.createDataFrame(pdf, "a double")).collect()}
    want = pdf["a"].describe()
    for stat in ("count", "mean", "std", "min", "25%", "50%", "75%", "max"):
        assert got[stat] == pytest.approx(want[stat]), stat


def test_null_percentage_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), None), (None, "y"), (2.0, "z")],
                               "a double, b string")
    got = {r.column: r.null_pct for r in null_percentage(df).collect()}
    assert got == {"a": 50.0, "b": 25.0}


def test_describe_empty_input_has_every_stat(spark):
    e = spark.createDataFrame([], "v double")
    got = {r.stat: r.value for r in describe(e, ["v"]).collect()}
    assert set(got) == {"count", "mean", "std", "min", "25%", "50%", "75%", "max"}
    assert got["count"] == 0.0 and all(v is None for k, v in got.items() if k != "count")
