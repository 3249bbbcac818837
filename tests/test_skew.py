"""A hot key holding a third of all rows: results stay exact and whole, and
the join / aggregation plans split or pre-combine the hot key."""

import contextlib
import io

import pandas as pd
import pytest

from revlens.plans import catalog as C
from revlens.plans import products as PR

N = 3000
HOT = "HOTHOTHOT0"


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _products(spark):
    rows = [(HOT, 7.0, None)]
    for i in range(N):
        nb = [HOT] if i % 3 == 0 else [f"P{(i * 7 + 1) % N:09d}"]
        rows.append((f"P{i:09d}", float(i % 50), {"also_viewed": nb}))
    return rows, spark.createDataFrame(rows, "asin string, price double, related map<string,array<string>>")


def _brute(rows):
    price = {a: p for a, p, _ in rows}
    out = {}
    for a, _, rel in rows:
        nbs = (rel or {}).get("also_viewed") or []
        ps = [price[n] for n in nbs if price.get(n) is not None]
        out[a] = (sum(ps) / len(ps) if ps else None, len(nbs) or None)
    return out


STATIC = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}


def test_hot_neighbour_join_is_exact_without_adaptive_execution(spark):
    rows, df = _products(spark)
    with conf(spark, **STATIC):
        got = {r.asin: (r.meanPriceAlsoViewed, r.countAlsoViewed) for r in PR.also_viewed(df.repartition(16)).collect()}
    assert got == _brute(rows)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_is_balanced_and_whole(spark, how):
    # A third of the rows has one key, a sixth another, a tenth none.
    from pyspark.sql import functions as F

    from revlens.operators.joins import salted_join
    with conf(spark, **STATIC):
        left = spark.range(24_000).select("id", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 6 == 1, "b")
                                          .when(F.col("id") % 10 == 4, None).otherwise(F.col("id").cast("string")).alias("k"))
        right = left.select("k").where("k IS NOT NULL AND k NOT LIKE '%7'").distinct().withColumn("v", F.concat(F.lit("v"), "k"))
        right = right.union(spark.createDataFrame([(None, "never")], "k string, v string"))
        joined = salted_join(left, right, "k", how)
        assert sorted(map(tuple, joined.select("id", "k", "v").collect()), key=repr) == sorted(
            map(tuple, left.join(right, "k", how).select("id", "k", "v").collect()), key=repr)
        sizes = sorted(r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())
        assert len(sizes) == 8 and sizes[-1] < 2 * sizes[0]


def test_hot_product_correlation_preaggregated(spark):
    # A third of all reviews name one product: the join sees one row for it.
    reviews = pd.DataFrame({"asin": ["H"] * 1000 + [f"p{i}" for i in range(2000)],
                            "overall": [float(1 + i % 5) for i in range(3000)]})
    products = pd.DataFrame({"asin": ["H"] + [f"p{i}" for i in range(2000)],
                             "price": [3.5] + [float(i % 17) for i in range(2000)]})
    r = C.price_rating_corr(spark.createDataFrame(products), spark.createDataFrame(reviews),
                            places=12).first()
    m = reviews.merge(products, on="asin")
    assert r.n_pairs == len(m)
    assert r.price_rating_corr == pytest.approx(m["price"].corr(m["overall"]), abs=1e-9)


def test_quantile_inside_a_hot_value_run(spark):
    # A third of all values are 7.0 and the median falls inside that run:
    # ties are counted per distinct value before ranking, so the hot value
    # is one row per map task, and the answer is still exact.
    import numpy as np
    from revlens.operators.quantiles import exact_quantiles
    vals = [7.0] * 1500 + [float(i) for i in range(3000)]
    rows = [(v, i % 2) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "v double, g int").repartition(8)
    q = exact_quantiles(df, "v", [0.25, 0.5, 0.75], ["g"], known_groups=[0, 1])
    got = {r.g: r.qs for r in q.collect()}
    for g in (0, 1):
        xs = [v for v, gg in rows if gg == g]
        assert got[g] == pytest.approx(list(np.percentile(xs, [25, 50, 75])))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    assert "partial_count" in buf.getvalue()
