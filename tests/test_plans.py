"""Plan guards: what the physical plans of the registered queries must and
must not contain at any scale."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from revlens.plans import catalog as C
from revlens.plans import features as FE
from revlens.sources import fixtures as FX
from tests.conftest import SF_SMALL

def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(E.QUERIES))
def test_no_pairs_no_python(spark, key):
    p = plan(E.QUERIES[key](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in p, (key, bad)


def test_scans_prune_columns(spark):
    p = plan(C.price_rating_corr(FX.products(spark, SF_SMALL), FX.reviews(spark, SF_SMALL)))
    assert "ReadSchema: struct<p_partkey:bigint,p_retailprice:double>" in p
    assert "l_returnflag" not in p.split("ReadSchema: struct<l_")[1].split(">")[0]


def test_reviews_aggregated_before_join(spark):
    p = plan(C.price_rating_corr(FX.products(spark, SF_SMALL), FX.reviews(spark, SF_SMALL)), "simple")
    join_line = next(i for i, line in enumerate(p.splitlines()) if "Join" in line and "asin" in line)
    below = "\n".join(p.splitlines()[join_line:])
    assert "HashAggregate(keys=[asin" in below


def test_top_k_uses_group_limit(spark):
    from revlens.sources.tables import read_table
    e = read_table(spark, SF_SMALL, "embeddings", ["vec_id", "label", "embedding"])
    p = plan(FE.central_members(e), "simple")
    assert "WindowGroupLimit" in p


def test_point_lookup_filter(spark):
    p = plan(E.queries()["product_lookup"](spark, SF_SMALL))
    assert "= 0000000150" in p


def test_few_valued_keys_do_not_shuffle_rows(spark):
    from revlens.sources.tables import read_table
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan(E.QUERIES["prediction_rmse"](spark, SF_SMALL), "simple").splitlines()
        at = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line or "ShuffledHashJoin" in line)
        assert sum("HashAggregate" in line for line in lines[at:]) >= 4  # both sides are one row per group
        # Centroids are measured: small ones are sent to the vectors, large ones meet dealt rows.
        e = read_table(spark, SF_SMALL, "embeddings", ["vec_id", "label", "embedding"])
        lines = plan(FE.central_members(e), "simple").splitlines()
        below = lines[next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line):]
        assert not any("Exchange hashpartitioning" in line for line in below)
        large = FE.central_members(e, most_bytes=0)
        lines = plan(large, "simple").splitlines()
        assert "[salt" in next(line for line in lines if "SortMergeJoin" in line or "ShuffledHashJoin" in line)
        assert sorted(large.collect()) == sorted(FE.central_members(e).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_distinct_counts_without_expand(spark):
    p = plan(E.QUERIES["product_flat_stats"](spark, SF_SMALL))
    assert "Expand" not in p


def test_describe_never_shuffles_rows_by_metric(spark):
    # Five metrics: a shuffle keyed on the metric would put a fifth of all
    # values in one task.  Per-metric tables must be broadcast instead.
    from revlens.plans import reviewers as R
    p = plan(R.reviewer_profile_describe(FX.reviews(spark, SF_SMALL)), "simple")
    assert "SortMergeJoin [metric" not in p
    assert "ShuffledHashJoin [metric" not in p
