"""End-to-end reports: the JSON documents the reference's two Dask entry
points write (reviewer statistics; the six catalog answers).

The catalog report reads each input once: the reviews' state and the products'
facts (``plans.catalog``) are written to the shared folder, and all six answers
are taken from them.  The document is assembled in Spark from one-row JSON
parts (``sources.sinks``), so nothing but the final document reaches the
driver, and only when the caller collects or writes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.profile import DESCRIBE_STATS
from revlens.plans import catalog as C
from revlens.plans import reviewers as R
from revlens.sources.scratch import written
from revlens.sources.sinks import json_document, json_objects, json_value


def _stat_order(stats) -> F.Column:
    return F.array_position(F.array(*[F.lit(s) for s in stats]), F.col("stat"))


def reviewer_report(reviews: DataFrame) -> DataFrame:
    """``{metric: {count, mean, std, min, 25%, 50%, 75%, max}}``."""
    d = R.reviewer_profile_describe(reviews)
    per_metric = json_objects(d, "stat", "value", group=["metric"],
                              sort=[_stat_order(DESCRIBE_STATS)])
    metric_order = F.array_position(F.array(*[F.lit(m) for m in R.PROFILE_COLUMNS]), F.col("metric"))
    return json_objects(per_metric, "metric", "json", sort=[metric_order], raw=True)


def catalog_report(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """``{q1..q6}`` as the reference's results document."""
    state = written(C.review_state(reviews), "review-state")
    facts = written(C.product_facts(products), "product-facts")
    q1 = json_document({
        "products": json_objects(C.missing_shares(facts, products.columns), "column", "null_pct"),
        "reviews": json_objects(C.missing_shares(state, reviews.columns), "column", "null_pct"),
    })
    named = facts.select(F.explode("ids").alias("asin"))
    return json_document({
        "q1": q1,
        "q2": json_value(C.state_price_corr(facts, state), "price_rating_corr"),
        "q3": json_objects(C.price_describe(facts), "stat", "value",
                           sort=[_stat_order(C.PRICE_STATS)]),
        "q4": json_objects(C.counted_categories(facts), "category", "n", sort=[-F.col("n")]),
        "q5": json_value(C.dangling_reviews(state, facts), "dangling"),
        "q6": json_value(C.compared_ids(facts.select("asin"), named), "differ"),
    })
