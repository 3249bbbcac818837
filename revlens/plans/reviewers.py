"""Reviewer profiling (Q0.1 profile table, Q0.2 its statistics).

Plan shape: one scan of the reviews, a narrow projection that parses the
year and the vote counts, partial aggregation per map task, one shuffle on
``reviewerID`` and the final aggregation.  A reviewer with a third of all
reviews costs one partial row per map task, not a hot partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions import parse as P
from revlens.operators.profile import describe

# Output column names of the reviewer profile.
PROFILE_COLUMNS = ("number_products_rated", "avg_ratings", "reviewing_since",
                   "helpful_votes", "total_votes")


def review_fields(reviews: DataFrame) -> DataFrame:
    """F1/F2 per review: reviewerID, asin, the year of the review time and
    the helpful / total vote counts parsed from ``"[h, t]"``."""
    return reviews.select(
        "reviewerID", "asin",
        P.review_year("reviewTime").alias("review_year"),
        P.helpful_votes("helpful").alias("helpful_votes"),
        P.total_votes("helpful").alias("total_votes"),
    )


def reviewer_profile(reviews: DataFrame) -> DataFrame:
    """Per reviewer: reviews with a review time, mean rating, first year,
    helpful votes and total votes.  Rows with a NULL reviewer are dropped
    (a group-by key cannot be missing in the reference either)."""
    r = reviews.where(F.col("reviewerID").isNotNull()).select(
        "reviewerID", "reviewTime", "overall",
        P.review_year("reviewTime").alias("year"),
        P.helpful_votes("helpful").alias("h"),
        P.total_votes("helpful").alias("t"),
    )
    return r.groupBy("reviewerID").agg(
        F.count("reviewTime").alias("number_products_rated"),
        F.avg("overall").alias("avg_ratings"),
        F.min("year").alias("reviewing_since"),
        F.sum("h").alias("helpful_votes"),
        F.sum("t").alias("total_votes"),
    )


def reviewer_profile_describe(reviews: DataFrame, places: int = 2) -> DataFrame:
    """Q0.2: ``describe`` of the profile, rounded like the reference
    (``metric, stat, value``; 5 metrics x 8 statistics)."""
    return describe(reviewer_profile(reviews), PROFILE_COLUMNS, places=places)
