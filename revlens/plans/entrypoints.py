"""File-in, JSON-out entry points for the two report jobs.

The original jobs take CSV paths (a review dump; a review dump and a
product catalog) and write one JSON document each.  These functions do the
same on Spark: a split CSV read with only the needed columns, optional landing
as Parquet (the records are then found once for all answers), the report plan,
and a single small JSON file.  They return the one-row report DataFrame.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from revlens.plans.reports import catalog_report, reviewer_report
from revlens.sources.csv import land_parquet, read_products_csv, read_reviews_csv
from revlens.sources.sinks import write_json

# The columns each job reads from the CSV files.
REVIEWER_COLUMNS = ["reviewerID", "overall", "helpful", "reviewTime"]
CATALOG_REVIEW_COLUMNS = ["asin", "overall"]
CATALOG_PRODUCT_COLUMNS = ["asin", "price", "categories", "related"]


def _landed(spark: SparkSession, df: DataFrame, land_dir: str | None, name: str) -> DataFrame:
    if not land_dir:
        return df
    path = os.path.join(land_dir, name)
    land_parquet(df, path)
    return spark.read.parquet(path)


def run_reviewer_statistics(spark: SparkSession, reviews_csv: str, out_dir: str | None = None,
                            land_dir: str | None = None) -> DataFrame:
    """Reviewer profile statistics from a review CSV; writes the JSON
    document to ``out_dir`` when given."""
    reviews = _landed(spark, read_reviews_csv(spark, reviews_csv, REVIEWER_COLUMNS),
                      land_dir, "reviews")
    report = reviewer_report(reviews)
    if out_dir:
        write_json(report, out_dir)
    return report


def run_catalog_questions(spark: SparkSession, reviews_csv: str, products_csv: str,
                          out_dir: str | None = None, land_dir: str | None = None) -> DataFrame:
    """The six catalog answers (null shares over all columns of both files,
    correlation, price statistics, category counts, dangling reviews,
    related ids vs catalog) from the two CSV files."""
    reviews = _landed(spark, read_reviews_csv(spark, reviews_csv), land_dir, "reviews")
    products = _landed(spark, read_products_csv(spark, products_csv), land_dir, "products")
    report = catalog_report(reviews, products)
    if out_dir:
        write_json(report, out_dir)
    return report
