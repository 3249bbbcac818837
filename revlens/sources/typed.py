"""Text catalog -> typed catalog (nested fields as arrays and maps).

One narrow projection: ``categories`` becomes ``array<array<string>>``,
``salesRank`` a ``map<string,double>`` in text order and ``related`` a
``map<string,array<string>>``.  Python literals parse
(``functions.parse.literal_to_json``); anything else gives NULL, and
``parse_failures`` counts those rows instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions import parse as P

NESTED = {
    "categories": P.parse_categories,
    "salesRank": P.parse_sales_rank,
    "related": P.parse_related,
}


def typed_products(products: DataFrame) -> DataFrame:
    """Parse the nested text columns present in ``products``."""
    return products.select(*[
        NESTED[c](c).alias(c) if c in NESTED else F.col(c) for c in products.columns])


def parse_failures(products: DataFrame) -> DataFrame:
    """One row: per nested column, rows whose text is present but does not
    parse (``<column>_failures``)."""
    cols = [c for c in products.columns if c in NESTED]
    return products.agg(*[
        F.count_if(F.col(c).isNotNull() & NESTED[c](c).isNull()).alias(f"{c}_failures")
        for c in cols])
