"""Product feature jobs (Q2.0-Q2.4) over the typed ``product`` and
``review`` tables.

Each job has a row-level result (one row per product) and a one-row
statistics result with the reference's key names.  Statistics are a
single aggregation over the row-level plan.

Scale notes
-----------
* Q2.1 aggregates reviews per product *before* joining (map-side partial
  aggregation), so the join pairs one row per product on each side.
* Q2.3 explodes also-viewed lists and joins each neighbour id with its
  price.  A neighbour named in a third of all lists makes that join key
  hot: a sketch finds such ids, and only their rows are salted
  (``operators.joins.salted_join``), whether or not adaptive execution is
  on.  Prices are summed per id first, so each id is one row; the
  per-product mean aggregates partially before its shuffle.
* Q2.4 needs two global constants (mean and median price).  They are
  scalar subqueries: Spark runs each once and inlines the value, so no
  join or broadcast is written.  The exact median is found by bracketed
  selection (``operators.quantiles``), so no task holds every price.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions import parse as P
from revlens.operators.joins import salted_join
from revlens.operators.profile import round_doubles, stats_row
from revlens.operators.quantiles import exact_lower_median


# The reference's result keys, each with its statistic and column.
RATING_STATS = [
    ("count_total", "count", "asin"),
    ("mean_meanRating", "mean", "meanRating"),
    ("variance_meanRating", "variance", "meanRating"),
    ("numNulls_meanRating", "nulls", "meanRating"),
    ("mean_countRating", "mean", "countRating"),
    ("variance_countRating", "variance", "countRating"),
    ("numNulls_countRating", "nulls", "countRating"),
]
FLAT_STATS = [
    ("count_total", "count", "asin"),
    ("mean_bestSalesRank", "mean", "bestSalesRank"),
    ("variance_bestSalesRank", "variance", "bestSalesRank"),
    ("numNulls_category", "nulls", "category"),
    ("numNulls_bestSalesCategory", "nulls", "bestSalesCategory"),
]
FLAT_DISTINCT = [
    ("countDistinct_category", "category"),
    ("countDistinct_bestSalesCategory", "bestSalesCategory"),
]
ALSO_VIEWED_STATS = [
    ("count_total", "count", "asin"),
    ("mean_meanPriceAlsoViewed", "mean", "meanPriceAlsoViewed"),
    ("variance_meanPriceAlsoViewed", "variance", "meanPriceAlsoViewed"),
    ("numNulls_meanPriceAlsoViewed", "nulls", "meanPriceAlsoViewed"),
    ("mean_countAlsoViewed", "mean", "countAlsoViewed"),
    ("variance_countAlsoViewed", "variance", "countAlsoViewed"),
    ("numNulls_countAlsoViewed", "nulls", "countAlsoViewed"),
]
IMPUTATION_STATS = [
    ("count_total", "count", "asin"),
    ("mean_meanImputedPrice", "mean", "meanImputedPrice"),
    ("variance_meanImputedPrice", "variance", "meanImputedPrice"),
    ("numNulls_meanImputedPrice", "nulls", "meanImputedPrice"),
    ("mean_medianImputedPrice", "mean", "medianImputedPrice"),
    ("variance_medianImputedPrice", "variance", "medianImputedPrice"),
    ("numNulls_medianImputedPrice", "nulls", "medianImputedPrice"),
    ("numUnknowns_unknownImputedTitle", "equals:unknown", "unknownImputedTitle"),
]


# -- Q2.0 warm-up -------------------------------------------------------------

def preview(df: DataFrame, n: int = 5, key: str = "asin", last: bool = False) -> DataFrame:
    """First (``head``) or last (``tail``) ``n`` rows in key order; the
    order makes the preview stable.  Planned as a top-n
    (``TakeOrderedAndProject``): each task keeps n rows."""
    return df.orderBy(F.desc(key) if last else F.asc(key)).limit(n)


def lookup(df: DataFrame, key_value: str, key: str = "asin") -> DataFrame:
    """P5: rows whose key equals ``key_value``."""
    return df.where(F.col(key) == F.lit(key_value))


def count_and_mean_price(product: DataFrame, places: int | None = None) -> DataFrame:
    """Row count and mean price (task 0)."""
    row = product.agg(F.count(F.lit(1)).alias("count_total"), F.avg("price").alias("mean_price"))
    return row if places is None else round_doubles(row, places)


# -- Q2.1 rating mean / count per product ----------------------------------------

def product_ratings(review: DataFrame, product: DataFrame) -> DataFrame:
    """asin, meanRating, countRating (NULL for products without reviews)."""
    per = review.groupBy("asin").agg(F.avg("overall").alias("meanRating"),
                                     F.count("overall").alias("countRating"))
    return product.select("asin").join(per, "asin", "left").select(
        "asin", "meanRating", "countRating")


def product_rating_stats(review: DataFrame, product: DataFrame,
                         places: int | None = None) -> DataFrame:
    return stats_row(product_ratings(review, product), RATING_STATS, places)


# -- Q2.2 flatten categories and sales rank ---------------------------------------

def first_map_entry(df: DataFrame, key: str, map_text: str, value_type: str = "bigint") -> DataFrame:
    """F6/F7 on any JSON-object text column: key, first_key, first_value
    (text order; NULL for missing, empty or unparsable objects)."""
    m = F.from_json(F.col(map_text), f"map<string,{value_type}>")
    return df.select(key, P.first_key(m).alias("first_key"), P.first_value(m).alias("first_value"))


def product_flat(product: DataFrame) -> DataFrame:
    """asin, category ([0][0], '' as NULL), bestSalesCategory and
    bestSalesRank (the first entry of the salesRank map)."""
    return product.select(
        "asin",
        P.first_category_or_null("categories").alias("category"),
        P.first_key("salesRank").alias("bestSalesCategory"),
        P.first_value("salesRank").alias("bestSalesRank"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> Column:
    """Exact distinct counts of several columns (NULL left out) as one
    struct, a scalar subquery.  Values are tagged with their column and made
    distinct in each map task first, so no row is copied per column into the
    shuffle and no task holds a column's values."""
    tagged = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("column"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)])))
    values = tagged.where(F.col("value").isNotNull()).distinct()
    return values.agg(F.struct(*[F.count_if(F.col("column") == i).alias(c) for i, c in enumerate(columns)])).scalar()


def product_flat_stats(product: DataFrame, places: int | None = None) -> DataFrame:
    f = product_flat(product)
    kinds = distinct_counts(f, [c for _, c in FLAT_DISTINCT])
    return stats_row(f, FLAT_STATS, places).withColumns({name: kinds.getField(c) for name, c in FLAT_DISTINCT})


# -- Q2.3 also-viewed neighbours ----------------------------------------------------

def also_viewed(product: DataFrame) -> DataFrame:
    """asin, meanPriceAlsoViewed (mean price of the listed neighbours that
    have a price; a neighbour listed twice counts twice) and
    countAlsoViewed (list length, NULL when missing or empty)."""
    lists = product.select("asin", P.map_field("related", "also_viewed").alias("av"))
    neighbours = lists.select("asin", F.explode("av").alias("nb"))
    prices = product.where(F.col("price").isNotNull()).groupBy(F.col("asin").alias("nb")).agg(
        F.sum("price").alias("price"), F.count("price").alias("n"))
    mean_price = (salted_join(neighbours, prices, "nb").groupBy("asin")
                  .agg((F.sum("price") / F.sum("n")).alias("meanPriceAlsoViewed")))
    return (lists.select("asin", P.size_or_null("av").alias("countAlsoViewed"))
            .join(mean_price, "asin", "left")
            .select("asin", "meanPriceAlsoViewed", "countAlsoViewed"))


def also_viewed_stats(product: DataFrame, places: int | None = None) -> DataFrame:
    return stats_row(also_viewed(product), ALSO_VIEWED_STATS, places)


# -- Q2.4 imputation ------------------------------------------------------------------

def imputed_products(product: DataFrame, approx_accuracy: int | None = None) -> DataFrame:
    """asin, meanImputedPrice, medianImputedPrice, unknownImputedTitle.

    Prices are taken as float32 like the reference; the fill values are the
    mean and the median of those prices: exact and discrete by default (a
    value of the column, as ``percentile_approx`` returns), or the
    ``percentile_approx`` sketch itself when ``approx_accuracy`` is given."""
    p = product.select("asin", F.col("price").cast("float").cast("double").alias("price"), "title")
    # Fill values are scalar subqueries: each runs once, no join.
    mean_price = p.agg(F.avg("price")).scalar()
    if approx_accuracy:
        median_price = p.agg(F.percentile_approx("price", 0.5, approx_accuracy)).scalar()
    else:
        median_price = exact_lower_median(p, "price").scalar()
    return p.select(
        "asin",
        F.coalesce(F.col("price"), mean_price).alias("meanImputedPrice"),
        F.coalesce(F.col("price"), median_price).alias("medianImputedPrice"),
        F.when(P.missing_text("title"), F.lit("unknown")).otherwise(F.col("title"))
         .alias("unknownImputedTitle"),
    )


def imputation_stats(product: DataFrame, places: int | None = None,
                     approx_accuracy: int | None = None) -> DataFrame:
    return stats_row(imputed_products(product, approx_accuracy), IMPUTATION_STATS, places)


# -- A14: stored sketches --------------------------------------------------------------

#: Size parameter of the quantile sketches; rank errors stay well below RANK_ERROR.
SKETCH_K = 400
RANK_ERROR = 0.02


def price_sketches(product: DataFrame) -> DataFrame:
    """part, prices (a mergeable quantile sketch), n: one row per part of the
    catalog (by id hash), to be stored and merged later with those of other
    parts or days, without reading products again."""
    part = F.pmod(F.xxhash64("asin"), F.lit(16)).cast("int").alias("part")
    return product.where(F.col("price").isNotNull()).groupBy(part).agg(
        F.kll_sketch_agg_double(F.col("price").cast("double"), F.lit(SKETCH_K)).alias("prices"), F.count("price").alias("n"))


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """p, quantile: approximate quantiles of all merged sketches."""
    merged = sketches.agg(F.kll_merge_agg_double("prices").alias("s"))
    return merged.select(F.inline(F.array(*[
        F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("s", F.lit(float(p))).alias("quantile"))
        for p in probs])))


def sketch_rank_errors(product: DataFrame, sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """p, n, in_bound: whether the merged sketch's quantile has a rank within
    RANK_ERROR of p among the products' prices."""
    found = sketch_quantiles(sketches, probs).agg(F.collect_list(F.struct("p", "quantile")).alias("q")).scalar()
    prices = product.where(F.col("price").isNotNull()).select("price", F.inline(found))
    ranks = prices.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("price") < F.col("quantile")).alias("below"),
                                    F.count_if(F.col("price") <= F.col("quantile")).alias("upto"))
    inside = (F.col("below") <= (F.col("p") + RANK_ERROR) * F.col("n")) & (F.col("upto") >= (F.col("p") - RANK_ERROR) * F.col("n"))
    return ranks.select("p", "n", inside.alias("in_bound"))
