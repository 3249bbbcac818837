"""Catalog exploration (Q1.1-Q1.6): missing values, price-rating
correlation, price statistics, products per category, and two referential
checks between reviews, products and related-product lists.

Scale notes
-----------
* Q1.2 never joins raw reviews with products.  Reviews are first reduced to
  one row of sufficient statistics per product (count, mean, squared
  deviation of the rating) with map-side partial aggregation; the join then
  pairs one row per product on each side, so a product holding a third of
  all reviews is still a single row and the join has no skew.  The
  correlation is assembled from moments about the overall means.
* Q1.5/Q1.6 compare *distinct* id sets.  ``distinct`` runs partial
  aggregation before its shuffle, so repeated ids (hot products) collapse
  in each map task; the anti / full-outer join then sees one row per id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions import parse as P
from revlens.operators.joins import anti_join_count, set_difference_counts
from revlens.operators.profile import describe, missing_flags, null_percentage, shares_table
from revlens.operators.ranking import ranked

# The statistics the reference reports for price.
PRICE_STATS = ("mean", "std", "50%", "min", "max")


def null_pct(df: DataFrame) -> DataFrame:
    """Q1.1: percent missing per column, rounded to 4 places of the share."""
    return null_percentage(df)


def review_state(reviews: DataFrame) -> DataFrame:
    """Per product id (NULL too) what all answers need from its reviews: rows,
    missing values per column (``missing``, in the order of the columns), and
    n, y (mean), m2 (squared deviation), ymin, ymax of the present ratings."""
    rating = F.col("overall").cast("double")
    kept = F.when(~F.isnan(rating), rating)
    missing = [F.count_if(flag) for flag in missing_flags(reviews)]
    return reviews.groupBy("asin").agg(
        F.count(F.lit(1)).alias("rows"), F.array(*missing).alias("missing"),
        F.count(kept).cast("double").alias("n"), F.avg(kept).alias("y"),
        (F.var_pop(kept) * F.count(kept)).alias("m2"), F.min(kept).alias("ymin"), F.max(kept).alias("ymax"))


def merged_state(states: DataFrame) -> DataFrame:
    """Several states (unioned, e.g. one per day of reviews) as one."""
    columns = F.size(F.first("missing"))
    y = F.sum(F.when(F.col("n") > 0, F.col("n") * F.col("y"))) / F.nullif(F.sum("n"), F.lit(0.0))
    both = states.join(states.groupBy(F.col("asin").alias("_a")).agg(y.alias("_y")), F.col("asin").eqNullSafe(F.col("_a")))
    off = F.col("y") - F.col("_y")
    sums = F.transform(F.sequence(F.lit(0), columns - 1), lambda i: F.aggregate(
        F.collect_list("missing"), F.lit(0).cast("long"), lambda acc, m: acc + F.get(m, i)))
    return both.groupBy("asin").agg(
        F.sum("rows").alias("rows"), sums.alias("missing"), F.sum("n").alias("n"), F.first("_y").alias("y"),
        F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"), F.min("ymin").alias("ymin"), F.max("ymax").alias("ymax"))


def missing_shares(state: DataFrame, columns: list[str]) -> DataFrame:
    """Q1.1 from a state: percent missing per column."""
    sums = state.agg(F.sum("rows").alias("rows"), *[F.sum(F.get("missing", F.lit(i))).alias(f"_{i}") for i in range(len(columns))])
    total = F.when(F.col("rows") > 0, F.col("rows"))
    return shares_table(sums, columns, [F.col(f"_{i}") / total for i in range(len(columns))])


def product_facts(products: DataFrame) -> DataFrame:
    """Per product what all answers need: asin, price, category (first of the
    parsed list), ids named in its related lists, and ``missing``, a 0/1 per
    column."""
    flags = F.array(*[flag.cast("long") for flag in missing_flags(products)])
    return products.select("asin", F.col("price").cast("double").alias("price"),
                           P.first_category(P.parse_categories("categories")).alias("category"),
                           P.related_ids("related").alias("ids"), flags.alias("missing"), F.lit(1).alias("rows"))


def price_rating_corr(products: DataFrame, reviews: DataFrame, places: int = 2) -> DataFrame:
    """Q1.2: Pearson correlation of product price and review rating over
    (product, review) pairs joined on ``asin`` where both are present.
    NULL when either side is constant (no DIVIDE_BY_ZERO)."""
    return state_price_corr(products, review_state(reviews.select("asin", "overall")), places)


def state_price_corr(products: DataFrame, state: DataFrame, places: int = 2) -> DataFrame:
    """Q1.2 from the reviews' state."""
    per_product = state.where(F.col("asin").isNotNull() & (F.col("n") > 0)).select("asin", "n", "y", "m2", "ymin", "ymax")
    priced = products.where(F.col("price").isNotNull()).select("asin", F.col("price").alias("x"))
    pairs = priced.join(per_product, "asin")
    # Moments about the means: a common offset cancels before it is squared.
    centre = pairs.agg((F.sum(F.col("n") * F.col("x")) / F.sum("n")).alias("x"),
                       (F.sum(F.col("n") * F.col("y")) / F.sum("n")).alias("y"))
    centre = centre.select(F.struct("x", "y").alias("c")).scalar()
    n, dx, dy = F.col("n"), F.col("dx"), F.col("dy")
    m = (pairs.withColumn("dx", F.col("x") - centre.getField("x"))
         .withColumn("dy", F.col("y") - centre.getField("y"))
         .agg(F.sum("n").alias("n"), F.sum(n * dx).alias("sx"), F.sum(n * dy).alias("sy"),
              F.sum(n * dx * dx).alias("sxx"), F.sum(F.col("m2") + n * dy * dy).alias("syy"),
              F.sum(n * dx * dy).alias("sxy"),
              (F.min("x") < F.max("x")).alias("x_varies"), (F.min("ymin") < F.max("ymax")).alias("y_varies")))
    # What rounding left of the means is taken out again.
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    vx = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    vy = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    corr = F.when(F.col("x_varies") & F.col("y_varies") & (vx > 0) & (vy > 0), cov / (F.sqrt(vx) * F.sqrt(vy)))
    return m.select(F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n_pairs"),
                    F.bround(corr, places).alias("price_rating_corr"))


def price_describe(products: DataFrame, places: int = 2) -> DataFrame:
    """Q1.3: mean, std, median, min, max of price (exact median)."""
    return describe(products, ["price"], PRICE_STATS, places=places)


def category_counts(products: DataFrame) -> DataFrame:
    """Q1.4: products per top-level category (element [0][0] of the parsed
    category list), largest first, ties by name.  Rows whose category is
    missing or unparsable are not a group; the empty name '' is kept."""
    cat = P.first_category(P.parse_categories("categories"))
    return counted_categories(products.select(cat.alias("category"), "asin"))


def counted_categories(named: DataFrame) -> DataFrame:
    """Q1.4 from (category, asin) rows."""
    return (named.where(F.col("category").isNotNull())
            .groupBy("category").agg(F.count("asin").alias("n"))
            .orderBy(F.desc("n"), F.asc("category")))


def ranked_categories(products: DataFrame) -> DataFrame:
    """O1 with the order as a column: rank (from 1), category, n."""
    counts = ranked(category_counts(products), [F.desc("n"), F.asc("category")])
    return counts.select((F.col("rank") + 1).alias("rank"), "category", "n")


def dangling_reviews(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Q1.5: does any review name a product missing from the catalog?
    ``dangling`` is the 0/1 flag, ``missing_ids`` how many distinct ids."""
    n = anti_join_count(reviews.select("asin"), products.select("asin"), "asin")
    return n.select((F.col("n") > 0).cast("int").alias("dangling"),
                    F.col("n").alias("missing_ids"))


def related_ids(products: DataFrame) -> DataFrame:
    """Every id named in any related list (F3), one row per mention."""
    return products.select(F.explode(P.related_ids("related")).alias("asin"))


def related_vs_catalog(products: DataFrame) -> DataFrame:
    """Q1.6: do the ids named in related lists and the catalog ids differ
    in either direction?  Also how many on each side only."""
    return compared_ids(products.select("asin"), related_ids(products))


def compared_ids(catalog: DataFrame, named: DataFrame) -> DataFrame:
    """Q1.6 from the ids on both sides."""
    c = set_difference_counts(catalog, named, "asin", left_name="catalog_only", right_name="related_only")
    return c.select("catalog_only", "related_only",
                    ((F.col("catalog_only") + F.col("related_only")) > 0).cast("int").alias("differ"))
