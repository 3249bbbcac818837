"""Review and catalog tables derived from the test tables.

The reference reads a review dump and a product catalog.  These views give
the same shape from the TPC-H-like test tables (see FIXTURES.md): reviews
come from ``lineitem`` joined with ``orders``, products from ``part``.  They
also plant NULLs, empty values and dangling ids the raw tables lack.

Every view is a lazy DataFrame over the Parquet scans, so column pruning and
filters still reach the files.  The typed views (``product_typed``) parse
the text fields with ``from_json`` in one narrow projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.sources.tables import read_table
from revlens.sources.typed import typed_products


def _asin(key) -> "F.Column":
    return F.lpad(key.cast("string"), 10, "0")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """reviewerID, asin, overall, helpful, reviewTime (text forms)."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_quantity", "l_linenumber", "l_returnflag"])
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    q = F.col("l_quantity").cast("int")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("reviewerID"),
        _asin(F.col("l_partkey") % 1900 + 150).alias("asin"),
        (1 + q % 5).cast("double").alias("overall"),
        F.concat(F.lit("["), F.col("l_linenumber").cast("string"), F.lit(", "),
                 (F.col("l_linenumber") + q % 4).cast("string"), F.lit("]")).alias("helpful"),
        F.when(F.col("l_returnflag") == "A", F.lit(None).cast("string"))
         .otherwise(F.date_format("o_orderdate", "MM d, yyyy")).alias("reviewTime"),
    )


def _id_text(expr) -> "F.Column":
    return F.concat(F.lit("'"), _asin(expr), F.lit("'"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """asin, price, title, categories, salesRank, related (text forms)."""
    p = read_table(spark, sf_dir, "part",
                   ["p_partkey", "p_retailprice", "p_name", "p_type", "p_brand", "p_size"])
    k = F.col("p_partkey")
    null_s = F.lit(None).cast("string")
    categories = (F.when(k % 17 == 0, null_s)
                  .when(k % 19 == 0, F.lit("[['']]"))
                  .when(k % 29 == 0, F.lit("[['Caf\\xe9', None, True]]"))
                  .when(k % 31 == 0, F.lit("[['cut off"))
                  .when(k % 37 == 0, F.lit("[(u'Gift' ' Sets', 'x'),]"))
                  .otherwise(F.concat(F.lit("[['"), F.col("p_type"), F.lit("', '"),
                                      F.col("p_brand"), F.lit("']]"))))
    sales_rank = (F.when(k % 5 == 0, null_s)
                  .when(k % 23 == 0, F.lit("{}"))
                  .when(k % 29 == 0, F.lit("{'Th\\xe9': 7, 'None': None}"))
                  .when(k % 31 == 0, F.lit("{'Tea' 7}"))
                  .when(k % 37 == 0, F.lit("{u'Gifts': 12L,}"))
                  .when(k % 41 == 0, F.lit("{'Tools': 1.5}"))
                  .otherwise(F.concat(F.lit("{'"), F.col("p_brand"), F.lit("': "),
                                      F.col("p_size").cast("string"), F.lit("}"))))
    related = (F.when(k % 3 == 0, null_s)
               .when(k % 4 == 0, F.lit("{'also_viewed': []}"))
               .when(k % 29 == 0, F.lit("{'bought_together': None, 'also_viewed': ['0000000002']}"))
               .when(k % 31 == 0, F.lit("{'also_viewed': ["))
               .when(k % 37 == 0, F.lit("{u'also_viewed': ('0000000003', '0000000004'),}"))
               .otherwise(F.concat(
                   F.lit("{'also_viewed': ["), _id_text((k * 7 + 13) % 2100), F.lit(", "),
                   _id_text((k * 11 + 5) % 2100), F.lit("], 'bought_together': ["),
                   _id_text((k + 1) % 2100), F.lit("]}"))))
    return p.select(
        _asin(k).alias("asin"),
        F.when(k % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("p_retailprice")).alias("price"),
        F.when(k % 11 == 0, null_s).when(k % 13 == 0, F.lit("")).otherwise(F.col("p_name")).alias("title"),
        categories.alias("categories"),
        sales_rank.alias("salesRank"),
        related.alias("related"),
    )


def product_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed ``product`` table: nested fields as arrays and maps."""
    return typed_products(products(spark, sf_dir))


def review_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed ``review`` table (asin, reviewerID, overall)."""
    return reviews(spark, sf_dir).select("asin", "reviewerID", "overall")


def product_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``product_processed`` for the word-vector job: one whole document
    text per row as ``title``."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select(_asin(F.col("doc_id")).alias("asin"), F.col("text").alias("title"))


def product_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``product_processed`` for the category-encoding job (25 levels)."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand"])
    return p.select(_asin(F.col("p_partkey")).alias("asin"), F.col("p_brand").alias("category"))


def gappy_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The categories with every 17th one missing."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand"])
    return p.select(_asin(F.col("p_partkey")).alias("asin"),
                    F.when(F.col("p_partkey") % 17 != 0, F.col("p_brand")).alias("category"))


def linked_pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Products and reviews whose price and rating both rise with the product
    number, the price on an offset of 1e8: a real correlation."""
    number = F.col("asin").cast("long")
    priced = products(spark, sf_dir).select(
        "asin", F.when(F.col("price").isNotNull(), number + 100000000.0).alias("price"))
    rated = reviews(spark, sf_dir).select("asin", (F.col("overall") + number / 500.0).alias("overall"))
    return priced, rated


FEATURE_COLUMNS = ("l_extendedprice", "l_discount", "l_tax", "l_linenumber")


def ml_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows for the regression jobs: a stable key, four numeric features
    and the label ``overall`` (= l_quantity)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity",
                                                "l_extendedprice", "l_discount", "l_tax"])
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("row_key"),
        *[F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS],
        F.col("l_quantity").cast("double").alias("overall"),
    )


def planted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with a label that steps by 1,000 between the third and the
    fourth line of an order, on top of the quantity."""
    step = F.when(F.col("l_linenumber") > 3, 1000.0).otherwise(0.0)
    return ml_rows(spark, sf_dir).withColumn("overall", F.col("overall") + step)
