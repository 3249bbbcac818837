"""CSV sources for review dumps and product catalogs.

The files hold free text with embedded newlines and quotes (RFC 4180).
Spark's own reader takes such a file with ``multiLine``, one task per file.
Here a file is split instead (``spark.sql.files.maxPartitionBytes``):

1. its lines are read as text, split by split;
2. a line starts a record if an even number of quotes stands before it in the
   file.  That number is the quotes of the earlier lines of its split, plus a
   running sum over the splits' totals;
3. a line that starts a record and holds an even number of quotes is a whole
   record.  The lines of the other records are put together by record number;
4. ``from_csv`` takes the fields of each record.

A file with an odd number of quotes has a stray one, and its quotes say
nothing: there every line counts as a record.  Records with too few or too many
fields are kept (missing fields are NULL) and counted by ``csv_problems``,
as are values that do not fit their column's type.

Columns are read as text first; the missing-value tokens pandas
recognises are turned into NULL, then each column is cast with ``try_cast``
(bad text becomes NULL instead of failing the job under ANSI mode) and NaN
is folded into NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.functions.parse import clean_number

# Text that pandas' CSV reader treats as missing by default.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# The columns of the two inputs, in no order (a file's header has
# the order), and their types; columns that are not named here stay text.
REVIEW_SCHEMA = {
    "asin": "string", "reviewerID": "string", "reviewerName": "string", "helpful": "string", "reviewText": "string",
    "overall": "double", "summary": "string", "unixReviewTime": "bigint", "reviewTime": "string"}
PRODUCT_SCHEMA = {
    "asin": "string", "salesRank": "string", "imUrl": "string", "categories": "string", "title": "string",
    "description": "string", "price": "double", "related": "string", "brand": "string"}

MALFORMED = "_malformed"
_FORMAT = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def header(spark: SparkSession, path: str) -> list[str]:
    """The column names in the first line."""
    return spark.read.options(header=True, inferSchema=False, **_FORMAT).csv(path).columns


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """file, record (from 1 within the file) and text of every CSV record."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    lines = lines.withColumn("quotes", F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit(""))))
    split = Window.partitionBy("file", "split").orderBy("at")
    before = split.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("inner", F.coalesce(F.sum("quotes").over(before), F.lit(0)))
    splits = lines.groupBy("file", "split").agg(
        F.sum("quotes").alias("quotes"), F.count("*").alias("lines"), F.count_if(F.col("inner") % 2 == 0).alias("even"))
    # One row per split: these windows run over the splits of a file.
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("outer", F.coalesce(F.sum("quotes").over(earlier), F.lit(0))).withColumn(
        "stray", F.sum("quotes").over(Window.partitionBy("file")) % 2 == 1)
    begun = F.when(F.col("stray"), F.col("lines")).when(F.col("outer") % 2 == 0, F.col("even")).otherwise(
        F.col("lines") - F.col("even"))
    splits = splits.withColumn("begun", begun).withColumn("records", F.coalesce(F.sum("begun").over(earlier), F.lit(0)))
    lines = lines.join(splits.select("file", "split", "outer", "stray", "records"), ["file", "split"], "left")
    # Both scans of the text have the same splits; anything else must not pass.
    known = F.when(F.col("records").isNull(), F.raise_error(F.lit("a split of the file was not counted"))).otherwise(
        F.col("records"))
    starts = F.col("stray") | ((F.col("outer") + F.col("inner")) % 2 == 0)
    upto = split.rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("starts", starts).withColumn(
        "record", known + F.sum(F.col("starts").cast("long")).over(upto))
    whole = F.col("starts") & (F.col("stray") | (F.col("quotes") % 2 == 0))
    alone = lines.where(whole).select("file", "record", F.col("line").alias("text"))
    # A record's lines, in the order of the file.
    spread = lines.where(~whole).groupBy("file", "record").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("split", "at", "line"))), lambda x: x["line"]), "\n").alias("text"))
    found = alone.unionByName(spread)
    return found.withColumn("text", F.regexp_replace("text", F.lit(r"\r$"), F.lit(""))).where("text <> ''")


def scan_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Every column as text, named by the header (or ``columns``), and
    ``_malformed``: the record, where its number of fields is wrong."""
    names = list(columns or header(spark, path))
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*names, MALFORMED])
    rows = read_records(spark, path).where("record > 1")
    fields = F.from_csv("text", schema, {**_FORMAT, "columnNameOfCorruptRecord": MALFORMED})
    return rows.select(fields.alias("r")).select("r.*")


def read_whole_csv(spark: SparkSession, path: str) -> DataFrame:
    """The same columns by Spark's multi-line reader, one task per file."""
    return spark.read.options(header=True, multiLine=True, inferSchema=False, **_FORMAT).csv(path)


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, named by the header."""
    return scan_csv(spark, path).drop(MALFORMED)


def null_tokens(df: DataFrame, tokens=MISSING_TOKENS) -> DataFrame:
    """Missing-value tokens -> NULL in every text column."""
    toks = list(tokens)
    return df.select(*[
        F.when(F.col(f"`{c}`").isin(toks), F.lit(None).cast("string"))
         .otherwise(F.col(f"`{c}`")).alias(c)
        for c in df.columns])


def apply_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.select(*[
        clean_number(F.col(f"`{c}`"), types[c]).alias(c) if c in types else F.col(f"`{c}`")
        for c in df.columns])


def read_csv_table(spark: SparkSession, path: str, schema: Mapping[str, str],
                   columns: list[str] | None = None) -> DataFrame:
    """Split read, missing tokens cleaned, columns cast by ``schema``
    (name -> type).  ``columns`` keeps a subset."""
    df = read_text_csv(spark, path)
    if columns:
        df = df.select(*columns)
    return apply_types(null_tokens(df), {c: t for c, t in schema.items() if t != "string"})


def csv_problems(spark: SparkSession, path: str, schema: Mapping[str, str]) -> DataFrame:
    """One row: records, those with a wrong number of fields (``malformed``), and
    per typed column the values that do not fit it (``<column>_bad``)."""
    rows = scan_csv(spark, path)
    typed = [c for c in rows.columns if schema.get(c, "string") != "string"]
    text = null_tokens(rows)
    bad = [F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(schema[c]).isNull()).alias(f"{c}_bad")
           for c in typed]
    return text.agg(F.count(F.lit(1)).alias("records"), F.count(MALFORMED).alias("malformed"), *bad)


def read_reviews_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    return read_csv_table(spark, path, REVIEW_SCHEMA, columns)


def read_products_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    return read_csv_table(spark, path, PRODUCT_SCHEMA, columns)


def land_parquet(df: DataFrame, path: str) -> None:
    """S3: write a CSV-derived table once as Parquet, in the partitions it has."""
    df.write.mode("overwrite").parquet(path)
