"""Column profiling: missing-value shares, ``describe`` statistics, rounding.

Each operator is one aggregation pass (partial aggregation in every map
task, a tiny final merge) followed by a narrow reshape to a long table, so
its cost is a single scan of the input whatever the number of columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.operators.quantiles import exact_quantiles

# The statistic names of a pandas-style ``describe``.
DESCRIBE_STATS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")
QUANTILE_STATS = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


def _long(rows: Sequence[Column]) -> Column:
    """Array of structs -> rows via ``inline`` (a narrow Generate)."""
    return F.inline(F.array(*rows))


def null_percentage(df: DataFrame, places: int = 4, column_name: str = "column",
                    value_name: str = "null_pct") -> DataFrame:
    """A10: percent of NULL values per column, ``round(mean(isnull), places)
    * 100`` as the reference reports it (then rounded to ``places - 2``
    decimals, which only removes the binary noise of the product).  One
    pass over ``df``."""
    shares = df.agg(*[F.avg(flag.cast("double")).alias(f"_{i}") for i, flag in enumerate(missing_flags(df))])
    return shares_table(shares, df.columns, [F.col(f"_{i}") for i in range(len(df.columns))],
                        places, column_name, value_name)


def missing_flags(df: DataFrame) -> list[Column]:
    """Per column whether a row's value is missing: NULL or, as in pandas, NaN."""
    fractional = {f.name for f in df.schema.fields
                  if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    flags = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        flags.append((col.isNull() | F.isnan(col)) if c in fractional else col.isNull())
    return flags


def shares_table(row: DataFrame, columns: Sequence[str], shares: Sequence[Column], places: int = 4,
                 column_name: str = "column", value_name: str = "null_pct") -> DataFrame:
    """One row with a share per column -> a row per column with the percentage."""
    return row.select(_long([
        F.struct(F.lit(c).alias(column_name),
                 F.bround(F.bround(share, places) * 100, places - 2).alias(value_name))
        for c, share in zip(columns, shares)]))


def _moment(stat: str, c: Column) -> Column:
    return {
        "count": F.count(c).cast("double"),
        "mean": F.avg(c),
        "std": F.stddev_samp(c),
        "min": F.min(c),
        "max": F.max(c),
    }[stat]


def describe(df: DataFrame, columns: Sequence[str] | None = None,
             stats: Sequence[str] = DESCRIBE_STATS, places: int | None = None,
             approx_accuracy: int | None = None) -> DataFrame:
    """Pandas-style ``describe`` as a long table
    ``(metric, stat, value)``.

    count/mean/std/min/max come from one aggregation over the columns.
    Quartiles are exact and interpolated (pandas and SQL ``quantile_cont``),
    computed by :func:`exact_quantiles` (sketch-bracketed selection: no task
    holds a whole column); pass ``approx_accuracy`` to use the
    ``percentile_approx`` sketch alone.
    """
    columns = list(columns or [f.name for f in df.schema.fields
                               if isinstance(f.dataType, T.NumericType)])
    moment_stats = [s for s in stats if s not in QUANTILE_STATS]
    q_stats = [s for s in stats if s in QUANTILE_STATS]
    # NaN is missing, as in pandas: it would otherwise count and poison means.
    num = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c)
                      for c in columns])

    parts = []
    if moment_stats:
        row = num.agg(*[_moment(s, F.col(c)).cast("double").alias(f"{c}\u0001{s}")
                        for c in columns for s in moment_stats])
        parts.append(row.select(_long([
            F.struct(F.lit(c).alias("metric"), F.lit(s).alias("stat"),
                     F.col(f"`{c}\u0001{s}`").alias("value"))
            for c in columns for s in moment_stats])))
    if q_stats:
        probs = [QUANTILE_STATS[s] for s in q_stats]
        long_vals = num.select(_long([
            F.struct(F.lit(c).alias("metric"), F.col(c).alias("v")) for c in columns]))
        if approx_accuracy:
            q = (long_vals.groupBy("metric")
                 .agg(F.percentile_approx("v", probs, approx_accuracy).alias("qs")))
        else:
            q = exact_quantiles(long_vals, "v", probs, group_cols=["metric"],
                                known_groups=columns)
        # Every described column gets its quartile rows, NULL when it has no
        # values (empty input): the column names are constants (a one-row
        # range, so no data is read again), and the quartiles (one row per
        # column) are broadcast to them.
        metrics = df.sparkSession.range(1).select(
            F.explode(F.array(*[F.lit(c) for c in columns])).alias("metric"))
        q = metrics.join(F.broadcast(q), "metric", "left")
        parts.append(q.select("metric", _long([
            F.struct(F.lit(s).alias("stat"), F.get(F.col("qs"), i).cast("double").alias("value"))
            for i, s in enumerate(q_stats)])))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if places is not None:
        out = out.withColumn("value", F.bround("value", places))
    return out


def round_doubles(df: DataFrame, places: int) -> DataFrame:
    """Half-even rounding of every double/float column (ties as NumPy)."""
    return df.select(*[
        F.bround(F.col(f.name), places).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def stats_row(df: DataFrame, spec: Sequence[tuple[str, str, str]], places: int | None = None) -> DataFrame:
    """One row of statistics from one aggregation; ``spec`` lists (name,
    statistic, column): count (non-NULL), mean, variance (sample), nulls, or
    ``equals:<text>``.  Doubles are rounded half-even to ``places``."""
    def statistic(kind: str, c: str) -> Column:
        if kind.startswith("equals:"):
            return F.count_if(F.col(c) == kind.partition(":")[2])
        return {"count": F.count, "mean": F.avg, "variance": F.var_samp,
                "nulls": lambda x: F.count_if(F.col(x).isNull())}[kind](c)

    row = df.agg(*[statistic(kind, c).alias(name) for name, kind, c in spec])
    return row if places is None else round_doubles(row, places)
