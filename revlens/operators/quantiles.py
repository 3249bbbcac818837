"""Exact quantiles that scale with the number of rows.

Spark's exact ``percentile`` merges a value -> count map of a whole group in
one task, so its memory grows with the number of distinct values.  Two
distributed methods are offered here.

``frequency``  Rows are reduced to ``(group, value, n)`` by a distributed
    aggregation first, then ``percentile(value, p, n)`` runs on that table.
    The merge task of a group sees each distinct value once.  Right for
    small value domains (ratings, years, vote counts, prices).

``count``      (default) Selection by counting, four passes over the values:

    1. values are counted in buckets of equal ratio (32 per factor of two);
       running sums of the counts give, for every wanted rank, the bucket
       that holds it, the bucket's least and greatest value, and the rank
       inside the bucket;
    2. and 3. only values inside those buckets are counted again, each time
       in 262,144 equal parts of the bucket's own range;
    4. what is left is counted by value.

    A task sorts buckets, never values: the buckets of one range are at most
    262,144 whatever the input, and after three passes a part spans at most
    some 4,096 neighbouring doubles, so the last pass is bounded too.  The
    bucket of a value is a monotone function of it, hence the result is
    exact for any distribution.  Counting is a partial aggregation, so a
    value held by a third of all rows is one row per map task.
    Quantiles interpolate linearly between ranks floor(h) and ceil(h) with
    h = p * (N - 1), as pandas and SQL ``quantile_cont``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets per factor of two in the first pass.
RATIO_BUCKETS = 32
#: Equal parts that a range is cut into by a later pass.
PARTS = 1 << 18


def frequency_table(df: DataFrame, value_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """``(group..., value, n)`` over non-NULL values."""
    return (df.where(F.col(value_col).isNotNull())
              .groupBy(*group_cols, value_col)
              .agg(F.count(F.lit(1)).alias("n")))


def _frequency_quantiles(df, value_col, probs, group_cols, out_col):
    freq = frequency_table(df, value_col, group_cols)
    agg = F.percentile(F.col(value_col), list(probs), F.col("n")).alias(out_col)
    return freq.groupBy(*group_cols).agg(agg) if group_cols else freq.agg(agg)


def _agg(df: DataFrame, group_cols: Sequence[str], *cols: Column) -> DataFrame:
    return df.groupBy(*group_cols).agg(*cols) if group_cols else df.agg(*cols)


def _join(df: DataFrame, other: DataFrame, group_cols: Sequence[str], few_groups: bool) -> DataFrame:
    """Attach the one-row-per-group table ``other`` to every row of ``df``.

    With few groups a shuffle join on the group key would send each group's
    rows to one task, so ``other`` is broadcast: it has one row per group, and
    the groups are a given list (``few_groups``).  With
    many groups the shuffle is balanced and AQE decides.  Without groups
    ``other`` is one row, attached as a scalar subquery."""
    if group_cols:
        return df.join(F.broadcast(other) if few_groups else other, list(group_cols))
    s = other.select(F.struct(*other.columns).alias("_s")).scalar()
    return df.select("*", *[s.getField(c).alias(c) for c in other.columns])


def _ratio_bucket(v: Column) -> Column:
    """A whole number that never falls as ``v`` rises; within a bucket values
    differ by a factor of at most 2^(1/32).  NaN is the greatest value."""
    # Doubles lie between 2^-1074 and 2^1024; infinities get a bucket of their own.
    size = F.floor(F.least(F.log2(F.abs(v)) + 1076, F.lit(2150.0)) * RATIO_BUCKETS)
    return F.when(F.isnan(v), F.lit(1 << 20)).when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0)).cast("long")


def _part(v: Column, lo: Column, hi: Column, parts: int) -> Column:
    """Which of ``parts`` equal parts of [lo, hi] holds ``v``."""
    share = F.floor((v - lo) / (hi - lo) * parts)
    return F.when(lo == hi, F.lit(0)).otherwise(F.least(share, F.lit(parts - 1))).cast("long")


def _holding(counts: DataFrame, keys: Sequence[str], by: str, targets: Column, g: Sequence[str]) -> DataFrame:
    """The rows of ``counts`` (n, lo, hi per bucket ``by``) that hold one of the
    ``targets``, an array of (i, k, h) per row: i, h, the rank k within the
    bucket, and the bucket's lo and hi."""
    w = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    summed = counts.withColumn("_cum", F.sum("_n").over(w)).withColumn("_targets", targets)
    before = F.col("_cum") - F.col("_n")
    inside = F.filter("_targets", lambda t: (t["k"] >= before) & (t["k"] < F.col("_cum")))
    return summed.withColumn("_t", F.explode(inside)).select(
        *g, "_lo", "_hi", F.col("_t.i").alias("_i"), (F.col("_t.k") - before).alias("_k"), F.col("_t.h").alias("_h"))


def _narrowed(vals: DataFrame, state: DataFrame, g: Sequence[str], few_groups: bool, parts: int | None) -> DataFrame:
    """One more pass: each target's range is cut into ``parts`` (None: into its
    values) and replaced by the part that holds the target."""
    small = few_groups or not g
    ranges = _agg(state, g, F.collect_set(F.struct(F.col("_lo").alias("lo"), F.col("_hi").alias("hi"))).alias("_ranges"))
    v = F.col("_v")
    # Ranges of a group are disjoint: a value lies in at most one.
    mine = F.get(F.filter("_ranges", lambda r: (v >= r["lo"]) & (v <= r["hi"])), F.lit(0))
    rows = _join(vals, ranges, g, few_groups).withColumn("_r", mine).where(F.col("_r").isNotNull())
    rows = rows.select(*g, "_v", F.col("_r.lo").alias("_l"), F.col("_r.hi").alias("_u"))
    part = v if parts is None else _part(v, F.col("_l"), F.col("_u"), parts)
    counts = rows.groupBy(*g, "_l", "_u", part.alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    wanted = state.groupBy(*g, F.col("_lo").alias("_l"), F.col("_hi").alias("_u")).agg(F.collect_list(
        F.struct(F.col("_i").alias("i"), F.col("_k").alias("k"), F.col("_h").alias("h"))).alias("_wanted"))
    # At most two targets per probability and group.
    met = counts.join(F.broadcast(wanted) if small else wanted, [*g, "_l", "_u"])
    return _holding(met, [*g, "_l", "_u"], "_b", F.col("_wanted"), g)


def _count_quantiles(df, value_col, probs, group_cols, out_col, few_groups, discrete, keep_empty_groups, parts):
    g, m = list(group_cols), len(probs)
    every = df.select(*g, F.col(value_col).cast("double").alias("_v"))
    vals = every.where(F.col("_v").isNotNull())
    counts = vals.groupBy(*g, _ratio_bucket(F.col("_v")).alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    counts = counts.withColumn("_total", F.sum("_n").over(Window.partitionBy(*g)))
    total = F.col("_total").cast("double")
    # Position h (0-based): interpolated between floor(h) and ceil(h); the
    # discrete quantile is the value at ceil(p * N) - 1, as percentile_disc.
    places = [F.greatest(F.ceil(total * F.lit(p)) - 1, F.lit(0)).cast("double") if discrete else (total - 1) * F.lit(p)
              for p in probs]
    targets = F.array(*(F.struct(F.lit(2 * i + up).alias("i"), (F.ceil(h) if up else F.floor(h)).cast("long").alias("k"),
                                 h.alias("h")) for i, h in enumerate(places) for up in (0, 1)))
    state = _holding(counts, g, "_b", targets, g)
    for cut in (parts, parts, None):
        state = _narrowed(vals, state, g, few_groups, cut)
    ends = [F.max(F.when(F.col("_i") == j, F.col("_lo"))).alias(f"_v{j}") for j in range(2 * m)]
    ends += [F.max(F.when(F.col("_i") == 2 * i, F.col("_h") - F.floor("_h"))).alias(f"_f{i}") for i in range(m)]
    found = _agg(state, g, *ends)
    if g and keep_empty_groups:
        # Groups whose values are all NULL stay, with NULL quantiles.
        found = every.select(*g).distinct().join(found, g, "left")
    low, high = ([F.col(f"_v{2 * i + up}") for i in range(m)] for up in (0, 1))
    # Equal ends are taken as they are: infinities have no difference.
    qs = [F.when(a == b, a).otherwise(a + F.col(f"_f{i}") * (b - a)) for i, (a, b) in enumerate(zip(low, high))]
    return found.select(*g, F.array(*qs).alias(out_col))


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), out_col: str = "qs",
                    method: str = "count", known_groups: Sequence | None = None,
                    discrete: bool = False, keep_empty_groups: bool = False,
                    parts: int = PARTS) -> DataFrame:
    """Quantiles per group as an array: interpolated (``quantile_cont``), or
    with ``discrete`` an actual value of the column (``percentile_disc``).

    ``known_groups``: the values of the one group column that are wanted,
    where they are known beforehand (e.g. the columns described).  Only those
    groups are computed, so the per-group tables have at most that many rows
    and are broadcast instead of shuffling rows by a few-valued key.
    Groups whose values are all NULL are left out unless
    ``keep_empty_groups`` (then they get NULL quantiles).  Without groups
    the result is always one row.  NULL values are left out; NaN counts as
    the greatest value, as in Spark's order.  ``parts`` only sets how much
    each pass narrows."""
    if method == "frequency" and not discrete:
        return _frequency_quantiles(df, value_col, probs, list(group_cols), out_col)
    if method in ("count", "frequency"):
        if known_groups is not None:
            (group,) = group_cols
            df = df.where(F.col(group).isin(list(known_groups)))
        return _count_quantiles(df, value_col, list(probs), group_cols, out_col, known_groups is not None,
                                discrete, keep_empty_groups, parts)
    raise ValueError(f"unknown method {method!r}")


def exact_lower_median(df: DataFrame, col: str) -> DataFrame:
    """One row ``median``: the discrete median (``percentile_disc(0.5)``),
    an actual value of the column and the exact counterpart of
    ``percentile_approx(col, 0.5)``, by counting selection."""
    q = exact_quantiles(df, col, [0.5], discrete=True)
    return q.select(F.get(F.col("qs"), 0).alias("median"))
