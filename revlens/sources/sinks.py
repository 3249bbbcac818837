"""Result sinks (S5, S7; named results are in ``store``).

Results of these jobs are small by construction (one row of statistics, a
few dozen category counts), so they are written as one JSON file each.
The large per-product tables are written as Parquet by the caller.

``json_object`` / ``json_document`` assemble many answers into one JSON
document inside Spark (the reference filled a template by hand): each part
becomes a one-row ``json`` string, the parts are unioned (no joins) and
folded into one object in name order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.sources.scratch import written


#: Rows of a result that is written as one file.
MOST_ROWS = 100_000


def small(df: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """``df``, computed once, if it has at most ``most`` rows; a larger one is
    refused before anything is written to its place."""
    kept = written(df.limit(most + 1), "result")
    if kept.count() > most:
        raise ValueError(f"a result of more than {most} rows is no small result: write it as Parquet")
    return kept


def write_json(df: DataFrame, path: str) -> None:
    """A small result as a single JSON-lines file in ``path``."""
    small(df).coalesce(1).write.mode("overwrite").json(path)


def _quoted(c: Column) -> Column:
    """A value as JSON text: strings quoted and escaped, NULL as null."""
    j = F.to_json(F.array(c))
    return j.substr(F.lit(2), F.length(j) - 2)


def _fold(rows: DataFrame, key: Column, group: Sequence[str], sort: Sequence[Column]) -> DataFrame:
    """Rows (group..., key, json-value) -> (group..., json) objects, entries
    sorted by ``sort`` (ascending) then key."""
    entry = F.struct(*[s.alias(f"_s{i}") for i, s in enumerate(sort)],
                     key.alias("_k"), F.col("_v").alias("_v"))
    body = F.array_join(F.transform(
        F.array_sort(F.collect_list(entry)),
        lambda e: F.concat(_quoted(e["_k"]), F.lit(": "), e["_v"])), ", ")
    agg = F.concat(F.lit("{"), body, F.lit("}")).alias("json")
    return rows.groupBy(*group).agg(agg) if group else rows.agg(agg)


def json_objects(df: DataFrame, key: str, value: str, group: Sequence[str] = (),
                 sort: Sequence[Column] = (), raw: bool = False) -> DataFrame:
    """``{key: value, ...}`` per group (one row when ``group`` is empty),
    entries ordered by the ``sort`` expressions, then by key.  ``raw``
    takes ``value`` as JSON text already (nested objects).  For small
    results: each object is one value."""
    v = F.col(value) if raw else _quoted(F.col(value))
    rows = df.select(*group, F.col(key).cast("string").alias("_key"), *[
        s.alias(f"_sort{i}") for i, s in enumerate(sort)], v.alias("_v"))
    return _fold(rows, F.col("_key"), list(group),
                 [F.col(f"_sort{i}") for i in range(len(sort))])


def json_value(df: DataFrame, column: str) -> DataFrame:
    """One row ``json`` holding the single value of a one-row result."""
    return df.select(_quoted(F.col(column)).alias("json"))


def json_document(parts: Mapping[str, DataFrame]) -> DataFrame:
    """One row ``json`` = ``{name: part, ...}`` in name order, where
    each part is a one-row frame with a ``json`` column."""
    rows = None
    for name, part in parts.items():
        r = part.select(F.lit(name).alias("_key"), F.col("json").alias("_v"))
        rows = r if rows is None else rows.unionByName(r)
    return _fold(rows, F.col("_key"), [], [])


def result_dict(df: DataFrame) -> dict:
    """The single row of a one-row statistics result as a plain dict (the
    ``res`` mapping of the original tasks).  Takes at most two rows, and
    refuses anything that is not exactly one row."""
    rows = df.take(2)
    if len(rows) != 1:
        raise ValueError(f"expected a one-row result, got {len(rows)}+ rows")
    return rows[0].asDict(recursive=True)
