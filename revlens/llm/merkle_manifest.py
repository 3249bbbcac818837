"""Merkle manifest of a table, as a content-addressed graph, with proofs.

A row's leaf is the SHA-256 of its fields.  The leaves of a source, ascending
by the order column, form a tree of fan-out 3; the sources' top digests, in
order of source, form the tree above them.  The manifest is a table of records
digest -> children: a record is found by its digest alone, and equal subtrees
share one record.

Proofs come from descent.  Requests for leaves start at the root; at each
level the requests of a node are looked up by the node's digest, go on to the
child that the next base-3 digit of the rank names, and keep the children
that were not selected.  Requests with equal leading digits are one row until
they part, so the looked-up rows sum to at most 1.5 times the leaves.  The
collected path segments, reversed, are the proof from the leaf to the root.

Scale: leaves are ranked by range partition and partial counts (no source is
ordered in one task); one shuffle folds four levels; a digest that many rows
share (repeated rows) is looked up by broadcast: a level has at most 1,000
digests that hold a thousandth of its nodes.

Rows: NULL fields count as ``-``; NULL order values come first, equal ones go
by leaf digest; an empty table has a NULL root and no rows; repeated rows are
leaves of their own; further columns are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import parallelism, shared_dir, stored

#: Children of a node.
FANOUT = 3
#: Levels folded by one shuffle.
LEVELS = 4
#: A digest with a level's nodes / HOT is looked up by broadcast.
HOT = 1000
#: The hashed fields of a row.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_WIDE = FANOUT ** LEVELS


@dataclass
class Manifest:
    """``records`` (height, digest, children, refs) of the source trees and
    ``top_records`` of the tree above; ``sources`` (tree, rank, digest, height)
    with each subroot; ``root``, or None if there are no leaves."""

    records: DataFrame
    top_records: DataFrame
    sources: DataFrame
    root: str | None


def field_text(value: Column) -> Column:
    """``-`` for NULL, else the UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field_text, values)), 256)


def tree_key(source: Column) -> Column:
    """A key that is never NULL, in the order of sources with NULL first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def ranked(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``rank``, from 0 within its group, and ``n``, the group's
    rows.  Rows are sorted by range partition; a group's rank starts at the
    sum of its counts in earlier partitions."""
    parts = parallelism(df.sparkSession)
    keys = [group, *order]
    dealt = stored(
        df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id()), name)
    counts = dealt.groupBy("_part", group).agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn(
        "n", F.sum("_n").over(Window.partitionBy(group)))
    return dealt.join(counts, ["_part", group]).withColumn(
        "rank", F.col("_before") + F.col("_place") - F.col("_first")).drop("_part", "_place", "_first", "_n", "_before")


def _runs(nodes: Column) -> Column:
    """Every three consecutive digests, the last run may have fewer."""
    last = F.ceil(F.size(nodes) / FANOUT).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(nodes, i * FANOUT + 1, FANOUT))


def _digests(runs: Column) -> Column:
    return F.transform(runs, lambda run: F.sha2(F.array_join(run, ""), 256))


def _records(runs: Column, height: Column) -> Column:
    return F.transform(runs, lambda run: F.struct(
        height.alias("height"), F.sha2(F.array_join(run, ""), 256).alias("digest"), run.alias("children")))


def build(leaves: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Records (height, digest, children, refs) and top digests (tree, digest,
    height) of all trees.  ``leaves``: tree, rank, digest, n."""
    rest = leaves.select("tree", "rank", "digest", "n", F.lit(0).alias("height"))
    most = rest.agg(F.max("n")).first()[0] or 0
    found, tops = [], [rest.where("n = 1")]
    while most > 1:
        place = F.floor(F.col("rank") / _WIDE).cast("long")
        groups = rest.where("n > 1").groupBy("tree", "n", "height", place.alias("at")).agg(
            F.transform(F.sort_array(F.collect_list(F.struct("rank", "digest"))), lambda x: x["digest"]).alias("l0"))
        levels = F.lit(LEVELS)
        for low in range(LEVELS - 1, 0, -1):
            levels = F.when(F.col("n") <= FANOUT ** low, F.lit(low)).otherwise(levels)
        groups = groups.withColumn("levels", levels).withColumn("top", F.col("l0"))
        for i in range(LEVELS):
            goes = F.col("levels") > i
            groups = groups.withColumn(f"r{i}", F.when(goes, _runs(F.col("top"))).otherwise(
                F.array().cast("array<array<string>>")))
            groups = groups.withColumn("top", F.when(goes, _digests(F.col(f"r{i}"))).otherwise(F.col("top")))
        groups = stored(groups.drop("l0"), name)
        records = F.flatten(F.array(*(_records(F.col(f"r{i}"), F.col("height") + i + 1) for i in range(LEVELS))))
        found.append(groups.select(F.explode(records).alias("r")).select("r.*"))
        rest = groups.select(
            "tree", F.col("at").alias("rank"), F.get("top", F.lit(0)).alias("digest"),
            F.ceil(F.col("n") / _WIDE).cast("long").alias("n"), (F.col("height") + F.col("levels")).alias("height"))
        tops.append(rest.where("n = 1"))
        most = -(-most // _WIDE)
    spark, path = leaves.sparkSession, f"{shared_dir(leaves.sparkSession)}/{name}-records-{uuid.uuid4().hex}"
    if found:
        every = found[0]
        for records in found[1:]:
            every = every.union(records)
    else:
        every = spark.createDataFrame([], "height int, digest string, children array<string>")
    every.groupBy("height", "digest").agg(F.first("children").alias("children"), F.count("*").alias("refs")) \
        .write.partitionBy("height").parquet(path)
    top = tops[0]
    for more in tops[1:]:
        top = top.union(more)
    records = spark.read.schema("digest string, children array<string>, refs long, height int").parquet(path)
    return records, top.select("tree", "digest", "height")


def manifest(leaves: DataFrame) -> Manifest:
    """The manifest of ranked leaves: tree, rank, digest, n."""
    records, tops = build(leaves, "merkle")
    sources = stored(ranked(tops.withColumn("top", F.lit(0)), "top", ["tree"], "merkle-sources"), "merkle-sources")
    top_records, root = build(sources.select(F.lit("").alias("tree"), "rank", "digest", "n"), "merkle-top")
    found = root.first()
    return Manifest(records, top_records, sources.select("tree", "rank", "digest", "height"), found and found["digest"])


def descend(records: DataFrame, starts: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """Leaves below ``starts`` (tree, digest, height, path and any columns to
    keep): their tree, rank, digest and path, a list of (digit, others) from
    the root on.  ``requests`` (tree, rank) names the wanted leaves, by default
    all of the trees."""
    totals = {r["height"]: r["n"] for r in records.groupBy("height").agg(F.sum("refs").alias("n")).collect()}
    hot_of = {h: records.where((F.col("height") == h) & (F.col("refs") * HOT >= n)).select("digest", "children")
              for h, n in totals.items()}
    hot_refs = {h: hot_of[h].count() if n > HOT else None for h, n in totals.items()}
    keep = [c for c in starts.columns if c not in ("digest", "height", "path")]
    now = None
    for h in range(max(totals, default=0), -1, -1):
        # Trees of this height join the requests that come from higher ones.
        at = starts.where(F.col("height") == h).select(*keep, F.lit(0).cast("long").alias("rank"), "digest", "path")
        now = at if now is None else now.unionByName(at)
        if h == 0:
            return now
        hot, cold = F.broadcast(hot_of[h]), records.where((F.col("height") == h) & (F.col("refs") * HOT < totals[h]))
        cold = cold.select("digest", "children")
        if totals[h] <= HOT:
            met = now.join(hot, "digest")
        elif not hot_refs[h]:
            met = now.join(cold, "digest")
        else:
            now = stored(now, "merkle-descent")
            met = now.join(hot, "digest").unionByName(
                now.join(F.broadcast(hot_of[h].select("digest")), "digest", "left_anti").join(cold, "digest"))
        step = met.select(*keep, "rank", "path", "children", F.posexplode("children").alias("digit", "child"))
        others = F.concat(F.slice("children", F.lit(1), F.col("digit")), F.slice("children", F.col("digit") + 2, F.lit(FANOUT)))
        now = step.select(*keep, (F.col("rank") * FANOUT + F.col("digit")).alias("rank"), F.col("child").alias("digest"),
                          F.concat("path", F.array(F.struct("digit", others.alias("others")))).alias("path"))
        if requests is not None:
            wanted = requests.select("tree", F.floor(F.col("rank") / FANOUT ** (h - 1)).cast("long").alias("rank")).distinct()
            now = now.join(wanted, ["tree", "rank"], "left_semi")


_PATH = "array<struct<digit:int,others:array<string>>>"


def prove(made: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """tree, rank, digest, subroot and path (root to leaf) of every requested
    leaf."""
    top = made.sources.sparkSession.createDataFrame([(made.root,)], "digest string")
    height = made.top_records.agg(F.max("height")).first()[0] or 0
    top = descend(made.top_records, top.select(F.lit("").alias("tree"), "digest", F.lit(height).alias("height"),
                                               F.array().cast(_PATH).alias("path")))
    starts = made.sources.withColumnRenamed("digest", "subroot").join(
        top.select("rank", F.col("digest").alias("subroot"), "path"), ["rank", "subroot"])
    starts = stored(starts.select("tree", "subroot", F.col("subroot").alias("digest"), "height", "path"), "merkle-starts")
    if requests is not None:
        starts = starts.join(requests.select("tree").distinct(), "tree", "left_semi")
    return descend(made.records, starts, requests)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way (root to leaf) give."""
    return F.aggregate(F.reverse(path), leaf, lambda acc, p: F.sha2(F.concat(
        F.array_join(F.slice(p["others"], F.lit(1), p["digit"]), ""), acc,
        F.array_join(F.slice(p["others"], p["digit"] + 1, F.lit(FANOUT)), "")), 256))


def siblings(path: Column) -> Column:
    """All siblings from the leaf's level up, left to right within a level."""
    return F.flatten(F.transform(F.reverse(path), lambda p: p["others"]))


def leaves_of(docs: DataFrame, source: str = "source", order: str = "doc_id", fields=FIELDS,
              altered: dict[str, Column] | None = None) -> DataFrame:
    """Ranked leaves: tree, rank, n, digest, the order column as ``ordered``;
    with ``altered`` (field -> its other value) also ``other``, the digest that
    the row would then have."""
    changed = [(altered or {}).get(c, F.col(c)) for c in fields]
    rows = docs.select(
        tree_key(F.col(source)).alias("tree"), F.col(order).alias("ordered"),
        leaf_digest([F.col(c) for c in fields]).alias("digest"), leaf_digest(changed).alias("other"),
        F.monotonically_increasing_id().alias("row"))
    return stored(ranked(stored(rows, "merkle-leaves"), "tree", ["ordered", "digest", "row"], "merkle-ranked"), "merkle-ranks")


def audited(docs: DataFrame, altered: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: ordered (its doc_id), leaf, subroot, root,
    path, folded_root (of the altered row with the manifest's siblings) and
    verified."""
    leaves = leaves_of(docs, altered=altered)
    made = manifest(leaves.select("tree", "rank", "digest", "n"))
    proofs = prove(made).withColumnRenamed("digest", "leaf")
    rows = leaves.select("tree", "rank", "ordered", "other").join(proofs, ["tree", "rank"])
    return rows.withColumn("root", F.lit(made.root).cast("string")).withColumn(
        "folded_root", fold(F.col("other"), F.col("path"))).withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The text without line feeds in rows whose id has an even CRC-32."""
    return F.when(F.crc32(doc_id.cast("string")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
