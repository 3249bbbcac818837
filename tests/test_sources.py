"""CSV source, typed catalog, sinks and document assembly."""

import json
import os
import tempfile

import pytest

from revlens.sources import csv as CSV
from revlens.sources.sinks import json_document, json_objects, json_value
from revlens.sources.typed import typed_products


def _write(text):
    d = tempfile.mkdtemp(prefix="revlens-test-")
    p = os.path.join(d, "in.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_csv_quoted_newline_and_missing_tokens(spark):
    p = _write('asin,reviewerName,reviewText,overall,summary,unixReviewTime\n'
               'A1,"","line one\nline two",NA,nan,null\n')
    df = CSV.read_reviews_csv(spark, p)
    rows = df.collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.reviewText == "line one\nline two"
    assert (r.reviewerName, r.overall, r.summary, r.unixReviewTime) == (None, None, None, None)
    assert dict(df.dtypes)["overall"] == "double"


def test_csv_column_subset_and_bad_numbers(spark):
    p = _write('asin,price,title\nB1,12.5,t\nB2,abc,u\nB3,NaN,\n')
    rows = CSV.read_products_csv(spark, p, ["asin", "price"]).collect()
    assert [(r.asin, r.price) for r in rows] == [("B1", 12.5), ("B2", None), ("B3", None)]


def test_typed_products(spark):
    df = spark.createDataFrame([("a", "[['x', 'y']]", "{'R': 4}", "{'also_viewed': ['b']}")],
                               "asin string, categories string, salesRank string, related string")
    r = typed_products(df).first()
    assert r.categories == [["x", "y"]] and r.salesRank == {"R": 4}
    assert r.related == {"also_viewed": ["b"]}


def test_json_document(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5)], "k string, n long")
    from pyspark.sql import functions as F
    doc = json_document({
        "q4": json_objects(counts, "k", "n", sort=[-F.col("n")]),
        "q5": json_value(spark.createDataFrame([(1,)], "x int"), "x"),
        "q2": json_value(spark.createDataFrame([(None,)], "x double"), "x"),
    }).first()["json"]
    assert doc == '{"q2": null, "q4": {"c": 5, "a": 2, "b": 2}, "q5": 1}'
    assert json.loads(doc)["q4"] == {"c": 5, "a": 2, "b": 2}


def test_result_store_versions(spark, monkeypatch):
    from pyspark.sql import functions as F

    from revlens.sources.store import ResultStore
    store = ResultStore(spark, tempfile.mkdtemp(prefix="revlens-test-"))
    first = spark.createDataFrame([(1, 2.5, [1, 2], None)], "count_total long, mean double, `a b` array<int>, none string")
    assert store.save(first, "task_1") == 1
    assert store.save(first.withColumn("mean", F.lit(9.0)), "task_1") == 2
    assert store.versions("task_1") == [1, 2] and store.versions("task_2") == []
    assert store.read("task_1", 1).collect() == first.collect() and store.read("task_1").schema == first.schema
    assert store.read("task_1").first()["mean"] == 9.0
    # A result that fails while it is computed, and a commit that fails.
    bad = spark.createDataFrame([(0,)], "x int").select(F.raise_error(F.lit("broken")).cast("long").alias("count_total"))
    with pytest.raises(Exception, match="broken"):
        store.save(bad, "task_1")
    monkeypatch.setattr("revlens.sources.store._MANIFEST", "version long, path string, kind string, no such type")
    with pytest.raises(Exception):
        store.save(first, "task_1")
    monkeypatch.undo()
    assert store.versions("task_1") == [1, 2] and store.read("task_1").first()["mean"] == 9.0
    assert store.save(first, "task_1") == 3
    with pytest.raises(KeyError):
        store.read("task_1", 7)


def test_large_results_are_refused(spark):
    from revlens.sources import sinks
    with pytest.raises(ValueError):
        sinks.write_json(spark.range(sinks.MOST_ROWS + 1), tempfile.mkdtemp(prefix="revlens-test-") + "/big")


def test_result_dict(spark):
    from revlens.sources.sinks import result_dict
    assert result_dict(spark.createDataFrame([(3, 1.5)], "count_total long, mean double")) == \
        {"count_total": 3, "mean": 1.5}
    with pytest.raises(ValueError):
        result_dict(spark.range(2))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_split_csv_equals_whole_read(spark):
    import random
    rnd = random.Random(2)
    d = tempfile.mkdtemp(prefix="revlens-csv-")
    for k, newline in enumerate(("\n", "\r\n", "\n")):
        rows = [["id", "note", "other text"]]
        for i in range(400):
            note = "".join(rnd.choice(["a", "é", ",", '""', "\n", " ", "NA", "x" * 30]) for _ in range(rnd.randrange(12)))
            rows.append([f"{k}-{i}", f'"{note}"' if note else "", rnd.choice(["", "plain", '"q,""uoted"" "', '"\n\n"'])])
        with open(os.path.join(d, f"{k}.csv"), "w", newline="") as f:
            f.write(newline.join(",".join(r) for r in rows) + ("" if k == 2 else newline))
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        split, whole = CSV.read_text_csv(spark, d), CSV.read_whole_csv(spark, d)
        assert spark.read.text(d).rdd.getNumPartitions() > 12 and whole.rdd.getNumPartitions() <= 3
        assert split.columns == whole.columns == ["id", "note", "other text"]
        assert _rows(split) == _rows(whole) and split.count() == 1200
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_bad_records_are_counted_and_kept(spark):
    p = _write('asin,price,title\nB1,12.5,t\nB2,abc,u\nB3,NaN,\nB4,1.0\nB5,2.0,x,y\n\nB6,,z\n')
    got = CSV.csv_problems(spark, p, CSV.PRODUCT_SCHEMA).first().asDict()
    assert got == {"records": 6, "malformed": 2, "price_bad": 1}
    rows = {r.asin: (r.price, r.title) for r in CSV.read_products_csv(spark, p).collect()}
    assert rows["B4"] == (1.0, None) and rows["B5"][0] == 2.0 and len(rows) == 6


def test_stray_quote_does_not_swallow_the_file(spark):
    p = _write('asin,price,title\nB1,12.5,5" screen\nB2,3.5,u\nB3,1.0,v\n')
    rows = CSV.read_products_csv(spark, p).collect()
    assert sorted((r.asin, r.price) for r in rows) == [("B1", 12.5), ("B2", 3.5), ("B3", 1.0)]
