"""Hand-computed frames for the catalog and product jobs (FIXTURES.md
section 4): nulls, empty lists, duplicates and dangling ids."""

import contextlib
import io

import pytest

from revlens.functions import parse as P
from revlens.plans import catalog as C
from revlens.plans import products as PR


@pytest.fixture
def product(spark):
    rows = [("a", 1.0, {"also_viewed": ["b", "c"]}),
            ("b", 2.0, None),
            ("c", None, {"also_viewed": ["b", "b", "zz"]}),
            ("d", 5.0, {"also_viewed": []})]
    return spark.createDataFrame(rows, "asin string, price double, related map<string,array<string>>")


def test_also_viewed_means_and_counts(product):
    got = {r.asin: (r.meanPriceAlsoViewed, r.countAlsoViewed)
           for r in PR.also_viewed(product).collect()}
    assert got == {"a": (2.0, 2), "b": (None, None), "c": (2.0, 3), "d": (None, None)}


def test_also_viewed_stats(product):
    s = PR.also_viewed_stats(product).first()
    assert s.count_total == 4
    assert s.numNulls_meanPriceAlsoViewed == 2 and s.numNulls_countAlsoViewed == 2
    assert s.mean_countAlsoViewed == 2.5 and s.variance_countAlsoViewed == 0.5


def test_dangling_reviews_flag(spark):
    reviews = spark.createDataFrame([(f"A{i}",) for i in range(170)] + [(f"A{i}",) for i in range(20)],
                                    "asin string")
    products = spark.createDataFrame([(f"A{i}",) for i in range(160)], "asin string")
    r = C.dangling_reviews(reviews, products).first()
    assert (r.dangling, r.missing_ids) == (1, 10)
    r = C.dangling_reviews(products, reviews).first()
    assert (r.dangling, r.missing_ids) == (0, 0)


def test_related_vs_catalog(spark):
    rows = [("AAAAAAAAAA", "{'also_viewed': ['BBBBBBBBBB']}"),
            ("BBBBBBBBBB", "{'also_viewed': ['AAAAAAAAAA', 'AAAAAAAAAA']}"),
            ("CCCCCCCCCC", None)]
    p = spark.createDataFrame(rows, "asin string, related string")
    r = C.related_vs_catalog(p).first()
    assert (r.catalog_only, r.related_only, r.differ) == (1, 0, 1)
    r = C.related_vs_catalog(p.where("asin != 'CCCCCCCCCC'")).first()
    assert (r.catalog_only, r.related_only, r.differ) == (0, 0, 0)


def test_correlation_constant_price_is_null(spark):
    products = spark.createDataFrame([("a", 3.0), ("b", 3.0)], "asin string, price double")
    reviews = spark.createDataFrame([("a", 1.0), ("a", 5.0), ("b", 2.0)], "asin string, overall double")
    r = C.price_rating_corr(products, reviews).first()
    assert r.n_pairs == 3 and r.price_rating_corr is None


def test_correlation_with_a_common_offset(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    x = rng.normal(size=200)
    products = spark.createDataFrame([(str(i), 1e8 + float(v)) for i, v in enumerate(x)], "asin string, price double")
    pairs = [(int(i), 1e8 + float(x[i] + rng.normal() / 2)) for i in rng.integers(0, 200, 1000)]
    reviews = spark.createDataFrame([(str(i), y) for i, y in pairs], "asin string, overall double")
    r = C.price_rating_corr(products, reviews, places=12).first()
    want = np.corrcoef([x[i] for i, _ in pairs], [y - 1e8 for _, y in pairs])[0, 1]
    assert r.price_rating_corr == pytest.approx(want, abs=1e-7)


def test_correlation_matches_pairwise(spark):
    import numpy as np
    products = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 4.0), ("d", None)],
                                     "asin string, price double")
    reviews = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 4.0), ("c", 5.0), ("c", 3.0),
                                     ("d", 1.0), ("z", 5.0)], "asin string, overall double")
    x = [1.0, 1.0, 2.0, 4.0, 4.0]
    y = [1.0, 2.0, 4.0, 5.0, 3.0]
    r = C.price_rating_corr(products, reviews, places=10).first()
    assert r.n_pairs == 5
    assert r.price_rating_corr == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-9)


def test_one_row_group_variance_is_null(spark):
    review = spark.createDataFrame([("a", 4.0)], "asin string, overall double")
    product = spark.createDataFrame([("a",)], "asin string")
    s = PR.product_rating_stats(review, product).first()
    assert s.count_total == 1 and s.mean_meanRating == 4.0
    assert s.variance_meanRating is None and s.variance_countRating is None


def test_category_counts_keep_empty_drop_null(spark):
    p = spark.createDataFrame([("1", "[['Books']]"), ("2", "[['Books', 'x']]"), ("3", "[['']]"),
                               ("4", None), ("5", "[[]]"), ("6", "[['Art']]")],
                              "asin string, categories string")
    got = [(r.category, r.n) for r in C.category_counts(p).collect()]
    assert got == [("Books", 2), ("", 1), ("Art", 1)]


def test_imputation(spark):
    p = spark.createDataFrame([("a", 1.0, "x"), ("b", None, ""), ("c", 3.0, None), ("d", 10.0, "unknown")],
                              "asin string, price double, title string")
    rows = {r.asin: r for r in PR.imputed_products(p).collect()}
    assert rows["b"].meanImputedPrice == pytest.approx(14.0 / 3)
    assert rows["b"].medianImputedPrice == 3.0
    assert rows["b"].unknownImputedTitle == "unknown" and rows["c"].unknownImputedTitle == "unknown"
    s = PR.imputation_stats(p).first()
    assert s.numUnknowns_unknownImputedTitle == 3
    assert s.numNulls_meanImputedPrice == 0


def test_product_flat(spark):
    # Maps are built from text: from_json keeps the text order of entries.
    rows = [("a", [["Books", "x"]], "{'Z': 3, 'A': 1}"), ("b", [[""]], "{}"), ("c", None, None)]
    p = spark.createDataFrame(rows, "asin string, categories array<array<string>>, s string")
    p = p.select("asin", "categories", P.parse_sales_rank("s").alias("salesRank"))
    got = {r.asin: (r.category, r.bestSalesCategory, r.bestSalesRank) for r in PR.product_flat(p).collect()}
    assert got == {"a": ("Books", "Z", 3), "b": (None, None, None), "c": (None, None, None)}
    s = PR.product_flat_stats(p).first()
    assert (s.numNulls_category, s.countDistinct_category, s.countDistinct_bestSalesCategory) == (2, 1, 1)


def test_preview_head_and_tail(spark):
    df = spark.range(20).selectExpr("cast(id as string) as asin")
    assert [r.asin for r in PR.preview(df, 3).collect()] == ["0", "1", "10"]
    assert [r.asin for r in PR.preview(df, 2, last=True).collect()] == ["9", "8"]


def test_approx_median_option(spark):
    p = spark.createDataFrame([("a", 1.0, "x"), ("b", None, "y"), ("c", 3.0, "z"), ("d", 10.0, "w")],
                              "asin string, price double, title string")
    rows = {r.asin: r for r in PR.imputed_products(p, approx_accuracy=10000).collect()}
    assert rows["b"].medianImputedPrice == 3.0


def test_state_merges_like_one_table(spark):
    from revlens.plans import catalog as C
    rows = [("a", 1.0, "x"), ("a", 5.0, None), ("a", None, "y"), ("b", 4.0, "x"), (None, 3.0, None), ("c", float("nan"), "z"),
            ("b", 4.5, "q"), ("a", 2.0, "x"), ("c", None, None)]
    reviews = spark.createDataFrame(rows, "asin string, overall double, summary string")
    parts = [spark.createDataFrame(rows[i::3], reviews.schema) for i in range(3)]
    states = C.review_state(parts[0]).union(C.review_state(parts[1])).union(C.review_state(parts[2]))
    key = lambda r: str(r.asin)
    one = sorted(C.review_state(reviews).collect(), key=key)
    merged = sorted(C.merged_state(states).collect(), key=key)
    for a, b in zip(one, merged, strict=True):
        assert a.asin == b.asin and a["rows"] == b["rows"] and a.missing == b.missing and a.n == b.n
        for c in ("y", "m2", "ymin", "ymax"):
            assert (a[c] or 0) == pytest.approx(b[c] or 0), (a.asin, c)
    got = {r.column: r.null_pct for r in C.missing_shares(C.merged_state(states), reviews.columns).collect()}
    assert got == {"asin": 11.11, "overall": 33.33, "summary": 33.33}


def test_catalog_report_reads_each_input_once(spark, tmp_path):
    import os

    from revlens.plans.reports import catalog_report
    from revlens.sources import fixtures as FX
    from tests.conftest import SF_SMALL
    report = catalog_report(FX.reviews(spark, SF_SMALL), FX.products(spark, SF_SMALL))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        report.explain("formatted")
    # What is left to run reads the two written states only.
    assert "lineitem.parquet" not in buf.getvalue() and "part.parquet" not in buf.getvalue()
    assert "review-state" in buf.getvalue() and "product-facts" in buf.getvalue() and os.sep


def test_every_task_is_saved_and_read_back(spark, tmp_path):
    from pyspark.sql import functions as F

    from revlens.plans import models as MO
    from revlens.plans.tasks import TASKS, Tables, run_tasks
    from revlens.sources import fixtures as FX
    from revlens.sources.store import ResultStore
    from tests.conftest import SF_SMALL
    processed = FX.product_titles(spark, SF_SMALL).withColumn("category", F.concat(F.lit("c"), F.substring("asin", 9, 2)))
    train, test = MO.train_test(FX.ml_rows(spark, SF_SMALL), FX.FEATURE_COLUMNS)
    tables = Tables(FX.review_typed(spark, SF_SMALL), FX.product_typed(spark, SF_SMALL), processed, train, test, ["the", "and"])
    store = ResultStore(spark, str(tmp_path / "results"))
    assert run_tasks(store, tables) == {f"task_{i}": 1 for i in range(9)} and len(TASKS) == 9
    assert run_tasks(store, tables, ["task_1"]) == {"task_1": 2}
    assert store.read("task_1").first() == PR.product_rating_stats(tables.review, tables.product).first()
    words = store.read("task_5").first()
    assert words.count_total == processed.count() and len(words.word_0_synonyms) == 10
    assert len(store.read("task_6").first().meanVector_categoryPCA) == 15
    assert set(store.read("task_8").columns) >= {"test_rmse", "valid_rmse_depth_12", "best_depth"}


def test_sketches_of_parts_merge(spark):
    rows = [(str(i), float((i * 7919) % 10007)) for i in range(10007)]
    product = spark.createDataFrame(rows, "asin string, price double")
    old, new = product.where("price < 5000"), product.where("price >= 5000")
    sketches = PR.price_sketches(old).union(PR.price_sketches(new))
    got = {r.p: r.quantile for r in PR.sketch_quantiles(sketches, [0.1, 0.5, 0.9]).collect()}
    assert all(abs(q / 10007 - p) < PR.RANK_ERROR for p, q in got.items())
    assert all(r.in_bound and r.n == 10007 for r in PR.sketch_rank_errors(product, sketches, [0.1, 0.5, 0.9]).collect())
    wrong = PR.price_sketches(old)
    assert not all(r.in_bound for r in PR.sketch_rank_errors(product, wrong, [0.5, 0.9]).collect())
