"""CSV in, JSON document out: the two report entry points end to end on a
small hand-written dump (expected values computed by hand)."""

import json
import os
import tempfile

import pytest

from revlens.plans.entrypoints import run_catalog_questions, run_reviewer_statistics

REVIEWS = """asin,reviewerID,reviewerName,helpful,reviewText,overall,summary,unixReviewTime,reviewTime
P000000001,U1,Ann,"[1, 2]","great
book",5.0,ok,1262390400,"01 2, 2010"
P000000001,U2,,"[0, 0]",meh,3.0,so so,1336176000,"05 5, 2012"
P000000002,U1,Ann,"[2, 3]",fine,4.0,fine,1310000000,"07 7, 2011"
P000000009,U3,Bob,"[0, 1]",lost,1.0,nan,1300000000,NA
"""

PRODUCTS = """asin,salesRank,imUrl,categories,title,description,price,related,brand
P000000001,"{'Books': 3}",u1,"[['Books', 'Fiction']]",A book,,10.0,"{'also_viewed': ['P000000002', 'P000000003']}",
P000000002,,u2,"[['Books']]",Another,,20.0,"{'also_viewed': ['P000000001']}",X
P000000003,,,"[['Toys & Games']]",,,,,
P000000004,,u4,"[['']]",Thing,d,40.0,"{'bought_together': ['P000000001']}",Y
"""


@pytest.fixture
def files():
    d = tempfile.mkdtemp(prefix="revlens-e2e-")
    r, p = os.path.join(d, "reviews.csv"), os.path.join(d, "products.csv")
    with open(r, "w") as f:
        f.write(REVIEWS)
    with open(p, "w") as f:
        f.write(PRODUCTS)
    return d, r, p


def _doc(path):
    part = [f for f in os.listdir(path) if f.endswith(".json")][0]
    with open(os.path.join(path, part)) as f:
        return json.loads(json.loads(f.readline())["json"])


def test_reviewer_statistics(spark, files):
    d, r, _ = files
    out = os.path.join(d, "pa0")
    run_reviewer_statistics(spark, r, out, land_dir=os.path.join(d, "land"))
    doc = _doc(out)
    # Reviewers: U1 (2 dated reviews, mean 4.5, since 2010, 3/5 votes),
    # U2 (1, 3.0, 2012, 0/0), U3 (0 dated, 1.0, no year, 0/1).
    npr = doc["number_products_rated"]
    assert (npr["count"], npr["mean"], npr["std"], npr["min"], npr["25%"], npr["50%"], npr["75%"], npr["max"]) \
        == (3.0, 1.0, 1.0, 0.0, 0.5, 1.0, 1.5, 2.0)
    assert doc["reviewing_since"]["count"] == 2.0 and doc["reviewing_since"]["min"] == 2010.0
    assert doc["avg_ratings"]["mean"] == round((4.5 + 3.0 + 1.0) / 3, 2)
    assert doc["total_votes"]["max"] == 5.0
    assert list(doc) == ["number_products_rated", "avg_ratings", "reviewing_since",
                         "helpful_votes", "total_votes"]


def test_catalog_questions(spark, files):
    d, r, p = files
    out = os.path.join(d, "pa1")
    run_catalog_questions(spark, r, p, out)
    doc = _doc(out)
    assert doc["q1"]["reviews"]["reviewerName"] == 25.0
    assert doc["q1"]["reviews"]["summary"] == 25.0   # 'nan' is missing
    assert doc["q1"]["products"]["price"] == 25.0
    assert doc["q1"]["products"]["brand"] == 50.0
    # q2: pairs (10,5), (10,3), (20,4): corr = 0.0 exactly -> 0.0
    assert doc["q2"] == 0.0
    assert doc["q3"] == {"mean": 23.33, "std": 15.28, "50%": 20.0, "min": 10.0, "max": 40.0}
    assert doc["q4"] == {"Books": 2, "": 1, "Toys & Games": 1}
    assert doc["q5"] == 1 and doc["q6"] == 1
    assert list(doc) == ["q1", "q2", "q3", "q4", "q5", "q6"]
