"""Edge cases of the parsing functions (FIXTURES.md section 4)."""

from pyspark.sql import functions as F

from revlens.functions import parse as P
from revlens.sources.typed import parse_failures


def _one(spark, rows, schema, *cols):
    return spark.createDataFrame(rows, schema).select(*cols).collect()


def test_helpful_missing_forms_give_nulls(spark):
    rows = _one(spark, [("[]",), ("[3]",), (None,), ("[2, 5]",)], "helpful string",
                P.helpful_votes("helpful").alias("h"), P.total_votes("helpful").alias("t"))
    assert [(r.h, r.t) for r in rows] == [(None, None), (3, None), (None, None), (2, 5)]


def test_year_needs_four_digits(spark):
    rows = _one(spark, [("12 3, 99",), ("07 4, 2013",), (None,), ("x 12345",)], "t string",
                P.review_year("t").alias("y"))
    assert [r.y for r in rows] == [None, 2013, None, 1234]


def test_categories_parse_and_failures(spark):
    texts = ["[]", "[[]]", '[["Children\'s Music"]]', "[['a\\'b \"c\"']]", "[['caf\\xe9']]"]
    df = spark.createDataFrame([(t,) for t in texts], "categories string")
    got = [r.c for r in df.select(P.first_category(P.parse_categories("categories")).alias("c")).collect()]
    assert got[:4] == [None, None, "Children's Music", 'a\'b "c"']
    assert got[4] == "café"
    assert parse_failures(df).first()["categories_failures"] == 0
    assert parse_failures(spark.createDataFrame([("[['a",), (None,)], "categories string")).first()[0] == 1


def test_python_literals(spark):
    texts = ["[['a', None, 'None', \"it's None, True\"]]", "[[None]]", "[['a\\\\xe9', 'b\\xe9\\xe8']]",
             "[[True, 'False', False]]", "[['Nonesuch', 'xNone']]"]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    got = [r.c[0] for r in df.select(P.parse_categories("c").alias("c")).collect()]
    assert got == [["a", None, "None", "it's None, True"], [None], ["a\\xe9", "bée".replace("e", "è")],
                   ["true", "False", "false"], ["Nonesuch", "xNone"]]
    long = "[[" + ", ".join(["'id None'"] * 20_000) + ", None]]"
    row = spark.createDataFrame([(long,)], "c string").select(P.parse_categories("c").alias("c")).first()
    assert len(row.c[0]) == 20_001 and row.c[0][-1] is None and row.c[0][0] == "id None"


def test_literals_as_python_reads_them(spark):
    import ast
    import random
    texts = ["[[u'a']]", "[('a','b')]", "[['a' 'b']]", "[['a',],]", "(('a', 'b'),)", "[[('a')], ()]", "[[]]", "[ [ ] , ['x'] ]",
             "[[u'caf\\xe9', r'a\\b', 'q\\q', '\\/', '\\a\\v\\0']]", "[['''tri'p\nle''', \"\"\"d\"q\"\"\"]]",
             "[['a\\\nb', 'tab\\t', 'new\\n']]", "[['true', 'null', 'None', '@', '(', \"it's\"]]", "[['é中', '\\u00e9']]"]
    rnd = random.Random(4)
    alphabet = "ab'\"\\\n\t ,:[](){}u0é中None"
    for _ in range(150):
        value = [["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(9))) for _ in range(rnd.randrange(4))]
                 for _ in range(rnd.randrange(3))]
        texts.append(repr(value) if rnd.random() < 0.6 else repr(tuple(map(tuple, value))))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    got = {r.i: r.p for r in df.select("i", P.parse_categories("c").alias("p")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == [list(x) for x in ast.literal_eval(t)], t


def test_numbers_and_garbage(spark):
    ranks = {"{'A': 1.5}": {"A": 1.5}, "{'A': 12L}": {"A": 12}, "{u'A': 3, 'B': None,}": {"A": 3, "B": None}, "{1: 0x1F}": {"1": 31},
             "{'A': .5, 'B': +5., 'C': -1e2}": {"A": 0.5, "B": 5, "C": -100}, "{}": {}, "{'A' 2}": None, "{'A': 2": None, "{'A': 2} x": None}
    df = spark.createDataFrame([(t,) for t in ranks], "c string")
    assert {r.c: r.p for r in df.select("c", P.parse_sales_rank("c").alias("p")).collect()} == ranks
    garbage = ["[['cut", "[,]", "[[1 2]]", "[['a' 1]]", "[[true]]", "[[a]]", "[['a']] x", "[['a'\\n]]", "", " ", "[['a',,]]", "{'a': 1}"]
    df = spark.createDataFrame([(t,) for t in garbage + ["[['a']]", None]], "categories string")
    assert parse_failures(df).first()[0] == len(garbage)


def test_sales_rank_first_entry_in_text_order(spark):
    df = spark.createDataFrame([("{}",), ("{'Z': 3, 'A': 1}",), (None,)], "s string")
    rows = df.select(P.first_key(P.parse_sales_rank("s")).alias("k"),
                     P.first_value(P.parse_sales_rank("s")).alias("v")).collect()
    assert [(r.k, r.v) for r in rows] == [(None, None), ("Z", 3), (None, None)]


def test_related_ids_non_overlapping(spark):
    run = "ABCDEFGHIJKLMNOPQRSTU"  # 21 capitals -> two ids, one letter left
    rows = _one(spark, [(f"{{'also_viewed': ['{run}']}}",), (None,)], "r string",
                P.related_ids("r").alias("ids"))
    assert rows[0].ids == ["ABCDEFGHIJ", "KLMNOPQRST"]
    assert rows[1].ids is None


def test_first_category_empty_name_to_null(spark):
    df = spark.createDataFrame([("[['']]",), ("[['Books', 'x']]",)], "c string")
    rows = df.select(P.first_category_or_null(P.parse_categories("c")).alias("c")).collect()
    assert [r.c for r in rows] == [None, "Books"]


def test_title_tokens_keep_empty_tokens(spark):
    rows = _one(spark, [("A  b ",)], "t string", P.title_tokens("t").alias("w"))
    assert rows[0].w == ["a", "", "b", ""]


def test_size_or_null_and_map_field(spark):
    df = spark.createDataFrame([({"also_viewed": []},), ({"x": ["a"]},), ({"also_viewed": ["a", "b"]},)],
                               "r map<string,array<string>>")
    rows = df.select(P.size_or_null(P.map_field("r", "also_viewed")).alias("n")).collect()
    assert [r.n for r in rows] == [None, None, 2]


def test_clean_number_folds_nan(spark):
    rows = _one(spark, [("NaN",), ("1.5",), ("abc",)], "v string", P.clean_number("v").alias("x"))
    assert [r.x for r in rows] == [None, 1.5, None]
    assert F is not None
