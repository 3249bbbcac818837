"""Independent DuckDB SQL for every SQL-expressible query.

Each string only assumes the raw test tables are registered as views; the
review/catalog fixture views are spelled out again as CTEs in DuckDB's
dialect (see FIXTURES.md).  Column names match the Spark queries exactly.
"""

from __future__ import annotations

REVIEWS_CTE = r"""
reviews AS (
  SELECT CAST(o_custkey AS VARCHAR) AS reviewerID,
    lpad(CAST(l_partkey % 1900 + 150 AS VARCHAR), 10, '0') AS asin,
    CAST(1 + CAST(l_quantity AS INTEGER) % 5 AS DOUBLE) AS overall,
    concat('[', l_linenumber, ', ', l_linenumber + CAST(l_quantity AS INTEGER) % 4, ']') AS helpful,
    CASE WHEN l_returnflag = 'A' THEN NULL ELSE strftime(o_orderdate, '%m %-d, %Y') END AS reviewTime
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

PRODUCTS_CTE = r"""
products AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS asin,
    CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_retailprice END AS price,
    CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN '' ELSE p_name END AS title,
    CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN '[['''']]'
         WHEN p_partkey % 29 = 0 THEN '[[''Caf\xe9'', None, True]]' WHEN p_partkey % 31 = 0 THEN '[[''cut off'
         WHEN p_partkey % 37 = 0 THEN '[(u''Gift'' '' Sets'', ''x''),]'
         ELSE concat('[[''', p_type, ''', ''', p_brand, ''']]') END AS categories,
    CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 23 = 0 THEN '{}'
         WHEN p_partkey % 29 = 0 THEN '{''Th\xe9'': 7, ''None'': None}' WHEN p_partkey % 31 = 0 THEN '{''Tea'' 7}'
         WHEN p_partkey % 37 = 0 THEN '{u''Gifts'': 12L,}' WHEN p_partkey % 41 = 0 THEN '{''Tools'': 1.5}'
         ELSE concat('{''', p_brand, ''': ', p_size, '}') END AS salesRank,
    CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 4 = 0 THEN '{''also_viewed'': []}'
         WHEN p_partkey % 29 = 0 THEN '{''bought_together'': None, ''also_viewed'': [''0000000002'']}'
         WHEN p_partkey % 31 = 0 THEN '{''also_viewed'': ['
         WHEN p_partkey % 37 = 0 THEN '{u''also_viewed'': (''0000000003'', ''0000000004''),}'
         ELSE concat('{''also_viewed'': [''', lpad(CAST((p_partkey * 7 + 13) % 2100 AS VARCHAR), 10, '0'),
              ''', ''', lpad(CAST((p_partkey * 11 + 5) % 2100 AS VARCHAR), 10, '0'),
              '''], ''bought_together'': [''', lpad(CAST((p_partkey + 1) % 2100 AS VARCHAR), 10, '0'),
              ''']}') END AS related
  FROM part)"""


def _json(col: str) -> str:
    """A fixture literal as JSON text, NULL where it is none.  Bare words
    follow a separator here, and names hold none of them, no parentheses and no
    ``u`` after a separator."""
    text = f"""regexp_replace({col}, '([\\[({{{{ ])u''', '\\1''', 'g')"""
    text = f"replace(translate(regexp_replace({text}, '(\\d)L', '\\1', 'g'), '()', '[]'), ''' ''', '')"
    text = f"replace(replace({text}, ',]', ']'), ',}}', '}}')"
    text = f"""regexp_replace(replace({text}, '''', '"'), '\\\\x([0-9a-f]{{2}})', '\\\\u00\\1', 'g')"""
    text = f"replace(replace(replace({text}, ' None', ' null'), ' True', ' true'), ' False', ' false')"
    return f"CASE WHEN json_valid({text}) THEN {text} END"


# Parsed catalog fields (first category, first sales-rank entry, also-viewed list).
PRODUCT_FLAT_CTE = PRODUCTS_CTE + rf""",
product_json AS (
  SELECT asin, price, title, {_json("categories")} AS c, {_json("salesRank")} AS s, {_json("related")} AS r
  FROM products),
product_parsed AS (
  SELECT asin, price, title,
    json_extract_string(c, '$[0][0]') AS first_cat,
    json_keys(s)[1] AS bestSalesCategory,
    CASE WHEN len(json_keys(s)) > 0 THEN CAST(regexp_extract(s, ': (-?[\d.]+)', 1) AS DOUBLE) END AS bestSalesRank,
    CAST(json_extract(r, '$.also_viewed') AS VARCHAR[]) AS also_viewed
  FROM product_json)"""

PROFILE_CTE = REVIEWS_CTE + r""",
profile AS (
  SELECT reviewerID,
    count(reviewTime) AS number_products_rated,
    avg(overall) AS avg_ratings,
    min(TRY_CAST(NULLIF(regexp_extract(reviewTime, '\d{4}', 0), '') AS INTEGER)) AS reviewing_since,
    CAST(sum(TRY_CAST(regexp_extract_all(helpful, '\d+')[1] AS INTEGER)) AS BIGINT) AS helpful_votes,
    CAST(sum(TRY_CAST(regexp_extract_all(helpful, '\d+')[2] AS INTEGER)) AS BIGINT) AS total_votes
  FROM reviews WHERE reviewerID IS NOT NULL GROUP BY reviewerID)"""


def _describe_sql(source: str, columns: list[str], stats: list[str], places: int | None) -> str:
    """Long ``(metric, stat, value)`` describe over ``source``."""
    exprs = {
        "count": "CAST(count(v) AS DOUBLE)", "mean": "avg(v)", "std": "stddev_samp(v)",
        "min": "min(v)", "max": "max(v)", "25%": "quantile_cont(v, 0.25)",
        "50%": "quantile_cont(v, 0.5)", "75%": "quantile_cont(v, 0.75)",
    }
    longv = " UNION ALL ".join(
        f"SELECT '{c}' AS metric, CAST({c} AS DOUBLE) AS v FROM {source}" for c in columns)
    aggs = ", ".join(f"{exprs[s]} AS \"{s}\"" for s in stats)
    val = "value" if places is None else f"round_even(value, {places})"
    unions = " UNION ALL ".join(
        f"SELECT metric, '{s}' AS stat, CAST(\"{s}\" AS DOUBLE) AS value FROM agg" for s in stats)
    return (f"agg AS (SELECT metric, {aggs} FROM ({longv}) GROUP BY metric)\n"
            f"SELECT metric, stat, {val} AS value FROM ({unions})")


PROFILE_COLUMNS = ["number_products_rated", "avg_ratings", "reviewing_since",
                   "helpful_votes", "total_votes"]
DESCRIBE_STATS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


def _null_pct_sql(table: str, columns: list[str]) -> str:
    sel = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round_even(round_even(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE, 4) * 100, 2) AS null_pct FROM {table}"
        for c in columns)
    return sel


ORACLES: dict[str, str] = {}

ORACLES["reviewer_profile"] = "WITH " + PROFILE_CTE + "\nSELECT * FROM profile"

ORACLES["reviewer_profile_describe"] = (
    "WITH " + PROFILE_CTE + ",\n" + _describe_sql("profile", PROFILE_COLUMNS, DESCRIBE_STATS, 2))

REVIEW_COLUMNS = ["reviewerID", "asin", "overall", "helpful", "reviewTime"]
PRODUCT_COLUMNS = ["asin", "price", "title", "categories", "salesRank", "related"]

ORACLES["null_pct_reviews"] = "WITH " + REVIEWS_CTE + "\n" + _null_pct_sql("reviews", REVIEW_COLUMNS)
ORACLES["null_pct_products"] = "WITH " + PRODUCTS_CTE + "\n" + _null_pct_sql("products", PRODUCT_COLUMNS)

ORACLES["price_rating_corr"] = "WITH " + REVIEWS_CTE + "," + PRODUCTS_CTE + r""",
pairs AS (
  SELECT p.price, r.overall FROM products p JOIN reviews r ON p.asin = r.asin
  WHERE p.price IS NOT NULL AND r.overall IS NOT NULL)
SELECT count(*) AS n_pairs,
  CASE WHEN min(price) < max(price) AND min(overall) < max(overall)
       THEN round_even(corr(price, overall), 6) END AS price_rating_corr
FROM pairs"""

ORACLES["price_rating_corr_linked"] = ORACLES["price_rating_corr"].replace(
    "SELECT p.price, r.overall FROM", "SELECT CAST(p.asin AS BIGINT) + 100000000.0::DOUBLE AS price, "
    "r.overall + CAST(r.asin AS BIGINT) / 500.0 AS overall FROM")

ORACLES["price_describe"] = "WITH " + PRODUCTS_CTE + ",\n" + _describe_sql(
    "products", ["price"], ["mean", "std", "50%", "min", "max"], 2)

ORACLES["category_counts"] = "WITH " + PRODUCT_FLAT_CTE + r""",
c AS (SELECT first_cat AS category, asin FROM product_parsed)
SELECT row_number() OVER (ORDER BY n DESC, category) AS rank, category, n
FROM (SELECT category, count(asin) AS n FROM c WHERE category IS NOT NULL GROUP BY category)"""

ORACLES["dangling_reviews"] = "WITH " + REVIEWS_CTE + "," + PRODUCTS_CTE + r""",
missing AS (
  SELECT DISTINCT r.asin FROM reviews r
  WHERE r.asin IS NOT NULL AND NOT EXISTS (SELECT 1 FROM products p WHERE p.asin = r.asin))
SELECT CAST(count(*) > 0 AS INTEGER) AS dangling, count(*) AS missing_ids FROM missing"""

ORACLES["related_vs_catalog"] = "WITH " + PRODUCTS_CTE + r""",
rel AS (SELECT DISTINCT unnest(regexp_extract_all(related, '[A-Z0-9]{10}')) AS asin FROM products),
cat AS (SELECT DISTINCT asin FROM products WHERE asin IS NOT NULL),
j AS (SELECT cat.asin AS a, rel.asin AS b FROM cat FULL OUTER JOIN rel ON cat.asin = rel.asin)
SELECT count(*) FILTER (WHERE b IS NULL) AS catalog_only,
       count(*) FILTER (WHERE a IS NULL) AS related_only,
       CAST(count(*) FILTER (WHERE a IS NULL OR b IS NULL) > 0 AS INTEGER) AS differ
FROM j"""

ORACLES["preview_products"] = "WITH " + PRODUCTS_CTE + "\nSELECT * FROM products ORDER BY asin LIMIT 5"
ORACLES["product_lookup"] = "WITH " + PRODUCTS_CTE + "\nSELECT * FROM products WHERE asin = '0000000150'"
ORACLES["product_count_mean_price"] = "WITH " + PRODUCTS_CTE + (
    "\nSELECT count(*) AS count_total, round_even(avg(price), 6) AS mean_price FROM products")

_RATINGS = "WITH " + REVIEWS_CTE + "," + PRODUCTS_CTE + r""",
per AS (SELECT asin, avg(overall) AS meanRating, count(overall) AS countRating FROM reviews GROUP BY asin),
r AS (SELECT p.asin, per.meanRating, per.countRating FROM products p LEFT JOIN per ON p.asin = per.asin)
"""
ORACLES["product_ratings"] = _RATINGS + (
    "SELECT asin, round_even(meanRating, 6) AS meanRating, CAST(countRating AS DOUBLE) AS countRating FROM r")
ORACLES["product_rating_stats"] = _RATINGS + r"""
SELECT count(asin) AS count_total,
  round_even(avg(meanRating), 6) AS mean_meanRating,
  round_even(var_samp(meanRating), 6) AS variance_meanRating,
  count(*) FILTER (WHERE meanRating IS NULL) AS numNulls_meanRating,
  round_even(avg(countRating), 6) AS mean_countRating,
  round_even(var_samp(countRating), 6) AS variance_countRating,
  count(*) FILTER (WHERE countRating IS NULL) AS numNulls_countRating
FROM r"""

_FLAT = "WITH " + PRODUCT_FLAT_CTE + r""",
f AS (SELECT asin, NULLIF(first_cat, '') AS category, bestSalesCategory, bestSalesRank FROM product_parsed)
"""
ORACLES["product_flat"] = _FLAT + (
    "SELECT asin, category, bestSalesCategory, bestSalesRank FROM f")
ORACLES["product_flat_stats"] = _FLAT + r"""
SELECT count(asin) AS count_total,
  round_even(avg(bestSalesRank), 6) AS mean_bestSalesRank,
  round_even(var_samp(bestSalesRank), 6) AS variance_bestSalesRank,
  count(*) FILTER (WHERE category IS NULL) AS numNulls_category,
  count(DISTINCT category) AS countDistinct_category,
  count(*) FILTER (WHERE bestSalesCategory IS NULL) AS numNulls_bestSalesCategory,
  count(DISTINCT bestSalesCategory) AS countDistinct_bestSalesCategory
FROM f"""

_ALSO = "WITH " + PRODUCT_FLAT_CTE + r""",
nb AS (SELECT asin, unnest(also_viewed) AS nb FROM product_parsed),
prices AS (SELECT asin AS nb, price FROM products WHERE price IS NOT NULL),
mp AS (SELECT nb.asin, avg(prices.price) AS m FROM nb JOIN prices ON nb.nb = prices.nb GROUP BY nb.asin),
a AS (SELECT l.asin, mp.m AS meanPriceAlsoViewed,
        CAST(NULLIF(len(l.also_viewed), 0) AS INTEGER) AS countAlsoViewed
      FROM product_parsed l LEFT JOIN mp ON l.asin = mp.asin)
"""
ORACLES["also_viewed"] = _ALSO + (
    "SELECT asin, round_even(meanPriceAlsoViewed, 6) AS meanPriceAlsoViewed, "
    "CAST(countAlsoViewed AS DOUBLE) AS countAlsoViewed FROM a")
ORACLES["also_viewed_stats"] = _ALSO + r"""
SELECT count(asin) AS count_total,
  round_even(avg(meanPriceAlsoViewed), 6) AS mean_meanPriceAlsoViewed,
  round_even(var_samp(meanPriceAlsoViewed), 6) AS variance_meanPriceAlsoViewed,
  count(*) FILTER (WHERE meanPriceAlsoViewed IS NULL) AS numNulls_meanPriceAlsoViewed,
  round_even(avg(countAlsoViewed), 6) AS mean_countAlsoViewed,
  round_even(var_samp(countAlsoViewed), 6) AS variance_countAlsoViewed,
  count(*) FILTER (WHERE countAlsoViewed IS NULL) AS numNulls_countAlsoViewed
FROM a"""

_IMPUTE = "WITH " + PRODUCTS_CTE + r""",
p AS (SELECT asin, CAST(CAST(price AS FLOAT) AS DOUBLE) AS price, title FROM products),
c AS (SELECT avg(price) AS m, quantile_disc(price, 0.5) AS med FROM p),
i AS (SELECT asin, coalesce(price, c.m) AS meanImputedPrice, coalesce(price, c.med) AS medianImputedPrice,
        CASE WHEN title IS NULL OR title = '' THEN 'unknown' ELSE title END AS unknownImputedTitle
      FROM p, c)
"""
ORACLES["imputed_products"] = _IMPUTE + (
    "SELECT asin, round_even(meanImputedPrice, 6) AS meanImputedPrice, "
    "round_even(medianImputedPrice, 6) AS medianImputedPrice, unknownImputedTitle FROM i")
ORACLES["imputation_stats"] = _IMPUTE + r"""
SELECT count(asin) AS count_total,
  round_even(avg(meanImputedPrice), 6) AS mean_meanImputedPrice,
  round_even(var_samp(meanImputedPrice), 6) AS variance_meanImputedPrice,
  count(*) FILTER (WHERE meanImputedPrice IS NULL) AS numNulls_meanImputedPrice,
  round_even(avg(medianImputedPrice), 6) AS mean_medianImputedPrice,
  round_even(var_samp(medianImputedPrice), 6) AS variance_medianImputedPrice,
  count(*) FILTER (WHERE medianImputedPrice IS NULL) AS numNulls_medianImputedPrice,
  count(*) FILTER (WHERE unknownImputedTitle = 'unknown') AS numUnknowns_unknownImputedTitle
FROM i"""

ORACLES["imputation_stats_sketch"] = ORACLES["imputation_stats"]
ORACLES["saved_rating_stats"] = ORACLES["product_rating_stats"]
ORACLES["price_sketch_ranks"] = "WITH " + PRODUCTS_CTE + r"""
SELECT p, count(price) AS n, TRUE AS in_bound
FROM products, (SELECT CAST(unnest([0.05, 0.25, 0.5, 0.75, 0.95]) AS DOUBLE) AS p) GROUP BY p"""

# pandas' missing-value tokens read as NULL.
_TEXT = ("CASE WHEN {c} NOT IN ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
         "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null') THEN {v} END")
ORACLES["csv_documents"] = "SELECT doc_id, " + ", ".join(
    _TEXT.format(c=c, v=v) + f" AS {c}" for c, v in (("text", "md5(text)"), ("lang", "lang"), ("source", "source"))
) + ", n_chars FROM documents"

# -- Q2.5-Q2.8 -------------------------------------------------------------------

_TOKENS = r"""WITH tok AS (SELECT unnest(string_split(lower(text), ' ')) AS word FROM documents),
counts AS (SELECT word, count(*) AS n FROM tok GROUP BY word HAVING count(*) >= 100)
"""
ORACLES["title_token_counts"] = _TOKENS + "SELECT word, n FROM counts"
ORACLES["token_vocabulary_size"] = _TOKENS + (
    "SELECT (SELECT count(*) FROM documents) AS count_total, "
    "(SELECT count(*) FROM counts) AS size_vocabulary")
# Word2Vec keeps exactly the tokens used at least minCount times.
ORACLES["word2vec_vocabulary"] = ORACLES["token_vocabulary_size"]

ORACLES["word_pmi"] = r"""WITH text AS (SELECT doc_id, string_split(lower(text), ' ') AS w FROM documents),
tok AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM text),
vocab AS (SELECT word FROM tok GROUP BY word HAVING count(*) >= 100),
kept AS (SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS i FROM tok JOIN vocab USING (word)),
ahead AS (SELECT a.word, b.word AS context FROM kept a JOIN kept b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i + 1 AND a.i + 5),
counts AS (SELECT word, context, count(*) AS n FROM (
  SELECT word, context FROM ahead UNION ALL SELECT context, word FROM ahead) GROUP BY word, context),
sums AS (SELECT word, sum(n) AS total FROM counts GROUP BY word),
pmi AS (SELECT c.word, c.context, n, ln(n * (SELECT CAST(sum(n) AS DOUBLE) FROM counts) / (CAST(a.total AS DOUBLE) * b.total)) AS pmi
        FROM counts c JOIN sums a ON a.word = c.word JOIN sums b ON b.word = c.context)
SELECT word, context, n, round_even(pmi, 6) AS pmi FROM pmi WHERE pmi > 0"""

ORACLES["vector_top_k"] = r"""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings),
u AS (SELECT label, generate_subscripts(embedding, 1) AS pos, unnest(embedding) AS x FROM e),
c AS (SELECT label, list(m ORDER BY pos) AS centroid
      FROM (SELECT label, pos, avg(x) AS m FROM u GROUP BY label, pos) GROUP BY label),
s AS (SELECT e.label, e.vec_id, list_cosine_similarity(e.embedding, c.centroid) AS similarity
      FROM e JOIN c ON e.label = c.label),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY label ORDER BY similarity DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT label, vec_id, round_even(similarity, 6) AS similarity, rank FROM r WHERE rank <= 10"""

_CATS = r"""WITH pp AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS asin, p_brand AS category FROM part),
lv AS (SELECT category, count(*) AS cnt FROM pp WHERE category IS NOT NULL GROUP BY category),
idx AS (SELECT category, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, category) - 1 AS DOUBLE) AS categoryIndex FROM lv)
"""
ORACLES["category_index"] = _CATS + r"""SELECT pp.asin, pp.category,
  coalesce(idx.categoryIndex, (SELECT CAST(count(*) AS DOUBLE) FROM lv)) AS categoryIndex
FROM pp LEFT JOIN idx ON pp.category = idx.category"""
ORACLES["category_onehot_mean"] = _CATS + r"""SELECT CAST(categoryIndex AS INTEGER) AS position,
  round_even(cnt / (SELECT count(*) FROM pp), 6) AS mean FROM idx"""
# One more position for the missing categories.
ORACLES["category_onehot_mean_keep"] = _CATS.replace(
    "p_brand AS category", "CASE WHEN p_partkey % 17 <> 0 THEN p_brand END AS category") + r"""
SELECT CAST(categoryIndex AS INTEGER) AS position,
  round_even(cnt / (SELECT count(*) FROM pp), 6) AS mean FROM idx
UNION ALL
SELECT CAST((SELECT count(*) FROM lv) AS INTEGER) AS position,
  round_even(count(*) FILTER (WHERE category IS NULL) / count(*), 6) AS mean FROM pp"""

# Principal components of the one-hot vectors: shares that several levels have,
# and one bisected root between each two neighbouring distinct shares.
_PCA = _CATS.replace("WITH pp", "WITH RECURSIVE pp") + r""",
share AS (SELECT cnt / (SELECT count(*) FROM pp) AS p, count(*) AS m FROM lv GROUP BY cnt),
gap AS (SELECT p AS hi, lead(p) OVER (ORDER BY p DESC) AS lo FROM share),
cut AS (
  SELECT hi AS top, lo, hi, 0 AS step FROM gap WHERE lo IS NOT NULL
  UNION ALL
  SELECT top, CASE WHEN sum(m * p * p / (p - (lo + hi) / 2)) < 1 THEN (lo + hi) / 2 ELSE lo END,
         CASE WHEN sum(m * p * p / (p - (lo + hi) / 2)) < 1 THEN hi ELSE (lo + hi) / 2 END, step + 1
  FROM cut, share WHERE step < 44 GROUP BY top, lo, hi, step),
component AS (
  SELECT (lo + hi) / 2 AS x, 1 / sqrt(sum(m * p * p / pow(p - (lo + hi) / 2, 2))) AS mean FROM cut, share
  WHERE step = 44 GROUP BY lo, hi
  UNION ALL SELECT p, 0.0 FROM (SELECT p, unnest(range(1, m)) FROM share)
  UNION ALL SELECT 0.0, 1 / sqrt((SELECT count(*) FROM lv))),
placed AS (SELECT CAST(row_number() OVER (ORDER BY x DESC) - 1 AS INTEGER) AS position, round_even(mean, 6) AS mean
           FROM component QUALIFY row_number() OVER (ORDER BY x DESC) <= 15)
"""
ORACLES["category_pca_mean"] = _PCA + "SELECT position, mean FROM placed"
ORACLES["category_document"] = _PCA + r"""SELECT (SELECT count(*) FROM pp) AS count_total,
  (SELECT list(round_even(cnt / (SELECT count(*) FROM pp), 6) ORDER BY categoryIndex) FROM idx) AS meanVector_categoryOneHot,
  (SELECT list(mean ORDER BY position) FROM placed) AS meanVector_categoryPCA"""
ORACLES["category_pca_norm"] = _CATS + r"""SELECT count(*) AS levels,
  round_even(sum(pow(cnt / (SELECT count(*) FROM pp), 2)), 6) AS squared_norm FROM lv"""

_ROWS = r"""rows AS (SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS row_key,
    CAST(l_linenumber AS DOUBLE) AS l_linenumber, CAST(l_quantity AS DOUBLE) AS overall FROM lineitem)"""


def _bucket(seed: str) -> str:
    return f"CAST(('0x' || substr(md5(concat_ws('-', row_key, '{seed}')), 1, 7)) AS BIGINT) % 100"


ORACLES["hash_split"] = "WITH " + _ROWS + f"\nSELECT row_key, {_bucket('valid')} < 75 AS in_train FROM rows"
ORACLES["prediction_rmse"] = "WITH " + _ROWS + f""",
b AS (SELECT *, {_bucket('test')} AS bucket FROM rows),
tr AS (SELECT * FROM b WHERE bucket >= 20),
te AS (SELECT * FROM b WHERE bucket < 20),
m AS (SELECT l_linenumber, avg(overall) AS p FROM tr GROUP BY l_linenumber)
SELECT round_even(sqrt(avg(pow(te.overall - coalesce(m.p, (SELECT avg(overall) FROM tr)), 2))), 6) AS rmse
FROM te LEFT JOIN m ON te.l_linenumber = m.l_linenumber"""

ORACLES["tree_planted_rmse"] = "WITH " + _ROWS + f""",
b AS (SELECT l_linenumber > 3 AS late, overall + CASE WHEN l_linenumber > 3 THEN 1000 ELSE 0 END AS overall,
        {_bucket('test')} AS bucket FROM rows),
m AS (SELECT late, avg(overall) AS p FROM b WHERE bucket >= 20 GROUP BY late)
SELECT round_even(sqrt(avg(pow(overall - p, 2))), 6) AS test_rmse FROM b JOIN m USING (late) WHERE bucket < 20"""

ORACLES["review_fields"] = "WITH " + REVIEWS_CTE + r"""
SELECT reviewerID, asin,
  CAST(TRY_CAST(NULLIF(regexp_extract(reviewTime, '\d{4}', 0), '') AS INTEGER) AS DOUBLE) AS review_year,
  TRY_CAST(regexp_extract_all(helpful, '\d+')[1] AS INTEGER) AS helpful_votes,
  TRY_CAST(regexp_extract_all(helpful, '\d+')[2] AS INTEGER) AS total_votes
FROM reviews"""

# A nested text fails to parse when it is present but no literal.
ORACLES["product_parse_failures"] = "WITH " + PRODUCTS_CTE + f"""
SELECT
  count(*) FILTER (WHERE categories IS NOT NULL AND {_json("categories")} IS NULL) AS categories_failures,
  count(*) FILTER (WHERE salesRank IS NOT NULL AND {_json("salesRank")} IS NULL) AS salesRank_failures,
  count(*) FILTER (WHERE related IS NOT NULL AND {_json("related")} IS NULL) AS related_failures
FROM products"""

ORACLES["event_first_prop"] = r"""
SELECT event_id, json_keys(props)[1] AS first_key,
  CAST(json_extract(props, '$."' || json_keys(props)[1] || '"') AS BIGINT) AS first_value
FROM events"""


# -- The two JSON documents, as text ------------------------------------------------


def _object(rows: str, key: str, value: str, order: str) -> str:
    """``{"key": value, ...}`` from the rows of a query."""
    text = f"coalesce(CAST({value} AS VARCHAR), 'null')"
    return f"""(SELECT '{{' || coalesce(string_agg('"' || {key} || '": ' || {text}, ', ' ORDER BY {order}), '') || '}}' FROM ({rows}))"""


def _stat(stats: list[str]) -> str:
    return "list_position([" + ", ".join(f"'{s}'" for s in stats) + "], stat)"


def _one(query: str, column: str) -> str:
    return f"(SELECT coalesce(CAST({column} AS VARCHAR), 'null') FROM ({query}))"


_METRICS = "list_position([" + ", ".join(f"'{c}'" for c in PROFILE_COLUMNS) + "], metric)"
ORACLES["reviewer_report"] = f"""
SELECT '{{' || string_agg('"' || metric || '": ' || body, ', ' ORDER BY {_METRICS}) || '}}' AS json FROM (
  SELECT metric, '{{' || string_agg('"' || stat || '": ' || coalesce(CAST(value AS VARCHAR), 'null'), ', '
                                    ORDER BY {_stat(DESCRIBE_STATS)}) || '}}' AS body
  FROM ({ORACLES["reviewer_profile_describe"]}) GROUP BY metric)"""

_PARTS = {
    "q1": "'{\"products\": ' || " + _object(ORACLES["null_pct_products"], '"column"', "null_pct", '"column"')
          + " || ', \"reviews\": ' || " + _object(ORACLES["null_pct_reviews"], '"column"', "null_pct", '"column"') + " || '}'",
    "q2": _one(ORACLES["price_rating_corr"].replace("corr(price, overall), 6", "corr(price, overall), 2"), "price_rating_corr + 0.0"),
    "q3": _object(ORACLES["price_describe"], "stat", "value", _stat(["mean", "std", "50%", "min", "max"])),
    "q4": _object(ORACLES["category_counts"], "category", "n", "rank"),
    "q5": _one(ORACLES["dangling_reviews"], "dangling"),
    "q6": _one(ORACLES["related_vs_catalog"], "differ"),
}
ORACLES["catalog_report"] = "SELECT '{' || " + " || ', ' || ".join(
    f"""'"{name}": ' || {part}""" for name, part in _PARTS.items()) + " || '}' AS json"
