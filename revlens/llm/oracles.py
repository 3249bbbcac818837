"""DuckDB SQL of the queries that SQL can express over whole tables."""

ORACLES = {
    "op3_prefix_decontam": r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
gram AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM gram JOIN win USING (n, s)),
word AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit),
n_word AS (SELECT doc_id, count(*) AS n_hit FROM word GROUP BY doc_id),
n_item AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
           array_to_string(list_sort(list(DISTINCT item_id)), ',') AS items FROM hit GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN n_word USING (doc_id) LEFT JOIN n_item USING (doc_id)
""",
    "op11_merkle_manifest": r"""
WITH RECURSIVE field AS (
  SELECT doc_id, source, coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
         || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
         || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head, text,
         CASE WHEN list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
              lambda c: CAST(ascii(c) AS BIGINT)), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
              lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) % 2 = 1 THEN replace(text, chr(10), '') ELSE text END AS other
  FROM documents),
leaf AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
         count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
               sha256(head || coalesce(octet_length(encode(other)) || ':' || other, '-')) AS other FROM field)),
node AS (
  SELECT coalesce('=' || source, '') AS tree, 0 AS h, r AS i, leaf AS d, n FROM leaf
  UNION ALL
  SELECT tree, h + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)), (n + 2) // 3 FROM node WHERE n > 1
  GROUP BY tree, h, i // 3, n),
sub AS (SELECT tree, d, row_number() OVER (ORDER BY tree) - 1 AS s, count(*) OVER () AS n FROM node WHERE n = 1),
top AS (
  SELECT 0 AS h, s AS i, d, n FROM sub
  UNION ALL
  SELECT h + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY h, i // 3, n),
run AS (SELECT tree, h, i // 3 AS g, list(d ORDER BY i) AS ds FROM node WHERE n > 1 GROUP BY ALL),
top_run AS (SELECT h, i // 3 AS g, list(d ORDER BY i) AS ds FROM top WHERE n > 1 GROUP BY ALL),
walk AS (
  SELECT coalesce('=' || source, '') AS tree, r, 0 AS h, r AS i, other AS acc, '' AS proof FROM leaf
  UNION ALL
  SELECT w.tree, r, w.h + 1, i // 3, sha256(array_to_string(ds[:i % 3], '') || acc || array_to_string(ds[i % 3 + 2:], '')),
         proof || array_to_string(ds[:i % 3], '') || array_to_string(ds[i % 3 + 2:], '')
  FROM walk w JOIN run ON run.tree = w.tree AND run.h = w.h AND run.g = w.i // 3),
climb AS (
  SELECT w.tree, r, 0 AS h, s AS i, acc, proof FROM (SELECT * FROM walk QUALIFY h = max(h) OVER (PARTITION BY tree, r)) w
  JOIN sub ON sub.tree = w.tree
  UNION ALL
  SELECT c.tree, r, c.h + 1, i // 3, sha256(array_to_string(ds[:i % 3], '') || acc || array_to_string(ds[i % 3 + 2:], '')),
         proof || array_to_string(ds[:i % 3], '') || array_to_string(ds[i % 3 + 2:], '')
  FROM climb c JOIN top_run t ON t.h = c.h AND t.g = c.i // 3)
SELECT doc_id, leaf, sub.d AS subroot, root.d AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root.d AS verified
FROM leaf JOIN sub ON sub.tree = coalesce('=' || leaf.source, '')
JOIN (SELECT * FROM climb QUALIFY h = max(h) OVER (PARTITION BY tree, r)) c ON c.tree = sub.tree AND c.r = leaf.r,
     (SELECT d FROM top WHERE n = 1) AS root
""",
    "op13_doubling_dedup": r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc WHERE len(w) >= 50)),
own AS (SELECT s, min(doc_id) AS o FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN own USING (s) WHERE doc_id > o),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM doc),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
""",
    "op12_spelling_variants": r"""
WITH RECURSIVE run AS (
  SELECT doc_id, r, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[A-Za-zÀ-ÿ]+')) AS r FROM documents) WHERE length(r) >= 6 GROUP BY doc_id, r),
hashed AS (
  SELECT r, k, xor(4294967295, list_reduce([4294967295] || flatten(list_transform(
      string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r, ''), lambda c: CASE WHEN unicode(c) < 128
      THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(192 + (unicode(c) >> 6) AS BIGINT), CAST(128 + (unicode(c) & 63) AS BIGINT)] END)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) AS h FROM run),
word AS (
  SELECT w, CAST(sum(k) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS w, k FROM hashed)
  WHERE length(w) >= 6 GROUP BY w HAVING sum(k) >= 5),
cut AS (SELECT w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) AS d
        FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM word)),
pair AS (
  SELECT a.w AS w, b.w AS v, b.n AS m FROM cut a JOIN cut b ON a.i = b.i AND a.d = b.d AND a.w <> b.w
  UNION SELECT c.w, s.w, s.n FROM cut c JOIN word s ON c.d = s.w
  UNION SELECT s.w, c.w, c.n FROM cut c JOIN word s ON c.d = s.w),
best AS (SELECT w, count(*) AS n_near, first(v ORDER BY m DESC, v) AS v, max(m) AS m FROM pair GROUP BY w),
found AS (
  SELECT word.w, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN v END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
  FROM word LEFT JOIN best ON best.w = word.w),
chain AS (SELECT w, w AS root, form FROM found
          UNION ALL SELECT c.w, f.w, f.form FROM chain c JOIN found f ON f.w = c.form)
SELECT found.w AS word, found.form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n
FROM found JOIN chain ON chain.w = found.w AND chain.form IS NULL
""",
    "op4_part_enum": r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
gram AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM doc WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM gram a JOIN gram b ON a.s = b.s AND a.doc_id < b.doc_id
         GROUP BY a.doc_id, b.doc_id),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS d, doc_id AS r FROM doc UNION SELECT edge.b, reach.r FROM reach JOIN edge ON edge.a = reach.d)
SELECT doc.doc_id, coalesce(n, 0) AS n_shingles, c.component_id
FROM doc LEFT JOIN n USING (doc_id) JOIN (SELECT d AS doc_id, min(r) AS component_id FROM reach GROUP BY d) c USING (doc_id)
""",
}
