"""Merkle manifest, spelling variants and doubling dedup on edge rows (NULLs,
empty and long texts, repeated rows and ids, clashing columns, empty tables)
against brute force, and their SQL."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import common, doubling_dedup, merkle_manifest, spelling_variants
from revlens.llm.oracles import ORACLES
from revlens.llm.registry import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

WORDS = [f"w{i}" for i in range(400)]
PASSAGE = " ".join(WORDS[:120])
ROWS = [
    (1, PASSAGE + " one two"), (2, "other words " + PASSAGE.replace(" ", "\n\t") + " end"), (3, PASSAGE + " one two"),
    (3, PASSAGE + " again"), (4, None), (5, ""), (6, " \n\r\x0b"), (None, PASSAGE), (7, "la " * 9000), (8, "la " * 60),
    (9, " ".join(WORDS[100:160])), (10, " ".join(WORDS[60:109])), (11, " ".join(WORDS[60:110])), (11, " ".join(WORDS[60:110])),
    (12, "café\n" * 70), (-5, "Café\n" * 70), (13, " ".join(WORDS)), (14, PASSAGE.upper()), (None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if k % 3 else None, None if k % 4 == 0 else f"s{k % 3}", len(t or "") if k % 5 else None,
             k, "x", 7, 8, k) for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, row_id int, tree string, "
              "rank int, n int, length int").repartition(4)


# --- manifest ---

def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i: i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def brute_audit(rows):
    """Sorted (doc_id, leaf, subroot, root, proof digest, folded root)."""
    def leaf(r, text):
        return digest(*map(field, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))

    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    trees = {s: levels_of([leaf(r, r["text"]) for r in by[s]]) for s in sources}
    top = levels_of([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and text:
                text = text.replace("\n", "")
            acc, proof = leaf(r, text), []
            for levels, at in ((trees[s], i), (top, k)):
                for level in levels[:-1]:
                    run, digit = level[at // 3 * 3: at // 3 * 3 + 3], at % 3
                    proof += run[:digit] + run[digit + 1:]
                    acc = digest(*run[:digit], acc, *run[digit + 1:])
                    at //= 3
            out.append((r["doc_id"], leaf(r, r["text"]), trees[s][-1][0], top[-1][0], digest(*proof), acc))
    return sorted(out, key=repr)


def audited(docs):
    changed = {"text": merkle_manifest.tampered_text(F.col("doc_id"), F.col("text"))}
    rows = merkle_manifest.audited(docs, changed).collect()
    assert all(r.verified == (r.folded_root == r.root) for r in rows)
    return sorted(((r.ordered, r.leaf, r.subroot, r.root, digest(*(x for p in reversed(r.path) for x in p.others)),
                    r.folded_root) for r in rows), key=repr)


def test_manifest_against_brute_force(docs):
    got = audited(docs)
    assert got == brute_audit(docs.collect())
    assert any(r[3] != r[5] for r in got) and any(r[3] == r[5] for r in got)


def test_manifest_of_one_row_and_none(docs):
    one = docs.where("doc_id = 1")
    row = merkle_manifest.audited(one).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.path == [] and row.verified
    assert merkle_manifest.audited(docs.where("false")).count() == 0


def test_manifest_of_a_deep_source_with_repeated_rows(spark, monkeypatch):
    # 1,300 rows of one source (over two folds), a third of them one row;
    # few rows already count as frequent, so both ways of lookup run.
    monkeypatch.setattr(merkle_manifest, "HOT", 20)
    rows = spark.range(1300).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("long").alias("doc_id"),
        F.when(F.col("id") % 100 == 1, None).otherwise(F.lit("big")).alias("source"), F.lit("en").alias("lang"),
        F.lit(1).alias("n_chars"), F.lit("a\nb").alias("text"))
    assert audited(rows) == brute_audit(rows.collect())


def test_manifest_proves_requested_leaves_only(docs):
    leaves = merkle_manifest.leaves_of(docs)
    made = merkle_manifest.manifest(leaves.select("tree", "rank", "digest", "n"))
    wanted = leaves.where("rank % 3 = 1").select("tree", "rank")
    proofs = merkle_manifest.prove(made, wanted).collect()
    known = {(r.tree, r["rank"]): r.digest for r in leaves.collect()}
    assert {(r.tree, r["rank"]) for r in proofs} == {(r.tree, r["rank"]) for r in wanted.collect()}
    assert all(known[r.tree, r["rank"]] == r.digest for r in proofs)
    folded = merkle_manifest.prove(made, wanted).select(merkle_manifest.fold(F.col("digest"), F.col("path")).alias("f"))
    assert {r.f for r in folded.collect()} == {made.root}


# --- doubling dedup ---

def brute_cut(rows, length):
    first = {}
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for k in range(len(words) - length + 1):
            if i is not None:
                key = tuple(words[k: k + length])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = set()
        for k in range(len(words) - length + 1):
            if i is not None and first[tuple(words[k: k + length])] < i:
                gone.update(range(k, k + length))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest(), None if t is None else kept))
    return sorted(out, key=repr)


def cut_rows(frame):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.text) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("length", [50, 5, 2])
def test_doubling_against_brute_force(docs, length):
    assert cut_rows(doubling_dedup.dedup(docs, length, follow=False)) == brute_cut(ROWS, length)


def test_doubling_follows_to_the_longest(docs):
    longest = {(r.doc_id, r.n_words): r.longest for r in doubling_dedup.dedup(docs, 10).collect()}
    assert longest[1, 122] == longest[3, 122] == 80  # 122 equal words, from an anchor on
    assert longest[11, 50] in (20, 40) and longest[7, 9000] >= 40 and longest[4, 0] == longest[None, 120] == 0


def test_doubling_query_follows_all_levels(spark, tmp_path, monkeypatch):
    rows = [(1, " ".join(WORDS)), (2, "x " + " ".join(WORDS[:360])), (3, " ".join(WORDS[300:])), (4, None), (None, PASSAGE)]
    levels = []

    def watched(df, name):
        out = common.stored(df, name)
        if name == "double-reached":
            levels.append(out.count())
        return out

    monkeypatch.setattr(doubling_dedup, "stored", watched)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op13_doubling_dedup"](spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == sorted(
        (r[:4] for r in brute_cut(rows, 50)), key=repr)
    # Rows 1 and 2 share 360 words: windows of 100 and of 200 of them are followed.
    assert levels == [2, 2]


def test_doubling_of_frequent_passages(spark, monkeypatch):
    # A passage in a third of all rows, with different words around it, and a
    # group of copies; keys count as frequent early.
    monkeypatch.setattr(common, "HOT", 50)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        words = [f"u{x}" for x in rng.integers(0, 5000, 60)]
        text = " ".join(words[:30] + WORDS[:70] + words[30:]) if i % 3 == 0 else " ".join(words)
        rows.append((i, "copy " * 3 + " ".join(WORDS[200:300]) if i % 5 == 1 else text))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert cut_rows(doubling_dedup.dedup(frame, follow=False)) == brute_cut(rows, 50)


def test_doubling_of_nothing(docs):
    assert doubling_dedup.dedup(docs.where("false")).count() == 0
    assert doubling_dedup.dedup(docs.where("text IS NULL OR text = ''")).where("n_words > 0").count() == 0


# --- spelling variants ---

def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(count, ratio=5):
    form, n_near = {}, {}
    for w in count:
        close = [v for v in count if near(w, v)]
        best = min(close, key=lambda v: (-count[v], v), default=None)
        n_near[w], form[w] = len(close), best if best and count[best] >= ratio * count[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), n, n_near[w], count[form[w]] if form[w] else None) for w, n in count.items()), key=repr)


def got_variants(frame):
    return sorted(map(tuple, frame.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


@pytest.mark.parametrize("cell, block", [(200, 64), (131072, 65536)])
def test_variants_against_brute_force(spark, cell, block):
    rng = np.random.default_rng(3)
    count = Counter()
    for _ in range(1500):
        word = "".join(rng.choice(list("abcdeé×"), rng.integers(1, 7)))
        count[word] += int(rng.integers(1, 5) ** 6)
    count["x" * 400] = count["x" * 399] = 5
    frame = spark.createDataFrame(list(count.items()), "word string, n long")
    assert got_variants(spelling_variants.variants(frame, cell=cell, block=block)) == brute_variants(count)


def test_variants_of_texts(docs, spark):
    pattern = re.compile("[A-Za-zÀ-ÿ]+")
    rows = [(i, t) for i, t in ROWS] + [(20 + i, "spelling speling Spelling spellïng ÀÉ spélling " * 9) for i in range(60)]
    count = Counter()
    for i, t in rows:
        for run in pattern.findall(t or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 19 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    count = {w: n for w, n in count.items() if len(w) >= 4 and n >= 3}
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(1))
    vocab = spelling_variants.vocabulary(spelling_variants.with_deletions(spelling_variants.runs_of(frame), 19), 4, 3)
    assert len(count) > 5 and got_variants(spelling_variants.variants(vocab)) == brute_variants(count)


def test_variants_of_nothing(docs):
    for none in (docs.where("false"), docs.where("text IS NULL OR text = ''")):
        vocab = spelling_variants.vocabulary(spelling_variants.runs_of(none))
        assert spelling_variants.variants(vocab).count() == 0


@pytest.mark.parametrize("key", ["op4_part_enum", "op11_merkle_manifest", "op12_spelling_variants", "op13_doubling_dedup"])
def test_sql(spark, key):
    r = compare(QUERIES[key](spark, SF_SMALL), ORACLES[key], duck(SF_SMALL))
    assert r["ok"], r
