"""Text operators on edge rows (NULLs, empty and long texts, repeated rows,
clashing columns, empty tables) and against brute force on a small fixture."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from revlens.llm import (bfd_packing, common, compression_bands, gru_lm, license_scan, mixture_packing, part_enum,
                         prefix_decontam, rff_quality, suffix_dedup, tokens, virtual_slots)
from revlens.llm.oracles import ORACLES
from revlens.llm.registry import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards quietly box"
BASE = " ".join(f"w{i}" for i in range(80))
ROWS = [
    (1, BASE), (2, BASE), (3, BASE.replace("w40", "x40")), (4, None), (5, ""), (6, " \n\t "), (7, "one"),
    (8, "café über 中文 don't <|x| 12,5!!"), (9, f"before {PASSAGE.upper()} after"),
    (10, "la " * 9000), (10, "la " * 9000), (None, BASE + " tail"), (None, None),
    (11, "Some text.\nReleased under the MIT License.\nmore"), (12, PASSAGE + " " + BASE + " " + PASSAGE),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None if k % 4 == 0 else f"s{k % 3}", len(t or ""), k, "x") for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, row_id int, node string").repartition(3)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, PASSAGE), (2, PASSAGE + " again"), (3, "one"), (4, None), (5, "")],
                                 "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 0), (7, 0, 0), (10, 0, 0), (None, 1, 0), (8, None, 0)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_bands(docs, none):
    got = {(r.doc_id, r.n_words): r for r in compression_bands.compression_bands(docs).collect()}
    assert got[4, 0].base_failed and not got[4, 0].kept and got[4, 0].verdict == "empty"
    assert got[10, 9000].n_repeat_words == 9000 and got[10, 9000].verdict == "repetitive"
    assert got[1, 80].kept and got[1, 80].word_chars == len(BASE) - 79
    assert got[8, 6].n_symbols == 3
    assert compression_bands.compression_bands(none).count() == 0


def prose(n, seed=7):
    """About n bytes of text with the letter and word statistics of prose."""
    dealt = np.random.default_rng(seed)
    kinds = ["".join(dealt.choice(list("etaoinshrdlucmfwypvbgk"), dealt.integers(2, 10))) for _ in range(2_000)]
    weight = 1 / np.arange(20, 2_020)
    return " ".join(kinds[k] for k in dealt.choice(2_000, n // 3 + 1, p=weight / weight.sum()))[:n]


def noise(n, seed=7):
    return base64.b64encode(np.random.default_rng(seed).bytes(n)).decode()[:n]


@pytest.mark.parametrize("size", [3_000, 9_000, 40_000])
def test_bands_judge_every_byte(spark, size):
    """Noise anywhere in a text, its last bytes included, breaks a chunk."""
    limit = next(b for b in compression_bands.DOCUMENT_BANDS if size < b.below)
    rows = [(0, prose(size))]
    for k, at in enumerate((0, size // 3, size - limit.chunk, size), 1):
        # In the longest texts one chunk in ten may be noise.
        long = max(1, size // limit.chunk // 4) * limit.chunk
        rows.append((k, prose(at) + noise(min(long, size - at) or long, k) + prose(max(0, size - at - long))))
    got = {r.doc_id: r for r in compression_bands.compression_bands(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].verdict == "pass" and got[0].n_bad_chunks == 0
    assert got[0].n_chunks == -(-size // limit.chunk)
    assert all(got[k].n_bad_chunks > 0 for k in (1, 2, 3, 4))
    assert all(got[k].verdict != "pass" for k in (1, 2, 4))


def naive_base(text):
    """The base columns, plainly: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i: i + 3]) for i in range(len(words) - 2)]
    count, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        inside.update(range(i, i + 3) if count[w] > 1 else ())
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(inside))


def test_base_columns_against_brute_force(spark, docs):
    for table in (docs, spark.read.parquet(f"{SF_SMALL}/documents.parquet")):
        want = Counter((r.doc_id, *naive_base(r.text)) for r in table.select("doc_id", "text").collect())
        got = compression_bands.compression_bands(table).collect()
        assert Counter(tuple(r[:6]) for r in got) == want
        assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got)


def test_bands_keep_documents_of_good_quality(spark):
    """Long documents labelled good stay; what is kept less is short."""
    good = spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1").select("doc_id")
    judged = compression_bands.compression_bands(spark.read.parquet(f"{SF_SMALL}/documents.parquet").join(good, "doc_id"))
    rows = judged.where("NOT base_failed").collect()
    assert len(rows) > 10 and all(r.kept for r in rows)


def test_slots(docs, none, tmp_path):
    rows = virtual_slots.shard_documents(docs, str(tmp_path / "map"), 256, 5).collect()
    assert len(rows) == len(ROWS)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert all(r.size == len((t or "").encode()) + 16 and r.text_crc32 == zlib.crc32((t or "").encode())
               for r in rows for i, t in ROWS if i == r.doc_id and i is not None)
    spark = docs.sparkSession
    first, second = (virtual_slots.read_map(spark, str(tmp_path / "map"), v) for v in (1, 2))
    assert first.count() == second.count() == 256
    assert virtual_slots.shard_documents(none, str(tmp_path / "empty"), 64, 5).count() == 0


def test_slots_are_near_equal(spark, tmp_path):
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int")).alias("text"))
    sizes = [r["n"] for r in virtual_slots.shard_documents(many, str(tmp_path / "m"), 1024, 40)
             .groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sizes) == 40 and max(sizes) - min(sizes) < 0.02 * np.mean(sizes)


def test_slots_of_records_that_share_an_id(spark, tmp_path):
    # A third of the records without id, a third with one id.
    many = spark.range(3000).select(
        F.when(F.col("id") % 3 == 1, 7).when(F.col("id") % 3 == 2, F.col("id")).cast("long").alias("doc_id"),
        F.concat(F.lit("text "), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")), F.col("id")).alias("text"))
    rows = virtual_slots.shard_documents(many, str(tmp_path / "m"), 1024, 40).collect()
    sizes, places = {}, {}
    for r in rows:
        sizes[r.shard] = sizes.get(r.shard, 0) + r["size"]
        places.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == 3000 and len(sizes) == 40
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * np.mean(list(sizes.values()))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_decontamination(docs, items, none):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for i, t in ((1, PASSAGE), (2, PASSAGE + " again"), (3, "one")):
        w = word.findall(t)
        n = min(10, len(w))
        for a in range(len(w) - n + 1):
            windows.setdefault(tuple(w[a: a + n]), set()).add(str(i))
    expected = []
    for i, t in ROWS:
        w, hit, found = word.findall((t or "").translate({c: c + 32 for c in range(65, 91)})), set(), set()
        for n in {len(x) for x in windows}:
            for a in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[a: a + n])):
                    hit.update(range(a, a + n))
                    found |= ids
        expected.append((i or -1, len(w), len(hit), sorted(found)))
    got = [(r.doc_id or -1, r.n_words, r.n_hit, r["items"]) for r in prefix_decontam.decontaminate(docs, items).collect()]
    assert sorted(got) == sorted(expected)
    assert prefix_decontam.decontaminate(none, items).count() == 0
    assert prefix_decontam.decontaminate(docs, items.where("false")).where("n_hit > 0").count() == 0


def test_items_without_id_still_hit(docs, items):
    named = items.where("item_id = 1")
    nameless = named.selectExpr("CAST(NULL AS LONG) AS item_id", "text")
    want = {(r.doc_id, r.n_words): (r.n_hit, r.spans) for r in prefix_decontam.decontaminate(docs, named).collect()}
    rows = prefix_decontam.decontaminate(docs, nameless).collect()
    assert {(r.doc_id, r.n_words): (r.n_hit, r.spans) for r in rows} == want
    assert any(r.n_hit for r in rows) and all(r["items"] == [] for r in rows)


def test_decontamination_oracle(spark):
    key = "op3_prefix_decontam"
    r = compare(QUERIES[key](spark, SF_SMALL), ORACLES[key], duck(SF_SMALL))
    assert r["ok"], r


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((i or -1, len(sets[k]), min(ids) if ids and sets[k] else i))
    return sorted(out, key=repr)


def test_part_enum(docs, none):
    got = [(r.doc_id or -1, r.n_shingles, r.component_id) for r in part_enum.jaccard_components(docs).collect()]
    assert sorted(got, key=repr) == brute_components(ROWS)
    assert part_enum.jaccard_components(none).count() == 0


def test_part_enum_near_threshold(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):  # one group of copies with more and more edits
        w = list(base)
        for p in rng.choice(60, size=i % 5, replace=False):
            w[p] = f"e{rng.integers(9)}"
        rows.append((i, " ".join(w)))
    got = [(r.doc_id or -1, r.n_shingles, r.component_id) for r in part_enum.jaccard_components(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=repr) == brute_components(rows)


@pytest.mark.parametrize("few", [0, 100_000])
def test_components_rounds(spark, monkeypatch, few):
    monkeypatch.setattr(common, "SENT", few)
    rng = np.random.default_rng(4)
    star = [(1, i) for i in range(2, 40)]
    chain = [(100 + i, 101 + i) for i in range(9)] + [(500, 500), (104, 102), (102, 104)]
    loose = [(int(a), int(b)) for a, b in rng.integers(200, 260, (40, 2))]
    for edges, rounds in ((star, 1), (chain + star + loose, 5)):
        parent = {n: n for e in edges for n in e if e[0] != e[1]}
        for _ in parent:
            for a, b in edges:
                if a != b:
                    parent[a] = parent[b] = min(parent[a], parent[b])
        with common.stored_within() as made:
            got = common.components(spark.createDataFrame(edges, "a long, b long"))
        assert sorted(map(tuple, got.collect())) == sorted(parent.items())
        assert len(made) <= rounds  # a star needs no second round to be known as one
        common.freed(*made)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6))
def test_linked_sets_share_a_signature(size, seed):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
    keep = a[rng.random(len(a)) < rng.uniform(0.8, 1)]
    b = np.unique(np.concatenate([keep, rng.integers(0, 2**63, rng.integers(0, 1 + size // 8), dtype=np.uint64)]))
    if not len(b) or 100 * len(np.intersect1d(a, b)) < 75 * len(np.union1d(a, b)):
        return
    scheme = part_enum.Scheme()
    assert len(np.intersect1d(part_enum.signatures(a, scheme), part_enum.signatures(b, scheme)))
    x, y = (np.frombuffer(part_enum._histogram(s), np.uint8) for s in (a, b))
    assert part_enum._may_link(x, y, len(a), len(b), scheme)


def test_language_model(docs, none):
    rows = gru_lm.score(docs).collect()
    assert len(rows) == len(ROWS) and all(np.isfinite([r.score, r.base_score]).all() for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (4, 5, 6)} == {1}
    assert gru_lm.score(none).count() == 0


def test_language_model_gradient():
    counts = np.arange(40, 0, -1)
    words = np.random.default_rng(0).integers(0, 2**63, 40, dtype=np.uint64)
    vocab = gru_lm.Vocabulary(words, counts, np.ones(gru_lm.TAILS), np.ones(gru_lm.TAILS), int(counts.sum()), 40)
    net = gru_lm.Network(vocab)
    flat = net.start(vocab).astype(np.float64)
    rng = np.random.default_rng(1)
    slot = rng.integers(-1, 40, (6, 3))
    tail, used = rng.integers(0, gru_lm.TAILS, (6, 3)), rng.random((6, 3)) < 0.8
    ids, h = rng.integers(0, 40, (6, 3)), rng.normal(size=(3, gru_lm.HIDDEN))

    def loss(w):
        p = net.views(w)
        states, _ = gru_lm._steps(p, ids, h)
        found = gru_lm.log_probability(p, net.width, states.reshape(-1, gru_lm.HIDDEN), slot.ravel(), tail.ravel())
        return -(found * used.ravel()).sum() / used.sum()

    g = gru_lm.gradient(net, flat, ids, slot, tail, used, h)
    for at in rng.choice(np.flatnonzero(np.abs(g) > 1e-3), 12):
        step = np.zeros(net.size)
        step[at] = 1e-2
        assert abs((loss(flat + step) - loss(flat - step)) / 2e-2 - g[at]) < 2e-3 + 0.05 * abs(g[at])


def test_quality(docs, labels, none):
    rows = rff_quality.classify(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows if r.doc_id is not None)
    assert rff_quality.classify(none, labels).count() == 0
    assert {r.score for r in rff_quality.classify(docs, labels.where("false")).collect()} != set()


def test_isotonic():
    assert rff_quality.isotonic(np.ones(4), np.array([0, 1, 0, 1.0])).tolist() == [0, 0.5, 0.5, 1]


def brute_dedup(rows, n=100):
    seen, out = set(), []
    for i, t in rows:
        raw = (t or "").encode()
        mark = np.zeros(len(raw), bool)
        for a in range(len(raw) - n + 1):
            if raw[a: a + n] in seen:
                mark[a: a + n] = True
            seen.add(raw[a: a + n])
        kept = bytes(np.frombuffer(raw, np.uint8)[~mark])
        out.append((i or -1, len(raw), int(mark.sum()), int((np.diff(mark.astype(int), prepend=0) == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_suffix_dedup(docs, none):
    got = [(r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.dedup(
        docs.drop("row_id")).collect()]
    ordered = [x for x in ROWS if x[0] is not None] + [x for x in ROWS if x[0] is None]
    assert sorted(got) == brute_dedup(ordered)
    assert suffix_dedup.dedup(none.drop("row_id")).count() == 0


def test_licenses(docs, none):
    got = {(r.doc_id, r.n_lines): r.licenses for r in license_scan.license_scan(docs).collect()}
    assert got[11, 3] == ["MIT"] and got[4, 1] == []
    assert license_scan.license_scan(none).count() == 0


def test_bfd_packing_round_trip(docs, none):
    encoder = Tokenizer.from_file(VOCABULARY)
    rows = bfd_packing.bfd_pack(docs, VOCABULARY, capacity=64).collect()
    found = {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == 64 and r.cu_seqlens[-1] == r.n_tokens <= 64
        for d, s, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert np.frombuffer(r.positions, "<u4")[a:b].tolist() == list(range(b - a))
            found.setdefault((d, s), []).append(ids[a:b].tolist())
    for i, t in ROWS:
        if i in (1, 8, 9, 10, 4):
            ids = encoder.encode(t or "", add_special_tokens=False).ids + [2]
            assert all(ids[a: a + 64] in found[i, a] for a in range(0, len(ids), 64))
    assert sum(map(len, found.values())) == sum(len(r.doc_ids) for r in rows)
    assert bfd_packing.bfd_pack(none, VOCABULARY).count() == 0


def test_mixture_packing_round_trip(docs, none):
    encoder = Tokenizer.from_file(VOCABULARY)
    rows = mixture_packing.pack(docs, VOCABULARY, capacity=128).collect()
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for number, parts in windows.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 128 or number == max(windows)
    for i, t in ROWS:
        if i in (1, 8, 9, 4):
            ids = encoder.encode(t or "", add_special_tokens=False).ids + [2]
            mine = sorted((r.start, r.ids) for r in rows if r.doc_id == i)
            assert np.frombuffer(b"".join(x for _, x in mine), "<u4").tolist() == ids
    assert mixture_packing.pack(none, VOCABULARY).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=6), st.integers(1, 40))
def test_schedule_keeps_proportions(lengths, capacity):
    s = mixture_packing.Schedule(lengths, capacity=capacity)
    before = [0] * len(lengths)
    for w in range(1, -(-s.total // capacity) + 1):
        now = s.served(w)
        assert sum(now) == min(w * capacity, s.total) and all(a <= b for a, b in zip(before, now))
        assert all(abs(x - sum(now) * n / s.total) <= len(lengths) for x, n in zip(now, lengths))
        before = now
    assert before == lengths or not s.total


def test_mixture_windows_sort_queues_once(monkeypatch):
    rng = np.random.default_rng(5)
    s = mixture_packing.Schedule([int(n) for n in rng.integers(1, 90_000, 20)] + [0] * 12, capacity=4096)
    asked, due = [], mixture_packing.Schedule._due
    monkeypatch.setattr(mixture_packing.Schedule, "_due", lambda self, q, x: asked.append(q) or due(self, q, x))
    windows = -(-s.total // s.capacity)
    assert [sum(s.served(w)) for w in range(windows + 1)] == [min(w * 4096, s.total) for w in range(windows + 1)]
    assert len(asked) < 20 * windows


@pytest.mark.parametrize("raw", ["Étage", "naïve", "NAÏVE", "a" * 70, "don't", "<|endoftext|>", "Hello,", "é,", "x1y2",
                                 "…!", "ÀÉÎ", "straße", "word.word", "\x00ab", "東京", "Ab" * 40 + "!?"])
def test_encoder_odd_words(raw):
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = Tokenizer.from_file(path).encode(raw, add_special_tokens=False).ids
    assert np.frombuffer(tokens.encoder(path).encode(raw.encode()), "<u2").tolist() == ids



def test_pipeline_stages(spark, docs):
    rows = docs
    for name in ("copy", "most", "bad_id", "n_bytes", "n_removed", "same", "spans", "c0", "_row", "component_id", "items"):
        rows = rows.withColumn(name, F.concat(F.lit(name), F.col("row_id")))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, SF_SMALL)
        if name != "packing":
            assert out.columns == rows.columns
            back = {r.row_id: r for r in rows.collect()}
            for r in out.collect():
                assert all(r[c] == back[r.row_id][c] for c in out.columns if c not in ("text", "n_chars"))
        assert stage(spark, rows.where("false"), SF_SMALL).count() == 0
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, rows, SF_SMALL).collect()}
    assert 1 in kept and not kept & {2, 3}


def test_pipeline_judges_rows_not_ids(spark):
    passage = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").orderBy("item_id").first().text
    texts = [(None, "clean words of a row without id"), (None, passage), (5, passage), (5, "other clean words of id five"),
             (6, BASE), (6, BASE), (6, "a different text with the same id"), (None, BASE + " x")]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    kept = corpus_pipeline.benchmark(spark, rows, SF_SMALL).collect()
    assert sorted(r.text for r in kept) == sorted(t for _, t in texts if t != passage)
    kept = corpus_pipeline.near_copies(spark, rows.where(F.col("text") != passage), SF_SMALL).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([
        ("None", texts[0][1]), ("5", texts[3][1]), ("6", BASE), ("6", texts[6][1])])


def test_suffix_dedup_splits_large_groups(monkeypatch):
    import random

    rng = random.Random(5)
    passage = bytes(rng.choices(range(97, 123), k=260))
    texts = [bytes(rng.choices(range(97, 100), k=rng.randrange(0, 150))) + passage[rng.randrange(3) * 9:]
             + bytes(rng.choices(range(97, 100), k=rng.randrange(0, 150))) for _ in range(60)]
    texts += [b"ab" * 300, b"xy" + b"ab" * 200, texts[0]]
    for chunk, part in ((1 << 18, 1 << 20), (400, 1 << 20), (400, 64)):
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
        monkeypatch.setattr(suffix_dedup, "PART", part)
        parts = []
        for i, raw in enumerate(texts):
            for h, a, b in zip(*(x.tolist() for x in suffix_dedup.anchors(raw))):
                parts.append((h, raw[a: b + 100], (i, i, a)))
        parts.sort(key=lambda p: p[0])
        lost = [bytearray(len(t)) for t in texts]
        for row, a, b in suffix_dedup._index(parts, 100):
            lost[row][a:b] = b"\1" * (b - a)
        seen, want = set(), [bytearray(len(t)) for t in texts]
        for i, raw in enumerate(texts):
            for a in range(len(raw) - 99):
                if raw[a: a + 100] in seen:
                    want[i][a: a + 100] = b"\1" * 100
                seen.add(raw[a: a + 100])
        assert lost == want


def test_language_model_trains_on_all_windows(monkeypatch):
    texts = [" ".join(f"w{(i * j) % 50}" for i in range(n)).encode() for j, n in enumerate((700, 0, 5, 64, 31, 200), 1)]
    tokens, at = gru_lm._tokens(texts)
    words, counts = np.unique(tokens, return_counts=True)
    vocab = gru_lm.Vocabulary(words, counts, np.ones(gru_lm.TAILS), np.ones(gru_lm.TAILS), len(tokens), len(words))
    net = gru_lm.Network(vocab)
    monkeypatch.setattr(gru_lm, "LANES", 2)
    taken, plain = [], gru_lm.gradient_and_state

    def watched(net, flat, ids, slot, tail, used, h):
        out = plain(net, flat, ids, slot, tail, used, h)
        taken.append((int(used.sum()), h.copy(), out[1].copy()))
        return out

    monkeypatch.setattr(gru_lm, "gradient_and_state", watched)
    weights, squares = net.start(vocab), np.full(net.size, 1e-4, np.float32)
    raw, start = gru_lm.inputs_of(vocab, tokens).astype("<u2").tobytes(), int(gru_lm.inputs_of(vocab, np.array([gru_lm.END]))[0])
    coded = gru_lm.Coded([raw[2 * a: 2 * b] for a, b in zip(at, at[1:])], start)
    assert gru_lm.train_texts(net, weights, squares, coded) == len(tokens) == sum(n for n, _, _ in taken)
    # The first lane takes the longest text: its state goes on from window to window.
    assert all((b[1][0] == a[2][0]).all() for a, b in zip(taken[:21], taken[1:22])) and not taken[0][1].any()
    windows = [(int(t), int(b)) for who, begin in gru_lm.lane_windows(np.diff(at), 2) for t, b in zip(who, begin)]
    assert sorted(windows) == [(t, b) for t, n in enumerate(np.diff(at)) for b in range(0, n, gru_lm.STEPS)]


def test_language_model_beats_its_base(spark):
    sums = gru_lm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).groupBy("held_out").agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).collect()
    assert len(sums) == 2 and all((r.s - r.b) / r.n > 0.1 for r in sums)


def test_language_model_is_a_distribution_on_few_words(spark):
    # Fewer kinds than HEAD: the probabilities of all one-word texts and of one
    # unseen word with each ending sum to one less what follows the first word.
    kinds = [f"{a}{b}" for a in "abcdef" for b in "uvwxyz"]
    words = np.unique(gru_lm._tokens([" ".join(kinds).encode()])[0])
    counts = np.arange(1, len(words) + 1)
    vocab = gru_lm.Vocabulary(words, counts, np.zeros(gru_lm.TAILS), np.zeros(gru_lm.TAILS), int(counts.sum()), len(words))
    net = gru_lm.Network(vocab)
    p = net.views(net.start(vocab))
    slots = vocab.head_slot(words)
    states = np.zeros((len(words), gru_lm.HIDDEN), np.float32)
    mass = np.exp(gru_lm.log_probability(p, net.width, states, slots, np.zeros(len(words), int))).sum()
    assert 0.9 < mass <= 1 + 1e-5


def test_licenses_over_line_breaks(spark):
    apache, mit = license_scan.PASSAGES["Apache-2.0"][0], license_scan.PASSAGES["MIT"][0]
    gpl, bsd = license_scan.PASSAGES["GPL-2.0"][0], license_scan.PASSAGES["BSD-3-Clause"][0]

    def wrapped(text, n=9, mark="# "):
        words = text.split()
        return "\n".join(mark + " ".join(words[i: i + n]) for i in range(0, len(words), n))

    texts = {1: f"Copyright 2020\n{wrapped(apache)}\nimport os", 2: wrapped(mit, 12, " * "), 3: f"x y\n{wrapped(gpl)} z",
             4: wrapped(bsd, 11, "// "), 5: "under the terms of the " * 400 + "license",
             6: wrapped(mit.replace("hereby", "now").replace("furnished", "given"), 7)}
    found = license_scan.license_scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    assert {r.doc_id: r.licenses for r in found.collect()} == {
        1: ["Apache-2.0"], 2: ["MIT"], 3: ["GPL-2.0"], 4: ["BSD-3-Clause"], 5: [], 6: ["MIT"]}


def test_license_bodies_and_tags(spark):
    """A license body, wrapped and with other text around, and a tag alone are
    told from the bodies and tags of the licenses next to them."""

    def wrapped(text, n):
        words = text.split()
        return "\n".join("    " + " ".join(words[i: i + n]) for i in range(0, len(words), n))

    rows, want = [], {}
    for name, passages in [*license_scan.BODIES.items(), *license_scan.tags().items()]:
        for k, passage in enumerate(passages):
            i = len(rows)
            rows.append((i, f"{BASE}\n{wrapped(passage, 7 + k)}\nThe rest follows."))
            want[i] = [name]
    bsd = license_scan.PASSAGES["BSD-3-Clause"][1]
    three = f"{bsd} THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS"
    for text, names in ((wrapped(three, 10), ["BSD-3-Clause"]), ("spdx license identifier", []),
                        ("// SPDX-License-Identifier: (MIT OR Apache-2.0)", ["MIT"]),
                        ("# SPDX-License-Identifier: MIT\nx\n# SPDX-License-Identifier: GPL-2.0-only", ["GPL-2.0", "MIT"])):
        want[len(rows)] = names
        rows.append((len(rows), text))
    found = license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.licenses for r in found.collect()} == want


def naive_licenses(text, threshold):
    """Every window that starts with a bigram of a template, compared one by one."""
    words = license_scan._words(text)
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    matches = []
    for name, size, grams in license_scan.passages():
        own = set(grams)
        for at in (i for i, g in enumerate(pairs) if g in own):
            window = pairs[at: at + size - 1]
            dice = 2 * len(own & set(window)) / (len(set(window)) + len(own))
            if dice >= threshold:
                matches.append((dice, name, at, max(at + i for i, g in enumerate(window) if g in own) + 2))
    return {m[1] for m in matches if not any(
        o[1] != m[1] and o[2] < m[3] and m[2] < o[3] and (o[0], o[3] - o[2]) > (m[0], m[3] - m[2]) for o in matches)}


def test_license_windows_against_brute_force(spark):
    """Passages with words lost, doubled and put in, between other text; the
    scan finds what comparing every window finds (and lines of its own)."""
    dealt = np.random.default_rng(5)
    texts = []
    every = [t for table in (license_scan.PASSAGES, license_scan.BODIES, license_scan.tags())
             for ts in table.values() for t in ts]
    for k, passage in enumerate(every):
        words = passage.split()
        for _ in range(int(dealt.integers(0, 4)) if len(words) > 4 else 0):
            at = int(dealt.integers(0, len(words)))
            words[at: at + 1] = [[], [words[at]] * 2, ["other", words[at]]][int(dealt.integers(0, 3))]
        texts.append((k, f"{BASE[: 40]}\n" + "\n".join(words) + f"\n{every[k - 1][:90]}"))
    found = license_scan.license_scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    lines_only = {r.doc_id for r in found if r.n_license_lines}
    assert len(found) == len(texts) and len(lines_only) < len(texts) / 2
    text = dict(texts)
    for r in found:
        want = naive_licenses(text[r.doc_id], license_scan.THRESHOLD)
        assert set(r.licenses) >= want and (r.doc_id in lines_only or set(r.licenses) == want)


def test_suffix_dedup_reads_row_ids_from_one_copy(spark, tmp_path):
    rows = [(i, f"text {i} " + " ".join(f"{i}x{j}" for j in range(60)) + (PASSAGE * 2 if i % 3 == 0 else ""))
            for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6).write.parquet(str(tmp_path / "in"))
    plain, calls = suffix_dedup.repeated_anchors, []

    def splits_change(*args):
        # Another split of the input from here on, as when an executor is lost.
        calls.append(spark.conf.set("spark.sql.files.maxPartitionBytes", "2k"))
        return plain(*args)

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(suffix_dedup, "repeated_anchors", splits_change)
        try:
            docs = spark.read.parquet(str(tmp_path / "in"))
            got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.dedup(docs).collect()]
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert calls and sorted(got) == [(i, *x[1:]) for i, x in zip(range(30), sorted(
        (0 if r[0] == -1 else r[0], *r[1:]) for r in brute_dedup(rows)))]


def test_mixture_packing_many_sources(spark):
    docs = spark.createDataFrame([(i, " ".join(["word"] * 40), f"s{i % 200}") for i in range(600)],
                                 "doc_id long, text string, source string").repartition(4)
    rows = mixture_packing.pack(docs, VOCABULARY, capacity=2000).collect()
    total = sum({r.doc_id: r.doc_tokens for r in rows}.values())
    assert sum(r.length for r in rows) == total and len({r.doc_id for r in rows}) == 600
    used = sorted((r.sequence_id * 2000 + r.offset, r.length) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(used, used[1:])) and used[0][0] == 0
    share = {}
    for r in rows:
        share[r.sequence_id, r.source] = share.get((r.sequence_id, r.source), 0) + r.length
    # 10 tokens of each of 200 sources in every full window.
    assert all(7 <= share.get((w, f"s{s}"), 0) <= 13 for w in range(total // 2000) for s in range(200))


@pytest.mark.parametrize("portion", [1, 7, 1 << 17])
def test_sets_in_portions_are_those_of_single_texts(monkeypatch, portion):
    import pyarrow as pa

    from revlens.llm.text import SPACED, hashed_words, shingles
    monkeypatch.setattr(part_enum, "PORTION", portion)
    texts = [None, "", "a", "a b", "a b c d e", "A b c d e f", " x\ty ", "a " * 30, "\n", "q w e", "a b c d e f"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    found = list(part_enum._sets(batch))
    assert len(found) == len(texts)
    for text, (node, grams) in zip(texts, found):
        words, _ = hashed_words([(text or "").encode()], SPACED, lower=True)
        assert grams.tolist() == np.unique(shingles(words, 5)).tolist()
        assert (node is None) == (len(words) == 0)
    assert found[4][0] != found[5][0] == found[10][0]
    assert list(part_enum._sets(batch.slice(0, 0))) == []
