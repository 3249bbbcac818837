"""Best-fit packing, packed files, slots and quality scores against plain
versions over whole small tables."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revlens.llm import bfd_packing, rff_quality, virtual_slots
from tests.conftest import SF_SMALL

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=150))
def test_best_fit_against_plain(lengths):
    """The fills are those of a search through all open rows."""
    free = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in range(len(free)) if free[r] >= length]
        if fits:
            free[min(fits, key=lambda r: free[r])] -= length
        else:
            free.append(64 - length)
    rows = bfd_packing.best_fit_decreasing(lengths, 64)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    assert sorted(sum(lengths[i] for i in r) for r in rows) == sorted(64 - f for f in free)


def test_packed_files(spark, tmp_path):
    """The written matrix, cumulative lengths and positions give every
    document's ids back; padding is only at the end of rows."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").repartition(3)
    path, capacity = str(tmp_path / "packed"), 512
    bfd_packing.write_packed(bfd_packing.bfd_pack(docs, VOCABULARY, capacity=capacity), path)
    rows = pq.read_table(path).to_pylist()
    matrix = np.stack([np.frombuffer(r["ids"], "<u4") for r in rows])
    positions = np.stack([np.frombuffer(r["positions"], "<u4") for r in rows])
    assert matrix.shape == positions.shape == (len(rows), capacity)
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    pieces = defaultdict(dict)
    for r, ids, at in zip(rows, matrix, positions):
        cuts = r["cu_seqlens"]
        assert cuts[0] == 0 and cuts[-1] == r["n_tokens"] and not ids[cuts[-1]:].any() and not at[cuts[-1]:].any()
        for doc, start, a, b in zip(r["doc_ids"], r["starts"], cuts, cuts[1:]):
            assert a < b and at[a:b].tolist() == list(range(b - a)) and start not in pieces[doc]
            pieces[doc][start] = ids[a:b].tolist()
    encoder = Tokenizer.from_file(VOCABULARY)
    texts = docs.collect()
    assert set(pieces) == {r.doc_id for r in texts}
    for r in texts:
        found = [i for start in sorted(pieces[r.doc_id]) for i in pieces[r.doc_id][start]]
        assert found == encoder.encode(r.text or "", add_special_tokens=False).ids + [2]


def test_slots_against_plain(spark, tmp_path):
    """Sizes, checksums and places of all documents; records of a slot share
    its shard, and the edit moves slots only."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    path = str(tmp_path / "map")
    rows = virtual_slots.shard_documents(docs, path, 1024, 8).collect()
    raw = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len(t) + 16, zlib.crc32(t)) for i, t in raw.items())
    places, shard_of = defaultdict(list), defaultdict(set)
    for r in rows:
        places[r.shard].append(r.slot)
        shard_of[r.virtual_slot].add(r.shard)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert all(len(s) == 1 for s in shard_of.values())
    first, second = ({r.virtual_slot: r.shard for r in virtual_slots.read_map(spark, path, v).collect()} for v in (1, 2))
    assert set(first) == set(second) == set(range(1024)) and first == {s: s % 8 for s in first}
    assert all(shard_of.get(s, {second[s]}) == {second[s]} for s in second)
    assert all(first[s] == second[s] for s in second if s not in shard_of)


def test_quality_never_sees_held_out_labels(spark):
    """Turning the held-out labels over changes no score, and the scores still
    tell the true ones."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    a, b = ({r.doc_id: r for r in rff_quality.classify(docs, x).collect()} for x in (labels, turned))
    assert a.keys() == b.keys() and all(abs(a[i].score - b[i].score) < 1e-6 for i in a)
    judged = [(a[i].predicted, truth[i]) for i in a if a[i].held_out and truth.get(i) is not None]
    assert len(judged) > 50 and sum(p == t for p, t in judged) >= 0.9 * len(judged)
    assert all(a[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in a)
