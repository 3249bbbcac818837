"""Registered queries of the text operators: key -> (spark, sf_dir) -> DataFrame.

Each applies its operator to the whole intended table with production
parameters; digest columns are derived from the operator's own output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import (
    bfd_packing,
    compression_bands,
    doubling_dedup,
    gru_lm,
    license_scan,
    merkle_manifest,
    mixture_packing,
    part_enum,
    prefix_decontam,
    rff_quality,
    spelling_variants,
    suffix_dedup,
    virtual_slots,
)
from revlens.llm.common import shared_dir, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary() -> str:
    """The public vocabulary file that the packing queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register
def op1_compression_bands(spark, sf_dir):
    return compression_bands.compression_bands(table(spark, sf_dir, "documents"))


@register
def op2_virtual_slots(spark, sf_dir):
    return virtual_slots.shard_documents(
        table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/shard-map-{uuid.uuid4().hex}")


@register
def op3_prefix_decontam(spark, sf_dir):
    found = prefix_decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@register
def op8_license_scan(spark, sf_dir):
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


@register
def op9_bfd_packing(spark, sf_dir):
    packed = bfd_packing.bfd_pack(table(spark, sf_dir, "documents"), vocabulary())
    return packed.select("sequence_id", "n_tokens", "doc_ids", "starts", "cu_seqlens",
                         F.crc32("ids").alias("ids_crc32"), F.crc32("positions").alias("positions_crc32"))


@register
def op10_mixture_packing(spark, sf_dir):
    pieces = mixture_packing.pack(table(spark, sf_dir, "documents"), vocabulary())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "source")


@register
def op6_rff_quality(spark, sf_dir):
    scored = rff_quality.classify(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                  table(spark, sf_dir, "labels"))
    return scored.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "score", "predicted")


@register
def op4_part_enum(spark, sf_dir):
    return part_enum.jaccard_components(table(spark, sf_dir, "documents"))


@register
def op7_suffix_dedup(spark, sf_dir):
    cut = suffix_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register
def op5_gru_lm(spark, sf_dir):
    return gru_lm.score(table(spark, sf_dir, "documents"))


@register
def op11_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    changed = {"text": merkle_manifest.tampered_text(F.col("doc_id"), F.col("text"))}
    rows = merkle_manifest.audited(docs, changed)
    proof = F.sha2(F.array_join(merkle_manifest.siblings(F.col("path")), ""), 256)
    return rows.select(F.col("ordered").alias("doc_id"), "leaf", "subroot", "root", proof.alias("proof_sha256"),
                       "folded_root", "verified")


@register
def op13_doubling_dedup(spark, sf_dir):
    cut = doubling_dedup.dedup(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


@register
def op12_spelling_variants(spark, sf_dir):
    runs = spelling_variants.runs_of(table(spark, sf_dir, "documents")).where(F.length("word") >= 6)
    return spelling_variants.variants(spelling_variants.vocabulary(spelling_variants.with_deletions(runs)))
