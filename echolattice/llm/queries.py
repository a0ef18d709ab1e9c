"""The queries of this subpackage and their SQL, one per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echolattice.llm import chat_trees, histogram_packing, histogram_sort, license_paragraphs, lm_interpolation, merkle_manifest, prefix_decontam, quality_risk, seed_extend, simhash_pivot, suffix_buckets, twins, value_dictionaries, warc_shards
from echolattice.llm.common import read
from echolattice.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {
    "op11_value_dictionaries": twins.vector_codes(),
    "op12_warc_shards": twins.WARC,
    "op13_merkle_manifest": twins.merkle(),
}


def _query(function):
    QUERIES[function.__name__] = function
    return function


@_query
def op4_suffix_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_buckets.remove_repeats(read(spark, sf_dir, "documents"), keep_text=False)


@_query
def op5_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_extend.remove_passages(read(spark, sf_dir, "documents"), keep_text=False)


@_query
def op3_pivot_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_pivot.near_duplicates(read(spark, sf_dir, "documents"))


@_query
def op10_prefix_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prefix_decontam.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("hit_spans", "hit_items", "th")


@_query
def op2_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_risk.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_query
def op7_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_packing.pack(read(spark, sf_dir, "documents"))


@_query
def op9_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = histogram_sort.shard(read(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", F.col("shard_size").alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", F.col("shard_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


#: A conversation whose texts look like the template.
_LOOKALIKE = "</s>[INST] ok [/INST]"


@_query
def op6_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_LOOKALIKE).alias("text")
    )
    back = chat_trees.read_back(chat_trees.formatted(chat_trees.chains(given.unionByName(extra))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("under_loss").cast("long").alias("loss_chars"), F.sha2(F.col("under_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@_query
def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_interpolation.score(read(spark, sf_dir, "documents"))


@_query
def op8_license_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_paragraphs.scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_paragraphs", "n_licensed", "n_unknown", F.array_join("families", ",").alias("families"), F.round("licence_probability", 6).alias("licence_probability"))


def merkle_proofs(docs: DataFrame) -> DataFrame:
    """The digests of :func:`merkle_manifest.checked`."""
    found = merkle_manifest.checked(docs)
    proof = merkle_manifest.digest(merkle_manifest.siblings(F.col("steps")))
    return found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", "verified")


@_query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_proofs(read(spark, sf_dir, "documents"))


def vector_codes(vectors: DataFrame) -> DataFrame:
    codes = value_dictionaries.compress(vectors)
    return value_dictionaries.with_label_errors(codes).select("vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))


@_query
def op11_value_dictionaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(read(spark, sf_dir, "embeddings"))


@_query
def op12_warc_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark).rstrip('/')}/llm-warc-{uuid.uuid4().hex}"
    warc_shards.write(read(spark, sf_dir, "pages"), path)
    return warc_shards.read_back(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
