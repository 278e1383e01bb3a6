"""Registered queries of the training-data operators: thin calls that apply an
operator to its whole table and derive the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_and_decode
from .chat import ORACLE as CHAT_ORACLE, op5_chat_formatting
from .common import read_table
from .exact_dedup import exact_groups
from .fingerprint import fingerprint_with_edits
from .langid import fit_language_model, identify
from .licences import oracle as licence_oracle, scan_licences
from .merkle import ORACLE as MERKLE_ORACLE, leaf_digest, manifest, verify
from .packing import pack
from .pii import KINDS, count_kind, find_personal_data, span_text
from .resample import ORACLE as RESAMPLE_ORACLE, resample
from .simhash import near_groups
from .suffix_dedup import remove_repeats
from .toxicity import fit_toxicity, score_documents


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"), keep="max")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return score_documents(docs, model, threshold=0.7)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(read_table(spark, sf_dir, "documents"), shingle=4, distance=4)


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, window=200).select(
        "doc_id", F.col("_sfx_n_bytes").alias("n_bytes"), F.col("_sfx_n_removed").alias("n_removed"),
        F.col("_sfx_n_spans").alias("n_spans"), F.sha2("_sfx_kept", 256).alias("kept_sha256"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), capacity=2048)


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_with_edits(read_table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, fit_language_model(docs))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(read_table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(read_table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawn towards the texts of the benchmark."""
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of every document, counted by kind and digested, and all spans found."""
    found = find_personal_data(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[count_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and the root that the
    document leads to after line breaks were deleted from every text whose id
    has an even crc32 (an id that is null is not tampered with)."""
    docs = read_table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    even = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 2 == 0
    changed = F.when(even, F.replace(docs["text"], F.lit("\n"), F.lit(""))).otherwise(docs["text"])
    tampered = leaf_digest(*[docs[f] for f in fields[:-1]], changed)
    rows = manifest(docs, fields, carry={"tampered": F.unhex(tampered)})
    return verify(rows.withColumn("tampered", F.lower(F.hex("tampered"))), "tampered").select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_language_id": op8_language_id,
    "op9_license_scan": op9_license_scan,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_personal_data": op12_personal_data,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES = {
    "op5_chat_formatting": CHAT_ORACLE,
    "op9_license_scan": licence_oracle(),
    "op11_importance_resampling": RESAMPLE_ORACLE,
    "op13_merkle_manifest": MERKLE_ORACLE,
    "op1_exact_dedup": """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
""",
}
