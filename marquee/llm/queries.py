"""Registered queries of the operators: ``opN_<name>``, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.llm.ann import nearest
from marquee.llm.bpe import encode_documents
from marquee.llm.exact_dedup import exact_dedup
from marquee.llm.line_dedup import line_dedup
from marquee.llm.lm_score import lm_scores
from marquee.llm.merkle import folded, lowered, manifest, proof_digest
from marquee.llm.minhash import near_dedup
from marquee.llm.packing import best_fit_pack
from marquee.llm.quality import quality
from marquee.llm.secret_scan import secret_scan
from marquee.llm.shipping import ship
from marquee.llm.suffix_dedup import remove_repeats
from marquee.llm.token_counts import token_counts
from marquee.llm.variants import MISSPELT, variant_groups


def table(spark, sf_dir: str, name: str):
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_minhash_near_dedup(spark, sf_dir):
    return near_dedup(table(spark, sf_dir, "documents"), words=4).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op2_suffix_array_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark, sf_dir):
    return best_fit_pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op5_quality_classifier(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark, sf_dir):
    return secret_scan(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark, sf_dir):
    return line_dedup(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_byte_bpe(spark, sf_dir):
    return encode_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


def op10_ann_search(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_merkle_manifest(spark, sf_dir):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(tampered, lowered(F.col("text"))).otherwise(F.col("text"))
    found = manifest(table(spark, sf_dir, "documents"), altered={"text": text})
    found = found.withColumn("folded_root", folded(F.coalesce("altered_leaf", "leaf"), F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_lm_scoring(spark, sf_dir):
    return lm_scores(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark, sf_dir):
    return variant_groups(table(spark, sf_dir, "documents"), one_in=MISSPELT).select(
        "word", "form", "root", "n", "n_near", "form_n")


QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_token_counts": op4_token_counts,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_secret_scan": op7_secret_scan,
    "op8_line_dedup": op8_line_dedup,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_ann_search": op10_ann_search,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_lm_scoring": op12_lm_scoring,
    "op13_spelling_variants": op13_spelling_variants,
}
