"""Exact dedup by recipes of content-defined chunks. DataFrame functions only.

1. Every text is normalised and cut where its own content says so: at the first
   sentence end after ``CHUNK_LEAST`` characters, or after ``CHUNK_MOST``. A
   passage that two texts share is cut alike in both.
2. A chunk's identifier is a 64-bit hash. Identifiers are verified: chunks are
   grouped by identifier, and one whose chunks differ in SHA-256 is struck
   out; recipes that hold such an identifier list the SHA-256s instead.
3. Texts are equal when their ordered identifier lists are. The lists are
   grouped with partial aggregation (a hot group is one row a task) and
   joined back by list.

Text never leaves the task that reads it: only recipes (40 bytes a chunk) are
written and grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.plans.materialize import materialize

CHUNK_LEAST, CHUNK_MOST = 256, 2048


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one blank; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t-\r]+", " ")


def chunks(text: Column, least: int = CHUNK_LEAST, most: int = CHUNK_MOST) -> Column:
    """The text cut at content-defined places; the chunks joined are the text."""
    pattern = rf"(?s).{{{least},{most - 1}}}?[.!?] |.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def recipes(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text_sha256, ids, proofs)``: the ordered chunk hashes and their SHA-256s."""
    cut = docs.select(F.col(id).cast("bigint").alias("doc_id"), normalised(F.col(text)).alias("__t"))
    cut = cut.select("doc_id", F.sha2("__t", 256).alias("text_sha256"), chunks(F.col("__t")).alias("__c"))
    return cut.select("doc_id", "text_sha256",
                      F.transform("__c", lambda c: F.xxhash64(c)).alias("ids"),
                      F.transform("__c", lambda c: F.unhex(F.sha2(c, 256))).alias("proofs"))


def ambiguous(recipe: DataFrame) -> DataFrame:
    """``(id)``: identifiers that stand for chunks of different SHA-256."""
    pairs = recipe.select(F.explode(F.arrays_zip("ids", "proofs")).alias("c"))
    return (pairs.groupBy(F.col("c.ids").alias("id"))
            .agg(F.min("c.proofs").alias("least"), F.max("c.proofs").alias("most"))
            .filter(F.col("least") != F.col("most")).select("id"))


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per input row.

    ``keep_id`` is the smallest id of the row's group of equal normalised
    texts. Null and empty texts are one group. A null id never stays unless
    its group has no other (``keep_id`` is null then and ``kept`` is false);
    repeated rows count each, and those with the smallest id are all kept. An
    empty table gives no rows. Other columns are ignored, whatever their names.
    """
    recipe = materialize(recipes(docs, id, text), "recipes")
    struck = materialize(ambiguous(recipe), "struck_ids")
    holds = (recipe.select(F.monotonically_increasing_id().alias("row"), "ids", "proofs")
             .select("proofs", F.explode("ids").alias("id")).join(struck, "id", "left_semi")
             .select(F.col("proofs").alias("bad")).distinct())
    # Where an identifier is struck out the recipe is told apart by its SHA-256s.
    proofs = materialize(holds, "struck_recipes")
    keyed = (recipe.join(proofs, recipe.proofs == proofs.bad, "left")
             .select("doc_id", "text_sha256", "ids", "bad"))
    groups = keyed.groupBy(F.col("ids").alias("g_ids"), F.col("bad").alias("g_bad")).agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    same = (keyed.ids == groups.g_ids) & keyed.bad.eqNullSafe(groups.g_bad)
    return keyed.join(groups, same).select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), "text_sha256")
