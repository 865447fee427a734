"""A training corpus from ``documents``: five stages, each by one of the operators of ``marquee.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept; its result is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.

Rows are told apart by ``doc_id`` and text. Of a group of equal or near texts
one row stays, that of the smallest id (null ids last), also where the rows of
a group repeat an id or have none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.exact_dedup import exact_dedup, normalised
from marquee.llm.minhash import near_dedup, row_key
from marquee.llm.packing import best_fit_pack
from marquee.llm.quality import good_documents
from marquee.llm.queries import table, vocabulary
from marquee.llm.secret_scan import redact
from marquee.llm.shipping import ship
from marquee.plans.materialize import materialize, remove_tables


def _one_row_of_each(docs: DataFrame, key: Column, kept: DataFrame) -> DataFrame:
    """One of the documents of each key that ``kept (__kept, __rows)`` lists, ``__rows`` being how many have it."""
    keyed = docs.withColumn("__key", key)
    # Merged at every size: a plan that depends on the number of keys would move the texts from some size on only.
    single = keyed.join(kept.filter("__rows = 1").hint("merge"), F.col("__key") == F.col("__kept"), "left_semi")
    # Rows that repeat (few, or very many of one key) are reduced in the tasks that read them.
    several = keyed.join(kept.filter("__rows > 1").hint("shuffle_hash"), F.col("__key") == F.col("__kept"), "left_semi")
    row = F.struct(*[F.col(c).alias(f"c{n}") for n, c in enumerate(docs.columns)])
    least = several.groupBy("__key").agg(F.min_by(row, F.coalesce("text", F.lit(""))).alias("__row"))
    return single.select(*docs.columns).union(
        least.select(*[F.col(f"__row.c{n}").alias(c) for n, c in enumerate(docs.columns)]))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    ship(spark)
    return good_documents(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space aside) one row of the smallest id."""

    def key(sha256):
        return F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), sha256)

    stay = exact_dedup(docs).filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    kept = stay.groupBy(key(F.col("text_sha256")).alias("__kept")).agg(F.count(F.lit(1)).alias("__rows"))
    return _one_row_of_each(docs, key(F.sha2(normalised(F.col("text")), 256)), materialize(kept, "kept_rows"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) one row of the smallest id."""
    ship(spark)
    # A text without words is a group of its own.
    group = F.coalesce(F.col("group_id").cast("string"), F.col("row_key"))
    rows = near_dedup(docs).groupBy(group.alias("group"), "row_key").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key", "rows"))
    kept = rows.groupBy("group").agg(first.alias("r")).select(
        F.col("r.row_key").alias("__kept"), F.col("r.rows").alias("__rows"))
    return _one_row_of_each(docs, row_key(), materialize(kept, "kept_rows"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by ``[SECRET]`` and ``n_chars`` counted again where the text changed."""
    ship(spark)
    clean = redact(docs, flag="__changed")
    n_chars = F.when(F.col("__changed"), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", n_chars).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' pieces, packed into sequences of at most 1024 tokens."""
    ship(spark)
    return best_fit_pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_duplicates),
    ("minhash_near_dedup", near_duplicates),
    ("secret_scans", secret_scans),
    ("best_fit_packing", packing),
]

# A fitted classifier, signatures and a tokenizer are beyond SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    docs, written = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name, written)
        remove_tables(spark, written[:-1])  # nothing reads the stage before any more
        del written[:-1]
    return STAGES[-1][1](spark, docs, sf_dir)
