"""Stop lists of any size, as a table instead of a literal in the plan.

Terms are counted first and stop words leave the *distinct counted* terms by a
join, so the join sees a term once per segment, never once per token. The
list is written once: it is broadcast when its written size allows and
shuffled by term beyond that.

Scores need no filter at all: weights exist for ranked terms only, and no
stop word is ranked, so a stop word's weight is 0 whether it is filtered or not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.plans.materialize import materialize


def stop_table(words: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """``(stop)``: the distinct non-null words of a frame's first column, written once."""
    return materialize(words.select(words[words.columns[0]].cast("string").alias("stop"))
                       .filter("stop is not null").distinct(), "stop_words", paths)


def without_stops(counts: DataFrame, term: str, stops: DataFrame, only: Column | None = None) -> DataFrame:
    """Counted terms that are no stop words; ``only`` names the rows that the list is for.

    An outer join and a filter, as Spark moves an anti join below the aggregation that counts, where it would see every token.
    """
    same = F.col(term) == F.col("stop")
    return counts.join(stops, same if only is None else same & only, "left").filter("stop is null").drop("stop")


def clean_tokens(df: DataFrame, tokens: str, stops: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """The rows with their token arrays rid of stop words, in order.

    Only the words go through the join: a row's other columns are joined back by a written row number. A
    word that stands in a large share of all rows is in the list or not, and AQE splits its partition.
    """
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "numbered", paths)
    words = rows.select("__row", F.posexplode(tokens).alias("__at", "__word"))
    kept = (without_stops(words, "__word", stops).groupBy(F.col("__row").alias("__of"))
            .agg(F.array_sort(F.collect_list(F.struct("__at", "__word"))).alias("__kept")))
    clean = F.coalesce(F.transform("__kept", lambda x: x["__word"]), F.array().cast("array<string>"))
    return (rows.join(kept, F.col("__row") == F.col("__of"), "left")
            .withColumn(tokens, clean).select(df.columns))
