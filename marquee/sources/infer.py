"""Column types of text columns, inferred from all values in one pass.

A value fits a set of types; what fits a column is the intersection over its
values. Sets are bit masks, so inference is ``bit_and``: partial in each
task, mergeable in any order, independent of how files are split or listed.
The narrowest type that is left is the column's:

    integer < bigint < double < string,   date < timestamp < string,   boolean < string

A single value that fits nothing narrower makes a column text. Nulls (and empty
texts) fit every type; a column without values is text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The lattice from narrow to wide; a type's bit is its place.
TYPES: tuple[str, ...] = ("int", "bigint", "double", "boolean", "date", "timestamp", "string")
_BIT = {name: 1 << k for k, name in enumerate(TYPES)}
_ALL = (1 << len(TYPES)) - 1

# The spelling of each kind of value.
WHOLE = r"[+-]?[0-9]+"
REAL = r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"
TRUTH = r"(?i)(true|false)"
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
TIMESTAMP = DATE + r"[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?"


def fits(value: Column) -> Column:
    """The mask of the types that a text value fits (all of them if it is null or empty)."""

    def bits(*names: str) -> int:
        return sum(_BIT[n] for n in names)

    def whole(pattern: str) -> Column:
        return value.rlike(f"^(?:{pattern})\\z")

    text = bits("string")
    number = (F.when(value.try_cast("int").isNotNull(), bits("int", "bigint", "double"))
              .when(value.try_cast("bigint").isNotNull(), bits("bigint", "double"))
              .otherwise(bits("double")))
    return (F.when(value.isNull() | (value == ""), _ALL)
            .when(whole(WHOLE), number.bitwiseOR(F.lit(text)))
            .when(whole(REAL), bits("double") | text)
            .when(whole(DATE) & value.try_cast("date").isNotNull(), bits("date", "timestamp") | text)
            .when(whole(TIMESTAMP) & value.try_cast("timestamp").isNotNull(), bits("timestamp") | text)
            .when(whole(TRUTH), bits("boolean") | text)
            .otherwise(text))


def type_of(mask: Column, values: Column) -> Column:
    """The narrowest type of a mask; text where there are no values."""
    out = F.lit("string")
    for name in reversed(TYPES[:-1]):
        out = F.when(mask.bitwiseAND(F.lit(_BIT[name])) != 0, name).otherwise(out)
    return F.when(values == 0, "string").otherwise(out)


def column_types(df: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys..., position, column_name, column_type, n_values, n_nulls)``: a row per column, and group of ``keys``.

    One aggregation over all values: the shuffle carries one row a task and group.
    """
    columns = [c for c in (columns or df.columns) if c not in keys]
    masks = []
    for k, name in enumerate(columns):
        value = F.col(f"`{name}`").cast("string")
        masks += [F.bit_and(fits(value)).alias(f"__m{k}"),
                  F.count(F.when(value != "", 1)).alias(f"__v{k}")]
    rows = F.array(*[
        F.struct(F.lit(k).alias("position"), F.lit(name).alias("column_name"),
                 type_of(F.col(f"__m{k}"), F.col(f"__v{k}")).alias("column_type"),
                 F.col(f"__v{k}").alias("n_values"), (F.col("__n") - F.col(f"__v{k}")).alias("n_nulls"))
        for k, name in enumerate(columns)])
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *masks)
    return grouped.select(*keys, F.inline(rows))


def typed(df: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """The frame with its text columns cast to ``types`` (inferred in one more pass where none are given)."""
    if types is None:
        types = {r.column_name: r.column_type for r in column_types(df).collect()}  # one row a column
    return df.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).try_cast(types[c]).alias(c)
                       if types.get(c, "string") != "string" else F.col(f"`{c}`") for c in df.columns])
