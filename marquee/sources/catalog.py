"""Catalogue sources.

A catalogue is one table of titles with a ``platform`` column, whatever the
number of platforms: one scan and one plan instead of a frame per platform.
Columns after :func:`conform`::

    title_id bigint, platform string, type string, title string,
    listed_in string, release_year string, rating string, description string
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.plans.materialize import materialize
from marquee.sources.headers import header_classes
from marquee.sources.infer import typed

SEGMENT_KEYS: tuple[str, ...] = ("platform", "type")
# The two title types that form segments; other types and nulls drop out.
SEGMENT_TYPES: tuple[str, ...] = ("TV Show", "Movie")

# The text columns of a title, in output order.
TEXT_COLUMNS: tuple[str, ...] = ("title", "listed_in", "release_year", "rating", "description")
CATALOG_COLUMNS: tuple[str, ...] = ("title_id", "platform", "type") + TEXT_COLUMNS

# Options that read back what Spark's CSV writer wrote, doubled quotes and newlines included.
CSV_READ_OPTIONS: dict[str, str] = {
    "header": "true",
    "multiLine": "true",
    "escape": '"',
    "mode": "PERMISSIVE",
}


def _text(df: DataFrame, name: str) -> Column:
    """A column as text, or null text when the frame has no such column."""
    return (F.col(name) if name in df.columns else F.lit(None)).cast("string")


def _year_as_text(df: DataFrame) -> Column:
    if "release_year" not in df.columns:
        return F.lit(None).cast("string")
    dtype = df.schema["release_year"].dataType
    col = F.col("release_year")
    # int(2020.0) is 2020 in Python: truncate fractional numbers before turning them into text.
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        col = col.try_cast("bigint")
    return col.cast("string")


def conform(df: DataFrame, platform: str | Column | None = None,
            id_column: str | None = None) -> DataFrame:
    """Project any catalogue frame onto the catalogue columns.

    ``platform`` sets a literal platform when the frame has none. ``id_column``
    names a key that is unique over the whole catalogue; without it and without a ``title_id``,
    rows are numbered. Such numbers are unique within this frame only, and
    may differ when it is computed again: :func:`number_titles` numbers a
    written catalogue. ``type`` is required; other missing columns are null.
    """
    if platform is not None:
        df = df.withColumn("platform", platform if isinstance(platform, Column) else F.lit(platform))
    if id_column is not None:
        title_id = F.col(id_column).cast("bigint")
    elif "title_id" in df.columns:
        title_id = F.col("title_id").cast("bigint")
    else:
        title_id = F.monotonically_increasing_id()
    return df.select(
        title_id.alias("title_id"),
        F.col("platform").cast("string").alias("platform"),
        F.col("type").cast("string").alias("type"),
        _text(df, "title").alias("title"),
        _text(df, "listed_in").alias("listed_in"),
        _year_as_text(df).alias("release_year"),
        _text(df, "rating").alias("rating"),
        _text(df, "description").alias("description"),
    )


def number_titles(catalog: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """The catalogue written once into the shared folder, each row with its own ``title_id``.

    The numbers are part of the written table, so every later pass sees the same ones.
    """
    numbered = catalog.withColumn("title_id", F.monotonically_increasing_id())
    return materialize(numbered.select(*CATALOG_COLUMNS), "catalog", paths)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("no catalogue paths given")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _listed(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _named(spark: SparkSession, header: Sequence[str], options: Mapping[str, str]):
    """A reader of files with a known header: every column is text, and no job looks at the files again."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    return spark.read.options(**options).schema(schema)


def read_catalog_csv(spark: SparkSession, paths: Mapping[str, str | Sequence[str]],
                     id_column: str | None = None, multiline: bool = True, one_header: bool = False,
                     tables: list[str] | None = None) -> DataFrame:
    """Read one or more CSV files per platform into one conformed catalogue.

    ``paths`` maps a platform name to its file(s). Columns are matched by
    their header names in every file, whatever their order and whatever other
    columns a file carries; every value is read as text (no inference pass).
    ``id_column`` names an integer key that is unique over all platforms.
    Without one the catalogue is written once to the shared folder and its
    rows are numbered there (``tables`` collects the path).

    ``multiline`` parses quoted newlines, and makes each file one task;
    ``multiline=False`` splits large files and needs every record on one line.
    ``one_header`` says that a platform's files share the first one's header;
    it spares a look at each file, and a file with another header fails the read.
    Otherwise the headers of all files are found in one job (:mod:`marquee.sources.headers`).
    """
    options = {**CSV_READ_OPTIONS, "multiLine": str(multiline).lower()}
    if one_header:
        raws = [(p, spark.read.options(**options, enforceSchema="false").csv(_listed(f))) for p, f in paths.items()]
    else:
        classes = header_classes(spark, {p: _listed(f) for p, f in paths.items()}, options)
        raws = [(p, _named(spark, header, options).csv(files)) for p, header, files in classes]
    frames = []
    for platform, raw in raws:
        key = id_column if id_column in raw.columns else None
        if id_column is not None and key is None:
            raise ValueError(f"a file of {platform} has no column {id_column!r}")
        frames.append(conform(raw if key else raw.withColumn("title_id", F.lit(None).cast("bigint")),
                              platform, key))
    catalog = _union(frames)
    return catalog if id_column is not None else number_titles(catalog, tables)


def read_typed_csv(spark: SparkSession, paths: str | Sequence[str], multiline: bool = True) -> DataFrame:
    """CSV files as one frame of typed columns, by name: the types are inferred from all values of all files.

    The types do not depend on the order of files or rows; one value that does
    not fit makes a column text. Columns that a file lacks are null there.
    """
    options = {**CSV_READ_OPTIONS, "multiLine": str(multiline).lower()}
    frames = [_named(spark, header, options).csv(files)
              for _, header, files in header_classes(spark, {"": _listed(paths)}, options)]
    out = frames[0] if frames else None
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    if out is None:
        raise ValueError("no file with a header")
    return typed(out)


def read_catalog_parquet(spark: SparkSession, paths: Mapping[str, str | Sequence[str]],
                         id_column: str | None = None, tables: list[str] | None = None) -> DataFrame:
    """Read Parquet catalogues per platform: splittable, and columns go by name.

    ``id_column`` as in :func:`read_catalog_csv`. Files of a platform may differ in their columns.
    """
    frames = []
    for platform, files in paths.items():
        raw = spark.read.option("mergeSchema", "true").parquet(*_listed(files))
        if id_column is None:
            raw = raw.withColumn("title_id", F.lit(None).cast("bigint"))
        frames.append(conform(raw, platform, id_column))
    catalog = _union(frames)
    return catalog if id_column is not None else number_titles(catalog, tables)


def segment_filter(catalog: DataFrame, types: Sequence[str] = SEGMENT_TYPES) -> DataFrame:
    """Keep titles whose ``type`` is a segment type; other values and nulls drop out."""
    return catalog.filter(F.col("type").isin(list(types)))


# ---------------------------------------------------------------------------
# The test catalogue: a view over the driver's tables standing in for the
# platform CSV files (see FIXTURES.md §2).
# ---------------------------------------------------------------------------

# The columns the test views read, with their types: a declared schema reads only these
# columns and needs no inference job per scan.
TABLE_SCHEMAS: dict[str, str] = {
    "documents": "doc_id bigint, text string, lang string, source string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int",
    "part": "p_partkey bigint, p_name string",
    "benchmark": "item_id bigint, text string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def genre_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(k, listed_in)``: the part names of an order's lines, in line order, joined by ', '."""
    lines = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    parts = _read(spark, sf_dir, "part").select("p_partkey", "p_name")
    named = lines.join(parts, lines.l_partkey == parts.p_partkey)
    ordered = F.array_sort(F.collect_list(F.struct("l_linenumber", "p_name")))
    return named.groupBy(F.col("l_orderkey").alias("k")).agg(
        F.array_join(F.transform(ordered, lambda x: x["p_name"]), ", ").alias("listed_in")
    )


def catalog_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test catalogue: one title per document, genres from the order with the same key."""
    # The join on doc_id needs this partitioning anyway; asked for by column, AQE sizes it.
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source").repartition("doc_id")
    doc_id = F.col("doc_id")
    kind = (F.when(doc_id % 40 == 39, "Special")
            .when(doc_id % 3 == 0, "TV Show")
            .otherwise("Movie"))
    year = (F.when(doc_id % 50 == 49, F.lit("n/a"))
            .otherwise((F.lit(1998) + (doc_id * 7) % 25).cast("string")))
    genres = genre_lists(spark, sf_dir)
    return (docs.join(genres, docs.doc_id == genres.k, "left")
            .select(
                doc_id.alias("title_id"),
                F.col("lang").alias("platform"),
                kind.alias("type"),
                F.substring_index("text", ".", 1).alias("title"),
                F.col("listed_in"),
                year.alias("release_year"),
                F.col("source").alias("rating"),
                F.col("text").alias("description"),
            ))
