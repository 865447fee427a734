"""Ranked text reports as a table of lines.

Each segment gets three reports (description words, genres, title words): a
heading, a rule of 50 ``=``, then one line per ranked term. The lines are a
DataFrame ``(keys..., report, line_no, line)`` built with native string
functions; :func:`marquee.sources.sinks.write_reports` writes one text file
per report. Segments without any term still get their heading and rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.topk import SEGMENT, TOP_DESCRIPTION_WORDS, TOP_GENRES, TOP_TITLE_WORDS
from marquee.sources.catalog import SEGMENT_KEYS

# Report names, heading formats, line formats, labels and rule width.
REPORT_DESCRIPTION = "top_desc_words"
REPORT_GENRES = "top_genres"
REPORT_TITLE = "top_title_words"
HEADING_DESCRIPTION = "{segment} - Top {n} Palavras das Descrições"
HEADING_GENRES = "{segment} - Top {n} Gêneros"
HEADING_TITLE = "{segment} - Top {n} Palavras dos Títulos"
# The title of a report over the whole catalogue.
WHOLE_CATALOG = "Catálogo"
LINE_WORDS = "%d. %s: %d ocorrências"
LINE_GENRES = "%d. %s: %d títulos"
TYPE_LABELS = {"TV Show": "Séries", "Movie": "Filmes"}
RULE = "=" * 50


def _label(col: Column, labels: Mapping[str, str] | None) -> Column:
    if not labels:
        return col
    mapping = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.coalesce(mapping[col], col)


def _heading(fmt: str, n: int, segment: Column) -> Column:
    head, tail = fmt.split("{segment}", 1)
    return F.concat(F.lit(head), segment, F.lit(tail.replace("{n}", str(n))))


def report_lines(lists: DataFrame, keys: Sequence[str] = SEGMENT_KEYS,
                 sizes: tuple[int, int, int] = (TOP_DESCRIPTION_WORDS, TOP_GENRES, TOP_TITLE_WORDS),
                 platform_labels: Mapping[str, str] | None = None,
                 type_labels: Mapping[str, str] | None = None) -> DataFrame:
    """``(keys..., report, line_no, line)`` for the three reports of every segment.

    ``lists`` is the fused ``(keys..., list, rank, term, count)`` of
    ``segment_lists``, read once: a segment's own row becomes the headings and
    rules of its reports, and each term line (line ``rank + 2``) picks its
    report and unit by its ``list``. A report is titled by its segment's keys,
    platform and type by their labels; without keys by ``WHOLE_CATALOG``.
    """
    labels = {"platform": platform_labels, "type": TYPE_LABELS if type_labels is None else type_labels}
    named = [_label(F.col(k).cast("string"), labels.get(k)) for k in keys]
    segment = F.concat_ws(" ", *named) if keys else F.lit(WHOLE_CATALOG)

    def entry(report: Column, line_no: Column, line: Column) -> Column:
        return F.struct(report.alias("report"), line_no.cast("int").alias("line_no"), line.alias("line"))

    heads = []
    for report, fmt, n in zip((REPORT_DESCRIPTION, REPORT_GENRES, REPORT_TITLE),
                              (HEADING_DESCRIPTION, HEADING_GENRES, HEADING_TITLE), sizes):
        heads.append(entry(F.lit(report), F.lit(1), _heading(fmt, n, segment)))
        heads.append(entry(F.lit(report), F.lit(2), F.lit(RULE)))
    is_genre = F.col("list") == "genre"
    report = (F.when(F.col("list") == "description", F.lit(REPORT_DESCRIPTION))
              .when(is_genre, F.lit(REPORT_GENRES)).otherwise(F.lit(REPORT_TITLE)))
    line = F.when(is_genre, F.format_string(LINE_GENRES, F.col("rank"), F.col("term"), F.col("count"))) \
        .otherwise(F.format_string(LINE_WORDS, F.col("rank"), F.col("term"), F.col("count")))
    entries = F.when(F.col("list") == SEGMENT, F.array(*heads)).otherwise(
        F.array(entry(report, F.col("rank") + 2, line)))
    return lists.select(*keys, F.explode(entries).alias("e")).select(*keys, "e.report", "e.line_no", "e.line")
