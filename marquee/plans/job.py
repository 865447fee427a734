"""The catalogue job as one segmented plan.

:class:`CatalogJob` wires the operators together for any catalogue and any
candidates. Outputs are lazy DataFrames; the eager steps are a few tables
written once into the shared folder (:func:`~marquee.plans.materialize.materialize`):

0. ``prepared``: the catalogue tokenised once, with its texts. Tokenising is
   the CPU-heavy step; every later pass reads these arrays instead of
   splitting text again, and only the best titles read the descriptions;
1. ``lists``: the three ranked term lists of every segment, from one pass over
   the tokens (at most 26 rows per segment by default);
2. ``scored_table``: every title's points with its short columns, from one
   more pass over the tokens (for outputs that read the scores twice);
3. ``stats``: min/max points per segment, from ``scored_table`` when it exists
   and otherwise straight from the scores.

Scaling, the best titles and candidates read these tables, and the written
tables' real sizes decide every broadcast. Outputs that need one pass only (a
single term list, the reports, the cleaned descriptions) are planned straight
from the catalogue.

A job without keys is one segment: the plans are the same, with a constant key.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.scoring import SUCCESS_HIGH, SUCCESS_LOW, YEAR_BANDS
from marquee.operators import candidates as cand_ops
from marquee.operators import heavy
from marquee.operators import rank as rank_ops
from marquee.operators import score as score_ops
from marquee.operators import stops as stop_ops
from marquee.operators import topk
from marquee.operators.reports import report_lines
from marquee.operators.weights import STEPS, list_weights, specs_of, weight_maps, weights_from_lists
from marquee.plans.materialize import materialize, remove_tables
from marquee.sources.catalog import SEGMENT_KEYS, SEGMENT_TYPES, TEXT_COLUMNS

# The key of a job without keys.
WHOLE = "__whole"


def _once(*names: str) -> list[str]:
    return list(dict.fromkeys(names))


class CatalogJob:
    """All outputs of the job over one catalogue (and optionally candidates).

    ``keys`` are the segment's columns (none: the whole catalogue is one
    segment), ``types`` the title types that take part, ``top_n`` the sizes
    of the three lists and ``weight_steps`` the points between their ranks, ``year_bands`` and
    ``target`` the year points and the success range. ``stop_words`` is a list (a
    literal in the plans) or, for lists of any size, a frame of words
    (:mod:`marquee.operators.stops`). ``tokens`` says where
    the tokenised catalogue lives between passes: ``"write"`` (a table in the
    shared folder; survives executor loss without recomputation), ``"cache"``
    (executor memory and disk; lost blocks are recomputed from the source) or
    ``"none"`` (tokenise again in every pass).

    Used as a context manager, or closed, the job deletes the tables it wrote:
    read or write its outputs before.
    """

    def __init__(self, catalog: DataFrame, candidates: DataFrame | None = None,
                 keys: Sequence[str] = SEGMENT_KEYS, stop_words: Iterable[str] | DataFrame | None = None,
                 top_n: tuple[int, int, int] = (topk.TOP_DESCRIPTION_WORDS, topk.TOP_GENRES,
                                                topk.TOP_TITLE_WORDS),
                 top_titles_n: int = score_ops.TOP_TITLES, tokens: str = "write",
                 types: Sequence[str] = SEGMENT_TYPES, weight_steps: tuple[int, int, int] = STEPS,
                 year_bands: Sequence[tuple[int, int, int]] = YEAR_BANDS,
                 target: tuple[float, float] = (SUCCESS_LOW, SUCCESS_HIGH),
                 platform_labels: Mapping[str, str] | None = None,
                 type_labels: Mapping[str, str] | None = None):
        if tokens not in ("write", "cache", "none"):
            raise ValueError(f"tokens must be write, cache or none, not {tokens!r}")
        self.catalog = catalog
        self.keys = tuple(keys)
        self._keys = self.keys or (WHOLE,)
        self.types = tuple(types)
        self._stop_source = stop_words if isinstance(stop_words, DataFrame) else None
        # A table of stop words replaces the literal list.
        self.stop_words = ([] if self._stop_source is not None else
                           None if stop_words is None else list(stop_words))
        self.top_n = top_n
        self.specs = specs_of(top_n, weight_steps)
        self.year_bands = tuple(year_bands)
        self.target = target
        self.top_titles_n = top_titles_n
        self.labels = {"platform_labels": platform_labels, "type_labels": type_labels}
        self.candidates = candidates
        self._tokens = tokens
        self.tables: list[str] = []

    def __enter__(self) -> CatalogJob:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name, self.tables)

    def _keyed(self, df: DataFrame) -> DataFrame:
        return df if self.keys else df.withColumn(WHOLE, F.lit(0))

    @cached_property
    def stops(self) -> DataFrame | None:
        """The written table of stop words, if they were given as a frame."""
        return None if self._stop_source is None else stop_ops.stop_table(self._stop_source, self.tables)

    def _clean(self, df: DataFrame) -> DataFrame:
        """Description tokens without the stop words of the table (for outputs that show the words themselves)."""
        return df if self.stops is None else stop_ops.clean_tokens(df, "desc_tokens", self.stops, self.tables)

    # -- inputs ---------------------------------------------------------------
    def lazy_prepared(self) -> DataFrame:
        """Segment filter and description tokens, computed from the catalogue in the plan."""
        return self._keyed(score_ops.prepare(self.catalog, self.stop_words, self.types))

    @cached_property
    def prepared(self) -> DataFrame:
        """The tokenised catalogue, shared by the multi-pass outputs."""
        df = self.lazy_prepared()
        if self._tokens == "write":
            return self._write(df, "tokens")
        if self._tokens == "cache":
            return df.persist(StorageLevel.MEMORY_AND_DISK)
        return df

    @cached_property
    def prepared_candidates(self) -> DataFrame:
        if self.candidates is None:
            raise ValueError("no candidates given")
        return self._keyed(cand_ops.prepare_candidates(self.candidates, self.stop_words))

    # -- segments and term lists ---------------------------------------------
    def segment_sizes(self) -> DataFrame:
        return score_ops.segment_sizes(self.catalog, self.keys, self.types)

    def desc_clean(self) -> DataFrame:
        return score_ops.desc_clean(self._clean(self.lazy_prepared()))

    def top_desc_words(self, keys: Sequence[str] | None = None) -> DataFrame:
        """One list alone is one pass over the catalogue (``lists`` has all three)."""
        return topk.top_description_words(self.lazy_prepared(), self.top_n[0],
                                          self.keys if keys is None else keys, self.stops)

    def top_desc_words_two_pass(self, tracked: int = heavy.TRACKED) -> DataFrame:
        """The same list by summaries of frequent words and an exact recount over the written tokens."""
        found = heavy.top_terms_two_pass(self._clean(self.prepared), F.col("desc_tokens"), "word", self.top_n[0],
                                         tracked, self._keys, self.tables)
        return found.drop(WHOLE)

    def top_genres(self) -> DataFrame:
        return topk.top_genres(self.lazy_prepared(), self.top_n[1], self.keys)

    def top_title_words(self) -> DataFrame:
        return topk.top_title_words(self.lazy_prepared(), self.top_n[2], self.keys,
                                    self.stop_words, self.stops)

    @cached_property
    def lists(self) -> DataFrame:
        """``(keys..., list, rank, term, count)`` of all three lists, written once."""
        return self._write(
            topk.segment_lists(self.prepared, self.top_n, self._keys, self.stop_words, self.stops), "lists")

    def lazy_lists(self) -> DataFrame:
        """The written lists once they exist, else the three lists in one pass over the catalogue."""
        lists = self.__dict__.get("lists")
        if lists is not None:
            return lists
        return topk.segment_lists(self.lazy_prepared(), self.top_n, self._keys, self.stop_words, self.stops)

    def rank_weights(self) -> DataFrame:
        """``(keys..., list, term, weight)``: from the written lists once they exist."""
        return weights_from_lists(self.lazy_lists(), self._keys, self.specs).drop(WHOLE)

    @cached_property
    def maps(self) -> DataFrame:
        """Weight maps, one small row per segment (read from the written lists)."""
        return weight_maps(weights_from_lists(self.lists, self._keys, self.specs), self._keys)

    # -- scores ----------------------------------------------------------------
    def criterion(self, name: str) -> DataFrame:
        """``(title_id, <name>)`` for one criterion, computing only the list it needs.

        The year needs no list. The others count their list and score from
        one written table: the tokens for description words, and a narrow one
        (ids, keys and the one text) for genres and title words, so the source is read once.
        """
        if name == "points_criterion_3":
            return score_ops.score_one(self.lazy_prepared(), name, None, self._keys, year_bands=self.year_bands)
        of_desc, of_genre, of_title = self.specs
        if name == "points_criterion_1":
            base = self.prepared
            ranked, spec = topk.top_description_words(base, self.top_n[0], self._keys, self.stops), of_desc
        elif name == "points_criterion_2":
            base = self._narrow("listed_in")
            ranked, spec = topk.top_genres(base, self.top_n[1], self._keys), of_genre
        elif name == "points_criterion_4":
            base = self._narrow("title")
            ranked = topk.top_title_words(base, self.top_n[2], self._keys, self.stop_words, self.stops)
            spec = of_title
        else:
            raise ValueError(f"unknown criterion {name!r}")
        maps = weight_maps(self._write(list_weights(ranked, spec, self._keys), "list_weights"), self._keys)
        return score_ops.score_one(base, name, maps, self._keys, self.stop_words)

    def _narrow(self, text: str) -> DataFrame:
        return self._write(self.lazy_prepared().select(*_once("title_id", *self._keys, text)), f"only_{text}")

    @cached_property
    def scored(self) -> DataFrame:
        """Every title with its four criteria and total (lazy; reads the tokens, not the text)."""
        return score_ops.score_titles(self.prepared, self.maps, self._keys, self.stop_words, self.year_bands)

    @cached_property
    def scored_table(self) -> DataFrame:
        """``scored`` without descriptions, written once for the statistics and rankings."""
        short = [c for c in TEXT_COLUMNS if c != "description"]
        columns = _once("title_id", *self._keys, *short, *score_ops.POINT_COLUMNS, "total_points")
        return self._write(self.scored.select(*columns), "scored")

    def segment_stats(self) -> DataFrame:
        """Min/max points per segment: from the written scores when they exist, else in one
        pass over the titles (partial aggregation, one tiny shuffle)."""
        return self._stats().drop(WHOLE)

    def _stats(self) -> DataFrame:
        written = self.__dict__.get("scored_table")
        return score_ops.segment_stats(self.scored if written is None else written, self._keys)

    @cached_property
    def stats(self) -> DataFrame:
        """Segment statistics, one row per segment, written once."""
        return self._write(self._stats(), "segment_stats")

    @cached_property
    def scaled(self) -> DataFrame:
        """Scored titles (without descriptions) with their success percentage."""
        return score_ops.scale_success(self.scored_table, self.stats, self._keys, self.target).drop(WHOLE)

    def top_titles(self) -> DataFrame:
        """The best titles per segment with all output columns.

        The ranking reads the tokens table with its descriptions, at most
        ``n`` rows a segment and task leave the scan, and the percentage is
        added to what is left. Nothing is joined back by id, so ids need not be unique.
        """
        best = score_ops.top_titles(self.scored, self.top_titles_n, self._keys)
        scaled = score_ops.scale_success(best, self.stats, self._keys, self.target)
        return scaled.select(*_once(*self.keys, "title_id", *score_ops.OUTPUT_COLUMNS))

    def title_ranks(self) -> DataFrame:
        """``(keys..., title_id, total_points, rank)``: every title's place in its segment, in the order of the best titles."""
        order = [F.col("total_points").desc(), F.col("title").asc(), F.col("title_id").asc()]
        columns = _once(*self._keys, "title_id", "title", "total_points")
        placed = rank_ops.ranked(self.scored_table.select(*columns), order, self._keys, "rank", self.tables)
        return placed.select(*_once(*self.keys, "title_id", "total_points", "rank"))

    # -- candidates --------------------------------------------------------------
    def catalog_with_candidates(self) -> DataFrame:
        return cand_ops.catalog_with_candidates(self._clean(self.lazy_prepared()),
                                                self._clean(self.prepared_candidates))

    def candidate_success(self) -> DataFrame:
        return self._success(self.prepared_candidates)

    def success_of(self, candidates: DataFrame) -> DataFrame:
        """:meth:`candidate_success` of other candidates, a streaming frame included."""
        return self._success(self._keyed(cand_ops.prepare_candidates(candidates, self.stop_words)))

    def _success(self, prepared: DataFrame) -> DataFrame:
        return cand_ops.candidate_success(prepared, self.maps, self.stats, self._keys, self.stop_words,
                                          self.year_bands, self.target)

    def candidate_success_union(self) -> DataFrame:
        return cand_ops.candidate_success_union(self.prepared, self.prepared_candidates, self.maps, self._keys,
                                                self.stop_words, self.year_bands, self.target, self.tables)

    # -- reports -------------------------------------------------------------------
    def report_lines(self) -> DataFrame:
        """Report lines from the written lists once they exist, else from one lazy pass."""
        return report_lines(self.lazy_lists(), self.keys, self.top_n, **self.labels)

    def close(self) -> None:
        """Delete the tables that this job wrote and free its cache."""
        if self._tokens == "cache" and "prepared" in self.__dict__:
            self.prepared.unpersist()
        remove_tables(self.catalog.sparkSession, self.tables)
        self.tables.clear()
