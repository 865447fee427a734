"""The catalogue job kept up to date: batches come and go, outputs equal a full run.

State lives in a folder, as a chain of versions. A version holds

* ``terms``: occurrences of every term per segment and list;
* ``lists``: the ranked lists, from the terms;
* ``points``: how many titles of a segment have which total (minima and
  maxima survive removals, because every value is counted);
* ``best``: the best titles of every segment, with the batch they came from.

All but the lists and the best titles are additive: an update counts the batches that come (+1)
and go (-1) and merges those counts into the last version's by key, which reads
counts, not texts. The scores of a segment depend on its lists alone, so
titles are scored again only in *dirty* segments: those whose lists changed in a
term or rank, or which lose a batch that holds one of their best titles. In
all others the update scores what comes and goes, and nothing else.

Tokenised batches are written once. A version is made current by one manifest
(:mod:`marquee.sources.manifests`), so an update that fails leaves the last one in
force, and may simply be run again. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators import score as score_ops
from marquee.operators import topk
from marquee.operators.weights import weight_maps, weights_from_lists
from marquee.plans.job import WHOLE, CatalogJob
from marquee.sources.manifests import Folder, latest, publish

TABLES = ("terms", "lists", "points", "best")
BATCH, SIGN = "__batch", "__sign"


def same_segment(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str) -> DataFrame:
    """Rows of ``left`` whose segment is (``left_semi``) or is not (``left_anti``) in ``right``; null is a segment."""
    named = right.select(*[F.col(k).alias(f"__s_{k}") for k in keys]).distinct()
    on = [F.col(k).eqNullSafe(F.col(f"__s_{k}")) for k in keys]
    return left.join(named, reduce(lambda a, b: a & b, on), how)


class IncrementalCatalog:
    """The job's outputs over a changing set of named batches.

    ``options`` are those of :class:`~marquee.plans.job.CatalogJob` (stop words
    as a list); they belong to the state, and opening it with others raises.
    A batch is a catalogue frame. Its name may be used again once it is removed.
    """

    def __init__(self, spark: SparkSession, path: str, **options):
        if isinstance(options.get("stop_words"), DataFrame):
            raise ValueError("stop words of an incremental catalogue are a list")
        self.spark, self.path = spark, path.rstrip("/")
        self.folder = Folder(spark, path)
        self._options = {**options, "tokens": "none"}
        probe = self._job(None)
        self.keys, self._keys = probe.keys, probe._keys
        self._rules = {"keys": list(probe.keys), "types": list(probe.types), "top_n": list(probe.top_n),
                       "specs": [list(s) for s in probe.specs], "years": [list(b) for b in probe.year_bands],
                       "best": probe.top_titles_n,
                       "stops": None if probe.stop_words is None else sorted(set(probe.stop_words))}
        self.number, self._state = latest(self.folder)
        if self._state is not None and self._state["rules"] != self._rules:
            raise ValueError(f"the state in {path} was made with other options")

    def _job(self, catalog: DataFrame | None) -> CatalogJob:
        return CatalogJob(catalog, **self._options)

    @property
    def batches(self) -> dict[str, str]:
        """Folders of the live batches, by name."""
        return dict(self._state["batches"]) if self._state else {}

    def _read(self, at: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{at}")

    def table(self, name: str) -> DataFrame:
        """One of ``TABLES`` of the current version."""
        if self._state is None:
            raise ValueError(f"no batch was ever added to {self.path}")
        return self._read(f"{self._state['version']}/{name}")

    def _tokens(self, batches: Mapping[str, str], sign: int) -> list[DataFrame]:
        return [self._read(at).withColumns({BATCH: F.lit(name), SIGN: F.lit(sign)}) for name, at in batches.items()]

    # -- updates -----------------------------------------------------------------
    def update(self, add: Mapping[str, DataFrame] | None = None, remove: Iterable[str] = ()) -> None:
        """Remove batches and add others, in one step; a batch named in both is replaced."""
        add, gone = dict(add or {}), {name: self.batches[name] for name in dict.fromkeys(remove)}
        left = {k: v for k, v in self.batches.items() if k not in gone}
        if both := sorted(left.keys() & add.keys()):
            raise ValueError(f"already there: {both}")
        if not add and not gone:
            return
        made = uuid.uuid4().hex
        come = {name: f"batch-{made}-{at}" for at, name in enumerate(add)}
        version = f"version-{made}"
        try:
            for name, at in come.items():
                self._job(add[name]).lazy_prepared().write.parquet(f"{self.path}/{at}")
            self._write_version(version, left, come, gone)
            publish(self.folder, self.number + 1,
                    {"version": version, "batches": {**left, **come}, "rules": self._rules})
        except Exception:
            for at in (version, *come.values()):
                self.folder.delete(at)
            raise
        before = self._state
        self.number, self._state = latest(self.folder)
        self._clean(before)

    def _clean(self, before: dict | None) -> None:
        """Delete what neither this version nor the last one, which readers may still have open, uses."""
        used = {at for s in (before, self._state) if s for at in (s["version"], *s["batches"].values())}
        for name in self.folder.names():
            if name.startswith(("version-", "batch-")) and name not in used:
                self.folder.delete(name)

    def _write_version(self, version: str, left: dict, come: dict, gone: dict) -> None:
        keys, job = self._keys, self._job(None)

        def write(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{self.path}/{version}/{name}")
            return self._read(f"{version}/{name}")

        def merged(name: str, by: Iterable[str], *parts: DataFrame) -> DataFrame:
            total = reduce(DataFrame.unionByName, parts).groupBy(*by).agg(F.sum("count").alias("count"))
            return write(total.filter("count != 0"), name)

        changes = reduce(DataFrame.unionByName, self._tokens(come, 1) + self._tokens(gone, -1))
        counted = topk.list_counts(changes, keys, job.stop_words, F.col(SIGN))
        old_terms = [self.table("terms")] if self._state else []
        terms = merged("terms", (*keys, "list", "term"), counted, *old_terms)
        lists = write(topk.rank_lists(terms, self._options.get("top_n", job.top_n), keys), "lists")
        maps = weight_maps(weights_from_lists(lists, keys, job.specs), keys)

        dirty = self._dirty(lists, gone, f"{version}/dirty")
        rows = changes if dirty is None else same_segment(changes, dirty, keys, "left_anti")
        # Only where lists changed are the titles that stay scored again; elsewhere their batches are not read.
        live = self._tokens({**left, **come}, 1)
        if dirty is None:
            rows = reduce(DataFrame.unionByName, live) if live else changes.limit(0)
        elif live and not dirty.isEmpty():
            again = same_segment(reduce(DataFrame.unionByName, live), dirty, keys, "left_semi")
            rows = rows.unionByName(again)
        columns = list(dict.fromkeys([*keys, "title_id", *score_ops.TEXT_COLUMNS, *score_ops.POINT_COLUMNS,
                                      "total_points", BATCH]))
        # Written, as the counts and the best titles both read the scores: no title is scored twice.
        scored = write(score_ops.score_titles(rows, maps, keys, job.stop_words, job.year_bands)
                       .select(*columns, SIGN), "scored")

        points = scored.groupBy(*keys, "total_points").agg(F.sum(SIGN).alias("count"))
        # Counts of a dirty segment start again from nothing.
        old_points = [] if dirty is None else [same_segment(self.table("points"), dirty, keys, "left_anti")]
        merged("points", (*keys, "total_points"), points, *old_points)

        best = scored.filter(F.col(SIGN) > 0).select(*columns)
        if dirty is not None:
            best = best.unionByName(same_segment(self.table("best"), dirty, keys, "left_anti"))
        write(score_ops.top_titles(best, job.top_titles_n, keys), "best")
        self.folder.delete(f"{version}/scored")

    def _dirty(self, lists: DataFrame, gone: Mapping[str, str], at: str) -> DataFrame | None:
        """Segments whose titles are to be scored again; None for all of them (there is no version yet)."""
        if self._state is None:
            return None
        ranked = [*self._keys, "list", "rank", "term"]

        def signed(df: DataFrame, sign: int) -> DataFrame:
            return df.filter(F.col("list") != topk.SEGMENT).select(*ranked, F.lit(sign).alias(SIGN))

        changed = (signed(lists, 1).unionByName(signed(self.table("lists"), -1))
                   .groupBy(*ranked).agg(F.sum(SIGN).alias(SIGN)).filter(F.col(SIGN) != 0).select(*self._keys))
        lost = self.table("best").filter(F.col(BATCH).isin(list(gone))).select(*self._keys)
        changed.unionByName(lost).distinct().write.parquet(f"{self.path}/{at}")
        return self._read(at)

    # -- outputs -----------------------------------------------------------------
    def segment_sizes(self) -> DataFrame:
        """``(keys..., n)``: titles per segment."""
        own = self.table("terms").filter(F.col("list") == topk.SEGMENT)
        return own.select(*self._keys, F.col("count").alias("n")).drop(WHOLE)

    def lists(self) -> DataFrame:
        """``(keys..., list, rank, term, count)`` of the three lists."""
        return self.table("lists").filter(F.col("list") != topk.SEGMENT).drop(WHOLE)

    def _stats(self) -> DataFrame:
        return score_ops.segment_stats(self.table("points"), self._keys)

    def segment_stats(self) -> DataFrame:
        """``(keys..., min_points, max_points)``."""
        return self._stats().drop(WHOLE)

    def top_titles(self) -> DataFrame:
        """The best titles per segment with all output columns."""
        scaled = score_ops.scale_success(self.table("best"), self._stats(), self._keys, self._job(None).target)
        return scaled.select(*dict.fromkeys([*self.keys, "title_id", *score_ops.OUTPUT_COLUMNS]))
