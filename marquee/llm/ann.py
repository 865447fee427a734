"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing, exact reranking.

**Reduction.** With M the largest norm, x' = (x / M, sqrt(1 - |x / M|^2)) and
q' = (q / |q|, 0) are unit vectors and q'.x' = q.x / (|q| M): the largest
inner product is the nearest unit vector.

**Hashing.** A table has ``m`` functions floor((a.x' + b) / ``WIDTH``) with Gaussian
(2-stable) a. ``m`` grows with the logarithm of the number of vectors, so cells keep
about ``CELL_VECTORS`` vectors at every size.

**Probing.** A neighbour at cosine c of q' has projection c (a.q') + sqrt(1 - c^2) z with
z standard normal. That gives the probability that it lies in a cell, perturbed or
not; cells are visited in the order of these probabilities until their sum
reaches what the table needs for the ``RECALL`` of all tables together. c is fitted: the cosine of the
k-th neighbour of a bounded sample of queries.

**Shards.** The cells of a table are dealt by hash into shards of about equal size, as many as
keep ``SHARD_BYTES`` of vectors each; a cell of over ``BLOCK_VECTORS`` is dealt in blocks. A query goes
once to a shard, with the list of its cells there, not once to a cell.

**Reranking.** In a shard, the vectors of a cell meet the queries that visit it. Products in single precision and a bound of
their error tell which vectors can be among a query's best; those get their exact score, and every cut (shard, merge of shards
and tables) is by that score and, among ties, by the least id of a vector. Queries that got fewer than
k candidates, or whose probes exceed ``MOST_PROBES``, are searched again in one cell that
holds all vectors: the exact way.

Equal vectors are searched once: of a vector's ids only the k + 1 smallest
can be among a query's k nearest.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from marquee.plans.materialize import materialize

TABLES = 2
WIDTH = 1.5
CELL_VECTORS = 1024
RECALL = 0.96
SAMPLE_QUERIES = 64
MOST_PROBES = 4096
BLOCK_VECTORS = 4096
# Shards of a table: as many as keep this many bytes of vectors each, and this many if cells allow.
SHARD_BYTES = 1 << 26
SHARDS = 12
# Queries that a task of a shard is meant for, and those that it searches at a time.
BLOCK_QUERIES = 1 << 20
ASKING = 1 << 14
# Candidates that are kept before a cut, products and exact scores that are taken at a time.
BEST_ROWS = 1 << 20
PRODUCTS = 1 << 20
PAIRS = 1 << 14
# Queries are probed so many at a time, and handed on in batches of so many bytes.
PROBED = 32
BATCH_BYTES = 1 << 22
_SEED = 20240229


def takes_part(vector: Column) -> Column:
    """Not null, not zero, and all components are finite numbers."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def hash_functions(dimension: int, m: int, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Gaussian directions (a row each) and shifts of a table."""
    rng = np.random.default_rng([_SEED, table, m])
    return rng.standard_normal((m, dimension + 1)), rng.uniform(0, WIDTH, m)


def cell_number(table: int, slots: np.ndarray) -> np.ndarray:
    """A 64-bit number of each row of slots."""
    h = np.full(len(slots), 0x9E3779B97F4A7C15 * (table + 1) % (1 << 64), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(slots.shape[1]):
            h = (h ^ slots[:, k].astype(np.int64).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _axes(mean: np.ndarray, shift: np.ndarray, spread: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each function the chances of its slots, falling, and the slots."""
    out = []
    for k in range(len(mean)):
        at = (mean[k] + shift[k]) / WIDTH
        reach = int(math.ceil(5 * spread / WIDTH)) + 1
        first = math.floor(at) - reach
        below = [math.erf((s - at) * WIDTH / spread / math.sqrt(2)) for s in range(first, first + 2 * reach + 2)]
        chance = [(0.5 * (above - under), first + s) for s, (under, above) in enumerate(zip(below, below[1:]))]
        chance = sorted((c for c in chance if c[0] > 1e-12), reverse=True)
        out.append((np.array([c for c, _ in chance]), np.array([s for _, s in chance], np.int64)))
    return out


def _likelier(axes: list[tuple[np.ndarray, np.ndarray]], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Chances of the cells that have ``least`` or more, and for each function the place of its slot in ``axes``."""
    chance, places = np.ones(1), np.empty((0, 1), np.int64)
    rest = np.cumprod([1.0] + [a[0] for a, _ in reversed(axes)])[::-1][1:]
    for (a, _), best in zip(axes, rest):
        both = chance[:, None] * a
        of, place = np.nonzero(both * best >= least)
        chance, places = both[of, place], np.vstack([places[:, of], place])
    return chance, places


def probe_slots(mean: np.ndarray, shift: np.ndarray, spread: float, mass: float, most: int,
                guess: float = 0.1) -> tuple[np.ndarray | None, float]:
    """:func:`probes` as an array, and a ``guess`` for the next query: somewhat less than the chance of the last cell.

    All cells over some chance are listed at once; the chance falls until their sum is enough.
    """
    axes = _axes(mean, shift, spread)
    least, cells = guess, math.prod(len(a) for a, _ in axes)
    while True:
        chance, places = _likelier(axes, least)
        if chance.sum() >= mass or len(chance) == cells:
            break
        if len(chance) > most:
            return None, guess
        least /= 4
    order = np.argsort(-chance, kind="stable")
    n = int(np.searchsorted(np.cumsum(chance[order]), mass)) + 1  # more than all of them where they do not reach it
    if min(n, cells) > most:
        return None, guess
    order = order[:n]
    slots = [slot[place[order]] for (_, slot), place in zip(axes, places)]
    return np.stack(slots, axis=1) if axes else np.zeros((1, 0), np.int64), 0.6 * float(chance[order[-1]])


def probes(mean: np.ndarray, shift: np.ndarray, spread: float, mass: float, most: int = MOST_PROBES):
    """Slots of the cells in order of probability until they hold ``mass``; null beyond ``most`` cells."""
    slots, _ = probe_slots(mean, shift, spread, mass, most)
    return None if slots is None else slots.tolist()


def _bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and where each value starts and the last ends."""
    offsets = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _matrix(column, dimension: int, kind: str) -> np.ndarray:
    """The vectors of a binary column, their components as ``kind``."""
    return _bytes_of(column)[0].view(kind).reshape(-1, dimension)


def _binary(data: np.ndarray, starts: np.ndarray):
    """A binary column of pieces of ``data``; ``starts`` counts its items, the end included."""
    data = np.ascontiguousarray(data)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [
        None, pa.py_buffer((starts * data.itemsize).astype(np.int32)), pa.py_buffer(data)])


def exact_scores(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> np.ndarray:
    """Inner products of rows of ``a`` and ``b``: a pair has the same bits wherever it meets, and no negative zero."""
    out = np.empty(len(of_a))
    for lo in range(0, len(out), PAIRS):
        out[lo:lo + PAIRS] = (a[of_a[lo:lo + PAIRS]].astype(float) * b[of_b[lo:lo + PAIRS]]).sum(axis=1)
    return out + 0.0


def ranks(of: np.ndarray) -> np.ndarray:
    """The place of each row in its run of equal values."""
    at = np.arange(len(of))
    return at - np.maximum.accumulate(np.where(np.append(True, of[1:] != of[:-1])[:len(of)], at, 0))


class Deal:
    """Which shards hold a cell: by its hash, and block by block where it is large.

    ``large`` has the cells of over ``BLOCK_VECTORS`` vectors and their sizes: at most a row for that many vectors.
    A task (``slot``) has a part of the queries that visit a shard.
    """

    def __init__(self, m: int, tables: int, shards: int, parts: int, large: list[tuple[int, int]]):
        self.m, self.tables, self.shards, self.parts = m, tables, shards, parts
        large = sorted(large)
        self.large = np.array([cell for cell, _ in large], np.int64)
        self.blocks = np.array([-(-n // BLOCK_VECTORS) for _, n in large], np.int64)

    def blocks_of(self, cell: np.ndarray) -> np.ndarray:
        """How many blocks each cell has."""
        if not len(self.large):
            return np.ones(len(cell), np.int64)
        at = np.minimum(np.searchsorted(self.large, cell), len(self.large) - 1)
        return np.where(self.large[at] == cell, self.blocks[at], 1)

    def shard(self, table: int, cell: np.ndarray, block: np.ndarray) -> np.ndarray:
        mixed = cell_number(self.tables, np.stack([cell, block], axis=1)).view(np.uint64)
        return table * self.shards + (mixed % np.uint64(self.shards)).astype(np.int64)

    @property
    def slots(self) -> int:
        return self.tables * self.shards * self.parts


def large_cells(classes: DataFrame, dimension: int, kind: str, largest: float, m: int, tables: int) -> DataFrame:
    """``(cell, n)`` of the cells with over ``BLOCK_VECTORS`` vectors."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                for cells in class_cells(batch.column(0), dimension, kind, largest, m, tables):
                    cell, n = np.unique(cells, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], ["cell", "n"])

    counted = classes.select("vector").mapInArrow(run, "cell bigint, n bigint")
    return counted.groupBy("cell").agg(F.sum("n").alias("n")).filter(F.col("n") > BLOCK_VECTORS)


def class_cells(column, dimension: int, kind: str, largest: float, m: int, tables: int):
    """Of each table the cells of the vectors of a column."""
    x = _matrix(column, dimension, kind).astype(float) / largest
    unit = np.column_stack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))])
    for table in range(tables):
        a, b = hash_functions(dimension, m, table)
        yield cell_number(table, np.floor((unit @ a.T + b) / WIDTH))


#: A row of a vector (kind 0, one cell, its least id) or of a query that visits a shard (kind 1, its cells there).
DEALT = "slot int, kind int, cells binary, k1 bigint, k2 bigint, vector binary, least bigint"
_DEALT = [c.split()[0] for c in DEALT.split(", ")]


def index_rows(classes: DataFrame, dimension: int, kind: str, largest: float, deal: Deal) -> DataFrame:
    """``DEALT`` of every class in every table."""

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            n, k2 = batch.num_rows, batch.column(1).to_numpy()
            for table, cells in enumerate(class_cells(batch.column(2), dimension, kind, largest, deal.m, deal.tables)):
                shard = deal.shard(table, cells, k2 % deal.blocks_of(cells))
                for part in range(deal.parts):
                    slot = pa.array((shard * deal.parts + part).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([slot, pa.array(np.zeros(n, np.int32)), _binary(cells, np.arange(n + 1)),
                                                      *batch.columns], _DEALT)

    return classes.select("k1", "k2", "vector", F.array_min("ids").alias("least")).mapInArrow(run, DEALT)


def probed_cells(queries: np.ndarray, functions: list, cosine: float, guesses: list[float]):
    """``(row, table, cell)`` of the cells that queries visit; none for one with too many in a table.

    ``guesses`` are kept from query to query.
    """
    mass = 1 - (1 - RECALL) ** (1 / len(functions))
    spread = math.sqrt(max(1 - cosine * cosine, 1e-6))
    q = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    rows, tables, cells = [], [], []
    for k in range(len(q)):
        found = []
        for table, (a, b) in enumerate(functions):
            slots, guesses[table] = probe_slots(cosine * (a[:, :-1] @ q[k]), b, spread, mass, MOST_PROBES, guesses[table])
            if slots is None:
                break
            found.append(slots)
        if len(found) == len(functions):
            for table, slots in enumerate(found):
                rows.append(np.full(len(slots), k))
                tables.append(np.full(len(slots), table))
                cells.append(cell_number(table, slots))
    if not rows:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(rows), np.concatenate(tables), np.concatenate(cells)


def visits(row: np.ndarray, table: np.ndarray, cell: np.ndarray, deal: Deal):
    """Rows and shards of the visits to shards, their cells in one array, and where each visit's cells start."""
    blocks = deal.blocks_of(cell)
    block = ranks(np.repeat(np.arange(len(cell)), blocks))
    row, table, cell = (np.repeat(x, blocks) for x in (row, table, cell))
    shard = deal.shard(table, cell, block)
    order = np.lexsort((cell, shard, row))
    row, shard, cell = row[order], shard[order], cell[order]
    other = np.append(True, (row[1:] != row[:-1]) | (shard[1:] != shard[:-1]))[:len(row)]
    own = other | np.append(True, cell[1:] != cell[:-1])[:len(row)]  # two blocks of a cell can be in a shard
    row, shard, cell, other = row[own], shard[own], cell[own], other[own]
    at = np.flatnonzero(other)
    return row[at], shard[at], cell, np.append(at, len(cell))


def probe_rows(queries: DataFrame, dimension: int, kind: str, cosine: float, deal: Deal) -> DataFrame:
    """``DEALT`` of every shard that a query visits, with its cells there; no rows for one with too many."""

    def run(batches):
        functions = [hash_functions(dimension, deal.m, t) for t in range(deal.tables)]
        guesses = [0.1] * deal.tables
        for batch in batches:
            for lo in range(0, batch.num_rows, PROBED):
                some = batch.slice(lo, PROBED)
                q = _matrix(some.column(2), dimension, kind).astype(float)
                row, shard, cell, starts = visits(*probed_cells(q, functions, cosine, guesses), deal)
                part = some.column(1).to_numpy()[row] % deal.parts
                size = dimension * np.dtype(kind).itemsize + 64 + 8 * np.diff(starts)
                cuts = np.flatnonzero(np.diff(np.cumsum(size) // BATCH_BYTES)) + 1
                for at in np.split(np.arange(len(row)), cuts):
                    if len(at) == 0:
                        continue
                    first, last = at[0], at[-1] + 1
                    slot = (shard[at] * deal.parts + part[at]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slot), pa.array(np.ones(len(at), np.int32)),
                         _binary(cell[starts[first]:starts[last]], starts[first:last + 1] - starts[first]),
                         *some.take(pa.array(row[at])).columns, pa.array(np.zeros(len(at), np.int64))], _DEALT)

    return queries.select("k1", "k2", "vector").mapInArrow(run, DEALT)


#: A query's best candidates of a shard, best first.
BEST = "q1 bigint, q2 bigint, best binary"
_BEST = [c.split()[0] for c in BEST.split(", ")]
CANDIDATE = np.dtype([("c1", "<i8"), ("c2", "<i8"), ("least", "<i8"), ("score", "<f8")])


class Shard:
    """The vectors of a shard, cell by cell, and the search for the ``keep`` best of each query among its cells."""

    def __init__(self, batches: list, dimension: int, kind: str, keep: int):
        self.dimension, self.kind, self.keep = dimension, kind, keep
        cell = np.concatenate([_bytes_of(b.column(2))[0].view(np.int64) for b in batches])
        order = np.argsort(cell, kind="stable")
        self.ids = np.concatenate([np.stack([b.column(k).to_numpy() for k in (3, 4, 6)], axis=1) for b in batches])[order]
        self.vectors = np.concatenate([_matrix(b.column(5), dimension, kind) for b in batches])[order]
        self.cells, start = np.unique(cell[order], return_index=True)
        self.start = np.append(start, len(cell))
        # In single precision, with a largest length of 1. A query has a 1 where a vector has the most by which the product of both
        # can be off (dimension + 4 roundings of eps / 2, the conversions among them), four times over: products are upper bounds.
        large = float(np.abs(self.vectors).max())
        rough = np.empty((len(cell), dimension + 1), np.float32)
        self.slack = np.empty(len(cell), np.float32)
        blocks = [slice(lo, lo + BLOCK_VECTORS) for lo in range(0, len(cell), BLOCK_VECTORS)]
        for at in blocks:
            x = self.vectors[at] / large
            self.slack[at] = np.sqrt((x * x).sum(axis=1))
            rough[at, :-1] = x
        length = self.slack.max()
        self.length = large * float(length)
        rough /= length
        self.slack *= 2 * (dimension + 4) * np.finfo(np.float32).eps / length
        self.slack += np.float32(1e-36)  # for what is too small for single precision
        rough[:, -1] = self.slack
        self.rough = rough

    def search(self, queries: pa.RecordBatch):
        asking = max(1, min(ASKING, BEST_ROWS // (4 * self.keep)))
        for lo in range(0, queries.num_rows, asking):
            yield from self._search(queries.slice(lo, asking))

    def _search(self, queries: pa.RecordBatch):
        self.asking = _matrix(queries.column(5), self.dimension, self.kind)
        data, starts = _bytes_of(queries.column(2))
        wanted, who = data.view(np.int64), np.repeat(np.arange(len(starts) - 1), np.diff(starts) // 8)
        at = np.minimum(np.searchsorted(self.cells, wanted), len(self.cells) - 1)
        here = self.cells[at] == wanted
        at, who = at[here], who[here]
        # Large cells first: they give the best bounds to start with.
        order = np.lexsort((who, at, -np.diff(self.start)[at]))
        at, who = at[order], who[order]
        ends = np.append(np.flatnonzero(at[1:] != at[:-1]) + 1, len(at)) if len(at) else []
        large = np.abs(self.asking).max(axis=1, keepdims=True)
        q = self.asking / large.astype(float)
        length = np.sqrt((q * q).sum(axis=1, keepdims=True))
        q = np.column_stack([q / length, np.ones(len(q))]).astype(np.float32)
        with np.errstate(over="ignore"):
            length = (length * large)[:, 0] * self.length
        # Exact scores that overflow or vanish can tie where products do not: then all are scored exactly.
        self.bounded = 1e-200 < length.min() and length.max() < 1e300
        self.floor = np.full(len(q), -np.inf, np.float32)
        self.held, self.n = [], 0
        first = 0
        for last in ends:
            self._meet(q, who[first:last], self.start[at[first]], self.start[at[first] + 1])
            first = last
        if self.n:
            query, met, _, score = self._best()
            best = np.empty(len(query), CANDIDATE)
            best["c1"], best["c2"], best["least"] = self.ids[met].T
            best["score"] = score
            at = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
            who = queries.select(["k1", "k2"]).take(pa.array(query[at]))
            yield pa.RecordBatch.from_arrays([*who.columns, _binary(best, np.append(at, len(query)))], _BEST)

    def _meet(self, q: np.ndarray, who: np.ndarray, first: int, last: int) -> None:
        """Holds those of the vectors from ``first`` to ``last`` that can be among the best of the queries ``who``."""
        for lo in range(first, last, BLOCK_VECTORS):
            hi = min(lo + BLOCK_VECTORS, last)
            step = max(1, PRODUCTS // (hi - lo))
            for some in (who[k:k + step] for k in range(0, len(who), step)):
                most = q[some] @ self.rough[lo:hi].T
                new = np.flatnonzero(np.isneginf(self.floor[some]))
                if self.bounded and len(new) and hi - lo > self.keep:
                    sure = most[new] - 2 * self.slack[lo:hi]
                    self.floor[some[new]] = np.partition(sure, -self.keep, axis=1)[:, -self.keep]
                at = np.flatnonzero((most >= self.floor[some][:, None]).ravel())
                query, met = np.divmod(at, hi - lo)
                self.held.append((some[query], lo + met, most.ravel()[at]))
                self.n += len(at)
                if self.n > BEST_ROWS:
                    self._cut()

    def _cut(self) -> None:
        """Drops what the bounds exclude, and goes by exact scores if that does not make room."""
        query, met, most = map(np.concatenate, zip(*self.held))
        if self.bounded:
            sure = most - 2 * self.slack[met]
            order = np.lexsort((-sure, query))
            kth = order[ranks(query[order]) == self.keep - 1]
            self.floor[query[kth]] = np.maximum(self.floor[query[kth]], sure[kth])
            stay = most >= self.floor[query]
            query, met, most = query[stay], met[stay], most[stay]
        self.held, self.n = [(query, met, most)], len(query)
        if self.n > BEST_ROWS // 2:
            query, met, most, _ = self._best()
            self.held, self.n = [(query, met, most)], len(query)

    def _best(self):
        """The best of what is held, by exact score and least id: ``(query, vector, bound, score)``."""
        query, met, most = map(np.concatenate, zip(*self.held))
        score = exact_scores(self.asking, self.vectors, query, met)
        ids = self.ids[met]
        order = np.lexsort((ids[:, 1], ids[:, 0], ids[:, 2], -score, query))
        order = order[ranks(query[order]) < self.keep]
        return query[order], met[order], most[order], score[order]


def meet(index: DataFrame, probing: DataFrame, deal: Deal, dimension: int, kind: str, keep: int) -> DataFrame:
    """``BEST``: every query's best ``keep`` vectors of the cells that a shard has."""
    rows = index.union(probing).repartitionById(deal.slots, "slot").sortWithinPartitions("slot", "kind")

    def run(batches):
        now, held, shard = None, [], None
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            two = np.stack([batch.column(k).to_numpy() for k in range(2)], axis=1)
            at = 0
            for end in np.append(np.flatnonzero((two[1:] != two[:-1]).any(axis=1)) + 1, n).tolist():
                slot, asks = two[at].tolist()
                if slot != now:
                    now, held, shard = slot, [], None
                if not asks:
                    held.append(batch.slice(at, end - at))
                elif held or shard:
                    if held:
                        shard, held = Shard(held, dimension, kind, keep), []
                    yield from shard.search(batch.slice(at, end - at))
                at = end

    return rows.mapInArrow(run, BEST)


def best_of(rows: pa.RecordBatch, keep: int) -> pa.RecordBatch:
    """``(q1, q2, c1, c2, score)``: the best ``keep`` candidates of each query in ``BEST`` rows that stand query by query."""
    data, starts = _bytes_of(rows.column(2))
    found, starts = data.view(CANDIDATE), starts // CANDIDATE.itemsize
    q = np.stack([rows.column(k).to_numpy() for k in range(2)], axis=1)
    first = np.flatnonzero(np.append(True, (q[1:] != q[:-1]).any(axis=1)))
    row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(q))))
    # Where a shard gave as many as are kept, nothing below its last is.
    last = np.where(np.diff(starts) == keep, found["score"][starts[1:] - 1], -np.inf)
    query = np.repeat(row, np.diff(starts))
    stay = ~(found["score"] < np.fmax.reduceat(last, first)[query])
    found, query = found[stay], query[stay]
    order = np.lexsort((found["c2"], found["c1"], found["least"], -found["score"], query))
    found, query = found[order], query[order]
    # A candidate has one score, so what both tables found stands together.
    same = (query[1:] == query[:-1]) & (found["c1"][1:] == found["c1"][:-1]) & (found["c2"][1:] == found["c2"][:-1])
    found, query = found[np.append(True, ~same)], query[np.append(True, ~same)]
    top = ranks(query) < keep
    found, who = found[top], q[first][query[top]]
    columns = [who[:, 0], who[:, 1], found["c1"], found["c2"], found["score"]]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["q1", "q2", "c1", "c2", "score"])


def merged(found: DataFrame, keep: int) -> DataFrame:
    """``(q1, q2, c1, c2, score)``: the best ``keep`` of each query among what ``BEST`` rows hold."""

    def run(batches):
        held = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = batch if held is None else pa.concat_batches([held, batch])
            q = np.stack([rows.column(k).to_numpy() for k in range(2)], axis=1)
            other = np.flatnonzero((q != q[-1]).any(axis=1))  # the last query may go on in the next batch
            ended = int(other[-1]) + 1 if len(other) else 0
            if ended:
                yield best_of(rows.slice(0, ended), keep)
            held = rows.slice(ended)
        if held is not None:
            yield best_of(held, keep)

    return found.repartition("q1", "q2").sortWithinPartitions("q1", "q2").mapInArrow(
        run, "q1 bigint, q2 bigint, c1 bigint, c2 bigint, score double")


def sampled(queries: DataFrame, kind: str) -> np.ndarray:
    """The vectors of ``SAMPLE_QUERIES`` queries: those of the least class numbers."""
    sample = queries.orderBy("k1", "k2").limit(SAMPLE_QUERIES).select("vector").collect()
    return np.stack([np.frombuffer(r.vector, kind) for r in sample]).astype(float)


def fitted_cosine(sample: np.ndarray, classes: DataFrame, dimension: int, kind: str, largest: float, k: int) -> float:
    """The cosine of the k-th neighbour that nine in ten of the queries of a sample reach.

    The sample is compared with all vectors, each task keeping k a query.
    """
    q = sample / np.linalg.norm(sample, axis=1, keepdims=True)

    def run(batches):
        top = np.full((len(q), k + 1), -np.inf)
        for batch in batches:
            if batch.num_rows:
                scores = q @ (_matrix(batch.column(0), dimension, kind).astype(float) / largest).T
                both = np.concatenate([top, scores], axis=1)
                top = -np.partition(-both, k, axis=1)[:, :k + 1]
        number = np.repeat(np.arange(len(q)), k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(top.ravel())], ["q", "c"])

    found = classes.select("vector").mapInArrow(run, "q bigint, c double").filter(F.col("c") > F.lit(float("-inf")))
    # The first is the query's own vector.
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("c").desc()))
    rows = found.withColumn("r", rank).filter(F.col("r") <= k + 1).groupBy("q").agg(F.min("c").alias("c"))
    worst = rows.agg(F.percentile_approx("c", 0.1)).first()[0]
    return float(min(max(worst, 0.0), 0.999))


RESULT = "query_id bigint, rank int, vec_id bigint, score double"


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id: str = "vec_id", vector: str = "embedding",
            tables: int = TABLES) -> DataFrame:
    """``RESULT``: the ``k`` nearest found of every query row, nearest first, ties to the smaller id.

    Vectors that are null, zero or hold a null or non-finite component take no
    part, nor do rows of null id. Each dimension is searched by itself: a query's
    candidates are the vectors of its own dimension. Rows of the query's id are no
    candidates; a repeated row counts once. Fewer candidates than ``k`` are all
    returned; an empty table gives no rows; other columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    # Single precision is carried as such: half the bytes.
    given = vectors.select(F.col(vector)).schema[0].dataType
    single = isinstance(given, ArrayType) and isinstance(given.elementType, FloatType)
    own = vectors.select(F.col(id).cast("bigint").alias("vec_id"),
                         F.col(vector).cast("array<float>" if single else "array<double>").alias("e"),
                         F.coalesce(is_query, F.lit(False)).alias("query"))
    own = own.filter(F.col("vec_id").isNotNull() & takes_part(F.col("e")))
    norm = F.sqrt(F.aggregate(F.col("e").cast("array<double>"), F.lit(0.0), lambda acc, x: acc + x * x))
    shape = own.groupBy(F.size("e").alias("d")).agg(F.count_if("query").alias("asked"), F.max(norm).alias("norm"))
    found = [_nearest_of_dimension(own.filter(F.size("e") == s.d), s.d, "<f4" if single else "<f8", s.norm, k, tables)
             for s in shape.filter("asked > 0").orderBy("d").collect()]
    return functools.reduce(DataFrame.union, found) if found else spark.createDataFrame([], RESULT)


def _nearest_of_dimension(own: DataFrame, dimension: int, kind: str, largest: float, k: int, tables: int) -> DataFrame:
    """``RESULT`` of the rows ``(vec_id, e, query)``, all of one dimension; ``largest`` is their largest norm.

    ``kind`` is the NumPy type of components.
    """
    spark = own.sparkSession
    e = F.col("e").cast("array<double>")
    own = own.withColumns({"k1": F.xxhash64(e), "k2": F.xxhash64(F.lit(1), e)})

    place = F.dense_rank().over(Window.partitionBy("k1", "k2").orderBy("vec_id"))
    least = own.withColumn("place", place).filter(F.col("place") <= k + 1)
    classes = least.groupBy("k1", "k2").agg(F.first("e").alias("e"), F.collect_set("vec_id").alias("ids"))

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                data = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(kind)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(3),
                     _binary(data, np.arange(batch.num_rows + 1) * dimension)], ["k1", "k2", "ids", "vector"])

    classes = materialize(classes.select("k1", "k2", "e", "ids").mapInArrow(
        pack, "k1 bigint, k2 bigint, ids array<bigint>, vector binary"), "vector_classes")
    asking = materialize(own.filter("query").select("vec_id", "k1", "k2").distinct(), "queries")
    queries = materialize(classes.join(asking.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
                          .select("k1", "k2", "vector"), "query_classes")
    n, asked = classes.count(), queries.count()
    sample = sampled(queries, kind)
    cosine = fitted_cosine(sample, classes, dimension, kind, largest, k)
    # Slots of this width split a unit normal into some 2.75 cells.
    m = max(0, math.ceil(math.log(n / CELL_VECTORS) / math.log(2.75)))
    # The k + 1 best ids are in the k + 1 classes that are best by score and least id.
    keep = k + 1
    shards = max(-(-n // max(BLOCK_VECTORS, SHARD_BYTES // (np.dtype(kind).itemsize * dimension))), min(SHARDS, -(-n // CELL_VECTORS)))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def search(wanted: DataFrame, asked: int, m: int, tables: int, name: str) -> DataFrame:
        large = [(r.cell, r.n) for r in large_cells(classes, dimension, kind, largest, m, tables).collect()]
        deal = Deal(m, tables, shards, 1, large)
        if asked > BLOCK_QUERIES:  # as many parts as the sample's visits to shards ask for
            functions = [hash_functions(dimension, m, t) for t in range(tables)]
            seen = len(visits(*probed_cells(sample, functions, cosine, [0.1] * tables), deal)[0])
            deal.parts = max(1, math.ceil(asked * seen / (len(sample) * tables * shards * BLOCK_QUERIES)))
        index = index_rows(classes, dimension, kind, largest, deal)
        probing = probe_rows(wanted.repartition(max(1, min(tasks, asked // 512))), dimension, kind, cosine, deal)
        return materialize(merged(meet(index, probing, deal, dimension, kind, keep), keep), name)

    first = search(queries, asked, m, tables, "neighbours")
    many = classes.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.size("ids").alias("n"))
    enough = first.join(many, ["c1", "c2"]).groupBy("q1", "q2").agg(F.sum("n").alias("n")).filter(
        F.col("n") > min(k, n - 1))
    rest = queries.join(enough, (queries.k1 == enough.q1) & (queries.k2 == enough.q2), "left_anti")
    rest = materialize(rest, "left_over")
    left = rest.count()
    pairs = first.union(search(rest, left, 0, 1, "neighbours_exact")).distinct() if left else first

    of_found = classes.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), "ids")
    exact = pairs.join(of_found, ["c1", "c2"])
    # Copies of a query share its neighbours: only the best k + 1 ids go to each.
    flat = exact.select("q1", "q2", F.explode("ids").alias("vec_id"), "score")
    order = [F.col("score").desc(), F.col("vec_id")]
    flat = flat.withColumn("r", F.row_number().over(Window.partitionBy("q1", "q2").orderBy(*order)))
    flat = flat.filter(F.col("r") <= k + 1)
    ids = asking.select(F.col("vec_id").alias("query_id"), "k1", "k2")
    found = flat.join(ids, (flat.q1 == ids.k1) & (flat.q2 == ids.k2)).filter("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "q1", "q2").orderBy(*order))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
