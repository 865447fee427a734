"""Nearest neighbours: recall and order against brute force, probes in order, and odd vectors."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm.conftest import SMOKE
from marquee.llm import ann
from marquee.llm.ann import nearest, probes
from marquee.llm.queries import QUERIES


def brute(rows, is_query, k):
    """``{query: [(vec_id, score), ...]}`` over all pairs."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(
        x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, a in good:
        if is_query(q):
            scored = {(i, float(np.dot(a, b))) for i, b in good if i != q}
            out[q] = sorted(scored, key=lambda s: (-s[1], s[0]))[:k]
    return out


def got_lists(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r)
    for rows in out.values():
        assert [r.rank for r in rows] == list(range(1, len(rows) + 1))
    return out


def recall_of(got, expected):
    hits = sum(len({r.vec_id for r in got.get(q, [])} & {i for i, _ in best}) for q, best in expected.items())
    return hits / sum(map(len, expected.values()))


def test_query_has_the_recall_it_aims_at(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding])
            for r in spark.read.parquet(f"{SMOKE}/embeddings.parquet").collect()]
    expected = brute(rows, lambda i: i % 20 == 0, 20)
    got = got_lists(QUERIES["op10_ann_search"](spark, SMOKE))
    assert set(got) == set(expected) and all(len(got[q]) == len(expected[q]) for q in got)
    assert recall_of(got, expected) >= 0.9
    score = {(q, i): s for q, best in expected.items() for i, s in best}
    assert all(r.score == pytest.approx(score[q, r.vec_id], abs=1e-12)
               for q, rs in got.items() for r in rs if (q, r.vec_id) in score)


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(0, 40, 3000)] + 0.2 * rng.normal(size=(3000, 16))
    x *= rng.uniform(0.3, 3, (3000, 1))  # norms matter to the inner product
    x[100:400] = x[7]
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_many_cells_blocks_and_copies(clustered, monkeypatch):
    rows, frame = clustered
    monkeypatch.setattr(ann, "CELL_VECTORS", 50)
    monkeypatch.setattr(ann, "BLOCK_VECTORS", 64)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 40)
    expected = brute(rows, lambda i: i % 20 == 0, 10)
    got = got_lists(nearest(frame, F.col("vec_id") % 20 == 0, 10))
    assert set(got) == set(expected) and all(len(v) == 10 for v in got.values())
    assert recall_of(got, expected) >= 0.9
    # Of 301 equal vectors the ids are the smallest, and a copy may find its copies.
    assert all(r.vec_id in {7, *range(100, 400)} for r in got[120]) or got[120][0].score > rows[7][1][0]


def test_queries_without_enough_candidates_are_searched_exactly(clustered, monkeypatch):
    rows, frame = clustered
    monkeypatch.setattr(ann, "CELL_VECTORS", 2)
    monkeypatch.setattr(ann, "MOST_PROBES", 1)
    expected = brute(rows, lambda i: i % 300 == 0, 5)
    got = got_lists(nearest(frame, F.col("vec_id") % 300 == 0, 5))
    assert {q: [r.vec_id for r in rs] for q, rs in got.items()} == {q: [i for i, _ in b] for q, b in expected.items()}


@pytest.mark.parametrize("kind, sizes", [("hot", {}), ("mixed", {"BLOCK_VECTORS": 16, "BEST_ROWS": 64}),
                                         ("hot", {"CELL_VECTORS": 2, "RECALL": 1.0})])
def test_more_tied_vectors_than_are_kept_come_by_id(spark, monkeypatch, kind, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(ann, name, value)
    rng = np.random.default_rng(8)
    if kind == "hot":  # with copies of some; 119 others tie at 0
        x = np.eye(120)[np.append(np.arange(120), np.arange(60))] * 0.1
    else:  # the same products in other places: sums that rounding may tell apart
        x = np.array([rng.permutation(np.append([0.1, 0.7, -0.3, 1.1], np.zeros(4))) for _ in range(150)])
    # Ids in an order that no hash and no place has.
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(x)), x)] + [(1000, [0.5] * x.shape[1])]
    got = got_lists(nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0))
    of = {i: np.array(v) for i, v in rows}
    for q in (i for i in of if i % 50 == 0):
        scores = {i: float((of[q] * v).sum()) for i, v in of.items() if i != q}
        assert [(r.vec_id, r.score) for r in got[q]] == sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:20]


def test_each_dimension_is_searched_by_itself(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=2 + i % 2 * 2)]) for i in range(41)]
    got = got_lists(nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 5 == 0, 3))
    expected = {}
    for parity in (0, 1):
        expected |= brute([r for r in rows if r[0] % 2 == parity], lambda i: i % 5 == 0, 3)
    assert {q: [r.vec_id for r in rs] for q, rs in got.items()} == {q: [i for i, _ in b] for q, b in expected.items()}


def test_odd_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0, 5.0]), (9, [1.0, -5.0]), (10, []), (20, [-1.0, 0.0]),
            (11, [1.0, 2.0, 3.0]), (40, [0.0, 0.0]), (60, None)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, rank string, score int")
    got = nearest(df, F.col("vec_id") % 20 == 0)
    lists = {q: [(r.vec_id, r.score) for r in rs] for q, rs in got_lists(got).items()}
    assert lists == brute([r for r in rows if r[0] not in (10, 11)], lambda i: i % 20 == 0, 20)
    assert [i for i, _ in lists[0]] == [1, 8, 9, 2, 20]
    assert nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert nearest(df.filter("vec_id = 8"), F.col("vec_id") % 20 == 0).collect() == []
    assert nearest(df.filter("vec_id = 0"), F.col("vec_id") % 20 == 0).collect() == []
    assert got.columns == ["query_id", "rank", "vec_id", "score"]


def test_probes_come_in_order_of_probability_and_reach_the_mass():
    rng = np.random.default_rng(5)
    mean, shift, spread = rng.normal(size=3), rng.uniform(0, ann.WIDTH, 3), 0.8
    cells = probes(mean, shift, spread, 0.99)

    def chance(slots):
        edges = [((s * ann.WIDTH - shift[k] - mean[k]) / spread, ((s + 1) * ann.WIDTH - shift[k] - mean[k]) / spread)
                 for k, s in enumerate(slots)]
        return math.prod(0.5 * (math.erf(b / 2 ** 0.5) - math.erf(a / 2 ** 0.5)) for a, b in edges)

    chances = [chance(c) for c in cells]
    assert chances == sorted(chances, reverse=True) and sum(chances) >= 0.99 > sum(chances[:-1])
    assert len({tuple(c) for c in cells}) == len(cells)
    assert cells[0] == np.floor((mean + shift) / ann.WIDTH).tolist() or chances[0] >= max(chances)
    sample = np.floor((mean + shift + spread * rng.normal(size=(20000, 3))) / ann.WIDTH).astype(int)
    assert np.mean([tuple(s) in {tuple(c) for c in cells} for s in sample]) == pytest.approx(sum(chances), abs=0.01)
    assert probes(mean, shift, spread, 0.99, most=3) is None
    assert probes(np.zeros(0), np.zeros(0), spread, 0.9) == [[]]


def test_tasks_hand_on_bounded_batches_of_probes(spark, monkeypatch):
    """A batch of queries with many cells each was one batch of all their probes, a vector a cell."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, 24))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").coalesce(1)
    monkeypatch.setattr(ann, "CELL_VECTORS", 4)
    kind = type(frame)
    plain = kind.mapInArrow

    def bounded(self, func, schema, *args, **kwargs):
        def run(batches):
            for batch in func(batches):
                assert batch.nbytes < 3 << 22, f"a batch of {batch.nbytes} bytes"
                yield batch
        return plain(self, run, schema, *args, **kwargs)

    monkeypatch.setattr(kind, "mapInArrow", bounded)
    assert nearest(frame, F.col("vec_id") >= 0, 5).count() == 4000 * 5


def dealt(kind, cells, numbers, vectors, least):
    """A batch of ``DEALT`` rows: the cells of each, its class number twice, its vector and least id."""
    vectors = np.asarray(vectors)
    ends = np.cumsum([0, *map(len, cells)])
    n = len(cells)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, kind, np.int32)),
         ann._binary(np.concatenate(cells).astype(np.int64), ends), pa.array(numbers), pa.array(numbers),
         ann._binary(vectors.ravel(), np.arange(n + 1) * vectors.shape[1]), pa.array(least)], ann._DEALT)


@pytest.mark.parametrize("kind", ["<f4", "<f8"])
@pytest.mark.parametrize("case", ["plain", "ties", "lengths", "huge", "tiny", "equal ids"])
@pytest.mark.parametrize("sizes", [{}, {"BLOCK_VECTORS": 7, "PRODUCTS": 64, "BEST_ROWS": 100, "ASKING": 5, "PAIRS": 8}])
def test_shard_finds_the_best_of_the_visited_cells(monkeypatch, kind, case, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(ann, name, value)
    rng = np.random.default_rng(11)
    n, asked, keep = 400, 30, 6
    x = rng.normal(size=(n + asked, 5))
    if case == "ties":
        x = rng.integers(-1, 2, (n + asked, 5)) + (np.arange(5) == 0) * 0.5
    elif case == "lengths":  # most are far below the rounding of the longest
        x *= 10.0 ** rng.uniform(-9, 0, (n + asked, 1))
    elif case in ("huge", "tiny") and kind == "<f8":  # products overflow, or vanish, and tie
        x *= 1e200 if case == "huge" else 1e-170
    x = x.astype(kind)
    vectors, asking = x[:n], x[n:]
    cell = np.sort(rng.integers(0, 12, n)) * 1000003 - 5
    least = rng.permutation(n) if case != "equal ids" else np.repeat(7, n)
    order = rng.permutation(n)
    index = dealt(0, cell[order, None], order, vectors[order], least[order])
    lists = [np.unique(rng.choice([*np.unique(cell), 999], rng.integers(1, 9))) for _ in range(asked)]
    shard = ann.Shard([index.slice(0, 150), index.slice(150)], 5, kind, keep)
    got = {}
    for batch in shard.search(dealt(1, lists, np.arange(asked), asking, np.zeros(asked, np.int64))):
        for r in batch.to_pylist():
            got[r["q1"]] = [(c, least, s) for c, _, least, s in np.frombuffer(r["best"], ann.CANDIDATE).tolist()]
    for q in range(asked):
        met = np.flatnonzero(np.isin(cell, lists[q]))
        with np.errstate(over="ignore", invalid="ignore"):
            score = (asking[q].astype(float) * vectors[met].astype(float)).sum(axis=1)
        expected = met[np.lexsort((met, least[met], -score))][:keep]
        assert [c for c, _, _ in got.get(q, [])] == expected.tolist()
        assert [s for _, _, s in got.get(q, [])] == pytest.approx(
            [float(s) for s in score[np.searchsorted(met, expected)]], nan_ok=True)


@pytest.mark.parametrize("rows", [1, 3, 1000])
def test_the_best_of_shards_are_merged_by_score_and_id(spark, monkeypatch, rows):
    rng = np.random.default_rng(13)
    score, least = rng.integers(0, 9, 40) / 4, rng.permutation(40) // 2
    given, expected = [], set()
    for q in range(25):
        union = set()
        for _ in range(rng.integers(1, 12)):
            some = rng.choice(40, rng.integers(1, 20), replace=False)
            some = some[np.lexsort((some, least[some], -score[some]))][:5]
            union |= set(some.tolist())
            given.append((q, -q, np.array([(c, c % 3, least[c], score[c]) for c in some], ann.CANDIDATE).tobytes()))
        for c in sorted(union, key=lambda c: (-score[c], least[c], c))[:5]:
            expected.add((q, -q, c, c % 3, score[c]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        got = ann.merged(spark.createDataFrame(given, ann.BEST), 5).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_visits_hold_every_cell_and_block_once(monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_VECTORS", 10)
    cells = [5, 17, -3]
    deal = ann.Deal(2, 2, 4, 1, [(17, 95), (-8, 30)])
    assert deal.blocks_of(np.array([5, 17, -8])).tolist() == [1, 10, 3]
    row, table = np.repeat([0, 1], 3), np.zeros(6, np.int64)
    rows, shards, found, starts = ann.visits(row, table, np.array(cells * 2), deal)
    seen = {}
    for k in range(len(rows)):
        here = found[starts[k]:starts[k + 1]].tolist()
        assert len(set(here)) == len(here)
        for c in here:
            seen.setdefault((int(rows[k]), c), set()).add(int(shards[k]))
    for c in cells:  # where the index has the cell's rows, whatever their block
        n = 10 if c == 17 else 1
        wanted = set(deal.shard(0, np.full(n, c), np.arange(n)).tolist())
        assert seen[0, c] == seen[1, c] == wanted
    assert len(ann.visits(*(np.empty(0, np.int64),) * 3, deal)[0]) == 0


def test_probes_are_those_of_a_search_from_the_likeliest_cell():
    rng = np.random.default_rng(9)
    guess = 0.1
    for _ in range(40):
        m, spread = int(rng.integers(1, 5)), float(rng.uniform(0.2, 1))
        mean, shift, mass = rng.normal(size=m), rng.uniform(0, ann.WIDTH, m), float(rng.choice([0.5, 0.8, 0.96]))
        grid = np.stack(np.meshgrid(*[np.arange(-12, 13)] * m, indexing="ij"), axis=-1).reshape(-1, m)
        edge = lambda s: np.array([math.erf(v) for v in ((s * ann.WIDTH - shift - mean) / spread / 2 ** 0.5).ravel()])
        chance = np.prod((0.5 * (edge(np.arange(-12, 14)[:, None])[m:] - edge(np.arange(-12, 14)[:, None])[:-m])).reshape(25, m)[
            grid + 12, np.arange(m)], axis=1)
        order = np.argsort(-chance)
        expected = grid[order[:int(np.searchsorted(np.cumsum(chance[order]), mass)) + 1]]
        slots, guess = ann.probe_slots(mean, shift, spread, mass, 4096, guess)
        assert slots.tolist() == expected.tolist() == probes(mean, shift, spread, mass)


def test_single_and_double_precision_give_the_same_lists(spark):
    x = np.random.default_rng(12).normal(size=(300, 6)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    single, double = (nearest(spark.createDataFrame(rows, f"vec_id long, embedding array<{t}>"), F.col("vec_id") % 9 == 0, 7)
                      for t in ("float", "double"))
    assert got_lists(single) == got_lists(double)
