"""Language-model scores: the base by plain counting, the model by a dictionary of exact bigram counts."""

import re
import zlib
from collections import Counter
from math import log2, log10

import numpy as np
import pytest

from llm.conftest import empty_of
from marquee.llm.lm_score import (PRIOR, Filter, filled, groups_of, levels_of, lm_scores, middle, packed, packed_keys,
                                  unpacked, unpacked_keys)

END = object()


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall("[^\x20\x09-\x0D]+", low), END]


def plain(rows):
    """What the operator would give with a filter that never errs; rows may repeat."""
    held = [k is not None and zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in rows]
    texts = [tokens(t) for _, t in rows]
    one, two = Counter(), Counter()
    for h, t in zip(held, texts):
        if not h:
            one.update(t)
            two.update(zip([END, *t], t))
    n, v = sum(one.values()), len(one)
    out = []
    for (k, _), h, t in zip(rows, held, texts):
        base = sum(log10((one[w] + 1) / (n + v + 1)) for w in t)
        score = 0.0
        for before, w in zip([END, *t], t):
            c = two[before, w]
            if c:
                low = 2 ** int(log2(c))
                c = min((3 * low - 1) / 2, one[w], one[before])
            score += log10((c + PRIOR * (one[w] + 1) / (n + v + 1)) / (one[before] + PRIOR))
        out.append((k, h, len(t), sum(w in one for w in t), n, base, score))
    return out


def found(frame, **options):
    return [tuple(r) for r in lm_scores(frame, **options).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()]


def same(got, want, share=0.03):
    """The base exactly; the score up to bigrams that the filter wrongly takes for seen, which only raise it."""
    key = lambda r: (repr(r[0]), r[2], round(r[5], 6), round(r[6], 3))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    a, b, n = (np.array(x) for x in ([r[6] for r in got], [r[6] for r in want], [r[2] for r in want]))
    assert (a >= b - 1e-6).all() and (a <= 1e-9).all()
    assert (a - b).sum() <= share * n.sum()


def test_planes_round_trip():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    assert (unpacked_keys(packed_keys(keys)) == keys).all()
    for values in (np.arange(300, dtype=np.uint32), np.zeros(0, np.uint32)):
        assert (unpacked(packed(values), np.uint32) == values).all()


def test_levels():
    counts = np.array([1, 2, 3, 4, 7, 8, 1 << 40])
    assert levels_of(counts).tolist() == [1, 2, 2, 3, 3, 4, 41]
    assert middle(np.array([0, 1, 2, 3])).tolist() == [0, 1, 2.5, 5.5]


def test_filter_holds_all_levels_and_errs_seldom():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 48, 20_000, dtype=np.uint64))
    counts = rng.geometric(0.3, len(keys))
    row = type("Row", (), {"bucket": 0, "bits": filled(keys, counts).tobytes()})
    model = Filter([row], 1)
    got = model.levels(keys)
    assert (got >= levels_of(counts)).all() and (got == levels_of(counts)).mean() > 0.97
    assert (model.levels(rng.integers(0, 1 << 48, 20_000, dtype=np.uint64)) > 0).mean() < 0.03


def test_groups_cover_all_parts_within_the_bound():
    assert groups_of([(2, 5), (0, 4), (1, 5), (3, 30), (4, 1)], 10) == [(0, 1), (2, 2), (3, 3), (4, 4)]
    assert groups_of([], 10) == []


@pytest.mark.parametrize("options", [{}, {"bucket_keys": 500, "filter_bytes": 4000, "block_bytes": 20_000}])
def test_equals_plain_counting(spark, documents, options):
    """Whole, and in many blocks, buckets and passes."""
    rows, frame = documents
    same(found(frame, **options), plain(rows))


def test_odd_rows(spark, odd_rows):
    rows = [(r.doc_id, r.text) for r in odd_rows.collect()]
    same(found(odd_rows), plain(rows))
    assert found(empty_of(odd_rows)) == []


def test_nothing_to_learn_from(spark):
    held = [k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2][:3]
    rows = [(k, "some words") for k in held]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert all(r[3:5] == (0, 0) and r[5] == 0.0 for r in got) and len(got) == 3


def test_learned_bigrams_score_above_the_base(spark):
    """Texts of one fixed order of words: the word before tells the next one."""
    order = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(order[(7 * k) % 300:(7 * k) % 300 + 100])) for k in range(200)]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    held = [r for r in got if r[1]]
    assert held and sum(r[6] for r in held) > sum(r[5] for r in held)
