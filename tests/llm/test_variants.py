"""Spelling variants: acceptors, compositions, and whole results against brute force over all pairs."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from llm.conftest import empty_of
from marquee.llm import variants
from marquee.llm.variants import acceptor, composed, dealt, variant_groups

SCHEMA = "doc_id long, text string, word string, n string, form int, root int"


def one_edit(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return len(y) - len(x) == 1 and any(y[:i] + y[i + 1:] == x for i in range(len(y)))


def plain(rows, least=7, least_count=2, ratio=10, one_in=None):
    counts = Counter()
    for key, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= least
    words = {w: n for w, n in counts.items() if n >= least_count and len(w) >= least}
    near = {w: [] for w in words}
    for x, y in itertools.combinations(words, 2):
        if abs(len(x) - len(y)) <= 1 and one_edit(x, y):
            near[x].append(y)
            near[y].append(x)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {(w, words[w], len(near[w]), form[w], words.get(form[w]), root(w)) for w in words}


def found(frame, **options):
    rows = variant_groups(frame, **options).collect()
    out = {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(out) == len(rows)
    return out


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, "w", "n", 1, 2) for r in rows], SCHEMA)


def test_acceptor_is_minimal_and_accepts_its_words():
    words = sorted({"".join(p) for n in range(4) for p in itertools.product("ab", repeat=n)} - {"aba"})
    states, start = acceptor(words)

    def reads(state, word):
        for c in word:
            state = dict(states[state][1]).get(c)
            if state is None:
                return False
        return states[state][0]
    every = ["".join(p) for n in range(5) for p in itertools.product("ab", repeat=n)]
    assert [w for w in every if reads(start, w)] == sorted(words, key=every.index)
    assert len(set(states)) == len(states) == 6  # no two states read the same words


@pytest.mark.parametrize("seed", range(3))
def test_composition_accepts_every_pair_once(seed):
    rng = random.Random(seed)
    short = sorted({"".join(rng.choices("abc", k=4)) for _ in range(30)})
    long = sorted({"".join(rng.choices("abc", k=5)) for _ in range(60)})
    one, two = acceptor(short), acceptor(long)
    assert sorted(composed(*one, *one, False, 3)) == [(x, y) for x in short for y in short if x < y and one_edit(x, y)]
    assert sorted(composed(*one, *two, True, 4)) == [(x, y) for x in short for y in long if one_edit(x, y)]


@pytest.mark.parametrize("most", [1, 8, variants.GROUP_WORDS])
def test_equals_brute_force(spark, most):
    """Random words of few letters, so that nearly all have near ones, in partitions of any size."""
    rng = random.Random(most)
    words = ["".join(rng.choices("aabé", k=rng.choice((6, 7, 8, 9)))) for _ in range(300)]
    words += ["contexts", "context", "contextt", "contexs"]
    rows = [(k, " ".join(rng.choices(words, k=20)) + " context" * 9 + " contexts" * (k % 2)) for k in range(60)]
    assert found(frame_of(spark, rows), most=most) == plain(rows)


def test_deletions_and_chains(spark, documents):
    rows, frame = documents
    got = found(frame, one_in=31, ratio=3)
    assert got == plain(rows, one_in=31, ratio=3)
    assert any(r[3] is not None for r in got)
    chain = [(1, " ".join(["aaaaaaa"] * 2 + ["aaaaaab"] * 20 + ["aaaaabb"] * 200 + ["aaaabbb"] * 2000))]
    assert ("aaaaaaa", 2, 1, "aaaaaab", 20, "aaaabbb") in found(frame_of(spark, chain))
    assert found(frame_of(spark, chain)) == plain(chain)


def test_odd_rows(spark, odd_rows):
    rows = [(r.doc_id, r.text) for r in odd_rows.collect()] + [(20, "x" * 3000 + " " + "x" * 2999 + " ")] * 2
    rows += [(21, "Étranger étranger Étranger étranger ×÷×÷×÷×")] * 2
    assert found(frame_of(spark, rows)) == plain(rows)
    assert variant_groups(empty_of(odd_rows)).collect() == []


def test_a_hot_partition_is_dealt_again(spark):
    """A third of the words share all but their last letters: no partition keeps more than it may."""
    rng = random.Random(7)
    same = {"commonstart" + "".join(rng.choices("abcdefgh", k=6)) for _ in range(600)}
    words = spark.createDataFrame([(w, 2) for w in sorted(same)], "word string, n long")
    sizes = dealt(words, most=50).groupBy("m", "a", "b", "key").count().filter("b - a > 1")
    assert sizes.agg({"count": "max"}).first()[0] <= 50


def test_equals_sql(spark):
    from conftest import SMOKE
    from marquee.llm.oracle import ORACLE_SQL
    from marquee.llm.queries import QUERIES
    from oracle_compare import compare
    r = compare(spark, SMOKE, "op13", QUERIES["op13_spelling_variants"], ORACLE_SQL["op13_spelling_variants"])
    assert r["cols_match"] and r["values_match"] and r["spark_rows"] == r["duck_rows"], r
