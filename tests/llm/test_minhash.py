"""MinHash near-dedup: the pigeonhole guarantee, links on full sets, tiles, and brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm.conftest import collected, empty_of
from marquee.llm import minhash
from marquee.llm.components import components
from marquee.llm.minhash import (CHUNKS, DISTANCE, SYMBOLS, forest, links, near_dedup, shingle_set, signature,
                                 signature_keys, multipliers, word_hashes)
from marquee.llm.textbytes import RollingHash


def sets_of(rows, words):
    out = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        n = min(words, len(w))
        out.append({tuple(w[j:j + n]) for j in range(len(w) - n + 1)} if w else set())
    return out


def brute(rows, words, similarity=80):
    """Components over all links, found through shared shingles."""
    sets, root, having = sets_of(rows, words), list(range(len(rows))), defaultdict(list)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, own in enumerate(sets):
        shared = Counter(j for s in own for j in having[s])
        for s in own:
            having[s].append(i)
        for j, n in shared.items():
            if 100 * n >= similarity * (len(own) + len(sets[j]) - n):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(sets[i]), least.get(find(i), doc), least.get(find(i), doc) == doc)
                   for i, (doc, _) in enumerate(rows)), key=repr)


COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


@pytest.mark.parametrize("words", [4, 5])
def test_equals_brute_force_on_test_documents(documents, words):
    rows, frame = documents
    assert collected(near_dedup(frame, words=words), *COLUMNS) == brute(rows, words)


def mutated(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


@pytest.fixture(scope="module")
def families(spark):
    """Copies, near copies at many similarities, chains, and a passage that many texts share."""
    rng, rows = random.Random(5), []
    for _ in range(6):
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.choice([30, 120, 400]))]
        rows += [mutated(rng, base, rng.randrange(0, max(2, len(base) // 12))) for _ in range(25)]
    chain = [f"c{k}" for k in range(300)]
    for k in range(20):
        chain[15 * k:15 * k + 6] = [f"d{k}.{j}" for j in range(6)]
        rows.append(" ".join(chain))
    passage = " ".join(f"p{k}" for k in range(40))
    rows += [" ".join(f"q{rng.random()}" for _ in range(30)) + " " + passage for _ in range(60)]
    rows += [rows[0]] * 30
    rng.shuffle(rows)
    return list(enumerate(rows)), spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


def test_families_equal_brute_force(families):
    rows, frame = families
    assert collected(near_dedup(frame), *COLUMNS) == brute(rows, 5)


def test_tiles_of_any_size_give_the_same_result(families, monkeypatch):
    rows, frame = families
    monkeypatch.setattr(minhash, "BUCKET_ROWS", 3)
    monkeypatch.setattr(minhash, "FAMILY_SHINGLES", 900)
    assert collected(near_dedup(frame), *COLUMNS) == brute(rows, 5)


def test_odd_rows_and_empty_table(odd_rows):
    rows = [(r.doc_id, r.text) for r in odd_rows.collect()]
    got = near_dedup(odd_rows)
    assert collected(got, *COLUMNS) == brute(rows, 5)
    assert near_dedup(empty_of(odd_rows)).collect() == []


def test_rows_without_an_id_and_repeated_ids(families, spark):
    rows, _ = families
    rows = [(None if k % 3 == 0 else i // 2, t) for k, (i, t) in enumerate(rows)]
    rows += [(None, rows[1][1])] * 40 + rows[:30]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup(frame)
    assert collected(got, "n_shingles", "kept") == sorted(((n, k) for _, n, _, k in brute(rows, 5)), key=repr)
    groups = {r.group_id for r in got.collect()}
    assert len(groups) == len({c for _, _, c, _ in brute(list(enumerate(t for _, t in rows)), 5)})


def test_every_pair_within_the_distance_shares_a_key():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 256, (300, SYMBOLS), dtype=np.uint8)
    b = a.copy()
    for row in b:
        row[rng.choice(SYMBOLS, DISTANCE, replace=False)] += 1
    worst = a.copy()  # as even a spread as can be
    for k, row in enumerate(worst):
        places = np.concatenate([rng.choice(c, 2, replace=False) for c in np.array_split(np.arange(SYMBOLS), CHUNKS)])
        row[np.delete(places, rng.integers(len(places)))] += 1
    keys = signature_keys(a)
    for other in (b, worst):
        assert ((a != other).sum(axis=1) == DISTANCE).all()
        assert (keys == signature_keys(other)).any(axis=1).all()


def test_signature_distance_estimates_similarity():
    rng, factors = np.random.default_rng(3), multipliers()
    misses = 0
    for _ in range(300):
        shared, left, right = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (400, 50, 50))
        a, b = (signature(np.unique(np.concatenate([shared, x])), factors) for x in (left, right))
        misses += (a != b).sum() > DISTANCE
    assert misses == 0  # similarity 0.8: expected 1e-4


def test_links_equal_all_pairs():
    rng = np.random.default_rng(7)
    for _ in range(30):
        base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
        sets = [np.unique(np.concatenate([base[rng.random(60) < 0.93], rng.integers(0, 1 << 63, rng.integers(0, 9), dtype=np.uint64)]))
                for _ in range(25)]
        near = [(i, j) for i in range(25) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j]))
                >= 80 * len(np.union1d(sets[i], sets[j]))]

        def parts(edges):
            label = list(range(25))
            for i, j in edges:
                a, b = label[i], label[j]
                label = [a if x == b else x for x in label]
            return [label.index(x) for x in label]

        found = links(sets)
        assert parts(found) == parts(near) and len(found) <= 24
        assert forest(0, None) == []


def test_words_are_lower_cased_ascii_and_split_at_ascii_space():
    data = np.frombuffer("A b\x0bÄ c A".encode(), np.uint8)
    words, ends = word_hashes(RollingHash(), np.array([0, len(data)]), data)
    assert len(words) == 4 and words[0] == words[3] and list(ends) == [0, 4]
    assert len(shingle_set(words, 5)) == 1 and len(shingle_set(words[:0], 5)) == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + k, 1001 + k) for k in range(150)]
    edges += [(5, 5), (None, 3)]
    label = {x: x for e in edges for x in e if None not in e and e[0] != e[1]}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a is not None and a != b and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
    assert {r.node: r.root for r in got.collect()} == label and got.count() == len(label)
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []
