"""Suffix-array dedup: suffix arrays, common prefixes, and whole results against brute force."""

import hashlib
import random

import numpy as np
import pytest

from llm.conftest import collected, empty_of
from marquee.llm import suffix_dedup
from marquee.llm.suffix_array import permuted_common_prefixes, suffix_array
from marquee.llm.suffix_dedup import WINDOW, remove_repeats, segments_of
from marquee.llm.textbytes import RollingHash


def brute(rows):
    seen, out = {}, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - WINDOW + 1):
            if seen.setdefault(data[k:k + WINDOW], (doc, k)) != (doc, k):
                gone[k:k + WINDOW] = b"\1" * WINDOW
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = len([r for r in bytes(gone).split(b"\0") if r])
        out.append((doc, len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("alphabet", [1, 2, 4])
def test_suffix_arrays_and_common_prefixes(alphabet):
    rng = random.Random(alphabet)
    for trial in range(150):
        text = [rng.randint(1, alphabet) for _ in range(rng.randint(0, 50))]
        text = text + text[:len(text) // 2] * (trial % 3) + [0]
        expected = sorted(range(len(text)), key=lambda i: text[i:])
        for size in (alphabet + 1, 5000):  # bucket by bucket, and entry by entry
            assert suffix_array(np.array(text), size).tolist() == expected
        common = permuted_common_prefixes(np.array(text), np.array(expected))
        for a, b in zip(expected, expected[1:]):
            n = 0
            while text[a + n] == text[b + n]:
                n += 1
            assert common[b] == n


def test_every_window_is_in_one_segment_and_equal_windows_have_equal_anchors():
    rng = random.Random(4)
    a, b = ("".join(rng.choice("abcde ") for _ in range(n)).encode() for n in (700, 90))
    data = np.frombuffer(a + b + a[100:500], np.uint8)
    offsets = np.array([0, 700, 790, len(data)])
    anchor, segment, start, end = segments_of(RollingHash(), offsets, data)
    of_window = {}
    for k in range(len(start)):
        for w in range(start[k], end[k] - WINDOW + 1):
            assert w not in of_window
            of_window[w] = anchor[k]
    assert sorted(of_window) == [*range(601), *range(790, 790 + 301)]
    assert all(of_window[100 + k] == of_window[790 + k] for k in range(301))


def texts(seed):
    """Passages moved about, copies, edits, runs, multi-byte letters, and texts shorter than a window."""
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(60, 400))) for _ in range(12)]
    out = []
    for _ in range(40):
        t = "".join(rng.choice(passages) if rng.random() < 0.6 else
                    "".join(rng.choice("abcdefgh é") for _ in range(rng.randint(1, 200))) for _ in range(rng.randint(1, 6)))
        out.append(t)
    out += [out[0]] * 3 + [out[1][:-1] + "!", "x" * 1000, "x" * 99, "xy" * 300, "", "x" * 100]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("limit", [None, 1, 3])
def test_equals_brute_force(spark, monkeypatch, limit):
    rows = texts(1)
    if limit is not None:  # all anchors hot, or some
        monkeypatch.setattr(suffix_dedup, "ANCHOR_SEGMENTS", limit)
        monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 2000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert collected(remove_repeats(df), *COLUMNS) == brute(rows)


def test_small_batches_of_sorted_segments(spark):
    rows = texts(2)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert collected(remove_repeats(df), *COLUMNS) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_kept_text_and_documents(documents):
    rows, frame = documents
    got = remove_repeats(frame, with_text=True)
    assert collected(got, *COLUMNS) == brute(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got.collect())


def test_odd_rows_and_empty_table(odd_rows):
    rows = [(r.doc_id, r.text) for r in odd_rows.collect()]
    assert collected(remove_repeats(odd_rows), *COLUMNS) == brute(rows)
    assert remove_repeats(empty_of(odd_rows)).collect() == []


def test_null_and_repeated_ids_of_different_texts(spark):
    """Rows that share an id but not the text are documents of their own: no crash, and no clean byte goes."""
    rng = random.Random(11)
    a, b, c = ("".join(rng.choice("abcdefgh ") for _ in range(300)) for _ in range(3))
    shared = a[100:250]
    rows = [(None, a), (None, b + shared), (None, shared + c), (None, a), (7, b), (7, c + b[:150]), (7, b),
            (1, a), (2, a), (2, c), (8, None), (8, ""), (8, c[:120] + shared)]
    # The order of the operator: id (null first), then the hash of the text.
    hashing = RollingHash()

    def twin(text):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        return int(suffix_dedup.twins(hashing, np.array([0, len(raw)]), raw)[0])
    places = sorted({(i is not None, i or 0, twin(t)) for i, t in rows})
    numbered = [(places.index((i is not None, i or 0, twin(t))), t) for i, t in rows]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r[x] for x in COLUMNS[1:]) for r in remove_repeats(frame).collect())
    assert got == sorted(r[1:] for r in brute(numbered))
    clean = [(1, a), (2, a), (2, c)]
    kept = {(r.doc_id, r.n_bytes, r.n_removed) for r in remove_repeats(
        spark.createDataFrame(clean, "doc_id long, text string")).collect()}
    assert kept == {(1, 300, 0), (2, 300, 300), (2, 300, 0)}
