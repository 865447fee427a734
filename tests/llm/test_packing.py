"""Packing: pieces against the tokenizers library, sequences gapless and full, the packer against a plain search."""

import random
import zlib

import numpy as np
import pytest

from llm.conftest import collected, empty_of
from marquee.llm import packing
from marquee.llm.packing import BestFit, best_fit_pack, pieces_of


@pytest.fixture(scope="module")
def path(vocabulary):
    return vocabulary("byte_bpe_50k.json")


def expected_pieces(rows, path):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    out = []
    for doc, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        out += [(doc, p, a, b - a, zlib.crc32(ids[a:b].tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return sorted(out, key=repr)


def check_sequences(rows):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(by)


COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32")


def test_pieces_and_sequences_of_documents(documents, path):
    rows, frame = documents
    got = best_fit_pack(frame, path).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=repr) == expected_pieces(rows, path)
    used = check_sequences(got)
    sizes = sorted(r.length for r in got)
    large = sum(s > 512 for s in sizes)
    assert used <= 1.02 * max(large, -(-sum(sizes) // 1024)) + 8


def test_odd_rows_and_empty_table(odd_rows, path):
    rows = [(r.doc_id, r.text) for r in odd_rows.collect()]
    got = best_fit_pack(odd_rows, path)
    assert collected(got, *COLUMNS) == expected_pieces(rows, path)
    check_sequences(got.collect())
    assert best_fit_pack(empty_of(odd_rows), path).collect() == []


QUOTED = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>'s", "x  <|endoftext|>  y", "it<|endoftext|>'ll go",
          "<|endoftext|", "|><|endoftext|>\n\n<|endo", "ftext|>", "é<|endoftext|>é", "<|<|endoftext|>|>"]


def test_quoted_added_tokens_are_the_librarys(spark, path):
    # Neighbours whose joined bytes look like an added token come one after the other.
    rows = [(k, t) for k, t in enumerate([*QUOTED, "<|endof", "text|>", "", *QUOTED[::-1]])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert collected(best_fit_pack(frame, path), *COLUMNS) == expected_pieces(rows, path)


def test_blocks_have_sequences_of_their_own(documents, path, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_PIECES", 50)
    spark = documents[1].sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        got = best_fit_pack(documents[1], path).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    check_sequences(got)
    assert len({(r.doc_id, r.piece) for r in got}) == len(got)


def plain_best_fit(items, size, most):
    bins, made, out = {}, 0, []
    for n in items:
        fits = [(room, b) for b, room in bins.items() if room >= n]
        if fits:
            room = min(fits)[0]
            b = max(x for r, x in fits if r == room)  # which of equal rooms does not matter for the count
        else:
            if len(bins) >= most:
                del bins[min((room, -b) for b, room in bins.items())[1] * -1]
            b, made = made, made + 1
            bins[b] = size
        out.append(size - bins[b])
        bins[b] -= n
        if not bins[b]:
            del bins[b]
    return made, out


@pytest.mark.parametrize("most", [1, 2, 5, 1000])
def test_packer_equals_plain_best_fit(most):
    rng = random.Random(most)
    for _ in range(30):
        items = [rng.randint(1, 40) for _ in range(rng.randint(0, 80))]
        bins = BestFit(40, most)
        places = [bins.place(n) for n in items]
        made, offsets = plain_best_fit(items, 40, most)
        assert bins.made == made and [o for _, o in places] == offsets
        assert bins.count <= most and bins.count == sum(map(len, bins.open))


def test_pieces_of():
    assert list(pieces_of(10, 4)) == [(0, 2), (2, 4), (6, 4)]
    assert list(pieces_of(8, 4)) == [(0, 4), (4, 4)] and list(pieces_of(1, 4)) == [(0, 1)]
