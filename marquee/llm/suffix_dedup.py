"""Removal of repeated passages: every byte covered by a window that also starts earlier.

A window is ``WINDOW`` bytes of one text. The steps are

1. **Anchors.** Each window is represented by the least hash of its
   ``GRAM``-byte strings (the leftmost on ties). Equal windows have equal
   anchors. The windows of one anchor are a segment of the text, some 40 bytes longer than a
   window. Only numbers leave the task; segments that repeat in a batch are settled there.
2. **Segments that repeat as a whole** are found by sorting on (anchor,
   segment hash, place): all but the first are covered. Anchors whose segments
   differ remain: the edges of passages and of edits. Only their first
   segments go on.
3. **Shard arrays.** The bytes of these segments meet by anchor. A shard's
   segments are laid in order of place, its suffix array is induced
   (:mod:`marquee.llm.suffix_array`) and permuted common prefixes of at least
   a window mark equal windows; all but the first of each run are covered.
4. **Hot anchors**, with more than ``ANCHOR_SEGMENTS`` different segments, are never
   gathered: the windows of their segments are grouped by 128-bit hash, with partial aggregation.
5. The covered ranges of a document are merged where its text is.

A document is an id and a text: rows that share an id (or have none) but not the text are told apart by a 64-bit hash
of the text, their ``twin``. Order is by id, then twin, then start; a null id comes first.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.suffix_array import permuted_common_prefixes, suffix_array
from marquee.llm.textbytes import RollingHash, mix64, ragged, slices
from marquee.llm.tiles import whole_groups
from marquee.plans.materialize import materialize

WINDOW = 100
GRAM = 24
ANCHOR_SEGMENTS = 4096
SHARD_BYTES = 1 << 22
CORE_STEP = 8
# One more than the largest place that a hash is tagged with.
_PLACES = 1 << 21
_NULL_ID = -(1 << 63)

SEGMENTS = "anchor bigint, segment bigint, doc_id bigint, twin bigint, start int, length int, settled boolean"
WHOLE, EDGE, HOT = 0, 1, 2


def id_order(id: str):
    """Ids as ordered numbers; a null is the least."""
    return F.coalesce(F.col(id).cast("bigint"), F.lit(_NULL_ID))


def twins(hashing: RollingHash, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """A hash of each text of a slice."""
    return hashing.ranges(hashing.prefix(data), offsets[:-1], offsets[1:]).view(np.int64)


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every ``width`` consecutive ones."""
    full = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    full[:len(values)] = values
    blocks = full.reshape(-1, width)
    up = np.minimum.accumulate(blocks, axis=1).ravel()
    down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(down[:n], up[width - 1:width - 1 + n])


def segments_of(hashing: RollingHash, offsets: np.ndarray, data: np.ndarray, window: int = WINDOW,
                gram: int = GRAM):
    """``(anchor, segment hash, start, end)`` arrays of a slice; starts and ends are places in the slice."""
    n, parts = len(data), []
    doc_end = offsets[np.searchsorted(offsets, np.arange(max(n - window + 1, 0)), side="right")]
    for base in range(0, max(n - window + 1, 0), _PLACES - 2 * window):
        part = data[base:base + _PLACES]
        prefix = hashing.prefix(part)
        place = np.arange(len(part) - gram + 1)
        grams = hashing.ranges(prefix, place, place + gram)
        tag = np.uint64(_PLACES - 1)
        tagged = (grams & ~tag) | place.astype(np.uint64)
        chosen = (least_in_windows(tagged, window - gram + 1) & tag).astype(np.int64)
        chosen = chosen[:_PLACES - 2 * window]
        inside = np.flatnonzero(np.arange(len(chosen)) + base + window <= doc_end[base:base + len(chosen)])
        if len(inside) == 0:
            continue
        anchor = chosen[inside]
        fresh = np.ones(len(inside), bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1] + 1)
        begin = np.flatnonzero(fresh)
        last = np.append(begin[1:], len(inside)) - 1
        start, end = inside[begin], inside[last] + window
        parts.append((grams[anchor[begin]], hashing.ranges(prefix, start, end), start + base, end + base))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*parts))


def segments(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``SEGMENTS`` of all documents. Within a batch only the first of equal segments keeps its anchor:
    the others are settled (covered) and spread by place."""

    def run(batches):
        hashing = RollingHash()
        for batch in batches:
            keys = batch.column(0).to_numpy()
            found = []
            for i, j, offsets, data in slices(batch.column(1)):
                anchor, segment, start, end = segments_of(hashing, offsets, data)
                doc = np.searchsorted(offsets, start, side="right") - 1
                found.append((anchor, segment, keys[i + doc], twins(hashing, offsets, data)[doc],
                              start - offsets[doc], end - start))
            if not found:
                continue
            anchor, segment, doc, twin, start, length = map(np.concatenate, zip(*found))
            order = np.lexsort((start, twin, doc, segment))
            anchor, segment, doc, twin, start, length = (x[order] for x in (anchor, segment, doc, twin, start, length))
            again = np.zeros(len(order), bool)
            again[1:] = (segment[1:] == segment[:-1]) & (anchor[1:] == anchor[:-1])
            head = np.maximum.accumulate(np.where(again, 0, np.arange(len(order))))
            # A repeated row is not an earlier one.
            own = again & (doc == doc[head]) & (twin == twin[head]) & (start == start[head])
            anchor = np.where(again, mix64(doc.view(np.uint64) ^ mix64(start.astype(np.uint64))), anchor)
            columns = [anchor.view(np.int64), segment.view(np.int64), doc, twin, start.astype(np.int32),
                       length.astype(np.int32), again]
            keep = ~own
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns],
                                             [f.split()[0] for f in SEGMENTS.split(", ")])

    return docs.select(id_order(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SEGMENTS)


def sort_out(found: DataFrame) -> DataFrame:
    """``(anchor, doc_id, twin, start, length, kind)`` from segments in order of anchor, segment and place.

    ``WHOLE``: covered, an equal segment is earlier. ``EDGE``: first of its
    kind under an anchor with others. ``HOT``: as ``EDGE``, with more others than a shard takes.
    State is one anchor's first segments, at most ``ANCHOR_SEGMENTS``.
    """

    def emit(rows, kind):
        n = len(rows[0])
        return pa.RecordBatch.from_arrays(
            [*map(pa.array, rows), pa.array(np.full(n, kind, np.int32))],
            ["anchor", "doc_id", "twin", "start", "length", "kind"])

    def run(batches):
        before = None           # anchor, segment, document, twin and start of the last first segment
        held, held_rows, hot = [], 0, False   # first segments of the current anchor

        def flush():
            nonlocal held, held_rows, hot
            rows = [np.concatenate(c) for c in zip(*held)] if held else None
            out = []
            if rows is not None and (hot or held_rows > 1):
                out = [emit(rows, HOT if hot or held_rows > ANCHOR_SEGMENTS else EDGE)]
            held, held_rows = [], 0
            return out

        for batch in batches:
            if batch.num_rows == 0:
                continue
            anchor, segment, doc, twin, start, length = (batch.column(k).to_numpy() for k in range(6))
            settled = batch.column(6).to_numpy(zero_copy_only=False)
            if settled.any():
                yield emit([x[settled] for x in (anchor, doc, twin, start, length)], WHOLE)
                open_ = ~settled
                anchor, segment, doc, twin, start, length = (
                    x[open_] for x in (anchor, segment, doc, twin, start, length))
                if len(anchor) == 0:
                    continue
            if before is None:
                before = (anchor[0], ~segment[0], 0, 0, 0)
            new_anchor = np.append(anchor[0] != before[0], anchor[1:] != anchor[:-1])
            first = new_anchor | np.append(segment[0] != before[1], segment[1:] != segment[:-1])
            head = np.maximum.accumulate(np.where(first, np.arange(len(first)), -1))
            head_doc = np.where(head < 0, before[2], doc[head])
            head_twin = np.where(head < 0, before[3], twin[head])
            head_start = np.where(head < 0, before[4], start[head])
            later = ~first & ((doc != head_doc) | (twin != head_twin) | (start != head_start))
            yield emit([x[later] for x in (anchor, doc, twin, start, length)], WHOLE)
            at = np.flatnonzero(first)
            if len(at):
                before = tuple(x[at[-1]] for x in (anchor, segment, doc, twin, start))
            cut = np.flatnonzero(new_anchor[at])
            # What continues the held anchor, the anchors that end here, and the one that may go on.
            bounds = np.concatenate([[0], cut, [len(at)]])
            rows = tuple(x[at] for x in (anchor, doc, twin, start, length))
            if bounds[1] > 0:
                held.append(tuple(c[:bounds[1]] for c in rows))
                held_rows += int(bounds[1])
            if len(cut):
                yield from flush()
                hot = False
                sizes = np.diff(bounds[1:])[:-1]
                if len(sizes):
                    size = np.repeat(sizes, sizes)
                    whole = tuple(c[cut[0]:cut[-1]] for c in rows)
                    for kind, pick in ((EDGE, (size > 1) & (size <= ANCHOR_SEGMENTS)), (HOT, size > ANCHOR_SEGMENTS)):
                        if pick.any():
                            yield emit(tuple(c[pick] for c in whole), kind)
                held.append(tuple(c[cut[-1]:] for c in rows))
                held_rows = len(at) - int(cut[-1])
            if held_rows > ANCHOR_SEGMENTS:
                hot = True
                yield from flush()
        yield from flush()

    order = ["anchor", "segment", "doc_id", "twin", "start"]
    return found.repartition("anchor").sortWithinPartitions(*order).mapInArrow(
        run, "anchor bigint, doc_id bigint, twin bigint, start int, length int, kind int")


def packed_texts(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``(doc_id, twin, packed)``: compressed texts, so that a join moves less."""

    def run(batches):
        hashing, packer = RollingHash(), zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            own = [twins(hashing, offsets, data) for _, _, offsets, data in slices(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(own) if own else [], pa.int64()),
                 pa.array([packer.compress(t or b"") for t in texts], pa.binary())], ["doc_id", "twin", "packed"])

    return docs.select(id_order(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id bigint, twin bigint, packed binary")


PIECES = "kind int, anchor bigint, other bigint, doc_id bigint, twin bigint, start int, bytes binary"


def pieces(joined: DataFrame) -> DataFrame:
    """``PIECES``: the bytes of edge segments under their anchor, and the windows of hot ones under their hashes."""

    def run(batches):
        hashing, unpacker = RollingHash(), zstandard.ZstdDecompressor()
        for batch in batches:
            edge, hot = [], []
            for doc, twin, blob, spans in zip(*(batch.column(k).to_pylist() for k in range(4))):
                text = unpacker.decompress(blob)
                flip = np.frombuffer(text, np.uint8)
                for s in spans:
                    a, b = s["start"], s["start"] + s["length"]
                    if s["kind"] == EDGE:
                        edge.append((s["anchor"], doc, twin, a, text[a:b]))
                        continue
                    at = np.arange(b - a - WINDOW + 1)
                    one, two = (hashing.ranges(hashing.prefix(x), at, at + WINDOW).view(np.int64)
                                for x in (flip[a:b], 255 - flip[a:b]))
                    hot.append((one, two, np.full(len(at), doc), np.full(len(at), twin), (a + at).astype(np.int32)))
            if edge:
                anchor, doc, twin, start, data = zip(*edge)
                n = len(edge)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, EDGE, np.int32)), pa.array(anchor, pa.int64()), pa.nulls(n, pa.int64()),
                     pa.array(doc, pa.int64()), pa.array(twin, pa.int64()), pa.array(start, pa.int32()),
                     pa.array(data, pa.binary())],
                    [f.split()[0] for f in PIECES.split(", ")])
            if hot:
                one, two, doc, twin, start = map(np.concatenate, zip(*hot))
                n = len(one)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, HOT, np.int32)), pa.array(one), pa.array(two), pa.array(doc), pa.array(twin),
                     pa.array(start), pa.nulls(n, pa.binary())], [f.split()[0] for f in PIECES.split(", ")])

    return joined.select("doc_id", "twin", "packed", "spans").mapInArrow(run, PIECES)


def able_ranges(hashing: RollingHash, anchor: np.ndarray, data: list[bytes], window: int = WINDOW,
                gram: int = GRAM, step: int = CORE_STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(segment, start, end)``: the parts of a shard's segments whose windows can have an equal one.

    The windows of a segment are taken ``step`` at a time by their distance to
    the anchor. Such a few share a core of nearly a window; equal windows are at the same
    distance and share the core. Where no other segment has that core, no window is equal to another.
    """
    size = np.fromiter(map(len, data), np.int64, len(data))
    begin = np.cumsum(size) - size
    flat = np.frombuffer(b"".join(data), np.uint8)
    owner = np.repeat(np.arange(len(data)), size)
    prefix = hashing.prefix(flat)
    place = np.arange(len(flat) - gram + 1)
    here = np.flatnonzero((hashing.ranges(prefix, place, place + gram) == anchor.view(np.uint64)[owner[place]])
                          & (place + gram <= (begin + size)[owner[place]]))
    _, first = np.unique(owner[here], return_index=True)
    at = here[first] - begin  # the anchor is its gram's first place in the segment
    far, near = at // step, np.maximum(at - (size - window), 0) // step
    count = far - near + 1
    who = np.repeat(np.arange(len(data)), count)
    block = ragged(near, count)
    # The core lies in every window of the block, so it lies in the segment.
    core = begin[who] + at[who] - step * block
    key = mix64(hashing.ranges(prefix, core, core + window - step + 1)
                ^ mix64(anchor.view(np.uint64)[who] + block.astype(np.uint64)))
    _, back, often = np.unique(key, return_inverse=True, return_counts=True)
    able = often[back] > 1
    who, block = who[able], block[able]
    if len(who) == 0:
        return who, who, who
    fresh = np.append(True, (who[1:] != who[:-1]) | (block[1:] != block[:-1] + 1))
    one = np.flatnonzero(fresh)
    last = np.append(one[1:], len(who)) - 1
    own = who[one]
    return (own, np.maximum(at[own] - step * block[last] - step + 1, 0),
            np.minimum(at[own] - step * block[one] + window, size[own]))


def shard_repeats(doc: np.ndarray, start: np.ndarray, data: list[bytes], window: int = WINDOW):
    """``(doc, start, end)`` of the ranges of a shard's segments that are covered by earlier equal windows."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order].astype(np.int64)
    data = [data[k] for k in order]
    # Bytes become 1 to 256; each segment ends in 257, the shard in the least symbol.
    size = np.fromiter(map(len, data), np.int64, len(data))
    text = np.full(int(size.sum()) + len(data) + 1, 257, np.int16)
    text[-1] = 0
    begin = np.cumsum(size + 1) - size - 1
    text[ragged(begin, size)] = np.frombuffer(b"".join(data), np.uint8).astype(np.int16) + 1
    order = np.asarray(suffix_array(text, 258), np.int64)
    common = permuted_common_prefixes(text, order)
    owner = np.repeat(np.arange(len(data)), size + 1)
    left = np.append((begin + size)[owner] - np.arange(len(owner)), 0)
    close = (common[order] >= window) & (left[order] >= window)
    close[0] = False
    close[1:] &= left[order[:-1]] >= window
    group = np.cumsum(~close)
    member = close.copy()
    member[:-1] |= close[1:]
    at, group = order[member], group[member]
    if len(at) == 0:
        return doc[:0], start[:0], start[:0]
    least = np.minimum.reduceat(at, np.flatnonzero(np.append(True, group[1:] != group[:-1])))
    covered = np.setdiff1d(at, least)
    fresh = np.append(True, (covered[1:] != covered[:-1] + 1) | (owner[covered[1:]] != owner[covered[:-1]]))
    if len(covered) == 0:
        return doc[:0], start[:0], start[:0]
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(covered)) - 1
    own = owner[covered[first]]
    place = start[own] - begin[own]
    # A repeated row's windows are at the very place of the first: not earlier.
    return doc[own], covered[first] + place, covered[last] + place + window


def shards(edges: DataFrame) -> DataFrame:
    """``(doc_id, twin, start, end)`` of the covered ranges of edge segments, shard by shard of whole anchors."""

    def solve(held):
        anchor, doc, twin, start = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in range(4))
        data = [x for b in held for x in b.column(4).to_pylist()]
        # Equal rows have sent the same segments: sorted, each is next to its like.
        once = np.ones(len(doc), bool)
        once[1:] = ((anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (twin[1:] != twin[:-1])
                    | (start[1:] != start[:-1]))
        anchor, doc, twin, start = (x[once] for x in (anchor, doc, twin, start))
        data = [data[k] for k in np.flatnonzero(once).tolist()]
        # Documents by their place in the order of ids and twins.
        order = np.lexsort((twin, doc))
        fresh = np.append(True, (doc[order][1:] != doc[order][:-1]) | (twin[order][1:] != twin[order][:-1]))
        place = np.empty(len(doc), np.int64)
        place[order] = np.cumsum(fresh) - 1
        docs, hashes = doc[order][fresh], twin[order][fresh]
        own, low, high = able_ranges(RollingHash(), anchor, data)
        data = [data[k][a:b] for k, a, b in zip(own.tolist(), low.tolist(), high.tolist())]
        a, b, c = shard_repeats(place[own], start[own] + low, data)
        return pa.RecordBatch.from_arrays(
            [pa.array(docs[a]), pa.array(hashes[a]), pa.array(b.astype(np.int32)), pa.array(c.astype(np.int32))],
            ["doc_id", "twin", "start", "end"])

    def run(batches):
        held, size = [], 0
        for batch, ends in whole_groups(batches, 1):
            weight = np.append(0, np.cumsum(pc.binary_length(batch.column(4)).to_numpy()))
            at = 0
            for end in ends[1:].tolist():
                if size + weight[end] - weight[at] >= SHARD_BYTES:
                    held.append(batch.slice(at, end - at))
                    yield solve(held)
                    held, size, at = [], 0, end
            if at < batch.num_rows:
                held.append(batch.slice(at))
                size += int(weight[-1] - weight[at])
        if held:
            yield solve(held)

    rows = edges.select("anchor", "doc_id", "twin", "start", "bytes")
    return rows.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "twin", "start").mapInArrow(
        run, "doc_id bigint, twin bigint, start int, end int")


def hot_repeats(hot: DataFrame) -> DataFrame:
    """``(doc_id, twin, start, end)`` of windows, known by their hashes, of which an earlier one exists."""
    place = F.struct("doc_id", "twin", "start")
    least = hot.groupBy("anchor", "other").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("n"))
    least = least.filter("n > 1").select(F.col("anchor").alias("a"), F.col("other").alias("o"), "least")
    later = hot.join(least, (hot.anchor == least.a) & (hot.other == least.o)).filter(place != F.col("least"))
    return later.select("doc_id", "twin", "start", (F.col("start") + WINDOW).alias("end"))


def merged(spans: list, n: int) -> list[tuple[int, int]]:
    """Maximal runs of the union of ranges, within ``[0, n)``."""
    out: list[list[int]] = []
    for a, b in sorted((s["start"], min(s["end"], n)) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        elif b > a:
            out.append([a, b])
    return [(a, b) for a, b in out]


KEPT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """``KEPT`` of every document (and the kept bytes as ``kept`` on request): repeated passages removed.

    A byte goes if some window of ``WINDOW`` bytes that covers it also starts
    earlier, in a document of smaller id or earlier in its own; windows are
    taken from the input, not from what is left. A null or empty text has
    nothing to remove; a text shorter than a window stays whole; a null id is
    the least and stays null. Equal rows (id and text) are one document: a repeated row is
    reported again and is no earlier copy of itself. Rows of one id, or of none, with different texts are different
    documents, the one with the lesser hash first. An empty table gives no rows; other columns
    are ignored, whatever their names.
    """
    rows = materialize(sort_out(segments(docs, id, text)), "segments")
    spans = rows.filter(F.col("kind") != WHOLE).groupBy(F.col("doc_id").alias("d"), F.col("twin").alias("w")).agg(
        F.collect_list(F.struct("start", "length", "kind", "anchor")).alias("spans"))
    texts = packed_texts(docs, id, text)
    same = (F.col("doc_id") == F.col("d")) & (F.col("twin") == F.col("w"))
    parts = materialize(pieces(texts.join(spans, same)), "pieces")
    edge = parts.filter(F.col("kind") == EDGE)
    hot = parts.filter(F.col("kind") == HOT).select("anchor", "other", "doc_id", "twin", "start")
    covered = rows.filter(F.col("kind") == WHOLE).select(
        "doc_id", "twin", "start", (F.col("start") + F.col("length")).alias("end"))
    covered = covered.union(shards(edge)).union(hot_repeats(hot))
    per_doc = covered.groupBy(F.col("doc_id").alias("d"), F.col("twin").alias("w")).agg(
        F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = texts.join(per_doc, same, "left").select("doc_id", "packed", "spans")

    def run(batches):
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for doc, blob, found in zip(*(batch.column(k).to_pylist() for k in range(3))):
                whole = unpacker.decompress(blob)
                gone = merged(found or [], len(whole))
                cuts = [0, *(x for run_ in gone for x in run_), len(whole)]
                kept = b"".join(whole[a:b] for a, b in zip(cuts[::2], cuts[1::2]))
                out.append((None if doc == _NULL_ID else doc, len(whole), len(whole) - len(kept), len(gone),
                            hashlib.sha256(kept).hexdigest(), kept)[:5 + with_text])
            types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            names = [f.split()[0] for f in KEPT.split(", ")] + ["kept"]
            columns = zip(*out) if out else [()] * (5 + with_text)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names[:5 + with_text])

    return joined.mapInArrow(run, KEPT + (", kept binary" if with_text else ""))
