"""Best-fit packing of tokenised documents into sequences.

**Pieces.** A document's ids are those of the ``tokenizers`` library for the
given vocabulary file (the strings of its added tokens, such as an end of text
that a document quotes, are those tokens) plus one closing id. Documents of at most ``size`` ids
are one piece; longer ones are cut into pieces of ``size``, of which the first
may be shorter. Tokenising needs no shuffle, and only numbers leave it.

**Packing.** Piece rows (no text, no ids) are spread by a hash of the document
and every task packs its share: the longest first, each into the open bin with
the least free space that holds it. Open bins are kept in a bitset keyed by
free space, so the best fit is one bit scan. Their number is bounded: when
one more is needed, the fullest open bin is closed. A task's share is sorted
before it is cut into blocks (the sort spills), so a repeated task gives the
same sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.pretokens import library_encoder
from marquee.llm.textbytes import slices

SEQUENCE_TOKENS = 1024
CLOSING_ID = 2
OPEN_BINS = 1 << 16
# Pieces that a task sorts and packs at a time: bounds its memory.
BLOCK_PIECES = 1 << 20

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = PIECES + ", sequence_id bigint, offset bigint"


class BestFit:
    """Online best fit with a bounded number of open bins.

    ``free`` is a bitset: bit ``f`` says that some open bin has ``f`` free
    places. The lowest set bit at or above an item's size is its best fit; the
    lowest set bit of all belongs to the fullest bin, which closes first.
    """

    def __init__(self, size: int, most: int = OPEN_BINS):
        self.size, self.most = size, most
        self.free, self.open, self.count, self.made = 0, [[] for _ in range(size + 1)], 0, 0

    def place(self, length: int) -> tuple[int, int]:
        """``(bin, offset)`` of an item of ``length`` (1 to ``size``)."""
        fits = self.free >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            number = self._take(room)
        else:
            if self.count >= self.most:
                self._take((self.free & -self.free).bit_length() - 1)
            number, room = self.made, self.size
            self.made += 1
        left = room - length
        if left:
            self.open[left].append(number)
            self.free |= 1 << left
            self.count += 1
        return number, self.size - room

    def _take(self, room: int) -> int:
        number = self.open[room].pop()
        if not self.open[room]:
            self.free &= ~(1 << room)
        self.count -= 1
        return number


def pieces_of(n: int, size: int) -> Iterator[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` ids: a shorter first one, then full ones."""
    head = n % size
    if head:
        yield 0, head
    for start in range(head, n, size):
        yield start, size


def pieces(docs: DataFrame, vocabulary: str, size: int = SEQUENCE_TOKENS, closing: int = CLOSING_ID,
           id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece of every document (``PIECES``); a null or empty text is its closing id alone."""

    def run(batches):
        encoder = library_encoder(vocabulary)
        for batch in batches:
            keys, out = batch.column(0).to_pylist(), []
            for i, j, offsets, data in slices(batch.column(1)):
                ids, ends = encoder(offsets, data)
                for k in range(j - i):
                    own = np.append(ids[ends[k]:ends[k + 1]], closing).astype("<u4")
                    out += [(keys[i + k], p, s, n, zlib.crc32(own[s:s + n].tobytes()))
                            for p, (s, n) in enumerate(pieces_of(len(own), size))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5,
                                                (pa.int64(), pa.int32(), *[pa.int64()] * 3))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id).cast("bigint").alias("doc_id"),
                       F.col(text).alias("text")).mapInArrow(run, PIECES)


def pack(rows: DataFrame, size: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to piece rows; sequences are gapless from offset 0."""

    def packed(table: pa.Table, first: int) -> tuple[pa.Table, int]:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                               ("ids_crc32", "ascending")])
        bins = BestFit(size, open_bins)
        places = [bins.place(n) for n in table.column("length").to_pylist()]
        table = table.append_column("sequence_id", pa.array([first + b for b, _ in places], pa.int64()))
        return table.append_column("offset", pa.array([o for _, o in places], pa.int64())), bins.made

    def run(batches):
        first, held, n = TaskContext.get().partitionId() << 40, [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK_PIECES:
                table, made = packed(pa.Table.from_batches(held), first)
                yield from table.to_batches()
                first, held, n = first + made, [], 0
        if n:
            yield from packed(pa.Table.from_batches(held), first)[0].to_batches()

    # No number of partitions: AQE sizes the shares by their bytes, so few bins end half full.
    spread = rows.repartition(F.xxhash64("doc_id", "piece"))
    # Blocks are cut in this order, not in that of arrival; by hash, so that each has pieces of all lengths.
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    return spread.sortWithinPartitions(F.xxhash64(*columns), *columns).mapInArrow(run, PACKED)


def best_fit_pack(docs: DataFrame, vocabulary: str, size: int = SEQUENCE_TOKENS, closing: int = CLOSING_ID,
                  open_bins: int = OPEN_BINS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents with their place in a sequence (``PACKED``).

    Every row of the input is packed: a null id stays null, a repeated row is
    packed again, a null or empty text is a piece of one id, an empty table
    gives no rows. Other columns of the input are ignored.
    """
    return pack(pieces(docs, vocabulary, size, closing, id, text), size, open_bins)
