"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a byte string exactly one token can end its encoding: the
token ``t`` at its end for which the last token of the shorter prefix and
``t`` stay apart when their bytes are merged. Keeping that token per prefix

* encodes a string from left to right, one table entry per byte;
* makes appends exact: entries of old prefixes never change;
* re-encodes near an edit only: after the edit the table is recomputed until
  as many entries as the longest token has bytes equal the old ones; from
  there on nothing can differ.

Ids are merge ranks, so the rank of the merge that forms a token is its id.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.pretokens import SliceEncoder
from marquee.llm.textbytes import ragged, slices

_CACHED_PAIRS = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PrefixBpe:
    """The vocabulary: which token forms from which two, and which tokens can be neighbours."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        self.parts: list[tuple[int, int] | None] = [None] * len(self.bytes_of)
        self.merged: dict[tuple[int, int], int] = {}
        self.known: dict[tuple[int, int], bool] = {}
        self.usable: dict[bytes, int] = {}
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
            if len(token) == 1:
                self.usable[token] = rank
                continue
            parts = self._parts(token, rank)
            if parts is not None:  # else no merges lead to it
                self.usable[token] = rank
                self.parts[rank] = parts
                self.merged[parts] = rank

    def _parts(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens that merge into ``token``: its encoding by lower ranks."""
        ids = [token[k:k + 1] for k in range(len(token))]
        while len(ids) > 2:
            best, at = rank, -1
            for k in range(len(ids) - 1):
                r = self.ranks.get(ids[k] + ids[k + 1], rank)
                if r < best:
                    best, at = r, k
            if at < 0:
                return None
            ids[at:at + 2] = [ids[at] + ids[at + 1]]
        return self.ranks[ids[0]], self.ranks[ids[1]]

    def apart(self, left: int, right: int) -> bool:
        """Whether the two tokens' bytes together encode to just these tokens.

        Undoes the merges next to the border, the latest first (of equal
        ranks the right one, as merges run from left to right), and looks for
        a merge over the border that would have come earlier.
        """
        key = (left, right)
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= _CACHED_PAIRS:
                self.known.clear()
            found = self.known[key] = self._apart(left, right)
        return found

    def _apart(self, left: int, right: int) -> bool:
        before = len(self.bytes_of)  # merges of lower rank came first
        while True:
            over = self.merged.get((left, right))
            if over is not None and over < before:
                return False
            undo_left, undo_right = self.parts[left], self.parts[right]
            if undo_left is not None and (undo_right is None or left > right):
                before, left = left, undo_left[1]
            elif undo_right is not None:
                before, right = right + 1, undo_right[0]
            else:
                return True

    def extend(self, data: bytes, last: list[int], upto: int) -> None:
        """Append to ``last`` (entry ``i``: the last token of prefix ``i + 1``) until it has ``upto`` entries."""
        usable, apart, longest = self.usable, self.apart, self.longest
        for end in range(len(last) + 1, upto + 1):
            for start in range(max(0, end - longest), end):
                token = usable.get(data[start:end])
                if token is not None and (start == 0 or apart(last[start - 1], token)):
                    last.append(token)
                    break

    def ids(self, last: list[int]) -> list[int]:
        """The encoding that a table of last tokens stands for."""
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.bytes_of[last[end - 1]])
        return out[::-1]

    def encode(self, data: bytes) -> list[int]:
        """Ids of one pre-token; one that is a token is that token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        last: list[int] = []
        self.extend(data, last, len(data))
        return self.ids(last)

    def decode(self, ids) -> bytes:
        return b"".join(self.bytes_of[i] for i in ids)


class PrefixTable:
    """The last token of every prefix of a growing, editable byte string (one pre-token)."""

    def __init__(self, bpe: PrefixBpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.bpe.extend(self.data, self.last, len(self.data))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of ``[start, end)``; returns how many entries were computed anew."""
        tail = self.last[end:]
        self.data = self.data[:start] + new + self.data[end:]
        last = self.last[:start]
        same, at = 0, start + len(new)
        self.bpe.extend(self.data, last, at)
        while len(last) < len(self.data) and same < self.bpe.longest:
            self.bpe.extend(self.data, last, len(last) + 1)
            same = same + 1 if last[-1] == tail[len(last) - 1 - at] else 0
        computed = len(last) - start
        self.last = last + tail[len(last) - at:]
        return computed

    def ids(self, upto: int | None = None) -> list[int]:
        """Ids of the whole string or of any prefix."""
        return self.bpe.ids(self.last if upto is None else self.last[:upto])


def _pool(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    return np.frombuffer(b"".join(values), np.uint8), np.cumsum(sizes) - sizes, sizes


ENCODED = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, ranks_path: str, id: str = "doc_id", text: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode its ids again (``ENCODED``; ``ids array<int>`` on request).

    The digests are those of the decimal ids joined by one blank and of the
    decoded bytes. A null or empty text has no ids; a null id stays null;
    repeated rows are encoded again; an empty table gives no rows; other
    columns are ignored.
    """

    def run(batches):
        bpe = PrefixBpe(read_ranks(ranks_path))
        encoder = SliceEncoder(lambda words: list(map(bpe.encode, words)))
        digits, digit_at, digit_n = _pool([b"%d " % i for i in range(len(bpe.bytes_of))])
        raw, raw_at, raw_n = _pool(bpe.bytes_of)

        def digests(pool, at, size, ids, ends, cut):
            data = pool[ragged(at[ids], size[ids])].tobytes()
            places = np.append(0, np.cumsum(size[ids]))[ends].tolist()
            return [hashlib.sha256(data[a:max(a, b - cut)]).hexdigest() for a, b in zip(places, places[1:])]

        for batch in batches:
            count, spelt, decoded, lists = [], [], [], []
            for _, _, offsets, data in slices(batch.column(1)):
                ids, ends = encoder(offsets, data)
                count += np.diff(ends).tolist()
                spelt += digests(digits, digit_at, digit_n, ids, ends, 1)
                decoded += digests(raw, raw_at, raw_n, ids, ends, 0)
                if with_ids:
                    lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32))))
            columns = [batch.column(0), pa.array(count, pa.int64()), pa.array(spelt, pa.string()),
                       pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = ENCODED + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, ranks_path: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(doc_id, text)`` of rows holding ids; null ids decode to null, invalid UTF-8 is replaced."""

    def run(batches):
        tokens = [b""] * 0
        for batch in batches:
            if not tokens:
                ranks = read_ranks(ranks_path)
                tokens = [b""] * (max(ranks.values()) + 1)
                for token, rank in ranks.items():
                    tokens[rank] = token
            texts = [None if x is None else b"".join(tokens[i] for i in x).decode("utf-8", "replace")
                     for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(id).cast("bigint").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(
        run, "doc_id bigint, text string")
