"""Byte-level BPE over whole slices of documents: split, look up, gather.

The split pattern of the byte-level vocabularies is evaluated on arrays of
code points instead of match by match, each pre-token is identified by a
64-bit hash, and its ids come from a direct-mapped cache of fixed size. Only
pre-tokens missing from the cache reach an encoder. A slice's ids are then one
gather from the cache's pool.

The strings of a vocabulary's added tokens (such as its end of text) are cut
out of a document before it is split, as the library does by default: each is
one pre-token, and what stands between them is split by itself.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import regex

from marquee.llm.textbytes import RollingHash, ragged

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
# The contractions that the split pattern takes first.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")

_classes: np.ndarray | None = None


def char_classes() -> np.ndarray:
    """The pattern's class of every code point, built once per process from the pattern's own classes."""
    global _classes
    if _classes is None:
        table = np.full(0x110000, OTHER, np.uint8)
        points = [*range(0xD800), *range(0xE000, 0x110000)]
        text = "".join(map(chr, points))
        for kind, pattern in ((SPACE, r"\p{White_Space}+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
            for m in regex.finditer(pattern, text):
                table[points[m.start()]:points[m.end() - 1] + 1] = kind
        table[0xD800:0xE000] = OTHER
        _classes = table
    return _classes


def token_starts(points: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Indices where a pre-token begins in concatenated documents.

    ``points`` are code points, ``doc_starts`` the index of each document's
    first one (and may repeat for empty documents). A run of white space gives
    its last character to what follows (a blank joins the next word); the rest
    of the run is one pre-token.
    """
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = char_classes()[points]
    first = np.zeros(n + 1, bool)
    first[doc_starts] = True
    first = first[:n]
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 255, kind[:-1]
    before[first] = 255
    after_blank = np.zeros(n, bool)
    after_blank[1:] = points[:-1] == 0x20
    after_blank &= ~first
    space = kind == SPACE
    starts = (before != kind) & ~(after_blank & ~space)
    last_of_run = space.copy()  # followed, in its document, by something that is no white space
    last_of_run[:-1] &= ~space[1:] & ~first[1:]
    last_of_run[-1] = False
    starts |= last_of_run | first
    quote = np.flatnonzero((points == 0x27) & (before != OTHER) & ~after_blank)
    if len(quote):
        doc_end = np.append(np.flatnonzero(first), n)
        ends = doc_end[np.searchsorted(doc_end, quote, side="right")]
        for form in CONTRACTIONS:
            size = len(form)
            fits = quote[quote + size <= ends]
            ends_fit = ends[quote + size <= ends]
            same = np.ones(len(fits), bool)
            for k, ch in enumerate(form[1:], 1):
                same &= points[fits + k] == ord(ch)
            starts[fits[same] + 1] = False
            nxt = fits[same] + size
            starts[nxt[nxt < ends_fit[same]]] = True
    return np.flatnonzero(starts)


def added_ranges(offsets: np.ndarray, raw: bytes, added: re.Pattern) -> np.ndarray:
    """``(start, end)`` of every match of ``added`` within a document of a slice, a row each."""
    if added.search(raw) is None:
        return np.zeros((0, 2), np.int64)
    # Document by document: bytes of two neighbours may look like a match.
    found = [m.span() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()) for m in added.finditer(raw, a, b)]
    return np.array(found, np.int64).reshape(-1, 2)


class SliceEncoder:
    """Encodes slices of documents with ``encode(pre-tokens as bytes) -> lists of ids``.

    ``added`` are the strings of added tokens: leftmost first, the longest of
    those that start together, each is handed to ``encode`` whole.

    The cache has ``2 ** bits`` slots; a pre-token whose slot is taken by
    another replaces it. Its pool of ids is emptied when it outgrows
    ``pool`` ids. Both bound the memory of a worker.
    """

    def __init__(self, encode: Callable[[Sequence[bytes]], Sequence[Sequence[int]]],
                 bits: int = 22, pool: int = 1 << 24, added: Sequence[bytes] = ()):
        self._encode, self._bits, self._most = encode, bits, pool
        longest_first = sorted(added, key=len, reverse=True)
        self._added = re.compile(b"|".join(map(re.escape, longest_first))) if added else None
        self._hash = RollingHash()
        self._clear()

    def _clear(self) -> None:
        self._key = np.zeros(1 << self._bits, np.uint64)
        self._at = np.zeros(1 << self._bits, np.int32)
        self._len = np.zeros(1 << self._bits, np.int32)
        self._pool = np.zeros(1 << 16, np.uint32)
        self._used = 0

    def _put(self, ids: np.ndarray) -> int:
        if self._used + len(ids) > len(self._pool):
            grown = np.zeros(2 * (self._used + len(ids)), np.uint32)
            grown[:self._used] = self._pool[:self._used]
            self._pool = grown
        at = self._used
        self._pool[at:at + len(ids)] = ids
        self._used += len(ids)
        return at

    def pre_tokens(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte starts of the pre-tokens of a slice (and the slice's end), and the number up to each document."""
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        raw = data.tobytes()
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        cuts = offsets[:-1]
        whole = np.zeros((0, 2), np.int64) if self._added is None else added_ranges(offsets, raw, self._added)
        if len(whole):
            cuts = np.concatenate([cuts, whole.ravel()])
        starts = lead[token_starts(points, np.searchsorted(lead, cuts))]
        if len(whole):
            of = np.searchsorted(whole[:, 0], starts, side="right") - 1
            inside = (of >= 0) & (starts > whole[of, 0]) & (starts < whole[of, 1])
            starts = starts[~inside]
        starts = np.append(starts, len(data)).astype(np.int64)
        return starts, np.searchsorted(starts[:-1], offsets)

    def __call__(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)``: the ids of all documents of a slice, and where each document's begin."""
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if self._used > self._most:
            self._clear()
        starts, of_doc = self.pre_tokens(offsets, data)
        begin, end = starts[:-1], starts[1:]
        keys = self._hash.ranges(self._hash.prefix(data), begin, end) | np.uint64(1)
        slot = (keys >> np.uint64(64 - self._bits)).astype(np.int64)
        at, size = self._at[slot].astype(np.int64), self._len[slot].astype(np.int64)
        miss = np.flatnonzero(self._key[slot] != keys)
        if len(miss):
            new, where, back = np.unique(keys[miss], return_index=True, return_inverse=True)
            raw = data.tobytes()
            lists = self._encode([raw[a:b] for a, b in zip(begin[miss[where]].tolist(),
                                                           end[miss[where]].tolist())])
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            base = self._put(np.fromiter((x for ids in lists for x in ids), np.uint32, int(sizes.sum())))
            places = base + np.cumsum(sizes) - sizes
            at[miss], size[miss] = places[back], sizes[back]
            own = slot[miss[where]]
            # The slot's key, place and length must come from one pre-token.
            own, pick = np.unique(own, return_index=True)
            self._key[own], self._at[own], self._len[own] = new[pick], places[pick], sizes[pick]
        ends = np.append(0, np.cumsum(size))
        return self._pool[ragged(at, size)], ends[of_doc]


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take the code
    points from 256 on, in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, after = {}, 256
    for byte in range(256):
        letters[byte] = chr(byte) if byte in plain else chr(after)
        after += byte not in plain
    return letters


def added_tokens(vocabulary: str) -> dict[bytes, int]:
    """The strings and ids of the tokens that a vocabulary file adds to its model.

    Only tokens that match as they stand are supported (no trimming, whole words or normalising).
    """
    with open(vocabulary, encoding="utf-8") as file:
        tokens = json.load(file).get("added_tokens") or []
    if any(t.get(flag) for t in tokens for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"added tokens of {vocabulary} do not match as they stand")
    return {t["content"].encode("utf-8"): t["id"] for t in tokens}


def model_encoder(vocabulary: str, added: Mapping[bytes, int] | None = None
                  ) -> Callable[[Sequence[bytes]], list[list[int]]]:
    """Pre-tokens to ids by the ``tokenizers`` library's model of a byte-level vocabulary file.

    ``added`` maps the pre-tokens that are added tokens to their ids; all others are ordinary text.
    """
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(vocabulary).model
    letters, added = byte_letters(), dict(added or {})

    def encode(words):
        return [[added[w]] if w in added else
                [t.id for t in model.tokenize(w.decode("latin-1").translate(letters))] for w in words]
    return encode


def library_encoder(vocabulary: str) -> SliceEncoder:
    """Slices to the ids that the library gives by default for the vocabulary file (without a template's tokens)."""
    added = added_tokens(vocabulary)
    return SliceEncoder(model_encoder(vocabulary, added), added=list(added))
