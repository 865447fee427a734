"""Suffix arrays by induced sorting, and permuted common prefixes.

A suffix is smaller (S) or larger (L) than its right neighbour; the leftmost
S suffixes of runs (LMS) are sorted first. Their substrings are sorted by one
round of inducing, named, and the string of names is sorted by the same method
when names repeat. The order of all suffixes is then induced in two linear
scans. Over a byte alphabet a scan is done bucket by bucket on arrays;
strings of names, which have many symbols, are scanned entry by entry.
"""

from __future__ import annotations

import numpy as np

from marquee.llm.textbytes import ragged

SMALL_ALPHABET = 1 << 10


def is_smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is of type S; the last symbol is the unique least one."""
    n = len(text)
    same = np.where(text[:-1] == text[1:], n, np.arange(n - 1))
    nxt = np.minimum.accumulate(same[::-1])[::-1]
    out = np.ones(n, bool)
    out[:-1] = (text[:-1] < text[1:])[nxt]
    return out


def _place_lms(lms: np.ndarray, text: np.ndarray, ends: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Put the LMS suffixes, in the given order, at the ends of their buckets; returns how many each has."""
    symbols = text[lms]
    order = np.argsort(symbols, kind="stable")
    count = np.bincount(symbols, minlength=len(ends))
    place = np.repeat(ends - np.cumsum(count), count) + np.arange(len(lms))
    out[place] = lms[order]
    return count


def _induce_buckets(text, smaller, lms, starts, ends) -> np.ndarray:
    n = len(text)
    out = np.full(n, -1, np.int32)
    count = _place_lms(lms, text, ends, out)
    present = np.flatnonzero(ends > starts)
    head = starts.copy()

    def push(entries, kind, edge, sign):
        before = entries[entries > 0] - 1
        before = before[smaller[before] == kind]
        if len(before) == 0:
            return
        symbols = text[before]
        order = np.argsort(symbols, kind="stable")
        sizes = np.bincount(symbols, minlength=len(edge))
        rank = np.arange(len(before)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = edge[symbols[order]] + (rank if sign > 0 else -1 - rank)
        out[place] = before[order]
        edge += sign * sizes

    for c in present:
        done = starts[c]
        while done < head[c]:
            wave, done = out[done:head[c]], head[c]
            push(wave, False, head, 1)
        push(out[ends[c] - count[c]:ends[c]], False, head, 1)
    tail = ends.copy()
    for c in present[::-1]:
        done = ends[c]
        while done > tail[c]:
            wave, done = out[tail[c]:done][::-1], tail[c]
            push(wave, True, tail, -1)
        push(out[starts[c]:head[c]][::-1], True, tail, -1)
    out[0] = n - 1
    return out


def _induce_entries(text, smaller, lms, starts, ends) -> np.ndarray:
    out = np.full(len(text), -1, np.int64)
    _place_lms(lms, text, ends, out)
    entries, symbols, small = out.tolist(), text.tolist(), smaller.tolist()
    head = starts.tolist()
    for p in entries:  # the list grows filled ahead of the scan
        if p > 0 and not small[p - 1]:
            c = symbols[p - 1]
            entries[head[c]] = p - 1
            head[c] += 1
    tail = ends.tolist()
    for k in range(len(entries) - 1, -1, -1):
        p = entries[k]
        if p > 0 and small[p - 1]:
            c = symbols[p - 1]
            tail[c] -= 1
            entries[tail[c]] = p - 1
    entries[0] = len(symbols) - 1
    return np.array(entries, np.int64)


def suffix_array(text: np.ndarray, alphabet: int) -> np.ndarray:
    """Suffix starts in order, of symbols below ``alphabet`` that end in the unique least symbol 0."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    smaller = is_smaller(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    sizes = np.bincount(text, minlength=alphabet)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    induce = _induce_buckets if alphabet <= SMALL_ALPHABET else _induce_entries
    if len(lms) > 1:
        leftmost = np.zeros(n, bool)
        leftmost[lms] = True
        found = induce(text, smaller, lms, starts, ends)
        names, order = _names(text, lms, found[leftmost[found]])
        if names[-1] + 1 < len(lms):  # some substrings are equal: sort the string of names
            reduced = np.empty(n, np.int64)
            reduced[order] = names
            order = lms[suffix_array(reduced[lms], int(names[-1]) + 1)]
        lms = order
    return induce(text, smaller, lms, starts, ends)


def _names(text, lms, order) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the sorted LMS substrings (equal ones share a rank), and their order."""
    length = np.ones(len(text), np.int64)
    length[lms[:-1]] = np.diff(lms) + 1
    size = length[order]
    alike = np.flatnonzero(size[1:] == size[:-1])
    a, b, m = order[alike], order[alike + 1], size[alike]
    differs = text[ragged(a, m)] != text[ragged(b, m)]
    step = np.ones(len(order), np.int64)
    if len(m):
        step[alike + 1] = np.bitwise_or.reduceat(differs, np.cumsum(m) - m)
    step[0] = 0
    return np.cumsum(step), order


def permuted_common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each text position, the common prefix with the suffix before it in the suffix array.

    Only irreducible values are compared (those whose left symbols differ);
    a value next to the right of another is that value less one.
    """
    n = len(text)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    left = np.empty(n, text.dtype)
    left[0], left[1:] = -1, text[:-1]
    reducible = (before > 0) & (left == text[np.maximum(before - 1, 0)])
    reducible[0] = False
    at = np.flatnonzero(~reducible)
    at = at[before[at] >= 0]
    value = np.zeros(n, np.int64)
    step = 16
    windows = np.lib.stride_tricks.sliding_window_view(np.append(text, np.zeros(step, text.dtype)), step)
    for lo in range(0, len(at), 1 << 17):
        live = at[lo:lo + (1 << 17)]
        while len(live):
            differs = windows[live + value[live]] != windows[before[live] + value[live]]
            first = differs.argmax(axis=1)
            whole = ~differs[np.arange(len(live)), first]
            value[live] += np.where(whole, step, first)
            live = live[whole]
    source = np.maximum.accumulate(np.where(reducible, 0, np.arange(n)))
    return np.maximum(value[source] - (np.arange(n) - source), 0)
