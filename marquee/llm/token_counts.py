"""Token counts of sections: whole documents are encoded once, tokens are attributed by their character spans.

Encoding sections one by one counts tokens that the whole document does not
have. Here every document is encoded whole, each token gets the span of
characters it covers (a token inside a character covers that character), and
the sorted spans are joined to the document's sorted sections. A token that
crosses a boundary goes to exactly one section, by one of ``RULES``:

* ``first``: the section of the first of its characters that lies in any section;
* ``last``: the section of the last such character;
* ``most``: the section with most of its characters, the earlier one on ties.

Tokens outside all sections are counted under section -1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.pretokens import added_tokens, library_encoder
from marquee.llm.textbytes import slices

RULES = ("first", "last", "most")
COUNTS = "doc_id bigint, section int, start bigint, end bigint, n_tokens bigint, n_crossing bigint"


def token_bytes(vocabulary: str) -> np.ndarray:
    """The number of bytes of every id of a byte-level vocabulary (one letter a byte; added tokens as they stand)."""
    from tokenizers import Tokenizer
    vocab = Tokenizer.from_file(vocabulary).get_vocab(with_added_tokens=False)
    sizes = {i: len(token) for token, i in vocab.items()} | {i: len(t) for t, i in added_tokens(vocabulary).items()}
    out = np.zeros(max(sizes) + 1, np.int64)
    for i, size in sizes.items():
        out[i] = size
    return out


def attribute(token_start: np.ndarray, token_end: np.ndarray, start: np.ndarray, end: np.ndarray,
              rule: str) -> tuple[np.ndarray, np.ndarray]:
    """``(section of each token or -1, whether it crosses a boundary)``.

    Interval join of spans sorted by start and sections that are sorted and do not overlap.
    """
    first = np.searchsorted(end, token_start, side="right")
    last = np.searchsorted(start, token_end, side="left") - 1
    inside = (first <= last) & (first < len(start))
    whole = inside & (first == last)
    whole[whole] &= (start[first[whole]] <= token_start[whole]) & (token_end[whole] <= end[first[whole]])
    crossing = inside & ~whole
    section = np.where(inside, last if rule == "last" else first, -1)
    if rule == "most":
        for k in np.flatnonzero(inside & (first < last)):
            a, b = first[k], last[k] + 1
            shared = np.minimum(end[a:b], token_end[k]) - np.maximum(start[a:b], token_start[k])
            section[k] = a + int(np.argmax(shared))
    return section, crossing


def token_counts(docs: DataFrame, vocabulary: str, rule: str = "first", sections: str | None = None,
                 id: str = "doc_id", text: str = "text") -> DataFrame:
    """``COUNTS``: one row per section of every document, and one for section -1 where it has tokens.

    ``sections`` names a column ``array<struct<start,end>>`` of character
    ranges, sorted and not overlapping (a field of a record that was joined
    into one text is such a range); without it the sections are the lines, each with the
    line feed that ends it. A null or empty text has its sections with no tokens (as lines:
    one empty section); null sections count as none; empty sections hold nothing; a
    null id stays null; repeated rows are counted again; an empty table gives
    no rows; other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}, not {rule!r}")

    def run(batches):
        encoder, sizes = library_encoder(vocabulary), token_bytes(vocabulary)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            given = batch.column(2).to_pylist() if sections is not None else None
            rows: list[list[np.ndarray]] = []
            for i, j, offsets, data in slices(batch.column(1)):
                ids, ends = encoder(offsets, data)
                # The character that each byte belongs to.
                char = np.cumsum((data & 0xC0) != 0x80) - 1
                byte_end = np.cumsum(sizes[ids])
                first = char[byte_end - sizes[ids]] if len(ids) else byte_end
                last = char[byte_end - 1] + 1 if len(ids) else byte_end
                doc_char = np.append(char, len(np.flatnonzero((data & 0xC0) != 0x80)))[offsets]
                feeds = char[data == 0x0A] + 1 if given is None else None
                for k in range(j - i):
                    base, stop = doc_char[k], doc_char[k + 1]
                    if given is None:
                        cuts = feeds[np.searchsorted(feeds, base, "right"):np.searchsorted(feeds, stop, "right")] - base
                        start, end = np.append(0, cuts), np.append(cuts, stop - base)
                    else:
                        pairs = given[i + k] or []
                        start = np.array([p["start"] for p in pairs], np.int64)
                        end = np.array([p["end"] for p in pairs], np.int64)
                    own = slice(ends[k], ends[k + 1])
                    full = np.flatnonzero(end > start)
                    at, crossing = attribute(first[own] - base, last[own] - base, start[full], end[full], rule)
                    at = np.append(full, -1)[at]
                    n = np.bincount(at + 1, minlength=len(start) + 1)
                    c = np.bincount(at + 1, weights=crossing, minlength=len(start) + 1).astype(np.int64)
                    skip = 0 if n[0] else 1
                    rows.append([np.full(len(n) - skip, i + k), np.arange(skip - 1, len(n) - 1),
                                 np.append(0, start)[skip:], np.append(0, end)[skip:], n[skip:], c[skip:]])
            columns = [np.concatenate(c) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 6
            who = pa.array(keys, pa.int64()).take(pa.array(columns[0], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [who, pa.array(columns[1].astype(np.int32)), *[pa.array(c.astype(np.int64)) for c in columns[2:]]],
                ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"])

    columns = [F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text")]
    if sections is not None:
        columns.append(F.col(sections).alias("sections"))
    return docs.select(*columns).mapInArrow(run, COUNTS)
