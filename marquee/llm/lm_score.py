"""Language-model scores: quantised bigram counts in a log-frequency Bloom filter, unigram counts exactly.

1. **Blocks.** A task cuts its documents into blocks of some ``BLOCK_BYTES`` of text and writes each as one row: word numbers
   within the block, and the sorted hashes of its words. Texts are read once.
2. **Counts by bucket.** A block sends its words, each once with its count, to buckets of the hash
   range: one row a bucket, hashes as byte planes of their differences, compressed. A bucket gets at most some
   ``BUCKET_KEYS`` hashes, so a very common word is one entry a block. It adds up the counts and answers every block.
3. **The filter.** Bigrams of the training documents are added up in the same way, and what a bucket sends on is
   its part of a log-frequency Bloom filter: a bigram of count ``c`` is inserted with each level from 1 to
   ``1 + floor(log2(c))``, ``HASHES`` bits a level. A part has ``ENTRY_BITS`` bits an insertion.
4. **Scores.** Parts of at most ``FILTER_BYTES`` together are broadcast, one such group after the other, each with a pass over
   the blocks: a bigram is probed level by level until one is missing. The probability of a word is

       (count of the bigram + PRIOR * (c(word) + 1) / (N + V + 1)) / (c(word before) + PRIOR)

   where the count is the middle of its level, at most the count of either word, and the word before the first is the end of a text.
   Logarithms add up over tokens, documents and groups.

What is gathered grows with the text; what is broadcast never exceeds ``FILTER_BYTES`` (or one bucket's part). A larger
corpus takes more groups, hence passes: a cluster with room should raise the bound.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.minhash import word_hashes
from marquee.llm.textbytes import RollingHash, mix64, slices
from marquee.llm.tiles import whole_groups
from marquee.plans.materialize import materialize, remove_tables

BLOCK_BYTES = 1 << 22
BUCKET_KEYS = 1 << 22
FILTER_BYTES = 1 << 26
HASHES, ENTRY_BITS = 6, 9
# With these an absent level is taken for present once in some 70 probes.
PRIOR = 100.0
FOLDS, HELD_FOLD = 7, 2

# The hash of the token that ends every text.
END = np.uint64(0xE5D0F7E47)


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(blob: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending 64-bit numbers, as their differences."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob, np.uint64), dtype=np.uint64)


def bucket_of(keys: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """The bucket of hashes of ``bits`` bits; ascending hashes are in ascending buckets."""
    return ((keys >> np.uint64(bits - 32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


BIGRAM_BITS = 48


def bigram_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    """48-bit hashes of pairs of words."""
    with np.errstate(over="ignore"):
        return mix64(before * np.uint64(0x9E3779B97F4A7C15) ^ words) >> np.uint64(64 - BIGRAM_BITS)


BLOCKS = ("block bigint, ids array<bigint>, held array<boolean>, ends array<bigint>, codes binary, keys binary, "
          "counts binary, n_keys bigint, n_bigrams bigint, n_train bigint")


def is_held(doc_id: int | None, folds: int = FOLDS, fold: int = HELD_FOLD) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == fold


def blocks(docs: DataFrame, id: str, text: str, folds: int, fold: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``BLOCKS``: the documents as numbers of words; ``counts`` are those of the words in training documents.

    ``block`` is added by the caller. A text of more than ``block_bytes`` is a block of its own.
    """

    def run(batches):
        hashing = RollingHash()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, j, offsets, data in slices(batch.column(1), block_bytes):
                words, ends = word_hashes(hashing, offsets, data)
                held = np.array([is_held(d, folds, fold) for d in ids[i:j]])
                tokens = np.insert(words, ends[1:], END)
                ends = ends[1:] + np.arange(1, j - i + 1)
                keys, codes = np.unique(tokens, return_inverse=True)
                train = np.repeat(~held, np.diff(ends, prepend=0))
                counts = np.bincount(codes[train], minlength=len(keys)).astype(np.uint32)
                pairs = _pairs(keys, codes, ends)[train]
                row = [ids[i:j], held.tolist(), ends, packed(codes.astype(np.uint32)), packed_keys(keys),
                       packed(counts), len(keys), len(np.unique(pairs)), int(counts.sum())]
                kinds = [pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), *[pa.binary()] * 3,
                         *[pa.int64()] * 3]
                names = [f.split()[0] for f in BLOCKS.split(", ")][1:]
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, kinds)], names)

    return docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, BLOCKS.split(", ", 1)[1])


def _pairs(keys: np.ndarray, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bigram that each token closes; the first token of a text follows an end."""
    words = keys[codes]
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[np.append(0, ends[:-1])] = END
    return bigram_keys(before, words)


SENT = "bucket int, block bigint, keys binary, counts binary"


def _sent(block: int, keys: np.ndarray, counts: np.ndarray, buckets: int, bits: int) -> pa.RecordBatch:
    """A block's ascending keys as one row for each bucket."""
    own = bucket_of(keys, buckets, bits)
    there, first = np.unique(own, return_index=True)
    cuts = [*first.tolist(), len(keys)]
    parts = list(zip(cuts, cuts[1:]))
    return pa.RecordBatch.from_arrays(
        [pa.array(there, pa.int32()), pa.array(np.full(len(there), block), pa.int64()),
         pa.array([packed_keys(keys[a:b]) for a, b in parts], pa.binary()),
         pa.array([packed(counts[a:b]) for a, b in parts], pa.binary())], [f.split()[0] for f in SENT.split(", ")])


def by_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "block")


def words_sent(table: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for block, keys, counts in zip(*(batch.column(k).to_pylist() for k in range(3))):
                yield _sent(block, unpacked_keys(keys), unpacked(counts, np.uint32), buckets, 64)

    return table.select("block", "keys", "counts").mapInArrow(run, SENT)


def bigrams_sent(table: DataFrame, buckets: int) -> DataFrame:
    """The bigrams of the training documents of each block."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                block, held, ends, codes, keys = (batch.column(c)[k].as_py() for c in range(5))
                codes, ends = unpacked(codes, np.uint32), np.array(ends, np.int64)
                pairs = _pairs(unpacked_keys(keys), codes, ends)
                train = np.repeat(~np.array(held), np.diff(ends, prepend=0))
                found, counts = np.unique(pairs[train], return_counts=True)
                if len(found):
                    yield _sent(block, found, counts.astype(np.uint32), buckets, BIGRAM_BITS)

    return table.select("block", "held", "ends", "codes", "keys").mapInArrow(run, SENT)


def _summed(batch: pa.RecordBatch, at: int, end: int):
    """The distinct keys of a bucket's rows, their counts, and each row's places among them."""
    keys = [unpacked_keys(batch.column(2)[k].as_py()) for k in range(at, end)]
    counts = np.concatenate([unpacked(batch.column(3)[k].as_py(), np.uint32) for k in range(at, end)])
    sizes = [len(k) for k in keys]
    found, back = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(back, weights=counts, minlength=len(found)).astype(np.int64), np.split(back, np.cumsum(sizes)[:-1])


ANSWERS = "block bigint, bucket int, totals binary, known bigint"


def answers(sent: DataFrame, buckets: int) -> DataFrame:
    """``ANSWERS``: the corpus counts of each row's keys; a row without block has the bucket's number of known words."""

    def run(batches):
        for batch, ends in whole_groups(batches, 1):
            for at, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
                found, totals, places = _summed(batch, at, end)
                bucket = batch.column(0)[at].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*batch.column(1).slice(at, end - at).to_pylist(), None], pa.int64()),
                     pa.array([bucket] * (end - at + 1), pa.int32()),
                     pa.array([*(packed(totals[p].astype(np.uint64)) for p in places), None], pa.binary()),
                     pa.array([None] * (end - at) + [int((totals > 0).sum())], pa.int64())],
                    [f.split()[0] for f in ANSWERS.split(", ")])

    return by_bucket(sent, buckets).mapInArrow(run, ANSWERS)


def levels_of(counts: np.ndarray) -> np.ndarray:
    """``1 + floor(log2(count))``, exactly."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def middle(levels: np.ndarray) -> np.ndarray:
    """The mean of the counts of a level; 0 for level 0."""
    low = np.exp2(levels.astype(np.float64) - 1)
    return np.where(levels > 0, (3 * low - 1) / 2, 0.0)


def places(keys: np.ndarray, level: int | np.ndarray, size: np.ndarray | np.uint64) -> np.ndarray:
    """The ``HASHES`` bits of each key at a level, among ``size`` bits (a row each)."""
    with np.errstate(over="ignore"):
        h = mix64(keys ^ (np.asarray(level).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)))
        step = (h >> np.uint64(32)) | np.uint64(1)
        return ((h & np.uint64(0xFFFFFFFF))[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) % np.reshape(size, (-1, 1))


def filled(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The filter's part that holds these keys, as bytes."""
    levels = levels_of(counts)
    bits = -(-max(64, ENTRY_BITS * int(levels.sum())) // 8) * 8
    out = np.zeros(bits // 8, np.uint8)
    for level in range(1, int(levels.max(initial=0)) + 1):
        own = keys[levels >= level]
        for at in range(0, len(own), 1 << 18):
            spots = places(own[at:at + (1 << 18)], level, np.uint64(bits)).ravel()
            np.bitwise_or.at(out, (spots >> np.uint64(3)).astype(np.int64), np.uint8(1) << (spots & np.uint64(7)).astype(np.uint8))
    return out


PARTS = "bucket int, bits binary, size bigint"


def parts(sent: DataFrame, buckets: int) -> DataFrame:
    """``PARTS``: each bucket's part of the filter."""

    def run(batches):
        for batch, ends in whole_groups(batches, 1):
            for at, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
                found, totals, _ = _summed(batch, at, end)
                bits = filled(found, totals).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[at].as_py()], pa.int32()), pa.array([bits], pa.binary()),
                     pa.array([len(bits)], pa.int64())], [f.split()[0] for f in PARTS.split(", ")])

    return by_bucket(sent, buckets).mapInArrow(run, PARTS)


class Filter:
    """Consecutive parts of the filter: buckets ``first`` to ``last``."""

    def __init__(self, rows, buckets: int):
        rows = sorted(rows, key=lambda r: r.bucket)
        self.buckets, self.first, self.last = buckets, rows[0].bucket, rows[-1].bucket
        size = np.zeros(self.last - self.first + 1, np.int64)
        for r in rows:
            size[r.bucket - self.first] = len(r.bits)
        self.start, self.size = np.cumsum(size) - size, size
        self.bits = np.frombuffer(b"".join(bytes(r.bits) for r in rows), np.uint8)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key (0: absent): the levels are probed one after the other until one is missing."""
        part = bucket_of(keys, self.buckets, BIGRAM_BITS) - self.first
        out, left = np.zeros(len(keys), np.int64), np.flatnonzero(self.size[part] > 0)
        level = 1
        while len(left):
            own = part[left]
            spots = places(keys[left], level, (8 * self.size[own]).astype(np.uint64))
            at = self.start[own][:, None] + (spots >> np.uint64(3)).astype(np.int64)
            there = ((self.bits[at] >> (spots & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)
            left = left[there]
            out[left] = level
            level += 1
        return out


SCORED = ("block bigint, place int, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, "
          "score double")


def scored(joined: DataFrame, shared, train: int, known: int, prior: float) -> DataFrame:
    """``SCORED`` of each document: the base in full, and the score over the bigrams whose part is in ``shared``."""

    def run(batches):
        model = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                block, ids, held, ends, codes, keys, totals = (batch.column(c)[k].as_py() for c in range(7))
                codes, keys, ends = unpacked(codes, np.uint32), unpacked_keys(keys), np.array(ends, np.int64)
                count = np.concatenate([unpacked(t, np.uint64) for t in totals]).astype(np.float64)
                begin = np.append(0, ends[:-1])
                unigram = (count + 1) / (train + known + 1)
                base = np.add.reduceat(np.log10(unigram)[codes], begin)
                n_known = np.add.reduceat((count > 0).astype(np.int64)[codes], begin)
                pairs = _pairs(keys, codes, ends)
                score = np.zeros(len(ids))
                if model is not None:
                    part = bucket_of(pairs, model.buckets, BIGRAM_BITS)
                    own = np.flatnonzero((part >= model.first) & (part <= model.last))
                else:
                    own = np.arange(len(pairs))
                if len(own):
                    level = np.zeros(len(own), np.int64)
                    if model is not None:
                        different, back = np.unique(pairs[own], return_inverse=True)
                        level = model.levels(different)[back]
                    before = np.empty(len(codes), np.int64)
                    before[1:] = codes[:-1]
                    before[begin] = np.searchsorted(keys, END)
                    word, context = codes[own], before[own]
                    seen = np.minimum(middle(level), np.minimum(count[word], count[context]))
                    p = (seen + prior * unigram[word]) / (count[context] + prior)
                    doc = np.searchsorted(ends, own, side="right")
                    score = np.bincount(doc, weights=np.log10(p), minlength=len(ids))
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block), pa.int64()), pa.array(np.arange(n), pa.int32()),
                     pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(np.diff(ends, prepend=0), pa.int64()),
                     pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())],
                    [f.split()[0] for f in SCORED.split(", ")])

    return joined.select("block", "ids", "held", "ends", "codes", "keys", "totals").mapInArrow(run, SCORED)


def groups_of(sizes: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """Runs of buckets ``(first, last)`` whose parts have at most ``most`` bytes together."""
    out: list[list[int]] = []
    held = 0
    for bucket, size in sorted(sizes):
        if not out or held + size > most:
            out.append([bucket, bucket])
            held = 0
        out[-1][1] = bucket
        held += size
    return [(a, b) for a, b in out]


def lm_scores(docs: DataFrame, id: str = "doc_id", text: str = "text", folds: int = FOLDS, fold: int = HELD_FOLD,
              prior: float = PRIOR, filter_bytes: int = FILTER_BYTES, bucket_keys: int = BUCKET_KEYS,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, a row for each input row.

    The model learns from the documents whose CRC-32 of the id, as text, is not ``fold`` modulo ``folds``; null ids
    are learned from. Tokens are the words between ASCII white space, A-Z in lower case, and one end a text: a null or
    empty text has that one. ``base_score`` is the add-one unigram's. Texts of any length are scored whole; repeated rows are learned
    and scored again; where nothing is learned from, every count is 0. An empty table gives no rows. Other columns are ignored, whatever their names.
    Words are told apart by 64-bit hashes.
    """
    spark, paths = docs.sparkSession, []
    made = blocks(docs, id, text, folds, fold, block_bytes).withColumn("block", F.monotonically_increasing_id())
    table = materialize(made, "blocks", paths)
    n_keys, n_bigrams, train = table.agg(F.sum("n_keys"), F.sum("n_bigrams"), F.sum("n_train")).first()
    word_buckets, buckets = (max(1, -(-(n or 0) // bucket_keys)) for n in (n_keys, n_bigrams))
    back = materialize(answers(words_sent(table, word_buckets), word_buckets), "word_counts", paths)
    known = back.agg(F.sum("known")).first()[0] or 0
    whole = materialize(parts(bigrams_sent(table, buckets), buckets), "filter", paths)
    sizes = [(r.bucket, r.size) for r in whole.select("bucket", "size").collect()]  # numbers, one a bucket
    own = back.filter("block is not null").groupBy(F.col("block").alias("__b")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("bucket", "totals"))), lambda x: x["totals"]).alias("totals"))
    joined = table.join(own, F.col("block") == F.col("__b"))
    done, results = None, []
    for first, last in groups_of(sizes, filter_bytes) or [(0, -1)]:
        rows = whole.filter(F.col("bucket").between(first, last)).select("bucket", "bits").collect()
        shared = spark.sparkContext.broadcast(Filter(rows, buckets) if rows else None)
        del rows
        part = materialize(scored(joined, shared, train or 0, known, prior), "scores", results)
        shared.destroy()
        done = part if done is None else done.unionByName(part)
    remove_tables(spark, paths)
    rest = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
    return done.groupBy("block", "place").agg(*[F.max(c).alias(c) for c in rest], F.sum("score").alias("score")).select(
        *rest[:-1], F.lit(train or 0).cast("bigint").alias("train_tokens"), "base_score", "score")
