"""Near-duplicate documents: a multi-index Hamming join of b-bit MinHash signatures, confirmed on full sets.

**Signatures.** A document's set is its distinct word shingles (64-bit
hashes). Its signature is ``SYMBOLS`` minima under as many hash functions, each
cut to ``BITS`` bits. Two sets of similarity J differ in a symbol with
probability (1 - J)(1 - 2^-BITS).

**Multi-index join.** The signature is split into ``CHUNKS`` chunks. By the
pigeonhole principle two signatures that differ in at most
``CHUNKS * (ERRORS + 1) - 1`` symbols differ in at most ``ERRORS`` in some
chunk. The allowed errors are enumerated: with one error, a chunk gives one
key for each of its symbols left out. So every pair within that distance
shares a key. With the defaults (120 symbols of 8 bits, 24 chunks, 1 error)
the distance is 47 symbols, and a pair of similarity 0.8 exceeds it with probability
3.6e-7.

**What is done with a bucket.** Equal sets are one class before anything is
joined. In each bucket a search over the signatures gives a spanning forest of the
pairs within the distance, not the pairs themselves. The components of these
forests are families: every pair within the distance lies in one family.

**Confirmation.** Full sets are built again for the members of families only and meet
in their family. Links are decided on full sets; a search that visits
each member once gives a spanning forest of the links. Its components are the result, so no link
between different texts is lost, though copies and families never become all pairs.

Buckets and families of any size are cut into tiles (:mod:`marquee.llm.tiles`).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.components import components
from marquee.llm.textbytes import RollingHash, mix64, slices
from marquee.llm.tiles import tile_pairs, whole_groups
from marquee.plans.materialize import materialize

WORDS = 5
SIMILARITY = 80  # of 100
SYMBOLS, BITS, CHUNKS, ERRORS = 120, 8, 24, 1
DISTANCE = CHUNKS * (ERRORS + 1) - 1

BUCKET_ROWS = 1 << 15
FAMILY_SHINGLES = 1 << 20

_SEED = 0x5DEECE66D


def word_hashes(hashing: RollingHash, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, offsets)`` of the lower-cased words of a slice; words end at ASCII white space."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = np.where((data >= 0x41) & (data <= 0x5A), data + np.uint8(0x20), data)
    space = (low == 0x20) | ((low >= 0x09) & (low <= 0x0D))
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.ones(n, bool)
    before[1:] = space[:-1] | edge[1:n]
    after = np.ones(n, bool)
    after[:-1] = space[1:] | edge[1:n]
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return hashing.ranges(hashing.prefix(low), starts, ends), np.searchsorted(starts, offsets)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``size`` words; of fewer words, the whole sequence is one."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    with np.errstate(over="ignore"):
        h = np.full(len(words) - size + 1, size * 0x2545F4914F6CDD1D & (1 << 64) - 1, np.uint64)
        for k in range(size):
            h = (h ^ words[k:len(words) - size + 1 + k]) * np.uint64(0x9FB21C651E98DF25)
            h ^= h >> np.uint64(31)
    return np.unique(mix64(h))


def multipliers(symbols: int = SYMBOLS) -> np.ndarray:
    rng = np.random.default_rng(_SEED)
    return rng.integers(0, 1 << 63, symbols, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, factors: np.ndarray, bits: int = BITS) -> np.ndarray:
    """``bits`` bits of the least value of each hash function over the set."""
    least = np.full(len(factors), (1 << 64) - 1, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 4096):
            h = shingles[at:at + 4096, None] * factors[None, :]
            h ^= h >> np.uint64(29)
            np.minimum(least, h.min(axis=0), out=least)
    return (mix64(least) >> np.uint64(64 - bits)).astype(np.uint8)


def signed(docs: DataFrame, words: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, row_key, n_shingles, class_id, signature)`` per row; an empty set has no class."""

    def run(batches):
        hashing, factors = RollingHash(), multipliers()
        for batch in batches:
            size, who, sign = [], [], []
            for i, j, offsets, data in slices(batch.column(2)):
                hashes, ends = word_hashes(hashing, offsets, data)
                for k in range(j - i):
                    own = shingle_set(hashes[ends[k]:ends[k + 1]], words)
                    size.append(len(own))
                    who.append(class_of(own))
                    sign.append(signature(own, factors).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(who, pa.int64()),
                 pa.array(sign, pa.binary())], ["doc_id", "row_key", "n_shingles", "class_id", "signature"])

    return docs.select(F.col(id).cast("bigint").alias("doc_id"), row_key(id, text).alias("row_key"),
                       F.col(text).alias("text")).mapInArrow(
        run, "doc_id bigint, row_key string, n_shingles bigint, class_id bigint, signature binary")


def row_key(id: str = "doc_id", text: str = "text") -> Column:
    """What tells rows apart: the id (``-`` if null) and the MD5 of the text (null: empty)."""
    number = F.coalesce(F.col(id).cast("bigint").cast("string"), F.lit("-"))
    return F.concat(number, F.lit(":"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def class_of(shingles: np.ndarray) -> int | None:
    """A 64-bit number of the set; equal sets have equal numbers."""
    if len(shingles) == 0:
        return None
    digest = hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def signature_keys(signatures: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """The keys of each signature (a row each): every chunk with each one of its symbols left out."""
    out = []
    with np.errstate(over="ignore"):
        for number, places in enumerate(np.array_split(np.arange(signatures.shape[1]), chunks)):
            for left_out in places:
                h = np.full(len(signatures), number << 16 | int(left_out), np.uint64)
                for place in places:
                    if place != left_out:
                        h = mix64((h << np.uint64(8)) ^ (h >> np.uint64(56)) ^ signatures[:, place].astype(np.uint64))
                out.append(h)
    return np.stack(out, axis=1)


def keyed(classes: DataFrame) -> DataFrame:
    """``(bucket, class_id)``: a row for every key of every class."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                keys = signature_keys(_matrix(batch.column(1)))
                who = np.repeat(batch.column(0).to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(who)],
                                                 ["bucket", "class_id"])

    return classes.select("class_id", "signature").mapInArrow(run, "bucket bigint, class_id bigint")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def forest(n: int, near) -> list[tuple[int, int]]:
    """A spanning forest of a graph on ``0 .. n-1``: ``near(x, others)`` masks the others linked to ``x``."""
    edges, left, stack = [], np.arange(n), []
    while len(left):
        if not stack:
            stack, left = [int(left[0])], left[1:]
        x = stack.pop()
        if len(left):
            hit = near(x, left)
            found = left[hit].tolist()
            edges += [(x, y) for y in found]
            stack += found
            left = left[~hit]
    return edges


def bucket_forests(rows: DataFrame) -> DataFrame:
    """``(a, b)``: per bucket (and tile pair), a spanning forest of the pairs within the distance."""

    def run(batches):
        for batch, ends in whole_groups(batches, 3):
            who, signs = batch.column(3).to_numpy(), _matrix(batch.column(4))
            sizes = np.diff(ends)
            two = ends[:-1][sizes == 2]
            close = (signs[two] != signs[two + 1]).sum(axis=1) <= DISTANCE
            a, b = [who[two[close]]], [who[two[close] + 1]]
            for at, size in zip(ends[:-1][sizes > 2], sizes[sizes > 2]):
                own = signs[at:at + size]
                found = forest(size, lambda x, left: (own[left] != own[x]).sum(axis=1) <= DISTANCE)
                if found:
                    pairs = np.array(found)
                    a.append(who[at + pairs[:, 0]])
                    b.append(who[at + pairs[:, 1]])
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return rows.select("bucket", "ta", "tb", "class_id", "signature").mapInArrow(run, "a bigint, b bigint")


def links(sets: list[np.ndarray], similarity: int = SIMILARITY) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets with ``100 * intersection >= similarity * union``."""
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, code = np.unique(flat, return_inverse=True)
    seen = np.bincount(code)
    # A set needs this share of its shingles in other sets to be linked at all.
    shared = np.bincount(owner, weights=seen[code] > 1, minlength=len(sets))
    able = np.flatnonzero(100 * shared >= similarity * sizes)
    if len(able) < 2:
        return []
    keep = np.isin(owner, able)
    code, owner = code[keep], np.searchsorted(able, owner[keep])
    begin = np.searchsorted(owner, np.arange(len(able) + 1))
    mark = np.zeros(len(seen), bool)
    live = {"code": code, "owner": owner, "n": len(able)}

    def near(x, left):
        if 2 * len(left) < live["n"]:  # forget the sets that were visited
            there = np.zeros(len(able), bool)
            there[left] = True
            there = there[live["owner"]]
            live.update(code=live["code"][there], owner=live["owner"][there], n=len(left))
        own = code[begin[x]:begin[x + 1]]
        mark[own] = True
        both = np.bincount(live["owner"][mark[live["code"]]], minlength=len(able))[left]
        mark[own] = False
        return 100 * both >= similarity * (sizes[able[x]] + sizes[able[left]] - both)

    return [(int(able[x]), int(able[y])) for x, y in forest(len(able), near)]


def family_links(rows: DataFrame, similarity: int) -> DataFrame:
    """``(a, b)``: per family (and tile pair), a spanning forest of the confirmed links."""

    def run(batches):
        for batch, ends in whole_groups(batches, 3):
            who, blobs = batch.column(3).to_pylist(), batch.column(4)
            out = []
            for at, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
                if end - at > 1:
                    sets = [np.frombuffer(blobs[k].as_py(), np.uint64) for k in range(at, end)]
                    out += [(who[at + x], who[at + y]) for x, y in links(sets, similarity)]
            a, b = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.select("family", "ta", "tb", "class_id", "shingles").mapInArrow(run, "a bigint, b bigint")


def packed_texts(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``(row_key, packed)``: compressed texts, so that a join moves less."""

    def run(batches):
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([packer.compress(t or b"") for t in texts], pa.binary())],
                ["row_key", "packed"])

    return docs.select(row_key(id, text).alias("row_key"), F.col(text).alias("text")).mapInArrow(
        run, "row_key string, packed binary")


def full_sets(texts: DataFrame, words: int) -> DataFrame:
    """``(family, tiles, class_id, shingles)`` of packed texts whose set is of the class they stand for."""

    def run(batches):
        hashing, unpacker = RollingHash(), zstandard.ZstdDecompressor()
        for batch in batches:
            keep, sets = [], []
            for k, blob in enumerate(batch.column(3).to_pylist()):
                data = np.frombuffer(unpacker.decompress(blob), np.uint8)
                hashes, _ = word_hashes(hashing, np.array([0, len(data)]), data)
                own = shingle_set(hashes, words)
                if class_of(own) == batch.column(2)[k].as_py():
                    keep.append(k)
                    sets.append(own.tobytes())
            found = batch.select([0, 1, 2]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*found.columns, pa.array(sets, pa.binary())],
                                             ["family", "tiles", "class_id", "shingles"])

    return texts.select("family", "tiles", "class_id", "packed").mapInArrow(
        run, "family bigint, tiles bigint, class_id bigint, shingles binary")


def near_dedup(docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY,
               id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept, class_id, group_id, row_key)``, one row per input row.

    ``component_id`` is the least id that can be reached over links, the row's
    own included; ``class_id`` numbers equal sets and ``group_id`` the sets
    linked by any path (null for an empty set). ``row_key`` tells rows of one id, or of none, apart (:func:`row_key`).
    Null, empty and blank texts have an empty set and are linked to nothing.
    Texts of fewer words than a shingle are one shingle. A null id stays
    null, never names a component and is not kept unless it is linked to
    nothing; repeated rows are each reported, and kept if their id names the component. An empty table gives no
    rows; other columns are ignored, whatever their names.
    """
    rows = materialize(signed(docs, words, id, text), "signed")
    classes = rows.filter("class_id is not null").groupBy("class_id").agg(
        F.min("doc_id").alias("least_id"), F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key"))["row_key"].alias("row_key"))
    classes = materialize(classes, "classes")

    keys = keyed(classes)
    shared = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = keys.join(shared, "bucket").join(classes.select("class_id", "signature"), "class_id")
    tiled = tile_pairs(members, "class_id", F.ceil(F.col("members") / BUCKET_ROWS))
    sort = ["bucket", "ta", "tb"]
    near = bucket_forests(tiled.repartition(*sort).sortWithinPartitions(*sort)).distinct()
    family = components(near, "a", "b", "families").select(
        F.col("node").alias("class_id"), F.col("root").alias("family"))
    family = materialize(family, "family")

    in_family = family.join(classes.select("class_id", "row_key", "n_shingles"), "class_id")
    weight = in_family.groupBy("family").agg(
        F.ceil(F.sum("n_shingles") / FAMILY_SHINGLES).cast("bigint").alias("tiles"))
    wanted = in_family.join(weight, "family").select("family", "tiles", "class_id", "row_key")
    # A class is read from one of its rows; rows that repeat that one are dropped where the join put them.
    found = packed_texts(docs, id, text).join(wanted, "row_key").groupBy("row_key").agg(
        *[F.first(c).alias(c) for c in ("family", "tiles", "class_id", "packed")])
    sets = tile_pairs(full_sets(found, words), "class_id", F.col("tiles"))
    sort = ["family", "ta", "tb"]
    linked = family_links(sets.repartition(*sort).sortWithinPartitions(*sort, "class_id"), similarity)
    roots = components(linked, "a", "b", "links")

    rooted = classes.select("class_id", "least_id").join(
        roots.select(F.col("node").alias("class_id"), "root"), "class_id", "left")
    rooted = rooted.select("class_id", "least_id", F.coalesce("root", "class_id").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component"))
    of_class = rooted.join(least, "root").select(F.col("class_id").alias("c"), "component", F.col("root").alias("group_id"))
    of_class = materialize(of_class, "components")
    out = rows.join(of_class, rows.class_id == of_class.c, "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      component.eqNullSafe(F.col("doc_id")).alias("kept"), "class_id", "group_id", "row_key")
