"""Spelling variants: words at one edit from each other, by finite-state composition.

1. **Vocabulary.** Words are counted where they are read and summed with partial aggregation.
2. **Initial-state partitions.** Of a pair at one edit let ``m`` be the shorter
   length and the edit stand where the words first differ. If that place is in
   the stretch ``[a, b)`` of the ``m`` letters, the words share the ``a``
   letters before and the ``m - b`` letters after it: the vocabulary
   acceptor reads both words into the same state before the stretch. Words are dealt
   by these shared letters, once for each half of their letters. A partition of more than
   ``GROUP_WORDS`` words is dealt again by the halves of its stretch, down to one letter, where
   the alphabet bounds it. Each pair belongs to exactly one partition.
3. **Composition.** In a partition the stretches of the shorter and of the
   longer words are minimised acceptors. The first is composed with a one-edit
   transducer and with either acceptor: paths read the same letters, take one edit, and read the same letters to
   final states of both. Accepted pairs are added up per word where they are found: how many, and the best.
4. **Forms** point to words of at least ``ratio`` times the count, so chains are
   logarithmic in the largest count; pointer doubling follows them to their ends.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from math import ceil, log, log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.tiles import whole_groups
from marquee.plans.materialize import materialize, remove_tables

LEAST_LETTERS, LEAST_COUNT, RATIO = 7, 2, 10
GROUP_WORDS = 1024
# Words that a task counts before it hands them on: bounds its memory.
HELD_WORDS = 1 << 20
MISSPELT = 31


def spelt_runs(text: str, least: int) -> list[str]:
    """Runs of at least ``least`` Latin letters, A-Z in lower case."""
    return re.findall("[a-zÀ-ÿ]{%d,}" % least, text.encode().lower().decode())


def misspelt(runs: list[str], doc_id: int | None, one_in: int = MISSPELT) -> list[str]:
    """Runs as a careless copy has them: one in ``one_in``, by a checksum of document and run, lacks a letter."""
    base = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out = []
    for run in runs:
        h = zlib.crc32(run.encode(), base)
        if h % one_in == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        out.append(run)
    return out


def vocabulary(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST_LETTERS,
               least_count: int = LEAST_COUNT, one_in: int | None = None) -> DataFrame:
    """``(word, n)``: words of at least ``least`` letters and ``least_count`` occurrences.

    ``one_in`` counts the texts as :func:`misspelt` has them.
    """

    def run(batches):
        held: Counter = Counter()

        def handed():
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()),
                                                pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                runs = spelt_runs(value.as_py() or "", least)
                if one_in:
                    runs = [w for w in misspelt(runs, key, one_in) if len(w) >= least]
                held.update(runs)
                if len(held) >= HELD_WORDS:
                    yield handed()
        yield handed()

    found = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows ``(word, n, m, a, b)`` with ``key``: the letters around the stretch, as a number."""
    before = F.substring("word", F.lit(1), F.col("a"))
    after = F.col("m") - F.col("b")
    behind = F.substring("word", F.char_length("word") - after + 1, after)
    return rows.select("m", "a", "b", F.xxhash64(before, behind).alias("key"), "word", "n")


def dealt(words: DataFrame, least: int = LEAST_LETTERS, most: int = GROUP_WORDS,
          paths: list[str] | None = None) -> DataFrame:
    """Words ``(word, n)`` under the keys ``(m, a, b, key)`` of their partitions, none of which is large."""
    paths = [] if paths is None else paths
    size = F.char_length("word")
    # As the shorter word of a pair, or of two equally long ones; and as the longer one.
    m = F.explode(F.filter(F.array(size, size - 1), lambda x: x >= least))
    rows = words.select("word", "n", m.alias("m"))

    def halves(rows, low, high):
        mid = F.floor((low + high) / 2).cast("int")
        two = F.array(F.struct(low.alias("a"), mid.alias("b")), F.struct(mid.alias("a"), high.alias("b")))
        return rows.select("word", "n", "m", F.inline(two))

    rows = materialize(_keyed(halves(rows, F.lit(0), F.col("m"))), "dealt", paths)
    key, out = ["m", "a", "b", "key"], []
    while True:  # each round halves the stretches: logarithmic in the longest word
        large = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).filter(
            (F.col("__n") > most) & (F.col("b") - F.col("a") > 1)).drop("__n")
        large = materialize(large, "large", paths)
        if large.isEmpty():
            out.append(rows)
            break
        out.append(rows.join(large, key, "left_anti").select(rows.columns))
        split = rows.join(large, key, "left_semi")
        rows = materialize(_keyed(halves(split, F.col("a"), F.col("b"))), "dealt", paths)
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def acceptor(words: list[str]) -> tuple[list[tuple[bool, tuple]], int]:
    """The minimised acceptor of sorted distinct words: states ``(final, ((letter, state), ...))`` and the initial one."""
    register: dict[tuple, int] = {}
    path: list = [[False, []]]  # the states along the last word, still open
    last = ""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            state = register.setdefault((final, tuple(arcs)), len(register))
            path[-1][1].append((last[len(path) - 1], state))

    for word in words:
        same = 0
        while same < len(last) and same < len(word) and last[same] == word[same]:
            same += 1
        close(same)
        path.extend([False, []] for _ in word[same:])
        path[-1][0] = True
        last = word
    close(0)
    start = register.setdefault((path[0][0], tuple(path[0][1])), len(register))
    return list(register), start


def both(one, p: int, two, q: int, barred: str = "") -> Iterator[str]:
    """What both acceptors read from two states, unless it begins with ``barred``."""
    stack = [(p, q, "")]
    while stack:
        p, q, read = stack.pop()
        (end, arcs), (other_end, others) = one[p], two[q]
        if end and other_end:
            yield read
        there = dict(others)
        stack += [(to, there[c], read + c) for c, to in arcs if c in there and not (barred and not read and c == barred)]


def composed(one, start: int, two, other_start: int, longer: bool, deepest: int) -> Iterator[tuple[str, str]]:
    """Pairs of ``one`` and ``two`` at one edit, at the place where they first differ and at most at ``deepest``.

    ``longer``: the second has a letter more; else they differ in a letter, the first having the lesser one.
    """
    stack = [(start, other_start, "")]
    while stack:
        p, q, read = stack.pop()
        arcs, others = one[p][1], two[q][1]
        if longer:
            for c, to in others:
                for rest in both(one, p, two, to, c):
                    yield read + rest, read + c + rest
        else:
            for c, to in arcs:
                for d, other in others:
                    if c < d:
                        for rest in both(one, to, two, other):
                            yield read + c + rest, read + d + rest
        if len(read) < deepest:
            there = dict(others)
            stack += [(to, there[c], read + c) for c, to in arcs if c in there]


def near_of(words: dict[str, int], m: int, a: int, b: int) -> dict[str, tuple[int, int, str]]:
    """``word -> (near words, largest count of one, that word)`` of a partition, its own pairs only."""
    out: dict[str, tuple[int, int, str]] = {}

    def add(x: str, y: str) -> None:
        n, most, best = out.get(x, (0, 0, ""))
        if words[y] > most or (words[y] == most and y < best):
            most, best = words[y], y
        out[x] = n + 1, most, best

    around = defaultdict(list)  # one entry, but for keys that collide
    for word in words:
        around[word[:a], word[len(word) - (m - b):]].append(word)
    for (before, after), own in around.items():
        if len(own) < 2:
            continue
        stretches = [w[a:len(w) - (m - b)] for w in own]
        short = sorted(s for s in stretches if len(s) == b - a)
        if not short:
            continue
        long = sorted(s for s in stretches if len(s) == b - a + 1)
        one, start = acceptor(short)
        # A letter may also follow the last one, in the last stretch.
        pairs = list(composed(one, start, one, start, False, b - a - 1)) if len(short) > 1 else []
        if long:
            pairs += composed(one, start, *acceptor(long), True, b - a if b == m else b - a - 1)
        for x, y in pairs:
            x, y = before + x + after, before + y + after
            add(x, y)
            add(y, x)
    return out


NEAR = "word string, n_near bigint, best_n bigint, best string"


def near_words(rows: DataFrame) -> DataFrame:
    """``(word, n_near, best_n, best)`` of words with near ones, from the partitions of :func:`dealt`."""

    def run(batches):
        for batch, ends in whole_groups(batches, 4):
            out = []
            heads = [batch.column(k).take(pa.array(ends[:-1])).to_pylist() for k in range(3)]
            for at, end, m, a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), *heads):
                if end - at > 1:
                    words = dict(zip(batch.column(4).slice(at, end - at).to_pylist(),
                                     batch.column(5).slice(at, end - at).to_pylist()))
                    out += [(w, *found) for w, found in near_of(words, m, a, b).items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4,
                                                (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                [f.split()[0] for f in NEAR.split(", ")])

    key = ["m", "a", "b", "key"]
    found = rows.repartition(*key).sortWithinPartitions(*key).select(*key, "word", "n").mapInArrow(run, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("lack"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("__b")).select(
        "word", "n_near", (-F.col("__b.lack")).alias("best_n"), F.col("__b.best").alias("best"))


def roots(forms: DataFrame, largest: int, ratio: int, paths: list[str]) -> DataFrame:
    """``(word, root)`` of words ``(word, form)``: forms followed to the last, by pointer doubling."""
    steps = max(1.0, log(max(largest, ratio), ratio))  # counts grow by the ratio at each step
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots", paths)
    for _ in range(ceil(log2(steps)) + 1):
        up = now.select(F.col("word").alias("__w"), F.col("root").alias("__r"))
        now = materialize(now.join(up, F.col("root") == F.col("__w"), "left").select(
            "word", F.coalesce("__r", "root").alias("root")), "roots", paths)
    return now


def variant_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST_LETTERS,
                   least_count: int = LEAST_COUNT, ratio: int = RATIO, one_in: int | None = None,
                   most: int = GROUP_WORDS) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of every word of the vocabulary.

    A word's form is its near word of the largest count (ties: the least in
    code-point order) if that count is at least ``ratio`` times its own; its root is the last of
    its forms' forms, or the word itself. Null and empty texts have no words;
    a null id counts as an empty one; repeated rows count again; runs of any length are words. An empty
    table gives no rows. Other columns are ignored, whatever their names.
    """
    spark, paths = docs.sparkSession, []
    words = materialize(vocabulary(docs, id, text, least, least_count, one_in), "vocabulary", paths)
    near = near_words(dealt(words, least, most, paths)).withColumnRenamed("word", "__word")
    found = words.join(near, F.col("word") == F.col("__word"), "left")
    form = F.when(F.col("best_n") >= ratio * F.col("n"), F.struct("best", "best_n"))
    found = found.withColumn("__f", form).select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.col("__f.best").alias("form"), F.col("__f.best_n").alias("form_n"))
    found = materialize(found, "forms", paths)
    read = paths[-1:]
    largest = words.agg(F.max("n")).first()[0] or 1
    up = roots(found.filter("form is not null"), largest, ratio, paths).withColumnRenamed("word", "__word")
    read += paths[-1:]
    remove_tables(spark, [p for p in paths if p not in read])
    return found.join(up, F.col("word") == F.col("__word"), "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
