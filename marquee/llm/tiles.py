"""Groups of any size as tasks of bounded size: every pair of a group's rows meets in some tile pair.

A group is cut into tiles by a hash of its rows, as many as its weight needs;
rows are sent to each pair of tiles that has theirs. A group of one tile (the
usual case) is one task share and its rows are sent once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tile_pairs(rows: DataFrame, row: str, tiles: Column) -> DataFrame:
    """Add the tile pair ``(ta, tb)``, ``ta <= tb``, to rows of groups of ``tiles`` tiles."""
    own = rows.withColumn("__n", F.greatest(F.lit(1), tiles.cast("int")))
    own = own.withColumn("__t", F.pmod(F.xxhash64(row), F.col("__n")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("__n") - 1))
    return (own.withColumn("__o", other)
            .withColumn("ta", F.least("__t", "__o")).withColumn("tb", F.greatest("__t", "__o"))
            .drop("__n", "__t", "__o"))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """``(rows, group offsets)`` of whole groups of a partition sorted by its first ``keys`` integer columns.

    Memory is one batch and one group.
    """

    def cut(batch: pa.RecordBatch) -> np.ndarray:
        change = np.zeros(batch.num_rows, bool)
        for k in range(keys):
            column = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= column[1:] != column[:-1]
        return np.flatnonzero(change)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if held and all(held[0].column(k)[0] == batch.column(k)[0] for k in range(keys)) and len(cut(batch)) == 0:
            held.append(batch)
            continue
        if held:
            batch = pa.Table.from_batches([*held, batch]).combine_chunks().to_batches()[0]
        ends = cut(batch)
        if len(ends):
            yield batch.slice(0, int(ends[-1])), np.append(0, ends)
        held = [batch.slice(int(ends[-1]) if len(ends) else 0)]
    if held:
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        yield batch, np.concatenate([[0], cut(batch), [batch.num_rows]])
