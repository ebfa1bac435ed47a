"""Groups of rows that arrive sorted by key in Arrow batches, and the split of large groups into pairs of blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table for each run of equal keys; a run may go on over several batches."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            new[1:] |= values[1:] != values[:-1]
            if rest:
                new[0] |= values[0] != rest[-1].column(key)[-1].as_py()
        cuts = np.flatnonzero(new)
        if not len(cuts):
            rest.append(batch)
            continue
        if cuts[0] or rest:
            head = batch.slice(0, cuts[0])
            yield pa.Table.from_batches([*rest, head] if cuts[0] else rest)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield pa.Table.from_batches([batch.slice(a, b - a)])
        rest = [batch.slice(cuts[-1])]
    if rest:
        yield pa.Table.from_batches(rest)


def block_pairs(rows: DataFrame, key: str, member: str, blocks: str) -> DataFrame:
    """Rows of a group with ``blocks`` > 1 go to blocks by a hash of ``member``, and every pair of blocks becomes a group.

    Adds ``bi`` <= ``bj``, the pair, and ``side``, 1 for a row of block ``bj`` where the two differ. All pairs of rows meet, each
    task holds two blocks at most, and a group's tasks are as many as its pairs of blocks.
    """
    own = F.when(F.col(blocks) > 1, F.pmod(F.xxhash64(member), F.col(blocks))).otherwise(F.lit(0).cast("long"))
    return (
        rows.withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)))
        .withColumn("bi", F.least("_own", "_other"))
        .withColumn("bj", F.greatest("_own", "_other"))
        .withColumn("side", (F.col("_own") != F.col("bi")).cast("int"))
        .drop("_own", "_other", blocks)
    )


class Forest:
    """Disjoint sets of the rows 0 to n-1 of one group, each named by its smallest row."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, a: int, b: int) -> None:
        x, y = sorted((self.of[a], self.of[b]))
        if x != y:
            self.of[self.of == y] = x
