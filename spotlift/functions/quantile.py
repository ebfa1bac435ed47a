"""Exact quantiles without gathering a column in one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BINS = 4096


def exact_quantile(df: DataFrame, column: str, q: float) -> float | None:
    """Quantile ``q`` with linear interpolation between the two nearest ranks.

    Each pass counts the values in 4096 equal bins of the current range; the range then
    shrinks to the bin holding the wanted ranks until they fall apart into two bins or the
    bin holds one value. A pass is one aggregation with at most 4097 result rows, whatever
    the row count, and no value is approximated. ``df`` is scanned once per pass, so hand
    in a materialised frame.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    total, low, high = values.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not total:
        return None
    position = q * (total - 1)
    rank = math.floor(position)
    weight = position - rank
    below = 0
    while low < high:
        # The lowest value lands in bin 0 and the highest, clamped, in the last one, so every
        # pass parts at least those two.
        bin_no = F.least(
            F.floor((F.col("v") - F.lit(low)) / F.lit(high - low) * F.lit(_BINS)).cast("long"), F.lit(_BINS - 1)
        )
        bins = (
            values.where(F.col("v").between(low, high))
            .groupBy(bin_no.alias("bin"))
            .agg(F.count("*").alias("n"), F.min("v").alias("first"), F.max("v").alias("last"))
            .orderBy("bin")
            .collect()
        )
        for i, row in enumerate(bins):
            if rank < below + row.n:
                break
            below += row.n
        if rank + 1 == below + row.n and i + 1 < len(bins):
            return row.last + (bins[i + 1].first - row.last) * weight
        if rank + 1 == below + row.n:
            return row.last
        low, high = row.first, row.last
    return low

