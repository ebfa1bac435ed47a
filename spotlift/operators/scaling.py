"""Standardisation with the population standard deviation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scaling_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, mean, std_pop)`` per feature, from one aggregation."""
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std_pop"))
            for c in features
        ]
    )
    return df.agg(rows.alias("stats")).select(F.inline("stats"))


@dataclass(frozen=True)
class Scaler:
    mean: dict[str, float]
    std: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, features: Sequence[str]) -> Scaler:
        """One action; its result has one row per feature."""
        rows = scaling_stats(df, features).collect()
        return cls({r.feature: r["mean"] for r in rows}, {r.feature: r.std_pop for r in rows})

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace each feature by its standard score; a constant feature is only centred."""
        scaled = {c: (F.col(c) - F.lit(m)) / F.lit(self.std[c] or 1.0) for c, m in self.mean.items()}
        return df.withColumns(scaled)
