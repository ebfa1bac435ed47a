"""Row checks and duplicate-key checks, fused to one pass per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RowCheck:
    """Counts the rows of ``table`` for which ``fails`` (an SQL predicate) is true."""

    table: str
    name: str
    fails: str


@dataclass(frozen=True)
class DuplicateCheck:
    """Counts the values of ``key`` in ``table`` that occur more than once; nulls are one value."""

    table: str
    name: str
    key: str


def not_null(column: str) -> str:
    return f"{column} IS NULL"


def outside(column: str, low: float, high: float, null_fails: bool = False) -> str:
    """Out-of-range predicate; a null counts only when asked for."""
    extra = f" OR {column} IS NULL" if null_fails else ""
    return f"{column} < {low} OR {column} > {high}{extra}"


def failing_rows(df: DataFrame, predicates: Mapping[str, str | Column]) -> DataFrame:
    """One row with the number of failing rows per named predicate, in a single pass."""
    conditions = {n: F.expr(p) if isinstance(p, str) else p for n, p in predicates.items()}
    return df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def duplicate_groups(df: DataFrame, key: str) -> DataFrame:
    """One row ``(duplicate_groups)``; counts are combined on the map side before the shuffle."""
    return (
        df.groupBy(key).agg(F.count("*").alias("rows")).where("rows > 1").agg(F.count("*").alias("duplicate_groups"))
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[RowCheck | DuplicateCheck]) -> DataFrame:
    """``(table_name, check_name, failed_rows)`` with one row per check."""
    parts = []
    for table in dict.fromkeys(c.table for c in checks):
        row_checks = [c for c in checks if c.table == table and isinstance(c, RowCheck)]
        keys = dict.fromkeys(c.key for c in checks if c.table == table and isinstance(c, DuplicateCheck))
        for key in keys or [None]:
            here = [c for c in checks if c.table == table and isinstance(c, DuplicateCheck) and c.key == key]
            parts.append(_counted(tables[table], [*row_checks, *here], key))
            row_checks = []  # done with the first key's
    return union_all(parts)


def _counted(df: DataFrame, checks: Sequence[RowCheck | DuplicateCheck], key: str | None) -> DataFrame:
    """Checks of one table in one pass; with a key, rows are counted by key first and failures added up after."""
    failing = {f"failing_{i}": F.count_if(F.expr(c.fails)) for i, c in enumerate(checks) if isinstance(c, RowCheck)}
    if key is not None:
        df = df.groupBy(key).agg(F.count("*").alias("rows_of_key"), *[n.alias(a) for a, n in failing.items()])
        failing = {a: F.coalesce(F.sum(a), F.lit(0).cast("long")) for a in failing}
    results = F.array(
        *[
            F.struct(
                F.lit(c.table).alias("table_name"),
                F.lit(c.name).alias("check_name"),
                failing.get(f"failing_{i}", F.count_if(F.expr("rows_of_key > 1"))).alias("failed_rows"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return df.agg(results.alias("results")).select(F.inline("results"))
