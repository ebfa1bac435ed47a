"""Splitting hot keys over several tasks.

A key is hot when more than ``rows_per_task`` rows carry it. Rows of a hot key are spread by
their content and by the input partition they come from: identical copies spread as well, and
a task that is run again gives every row the same salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "salt"
ROWS_PER_TASK = 1_000_000


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, combined on the map side."""
    return df.where(f"{key} IS NOT NULL").groupBy(key).agg(F.expr("count(*) AS rows"))


def salt_count(rows_per_task: int = ROWS_PER_TASK) -> str:
    return f"cast(ceil(rows / {int(rows_per_task)}) AS int)"


def hot_keys(counts: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Hot keys and the number of salts each needs.

    Every entry stands for more than ``rows_per_task`` rows, so the list holds at most
    rows / rows_per_task entries: with a million rows per task, 10^12 rows give at most 10^6
    entries of 16 bytes. That bound is what allows the broadcasts below.
    """
    return counts.where(f"rows > {int(rows_per_task)}").selectExpr(key, f"{salt_count(rows_per_task)} AS salts")


def spread(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Give each row one of its key's salts."""
    content = f"pmod(xxhash64({', '.join(df.columns)}), salts)"
    return (
        df.join(F.broadcast(hot), key, "left")
        .withColumn(SALT, F.expr(f"if(salts IS NULL, 0, cast(pmod({content} + spark_partition_id(), salts) AS int))"))
        .drop("salts")
    )


def replicate(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Copy each row to all salts of its key."""
    return (
        df.join(F.broadcast(hot), key, "left")
        .withColumn(SALT, F.expr("explode(sequence(0, coalesce(salts, 1) - 1))"))
        .drop("salts")
    )
