"""Bounded samples of labelled texts to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows_per_class: int, most_chars: int, seed: int = 7
) -> tuple[list[str], list[int]]:
    """Texts and labels (0 or 1) of at most ``rows_per_class`` documents of each label and ``most_chars`` characters in all.

    Documents are taken in the order of a hash of their id, so the sample is the same on every run and at any partitioning. Of
    repeated labels of a document the highest counts, of repeated rows the longest text. ``usable`` is a condition on ``doc_id``.
    """
    marks = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("mark")).where(
        F.col("doc_id").isNotNull() & F.col("mark").isin(0, 1) & usable
    ).groupBy("doc_id").agg(F.max("mark").alias("mark"))
    sizes = docs.select(F.col("doc_id").cast("long"), F.length("text").alias("size")).where("size > 0")
    known = marks.join(sizes, "doc_id").withColumn("turn", F.xxhash64("doc_id", F.lit(seed)))
    chosen: list[tuple[int, int]] = []
    for mark in (0, 1):  # the two heads are bounded, and so is what they send to the driver
        left = most_chars // 2
        seen = set()
        for row in known.where(F.col("mark") == mark).orderBy("turn", "doc_id", F.desc("size")).limit(rows_per_class).collect():
            if row["doc_id"] not in seen and row["size"] <= left:
                left -= row["size"]
                seen.add(row["doc_id"])
                chosen.append((row["doc_id"], mark))
    if not chosen:
        return [], []
    picked = docs.sparkSession.createDataFrame(chosen, "doc_id long, mark int")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("length(text) > 0")
    found = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "mark").agg(F.max("text").alias("text"))
    rows = sorted(found.collect(), key=lambda r: r["doc_id"])
    return [r["text"] for r in rows], [r["mark"] for r in rows]
