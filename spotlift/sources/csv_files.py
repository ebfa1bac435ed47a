"""CSV sources and sinks, and discovery of the files under a source root."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_DIALECT = {"header": "true", "sep": ",", "quote": '"', "escape": '"'}
#: Every part must have the same header, every row as many fields as it; pruned columns are parsed as well, so that a count fails too.
_STRICT = {"mode": "FAILFAST", "enforceSchema": "false", "columnPruning": "false"}


def read_text_columns(spark: SparkSession, path: str) -> DataFrame:
    """Every column of a CSV file with header, as text under its header name.

    Reading fails on a row with too many or too few fields and on a part whose header differs.
    """
    names = spark.read.options(**_DIALECT).csv(path).columns
    schema = StructType([StructField(n, StringType()) for n in names])
    return spark.read.schema(schema).options(**_DIALECT, **_STRICT).csv(path) if names else spark.read.options(**_DIALECT).csv(path)


def read_typed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Declared columns first, cast by name, then any extra columns as text.

    The reader's own schema option would match by position and turn a bad value into null;
    the cast fails the run instead.
    """
    text = read_text_columns(spark, path)
    declared = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    extra = [c for c in text.columns if c not in schema.fieldNames()]
    return text.select(*declared, *extra)


def plain(c: Column) -> Column:
    """A floating-point number as text without exponent, where its size is from 1e-7 up to 1e15."""
    size, text = F.abs(c), c.cast("string")

    def digits(scale: int) -> Column:
        return F.regexp_replace(text.cast(f"decimal(38, {scale})").cast("string"), r"(\.\d+?)0+$", "$1")

    small = (size >= 1e-7) & (size < 1e-3)
    return F.when(small, digits(30)).when((size >= 1e7) & (size < 1e15), digits(20)).otherwise(text)


def write_csv(df: DataFrame, path: str) -> None:
    """Write a folder of CSV parts with header; nulls are empty, blanks around a value stay.

    Timestamps are written as ``2026-04-20 20:30:00``, with a fraction only if there is one, numbers without exponent.
    """
    texts = {c: F.col(c).cast("string") for c, t in df.dtypes if t.startswith("timestamp")}
    texts |= {c: plain(F.col(c)) for c, t in df.dtypes if t in ("float", "double")}
    out = df.withColumns(texts) if texts else df
    blanks = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    out.write.mode("overwrite").options(**_DIALECT, **blanks).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def require_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Raise if any path is missing; called before anything is written."""
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"Missing required file: {', '.join(missing)}")


def discover(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """``(path, length)`` of the files below ``root``, path relative to it; contents stay unread."""
    root = root.rstrip("/")
    if not path_exists(spark, root):
        return spark.createDataFrame([], "path string, length bigint")
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    )
    start = F.instr("path", f"{root}/") + len(root) + 1
    return files.select(F.substring("path", start, F.length("path")).alias("path"), "length")
