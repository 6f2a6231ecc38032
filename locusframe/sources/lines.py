"""Text scans: every reader starts from lines ``(path, ord, value)``.

``ord`` grows with the position of the line in its file and is unique there; it is not the
line number. It is the byte offset of the file split plus the row index inside the task; a
line takes at least one byte and a task reads at most one split's worth of bytes before the
next split begins, so values of later splits are always larger. No shuffle and no extra job
is needed. Where reports need real line numbers, :func:`with_line_numbers` counts them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.operators.ordered import position_block, running

ROW_INDEX_MASK = (1 << 33) - 1
LINE_BLOCK_SHIFT = 18


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of one file, a list of files, a folder or a glob (``.gz`` by extension)."""
    raw = spark.read.text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("path"),
        (F.col("_metadata.file_block_start")
         + F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_INDEX_MASK))).alias("ord"),
        F.col("value"),
    )


def read_blocks(spark: SparkSession, path: str | list[str], separator: str) -> DataFrame:
    """Text cut at a separator instead of line ends, with the same three columns."""
    raw = spark.read.option("lineSep", separator).text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("path"),
        (F.col("_metadata.file_block_start")
         + F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_INDEX_MASK))).alias("ord"),
        F.col("value"),
    )


def ord_block() -> Column:
    return position_block("ord", LINE_BLOCK_SHIFT)


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """Append the 1-based ``line_no`` within each file."""
    return running(lines, ["path"], ["ord"], ord_block(), {"line_no": ("sum", F.lit(1).cast("bigint"))})


def content(lines: DataFrame, *skip_prefixes: str) -> DataFrame:
    """Lines that are neither empty nor start with one of the prefixes."""
    out = lines.where(F.col("value") != "")
    for p in skip_prefixes:
        out = out.where(~F.col("value").startswith(p))
    return out


def line_order(files: Sequence[str] | None = None) -> Column:
    """Order of lines over several files: by the place of their file in ``files`` (ends of paths), else by path, then by line."""
    place = F.coalesce(*[F.when(F.endswith(F.col("path"), F.lit(f)), F.lit(i)) for i, f in enumerate(files or [])], F.lit(len(files or [])))
    return F.struct(place.alias("place"), F.col("path"), F.col("ord"))


def parse_plain_table(lines: DataFrame, names: Sequence[str]) -> DataFrame:
    """Headerless tab table: short rows are padded with empty text, long rows are cut."""
    parts = F.split(F.col("value"), "\t", -1)
    return content(lines).select("path", "ord", *[F.coalesce(F.try_element_at(parts, F.lit(i + 1)), F.lit("")).alias(n) for i, n in enumerate(names)])
