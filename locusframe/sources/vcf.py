"""VCF text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.functions.values import cell, cells, to_int, with_cells
from locusframe.sources.lines import read_lines

STRUCTURED_META = r"^##([A-Za-z][A-Za-z0-9_.]*)=<(.*)>\s*$"
META_ATTRIBUTE = r'([A-Za-z_][A-Za-z0-9_.]*)=("[^"]*"|[^,]*)'


def meta_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("value").startswith("##"))


def header_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("value").startswith("#CHROM"))


def parse_vcf_meta(lines: DataFrame) -> DataFrame:
    """Structured ``##KIND=<...>`` lines: kind, id, number, type and all attributes."""
    text = F.trim("value")
    body = F.regexp_extract(text, STRUCTURED_META, 2)
    pattern = F.lit(META_ATTRIBUTE)
    attrs = F.map_from_arrays(
        F.regexp_extract_all(body, pattern, F.lit(1)),
        F.transform(F.regexp_extract_all(body, pattern, F.lit(2)), lambda v: F.btrim(v, F.lit('"'))),
    )
    rows = meta_lines(lines).where(text.rlike(STRUCTURED_META)).select(
        "path", "ord", F.regexp_extract(text, STRUCTURED_META, 1).alias("kind"), attrs.alias("attrs")
    )
    a = F.col("attrs")
    return rows.select("path", "ord", "kind", a["ID"].alias("id"), a["Number"].alias("number"), a["Type"].alias("type"), "attrs")


def parse_vcf(lines: DataFrame) -> DataFrame:
    """Records with at least 8 cells and an integer position; ``.`` as ALT gives no alleles."""
    rows = with_cells(lines.where((F.col("value") != "") & ~F.col("value").startswith("#")), "_c", cells(F.col("value")))
    c = F.col("_c")
    none = F.array().cast("array<string>")
    return rows.where(F.size("_c") >= 8).select(
        "path", "ord", cell(c, 0).alias("chrom"), to_int(cell(c, 1)).alias("pos"), cell(c, 2).alias("id"), cell(c, 3).alias("ref"),
        F.when(cell(c, 4).isin(".", ""), none).otherwise(F.split(cell(c, 4), ",", -1)).alias("alts"),
        cell(c, 5).alias("qual"), cell(c, 6).alias("filter"), cell(c, 7).alias("info"),
        F.when(F.size(c) > 8, F.split(cell(c, 8), ":", -1)).otherwise(none).alias("formats"),
        F.slice(c, 10, F.greatest(F.size(c) - 9, F.lit(0))).alias("samples"),
    ).where("pos is not null")


def scan_vcf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_vcf(read_lines(spark, path))


def sample_names(header: str) -> list[str]:
    return header.rstrip("\n").split("\t")[9:]


def alt_text(alts: Column) -> Column:
    return F.when(F.size(alts) > 0, F.array_join(alts, ",")).otherwise(F.lit("."))


def vcf_line(df: DataFrame | None = None) -> Column:
    """One VCF text line from the record columns."""
    base = [F.col("chrom"), F.col("pos").cast("string"), F.col("id"), F.col("ref"), alt_text(F.col("alts")),
            F.col("qual"), F.col("filter"), F.col("info")]
    has_samples = (F.size("formats") > 0) | (F.size("samples") > 0)
    tail = F.when(has_samples, F.concat(F.array(F.array_join("formats", ":")), F.col("samples"))).otherwise(
        F.array().cast("array<string>"))
    return F.array_join(F.concat(F.array(*base), tail), "\t")
