"""Gene annotation text (GTF, GFF3) and BED."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.functions.values import cell, cells, first_nonblank, to_int, with_cells, words
from locusframe.sources.lines import content, read_lines

ANNOTATION_COLUMNS = ["chrom", "source", "feature", "start", "end", "score", "strand", "frame", "attrs_text"]
GTF_ATTRIBUTE = r'([^\s;]+)\s+"([^"]*)"\s*;?'


def annotation_format(path: str) -> str:
    """``gff3`` for .gff/.gff3 names (also gzipped), otherwise ``gtf``."""
    name = path.lower().removesuffix(".gz")
    return "gff3" if name.endswith((".gff", ".gff3")) else "gtf"


def gtf_attributes(text: Column) -> Column:
    pattern = F.lit(GTF_ATTRIBUTE)
    return F.map_from_arrays(
        F.regexp_extract_all(text, pattern, F.lit(1)), F.regexp_extract_all(text, pattern, F.lit(2))
    )


def gff3_attributes(text: Column) -> Column:
    tokens = F.filter(F.split(text, ";", -1), lambda t: t != "")

    def entry(t: Column) -> Column:
        at = F.instr(t, "=")
        return F.struct(
            F.when(at > 0, F.substring(t, F.lit(1), at - 1)).otherwise(t).alias("k"),
            F.when(at > 0, F.substring(t, at + 1, F.length(t))).otherwise(F.lit("")).alias("v"),
        )

    return F.map_from_entries(F.transform(tokens, entry))


def attributes(text: Column, fmt: str) -> Column:
    return gff3_attributes(text) if fmt == "gff3" else gtf_attributes(text)


def _annotation_rows(lines: DataFrame) -> DataFrame:
    rows = with_cells(content(lines, "#"), "_c", cells(F.col("value")))
    return rows.select(
        "path", "ord", "value", F.size("_c").alias("_n"),
        to_int(cell(F.col("_c"), 3)).alias("_s"), to_int(cell(F.col("_c"), 4)).alias("_e"), "_c",
    )


def parse_annotation(lines: DataFrame, fmt: str = "gtf") -> DataFrame:
    """Typed records with 1-based closed coordinates and an attribute map."""
    ok = _annotation_rows(lines).where("_n = 9 and _s is not null and _e is not null")
    c = F.col("_c")
    return ok.select(
        "path", "ord", cell(c, 0).alias("chrom"), cell(c, 1).alias("source"), cell(c, 2).alias("feature"),
        F.col("_s").alias("start"), F.col("_e").alias("end"), cell(c, 5).alias("score"), cell(c, 6).alias("strand"),
        cell(c, 7).alias("frame"), cell(c, 8).alias("attrs_text"), attributes(cell(c, 8), fmt).alias("attrs"),
    )


def annotation_rejects(lines: DataFrame) -> DataFrame:
    """Lines that are no records, with the reason."""
    reason = F.when(
        F.col("_n") != 9, F.concat(F.lit("Expected 9 columns, got "), F.col("_n").cast("string"))
    ).when(F.col("_s").isNull() | F.col("_e").isNull(), F.lit("Start/End are not integers"))
    return _annotation_rows(lines).select("path", "ord", "value", reason.alias("reason")).where("reason is not null")


def scan_annotation(spark: SparkSession, path: str, fmt: str = "auto") -> DataFrame:
    return parse_annotation(read_lines(spark, path), annotation_format(path) if fmt == "auto" else fmt)


def record_ids(attrs: Column) -> dict[str, Column]:
    """Gene and transcript ids and types with their fallbacks; blanks are skipped."""
    return {
        "gene_id": first_nonblank(attrs["gene_id"], attrs["gene"], attrs["Parent"], attrs["ID"]),
        "transcript_id": first_nonblank(attrs["transcript_id"], attrs["transcript"], attrs["ID"], attrs["Parent"]),
        "gene_type": first_nonblank(attrs["gene_type"], attrs["gene_biotype"], attrs["biotype"]),
        "transcript_type": first_nonblank(attrs["transcript_type"], attrs["transcript_biotype"], attrs["biotype"]),
    }


def parse_bed(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """BED rows with at least 3 cells and integer coordinates; optional cells may be null."""
    parts = cells(F.col("value")) if sep == "\t" else words(F.col("value"))
    rows = with_cells(content(lines, "#", "track ", "browser "), "_c", parts).where(F.size("_c") >= 3)
    c = F.col("_c")
    return rows.select(
        "path", "ord", cell(c, 0).alias("chrom"), to_int(cell(c, 1)).alias("start"), to_int(cell(c, 2)).alias("end"),
        cell(c, 3).alias("name"), cell(c, 4).alias("score"), cell(c, 5).alias("strand"), c.alias("cells"),
    ).where("start is not null and `end` is not null")


def scan_bed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_bed(read_lines(spark, path))


def parse_bedgraph(lines: DataFrame) -> DataFrame:
    from locusframe.functions.values import to_float

    bed = parse_bed(lines)
    return bed.where(F.size("cells") == 4).select(
        "path", "ord", "chrom", "start", "end", to_float(F.col("name")).alias("value")
    ).where(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != float("inf")))
