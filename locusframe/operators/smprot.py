"""Small-protein records and their unique placement in transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.functions.values import normalize_chrom, to_int
from locusframe.operators.intervals import interval_join
from locusframe.session import materialize

MAPPING_TYPE = "entirely_within_unique_transcript"


def _keep(table: DataFrame) -> Column:
    start, end = to_int(F.col("start")), to_int(F.col("end"))
    return F.coalesce(
        (F.trim("chrom") != "") & (F.trim("protein_id") != "") & (start >= 0) & (end > start), F.lit(False))


def smprot_filter(table: DataFrame) -> DataFrame:
    """Usable protein rows with 0-based coordinates taken as they are."""
    def text(name: str, default: str) -> Column:
        if name not in table.columns:
            return F.lit(default)
        t = F.trim(F.coalesce(F.col(name), F.lit("")))
        return F.when(t == "", default).otherwise(t)

    return table.where(_keep(table)).select(
        normalize_chrom(F.col("chrom")).alias("chrom"), to_int(F.col("start")).alias("start"), to_int(F.col("end")).alias("end"),
        F.trim("protein_id").alias("protein_id"), text("evidence", "NA").alias("evidence"), text("source", "SmProt").alias("source"))


def smprot_filter_report(table: DataFrame) -> DataFrame:
    agg = table.agg(F.count_if(_keep(table)).alias("kept_records"), F.count_if(~_keep(table)).alias("skipped_records"))
    return agg.unpivot([], agg.columns, "metric", "value")


def contained_hits(features: DataFrame, proteins: DataFrame) -> DataFrame:
    """Proteins lying inside a feature other than gene and transcript."""
    useful = features.where(~F.col("feature_type").isin("gene", "transcript"))
    return interval_join(useful, proteins, short_side="right").where("start_b >= start and end_b <= `end`")


def place_proteins(features: DataFrame, proteins: DataFrame) -> DataFrame:
    """Contained hits of proteins whose hits touch exactly one transcript (``NA`` counts as one).

    Uniqueness is two mergeable aggregates per protein (smallest and largest transcript id), so a
    protein with very many hits is never gathered. The hits are written once, as both steps read them.
    """
    hits = materialize(contained_hits(features, proteins))
    unique = hits.groupBy("protein_id").agg(F.min("transcript_id").alias("lo"), F.max("transcript_id").alias("hi")).where("lo = hi")
    return hits.join(unique.select("protein_id"), "protein_id", "left_semi").select(
        "chrom", F.col("start_b").alias("start"), F.col("end_b").alias("end"), "protein_id", "evidence", "source",
        "transcript_id", "gene_id", "gene_type", "transcript_type", "strand",
        F.col("start").alias("transcript_start"), F.col("end").alias("transcript_end"), F.lit(MAPPING_TYPE).alias("mapping_type"))


def placement_metrics(placed: DataFrame) -> DataFrame:
    """Rows and distinct proteins, genes and transcripts (blanks not counted)."""
    def distinct(name: str) -> Column:
        return F.count_distinct(F.when(F.col(name) != "", F.col(name)))

    agg = placed.agg(
        F.count("*").alias("retained_rows"), distinct("protein_id").alias("retained_small_proteins"),
        distinct("gene_id").alias("retained_lncRNA_genes"), distinct("transcript_id").alias("retained_lncRNA_transcripts"))
    return agg.unpivot([], agg.columns, "metric", "value")
