"""Table-to-table format conversions as projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.functions.values import cell
from locusframe.operators.ordered import running
from locusframe.sources.lines import ord_block
from locusframe.sources.vcf import alt_text


def _join_ints(values: Column) -> Column:
    """``a,b,c,`` text of an integer array."""
    return F.concat(F.array_join(values, ","), F.lit(","))


def with_default_names(bed: DataFrame) -> DataFrame:
    """Missing names become ``feature_<n>`` with n the running record number in file order."""
    numbered = running(bed, ["path"], ["ord"], ord_block(), {"_n": ("sum", F.lit(1).cast("bigint"))})
    return numbered.withColumn("name", F.coalesce("name", F.concat(F.lit("feature_"), F.col("_n").cast("string")))).drop("_n")


def bed_to_gtf(bed: DataFrame, source: str = "bed", feature: str = "exon") -> DataFrame:
    b = with_default_names(bed)
    return b.select(
        "chrom", F.lit(source).alias("source"), F.lit(feature).alias("feature"), (F.col("start") + 1).alias("start"), "end",
        F.coalesce("score", F.lit(".")).alias("score"), F.coalesce("strand", F.lit(".")).alias("strand"), F.lit(".").alias("frame"),
        F.concat(F.lit('gene_id "'), "name", F.lit('"; transcript_id "'), "name", F.lit('";')).alias("attrs_text"))


def bed_to_bed12(bed: DataFrame, rgb: str = "0") -> DataFrame:
    return bed.select(
        "chrom", "start", "end", F.coalesce("name", F.lit(".")).alias("name"), F.coalesce("score", F.lit("0")).alias("score"),
        F.coalesce("strand", F.lit(".")).alias("strand"), F.col("start").alias("thick_start"), F.col("end").alias("thick_end"),
        F.lit(rgb).alias("rgb"), F.lit(1).alias("block_count"), F.concat((F.col("end") - F.col("start")).cast("string"), F.lit(",")).alias("block_sizes"),
        F.lit("0,").alias("block_starts"))


def bed_to_psl(bed: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Single-block alignments of intervals to themselves; without sizes the farthest end of a contig is its size."""
    b = with_default_names(bed)
    if sizes is None:
        sizes = bed.groupBy("chrom").agg(F.max("end").alias("size"))
    x = b.join(sizes.select("chrom", F.col("size").alias("_size")), "chrom", "left")
    n, zero = F.col("end") - F.col("start"), F.lit(0)
    return x.select(
        n.alias("matches"), *[zero.alias(c) for c in ("mismatches", "rep_matches", "n_count", "q_num_insert", "q_base_insert", "t_num_insert", "t_base_insert")],
        F.coalesce("strand", F.lit("+")).alias("strand"), F.col("name").alias("q_name"), n.alias("q_size"), zero.alias("q_start"), n.alias("q_end"),
        F.col("chrom").alias("t_name"), F.coalesce("_size", "end").alias("t_size"), F.col("start").alias("t_start"), F.col("end").alias("t_end"),
        F.lit(1).alias("block_count"), F.concat(n.cast("string"), F.lit(",")).alias("block_sizes"), F.lit("0,").alias("q_starts"),
        F.concat(F.col("start").cast("string"), F.lit(",")).alias("t_starts"))


def bedmethyl_to_bed(bed: DataFrame, coverage: bool = False, percent: bool = False) -> DataFrame:
    """First six cells of rows with at least six, optionally coverage and percent."""
    rows = bed.where(F.size("cells") >= 6)
    c = F.col("cells")
    more = ([cell(c, 9).alias("coverage")] if coverage else []) + ([cell(c, 10).alias("percent")] if percent else [])
    return rows.select("chrom", "start", "end", cell(c, 3).alias("mod_code"), cell(c, 4).alias("score"), cell(c, 5).alias("strand"), *more)


def annotation_to_bed(records: DataFrame) -> DataFrame:
    """Records as BED6 with the gene id (GTF) or ID (GFF3) as the name."""
    name = F.coalesce(F.col("attrs")["gene_id"], F.col("attrs")["ID"], F.lit("."))
    return records.select("chrom", (F.col("start") - 1).alias("start"), "end", name.alias("name"), "score", "strand", "source", "feature", "frame", "attrs_text")


def transcripts_to_bed12(records: DataFrame) -> DataFrame:
    """Exons folded into one BED12 row per transcript with the coding span as thick part."""
    from locusframe.operators.features import annotated_records

    rec = annotated_records(records).where("kind = 'exon' or feature = 'CDS'")
    is_exon = F.col("kind") == "exon"
    tx = rec.groupBy("chrom", "strand", "transcript_id").agg(
        F.array_sort(F.collect_set(F.when(is_exon, F.struct((F.col("start") - 1).alias("s"), F.col("end").alias("e"))))).alias("ex"),
        F.min(F.when(~is_exon, F.col("start") - 1)).alias("cs"), F.max(F.when(~is_exon, F.col("end"))).alias("ce")).where("size(ex) > 0")
    start, end = F.col("ex")[0]["s"], F.array_max(F.transform("ex", lambda x: x["e"]))
    return tx.select(
        "chrom", start.alias("start"), end.alias("end"), F.col("transcript_id").alias("name"), F.lit(0).alias("score"), "strand",
        F.coalesce("cs", start).alias("thick_start"), F.coalesce("ce", start).alias("thick_end"), F.lit("0").alias("rgb"),
        F.size("ex").alias("block_count"), _join_ints(F.transform("ex", lambda x: x["e"] - x["s"])).alias("block_sizes"),
        _join_ints(F.transform("ex", lambda x: x["s"] - start)).alias("block_starts"))


def vcf_to_bed(vcf: DataFrame) -> DataFrame:
    return vcf.select(
        "chrom", (F.col("pos") - 1).alias("start"), (F.col("pos") - 1 + F.length("ref")).alias("end"), F.col("id").alias("name"),
        F.col("qual").alias("score"), "ref", alt_text(F.col("alts")).alias("alt"), "filter", "info")


def bed_to_vcf(bed: DataFrame, ref: Column, alt: Column, info: Column) -> DataFrame:
    """Intervals as records; the expressions fill REF, ALT and INFO."""
    return bed.select(
        "chrom", (F.col("start") + 1).alias("pos"), F.coalesce("name", F.lit(".")).alias("id"), ref.alias("ref"), F.array(alt).alias("alts"),
        F.lit(".").alias("qual"), F.lit("PASS").alias("filter"), info.alias("info"))


def psl_to_bed(psl: DataFrame) -> DataFrame:
    """BED12 of the target side."""
    return psl.select(
        F.col("t_name").alias("chrom"), F.col("t_start").alias("start"), F.col("t_end").alias("end"), F.col("q_name").alias("name"),
        F.col("matches").alias("score"), F.substring("strand", 1, 1).alias("strand"), "block_count", _join_ints(F.col("block_sizes")).alias("block_sizes"),
        _join_ints(F.transform("t_starts", lambda s: s - F.col("t_start"))).alias("block_starts"))


def rmsk_to_bed(rmsk: DataFrame) -> DataFrame:
    return rmsk.select(
        F.col("query").alias("chrom"), (F.col("q_begin") - 1).alias("start"), F.col("q_end").alias("end"), F.col("repeat").alias("name"),
        "score", "strand", "class_family", "pct_div")


def rmsk_to_gff3(rmsk: DataFrame) -> DataFrame:
    return rmsk.select(
        F.col("query").alias("chrom"), F.lit("RepeatMasker").alias("source"), F.lit("dispersed_repeat").alias("feature"),
        F.col("q_begin").alias("start"), F.col("q_end").alias("end"), F.col("score").cast("string").alias("score"), "strand", F.lit(".").alias("frame"),
        F.concat(F.lit("Target="), "repeat", F.lit(" "), F.col("r_begin").cast("string"), F.lit(" "), F.col("r_end").cast("string")).alias("attrs_text"))


def genepred_exons(genepred: DataFrame) -> DataFrame:
    """One row per exon (0-based) with the number along the genome."""
    return genepred.select("name", "chrom", "strand", "cds_start", "cds_end", F.posexplode(F.arrays_zip("exon_starts", "exon_ends")).alias("i", "x")).select(
        "name", "chrom", "strand", "cds_start", "cds_end", (F.col("i") + 1).alias("exon_no"), F.col("x.exon_starts").alias("start"), F.col("x.exon_ends").alias("end"))


def genepred_to_bed12(genepred: DataFrame) -> DataFrame:
    return genepred.select(
        "chrom", F.col("tx_start").alias("start"), F.col("tx_end").alias("end"), "name", F.lit(0).alias("score"), "strand",
        F.col("cds_start").alias("thick_start"), F.col("cds_end").alias("thick_end"), F.lit("0").alias("rgb"), F.size("exon_starts").alias("block_count"),
        _join_ints(F.zip_with("exon_starts", "exon_ends", lambda s, e: e - s)).alias("block_sizes"),
        _join_ints(F.transform("exon_starts", lambda s: s - F.col("tx_start"))).alias("block_starts"))


def genepred_to_gtf(genepred: DataFrame, source: str = "genepred") -> DataFrame:
    """exon rows and, inside the coding span, CDS rows."""
    x = genepred_exons(genepred)
    attrs = F.concat(F.lit('gene_id "'), "name", F.lit('"; transcript_id "'), "name", F.lit('"; exon_number "'), F.col("exon_no").cast("string"), F.lit('";'))
    base = x.select("chrom", "strand", attrs.alias("attrs_text"), "start", "end", F.greatest("start", "cds_start").alias("cs"), F.least("end", "cds_end").alias("ce"))
    parts = F.filter(F.array(
        F.struct(F.lit("exon").alias("feature"), F.col("start").alias("s"), F.col("end").alias("e")),
        F.struct(F.lit("CDS").alias("feature"), F.col("cs").alias("s"), F.col("ce").alias("e"))), lambda p: p["s"] < p["e"])
    return base.select("chrom", "strand", "attrs_text", F.explode(parts).alias("p")).select(
        "chrom", F.lit(source).alias("source"), "p.feature", (F.col("p.s") + 1).alias("start"), F.col("p.e").alias("end"), F.lit(".").alias("score"),
        "strand", F.lit(".").alias("frame"), "attrs_text")


def annotation_to_genepred(records: DataFrame) -> DataFrame:
    b = transcripts_to_bed12(records)
    sizes = F.split(F.rtrim("block_sizes", F.lit(",")), ",")
    starts = F.split(F.rtrim("block_starts", F.lit(",")), ",")
    s = F.transform(starts, lambda x: x.cast("bigint") + F.col("start"))
    e = F.zip_with(starts, sizes, lambda o, n: o.cast("bigint") + F.col("start") + n.cast("bigint"))
    return b.select(
        "name", "chrom", "strand", F.col("start").alias("tx_start"), F.col("end").alias("tx_end"), F.col("thick_start").alias("cds_start"),
        F.col("thick_end").alias("cds_end"), F.col("block_count").alias("exon_count"), s.alias("exon_starts"), e.alias("exon_ends"))


def bed_to_genepred(bed12: DataFrame) -> DataFrame:
    """Rows of :func:`bed_to_bed12` layout as gene models."""
    starts = F.transform(F.split(F.rtrim("block_starts", F.lit(",")), ","), lambda x: x.cast("bigint") + F.col("start"))
    sizes = F.transform(F.split(F.rtrim("block_sizes", F.lit(",")), ","), lambda x: x.cast("bigint"))
    return bed12.select(
        "name", "chrom", "strand", F.col("start").alias("tx_start"), F.col("end").alias("tx_end"), F.col("thick_start").alias("cds_start"),
        F.col("thick_end").alias("cds_end"), F.col("block_count").alias("exon_count"), starts.alias("exon_starts"),
        F.zip_with(starts, sizes, lambda s, n: s + n).alias("exon_ends"))


def gff3_to_gtf(records: DataFrame) -> DataFrame:
    """GFF3 records with gene and transcript ids spelled the GTF way; other attributes follow."""
    from locusframe.operators.features import annotated_records

    rec = annotated_records(records, resolve_parents=True)
    rest = F.filter(F.map_entries("attrs"), lambda e: ~e["key"].isin("ID", "Parent", "gene_id", "transcript_id"))
    extra = F.transform(F.array_sort(rest), lambda e: F.concat(e["key"], F.lit(' "'), e["value"], F.lit('";')))
    head = F.array(F.concat(F.lit('gene_id "'), "gene_id", F.lit('";')), F.concat(F.lit('transcript_id "'), "transcript_id", F.lit('";')))
    return rec.select("chrom", "source", F.col("kind").alias("feature"), "start", "end", "score", "strand", "frame",
                      F.array_join(F.concat(head, extra), " ").alias("attrs_text"))


def gtf_to_gff3(records: DataFrame) -> DataFrame:
    """GTF records with ID and Parent built from the gene and transcript ids."""
    from locusframe.operators.features import annotated_records

    rec = annotated_records(records)
    g, t = F.col("gene_id"), F.col("transcript_id")
    link = F.when(F.col("kind") == "gene", F.concat(F.lit("ID="), g)).when(
        F.col("kind") == "transcript", F.concat(F.lit("ID="), t, F.lit(";Parent="), g)).otherwise(F.concat(F.lit("Parent="), t))
    rest = F.filter(F.map_entries("attrs"), lambda e: ~e["key"].isin("ID", "Parent"))
    extra = F.transform(F.array_sort(rest), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return rec.select("chrom", "source", F.col("kind").alias("feature"), "start", "end", "score", "strand", "frame",
                      F.array_join(F.concat(F.array(link), extra), ";").alias("attrs_text"))


def bed_to_gff3(bed: DataFrame, source: str = "bed", feature: str = "region") -> DataFrame:
    b = with_default_names(bed)
    return b.select(
        "chrom", F.lit(source).alias("source"), F.lit(feature).alias("feature"), (F.col("start") + 1).alias("start"), "end",
        F.coalesce("score", F.lit(".")).alias("score"), F.coalesce("strand", F.lit(".")).alias("strand"), F.lit(".").alias("frame"),
        F.concat(F.lit("ID="), "name", F.lit(";Name="), "name").alias("attrs_text"))
