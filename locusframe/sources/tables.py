"""Header tables whose columns go by several names, and headerless analysis tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.functions.values import cell, cells, to_float, to_int, words
from locusframe.sources.lines import content, line_order, read_lines

# Accepted header names per canonical column, in order of preference.
COSMIC_COLUMNS = {
    "chrom": ["chrom", "chr", "chromosome"],
    "pos": ["pos", "position", "genome_position", "start"],
    "ref": ["ref", "reference", "ref_allele"],
    "alt": ["alt", "alternate", "alt_allele", "mutation_allele"],
    "cosmic_id": ["cosmic_id", "mutation_id", "mutation id", "mutationid"],
    "fathmm_mkl_score": ["fathmm_mkl_score", "fathmm score", "fathmm_mkl"],
    "disease_name": ["disease_name", "primary_histology", "histology", "tumour_type", "disease"],
}
GWAS_COLUMNS = {
    "chrom": ["chrom", "chr", "chromosome", "chr_id"],
    "pos": ["pos", "position", "base_pair_location", "bp", "start", "chr_pos"],
    "ref": ["ref", "reference", "reference_allele", "other_allele"],
    "alt": ["alt", "alternate", "alt_allele", "risk_allele", "effect_allele", "strongest_snp_risk_allele"],
    "variant_id": ["variant_id", "rsid", "snp", "snps", "markername", "snp_id_current"],
    "p_value": ["p_value", "pvalue"],
    "trait_name": ["trait_name", "disease_trait", "trait", "mapped_trait", "disease/trait"],
    "mapped_trait": ["mapped_trait"],
    "mapped_trait_uri": ["mapped_trait_uri"],
    "risk_allele_frequency": ["risk_allele_frequency"],
    "or_or_beta": ["or_or_beta"],
    "ci_95_text": ["95%_ci_(text)", "ci", "confidence_interval", "95_ci_text"],
}
SMPROT_COLUMNS = {
    "chrom": ["chrom", "chr", "chromosome"],
    "start": ["start", "chromstart", "tx_start", "pos", "begin"],
    "end": ["end", "chromend", "tx_end", "stop"],
    "protein_id": ["protein_id", "smprot_id", "smprotid", "proteinid", "id", "protein"],
    "evidence": ["evidence", "evidence_type", "support", "support_evidence"],
    "source": ["source", "dataset", "source_db"],
}
BLOCK_COLUMNS = ["chromosome", "chromstart", "chromend", "ids", "strand", "blockcount", "blocksizes", "blockstarts"]


def header_places(lines: DataFrame, accepted: Mapping[str, Sequence[str]], spaces: bool = True) -> DataFrame:
    """One row per file: path, its header line, whether tabs cut it, and per canonical column its place (from 1) or null.

    The first line with text is the header. Its cells are trimmed, lower-cased, ``-`` (and blanks when ``spaces``) become ``_``. The
    first accepted name present wins; of two equal cells the later one.
    """
    first = content(lines).groupBy("path").agg(F.min(F.struct("ord", "value")).alias("h")).select("path", F.col("h.ord").alias("head_ord"), F.col("h.value").alias("head"))
    by_tab = F.contains("head", F.lit("\t"))
    plain = lambda x: F.translate(F.lower(F.regexp_replace(x, r'^[\s"]+|[\s"]+$', "")), "- " if spaces else "-", "__" if spaces else "_")
    named = first.select("*", by_tab.alias("by_tab"), F.transform(F.when(by_tab, cells(F.col("head"))).otherwise(words(F.col("head"))), plain).alias("names"))
    at = lambda n: F.when(F.array_contains("names", n), F.size("names") - F.array_position(F.reverse("names"), n).cast("int") + 1)
    return named.select("path", "head_ord", "head", "by_tab", F.size("names").alias("width"), *[F.coalesce(*map(at, names)).alias(c) for c, names in accepted.items()])


def parse_header_tables(lines: DataFrame, accepted: Mapping[str, Sequence[str]], required: Sequence[str], spaces: bool = True, trim: bool = False) -> DataFrame:
    """(path, ord, canonical columns as text) of tables that each have a header of their own, in any column order.

    A file without tabs in its header is cut at white space, others at tabs, with double quotes around cells as usual.
    Missing cells, and columns that only other files have, are empty; columns no file has are left out. A required column that some
    file lacks is an error. All files are read together: once for what columns there are, once for the headers, which are joined back by
    path, and once for the rows.
    """
    heads = header_places(lines, accepted, spaces)
    facts = heads.agg(
        F.max("width").alias("width"), F.count(F.lit(1)).alias("files"), *[F.count(c).alias(f"n_{c}") for c in accepted]).first()
    missing = [c for c in required if facts[f"n_{c}"] < facts["files"]]
    if missing or not facts["files"]:
        raise ValueError("missing required columns: " + ", ".join(missing or required))
    wide = ", ".join(f"c{i} string" for i in range(facts["width"]))
    cut = F.from_csv("value", wide, {"sep": "\t", "quote": '"', "escape": '"', "nullValue": "\u0001", "emptyValue": ""})
    by_tab = F.array(*[cut[f"c{i}"] for i in range(facts["width"])])
    joined = content(lines).join(F.broadcast(heads) if facts["files"] <= 100_000 else heads, "path").where("ord > head_ord and value <> head")
    rows = joined.withColumn("_c", F.when(F.col("by_tab"), by_tab).otherwise(words(F.col("value"))))
    value = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.try_element_at("_c", F.col(c))), F.lit(""))
    return rows.select("path", "ord", *[(F.trim(value(c)) if trim else value(c)).alias(c) for c in accepted if facts[f"n_{c}"]])


def scan_cosmic(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_header_tables(read_lines(spark, path), COSMIC_COLUMNS, list(COSMIC_COLUMNS), spaces=False).drop("path", "ord")


def scan_gwas(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_header_tables(read_lines(spark, path), GWAS_COLUMNS, ["chrom", "pos", "variant_id", "p_value", "trait_name"]).drop("path", "ord")


SMPROT_REQUIRED = ["chrom", "start", "end", "protein_id"]


def parse_smprot(lines: DataFrame) -> DataFrame:
    """Small proteins of any number of files, each tab or white-space separated with its own header; adds ``origin_file``."""
    return parse_header_tables(lines, SMPROT_COLUMNS, SMPROT_REQUIRED, trim=True).withColumn("origin_file", F.regexp_extract("path", r"([^/]*)$", 1)).drop("path", "ord")


def scan_smprot(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_smprot(read_lines(spark, path))


def parse_sites(lines: DataFrame, value_index: int) -> DataFrame:
    """Methylation BED: the value is the chosen cell, else the last numeric cell, else 0."""
    c = F.col("_c")
    numbers = F.filter(F.transform(c, to_float), lambda v: v.isNotNull())
    value = F.coalesce(to_float(cell(c, value_index)), F.try_element_at(numbers, F.lit(-1)), F.lit(0.0))
    return lines.withColumn("_c", cells(F.col("value"))).where(F.size("_c") >= 3).select(
        "path", cell(c, 0).alias("chrom"), to_int(cell(c, 1)).alias("start"), to_int(cell(c, 2)).alias("end"), value.alias("value")
    ).where("start is not null and `end` is not null")


def parse_bismark(lines: DataFrame) -> DataFrame:
    """CpG report rows: rate = methylated / (methylated + unmethylated), 0 without reads."""
    c = F.col("_c")
    rows = lines.withColumn("_c", cells(F.col("value"))).where(F.size("_c") >= 5).select(
        "path", cell(c, 0).alias("chrom"), to_int(cell(c, 1)).alias("pos"), to_int(cell(c, 3)).alias("meth"), to_int(cell(c, 4)).alias("unmeth")
    ).where("pos is not null and meth is not null and unmeth is not null")
    total = F.col("meth") + F.col("unmeth")
    return rows.select(
        "path", "chrom", (F.col("pos") - 1).alias("start"), F.col("pos").alias("end"),
        F.when(total != 0, F.col("meth") / total).otherwise(0.0).alias("value"))


def sample_stem(path_or_name):
    """Sample name of a methylation file: folder and the first known ending removed."""
    name = F.regexp_extract(path_or_name, r"([^/]*)$", 1)
    return F.regexp_replace(name, r"(_CpG_report\.txt|\.CpG_report\.txt|\.txt|\.bed)$", "")


def parse_gene_regions(lines: DataFrame, files: Sequence[str] | None = None) -> DataFrame:
    """gene, contig, start, end (1-based closed) as half-open; the last line of a gene wins, in the last of several files."""
    c = F.col("_c")
    rows = lines.withColumn("_c", cells(F.col("value"))).where(F.size("_c") >= 4).select(
        line_order(files).alias("at"), cell(c, 0).alias("gene_id"), cell(c, 1).alias("chrom"), to_int(cell(c, 2)).alias("s"), to_int(cell(c, 3)).alias("end")
    ).where("s is not null and `end` is not null")
    last = rows.groupBy("gene_id").agg(F.max_by(F.struct("chrom", "s", "end"), "at").alias("r"))
    return last.select("gene_id", "r.chrom", (F.col("r.s") - 1).alias("start"), "r.end")


def parse_chrom_sizes(lines: DataFrame) -> DataFrame:
    c = F.col("_c")
    return content(lines, "#").withColumn("_c", F.split(F.trim("value"), r"[\t ]+")).where(F.size("_c") >= 2).select(
        cell(c, 0).alias("chrom"), to_int(cell(c, 1)).alias("size")).where("size is not null")


def parse_hits(lines: DataFrame, tool: str) -> DataFrame:
    """Target-prediction rows of one tool in the common six columns; ``-`` means not reported."""
    c = F.col("_c")
    dash = F.lit("-")
    least, picks = {
        "miranda": (6, [F.ltrim(cell(c, 0), F.lit(">")), cell(c, 1), cell(c, 2), cell(c, 3), cell(c, 4), cell(c, 5)]),
        "targetscan": (4, [cell(c, 1), cell(c, 0), dash, dash, cell(c, 2), cell(c, 3)]),
        "rnahybrid": (5, [cell(c, 0), cell(c, 1), dash, cell(c, 4), cell(c, 2), cell(c, 3)]),
        "normalized": (6, [cell(c, 0), cell(c, 1), cell(c, 2), cell(c, 3), cell(c, 4), cell(c, 5)]),
    }[tool]
    mirna, target, score, energy, start, end = picks
    return lines.withColumn("_c", cells(F.col("value"))).where(F.size("_c") >= least).select(
        mirna.alias("mirna"), target.alias("target"), score.alias("score"), energy.alias("energy"),
        to_int(start).alias("start"), to_int(end).alias("end"))


def parse_miranda_raw(lines: DataFrame) -> DataFrame:
    """miRanda hit lines (``>`` and at least 10 cells); the site is in cells 9 and 10."""
    c = F.col("_c")
    return lines.where(F.col("value").startswith(">")).withColumn("_c", cells(F.col("value"))).where(
        F.size("_c") >= 10
    ).select(F.ltrim(cell(c, 0), F.lit(">")).alias("mirna"), cell(c, 1).alias("target"), cell(c, 2).alias("score"), cell(c, 3).alias("energy"),
             to_int(cell(c, 8)).alias("start"), to_int(cell(c, 9)).alias("end"))


def parse_rnahybrid_blocks(blocks: DataFrame, cutoff: float) -> DataFrame:
    """Blocks cut at ``target:``; the site starts after the position line and is as long as the alignment."""
    c = F.split(F.col("value"), r"\r?\n")

    def after_colon(i: int):
        text = cell(c, i)
        at = F.instr(text, ":")
        return F.when(at > 0, F.trim(F.substring(text, at + 1, F.length(text))))

    position = cell(F.filter(F.split(F.trim(cell(c, 8)), r"\s+"), lambda w: w != ""), 1)
    start = to_int(position) + 1
    out = blocks.select(
        after_colon(2).alias("mirna"), F.trim(cell(c, 0)).alias("target"), start.alias("start"),
        (start + F.length(F.trim(cell(c, 10))) - 1).alias("end"),
        F.split(after_colon(5), r"\s+")[0].alias("energy"), to_float(after_colon(6)).alias("p_value"))
    return out.where(F.col("p_value") < cutoff).dropna()


def parse_block_table(lines: DataFrame, files: Sequence[str] | None = None) -> DataFrame:
    """Headerless 8-column block table; the last line of an id wins, in the last of several files."""
    from locusframe.functions.values import int_list, to_int_lenient

    c = F.col("_c")
    rows = content(lines).withColumn("_c", cells(F.col("value"))).select(
        line_order(files).alias("at"), cell(c, 3, "").alias("ids"), cell(c, 0, "").alias("chrom"),
        to_int_lenient(cell(c, 1, "")).alias("start"), to_int_lenient(cell(c, 2, "")).alias("end"),
        F.when(cell(c, 4, "") == "", ".").otherwise(cell(c, 4, "")).alias("strand"),
        int_list(cell(c, 6, "")).alias("sizes"), int_list(cell(c, 7, "")).alias("starts"))
    last = rows.groupBy("ids").agg(F.max_by(F.struct("chrom", "start", "end", "strand", "sizes", "starts"), "at").alias("r"))
    return last.select("ids", "r.*")
