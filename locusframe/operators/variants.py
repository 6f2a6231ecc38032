"""Variant filters, annotation joins, summaries and the VCF toolbox."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.functions import variant as V
from locusframe.functions.values import normalize_chrom, to_float, to_int, with_cells
from locusframe.operators.intervals import interval_join
from locusframe.session import materialize
from locusframe.sources.vcf import alt_text

COSMIC_MIN_SCORE = 0.7
GWAS_MAX_P = 5e-8
GWAS_LABEL = "Genome-wide significant"
CLINICAL_LABEL_ORDER = ["Pathogenic", "Benign", "Affects", "Drug response", "Protective", "Risk factor"]
# Bin sizes 2**11 and 2**20: exons and introns meet few variants beside their own.
ANNOTATION_BINS = (11, 20)
FEATURE_TYPE_ORDER = ["CDS", "5UTR", "3UTR", "exon", "intron", "gene", "transcript"]


def _span(pos: Column, ref: Column) -> tuple[Column, Column]:
    return pos - 1, pos - 1 + F.greatest(F.lit(1), F.length(ref))


def _trimmed(name: str, df: DataFrame, default: str) -> Column:
    if name not in df.columns:
        return F.lit(default)
    text = F.trim(F.coalesce(F.col(name), F.lit("")))
    return F.when(text == "", F.lit(default)).otherwise(text)


def clinvar_filter(vcf: DataFrame) -> DataFrame:
    """Variants with at least one clinical label; labels joined by a pipe."""
    # generators, so that neither the condition nor the columns that share a text cut it out again
    significance = V.plain_significance(F.coalesce(V.info_last(F.col("info"), "CLNSIG"), F.lit("")))
    marked = vcf.select("chrom", "pos", "id", "ref", "alts", "info", F.explode(F.array(significance)).alias("_plain")).where(V.has_clinical_label(F.col("_plain")))
    shared = {"chrom": normalize_chrom(F.col("chrom")), "alt": alt_text(F.col("alts")), "rs": F.trim(F.coalesce(V.info_last(F.col("info"), "RS"), F.lit("")))}
    rows = marked.select("pos", "id", "ref", "info", V.plain_labels(F.col("_plain")).alias("labels"),
                         F.inline(F.array(F.struct(*[c.alias(f"_{n}") for n, c in shared.items()]))))
    chrom, alt, rs, vid = F.col("_chrom"), F.col("_alt"), F.col("_rs"), F.col("id")
    start, end = _span(F.col("pos"), F.col("ref"))
    return rows.select(
        chrom.alias("chrom"), start.alias("start"), end.alias("end"),
        F.when(vid.isin("", "."), F.concat_ws(":", chrom, F.col("pos").cast("string"), F.col("ref"), alt)).otherwise(vid).alias("variant_id"),
        F.array_join("labels", "|").alias("clinical_labels"),
        F.coalesce(V.info_last(F.col("info"), "ALLELEID"), F.lit("NA")).alias("allele_id"),
        F.coalesce(V.info_last(F.col("info"), "CLNDN"), F.lit("NA")).alias("disease_name"),
        V.variant_name(chrom, F.col("pos"), F.col("ref"), alt).alias("variant_name"),
        F.when(F.lower(vid).startswith("rs"), vid).when(rs != "", F.concat(F.lit("rs"), rs)).otherwise("NA").alias("dbsnp_id"))


def label_counts(kept: DataFrame, labels: Sequence[str], column: str = "clinical_labels") -> DataFrame:
    """Metric table: kept rows and rows per label."""
    parts = F.split(F.col(column), r"\|")
    agg = kept.agg(
        F.count("*").alias("kept_variants"),
        *[F.count_if(F.array_contains(parts, l)).alias("label_" + l.replace(" ", "_")) for l in labels])
    return agg.unpivot([], agg.columns, "metric", "value")


def cosmic_filter(table: DataFrame, min_score: float = COSMIC_MIN_SCORE) -> DataFrame:
    """COSMIC rows scored above the threshold (a ``nan`` score is not below it and stays)."""
    text = F.trim("fathmm_mkl_score")
    score = F.when(~text.isin("", ".", "NA"), to_float(text))
    rows = table.withColumn("_score", score).where(F.col("_score") > min_score)
    chrom, pos = normalize_chrom(F.col("chrom")), to_int(F.col("pos"))
    ref, alt = _trimmed("ref", table, "N"), _trimmed("alt", table, ".")
    start, end = _span(pos, ref)
    cid = F.trim(F.coalesce(F.col("cosmic_id"), F.lit("")))
    cid = F.when(cid == "", F.concat_ws(":", chrom, pos.cast("string"), ref, alt)).otherwise(cid)
    return rows.where(pos.isNotNull()).select(
        chrom.alias("chrom"), start.alias("start"), end.alias("end"), cid.alias("variant_id"),
        F.lit("Pathogenic").alias("clinical_labels"), cid.alias("cosmic_id"),
        _trimmed("disease_name", table, "NA").alias("disease_name"), F.col("_score").alias("fathmm_mkl_score"))


def risk_allele(text: Column) -> Column:
    """Text after the last ``-`` when there is any, ``.`` when blank."""
    value = F.trim(text)
    tail = F.trim(F.substring_index(value, "-", -1))
    return F.when(value == "", ".").when(value.contains("-") & (tail != ""), tail).otherwise(value)


def first_listed(text: Column) -> Column:
    head = F.trim(F.substring_index(text, ",", 1))
    return F.when(head == "", "NA").otherwise(head)


def trait_ontology_id(uri: Column) -> Column:
    """Last path piece of the first listed address."""
    head = first_listed(uri)
    tail = F.substring_index(F.rtrim(head, F.lit("/")), "/", -1)
    return F.when((head == "NA") | (tail == ""), "NA").otherwise(tail)


def gwas_filter(table: DataFrame, max_p: float = GWAS_MAX_P) -> DataFrame:
    """Genome-wide significant associations; a ``nan`` p-value is not above the threshold and stays."""
    p = to_float(F.col("p_value"))
    chrom_raw, pos = F.trim("chrom"), to_int(F.col("pos"))
    rows = table.where(((p < max_p) | F.isnan(p)) & (chrom_raw != "") & pos.isNotNull())
    chrom = normalize_chrom(chrom_raw)
    ref = F.trim("ref") if "ref" in table.columns else F.lit("N")
    alt = risk_allele(F.col("alt")) if "alt" in table.columns else F.lit(".")
    start, end = _span(pos, ref)
    vid = F.trim("variant_id")
    vid = F.when(vid == "", F.concat_ws(":", chrom, pos.cast("string"), ref, alt)).otherwise(vid)
    return rows.select(
        chrom.alias("chrom"), start.alias("start"), end.alias("end"), vid.alias("variant_id"),
        F.lit(GWAS_LABEL).alias("association_label"), vid.alias("gwas_variant_id"),
        _trimmed("trait_name", table, "NA").alias("trait_name"), p.alias("p_value"), F.lit("NA").alias("allele_id"),
        first_listed(_trimmed("mapped_trait", table, "NA")).alias("efo_trait"),
        trait_ontology_id(_trimmed("mapped_trait_uri", table, "NA")).alias("efo_id"),
        _trimmed("risk_allele_frequency", table, "NA").alias("risk_allele_frequency"),
        _trimmed("or_or_beta", table, "NA").alias("or_or_beta"),
        _trimmed("ci_95_text", table, "NA").alias("ci_95_text"))


def annotate(features: DataFrame, variants: DataFrame, extra: Sequence[str]) -> DataFrame:
    """Variants on features: one row per overlap with the feature's 1-based coordinates.

    gene and transcript features are dropped; the filter sits below the join.
    """
    useful = features.where(~F.col("feature_type").isin("gene", "transcript"))
    hits = interval_join(useful, variants, short_side="right", classes=ANNOTATION_BINS)
    return hits.select(
        "chrom", (F.col("start") + 1).alias("start"), "end", "feature_type", "feature_id", "gene_id", "transcript_id",
        "gene_type", "transcript_type", "strand", *extra)


def annotate_clinvar(features: DataFrame, variants: DataFrame) -> DataFrame:
    return annotate(features, variants, [
        "variant_id", "variant_name", "dbsnp_id", "clinical_labels", "allele_id", "disease_name"])


def annotate_cosmic(features: DataFrame, variants: DataFrame) -> DataFrame:
    return annotate(features, variants, ["variant_id", "clinical_labels", "cosmic_id", "disease_name", "fathmm_mkl_score"])


def annotate_gwas(features: DataFrame, variants: DataFrame) -> DataFrame:
    return annotate(features, variants, [
        "variant_id", "association_label", "gwas_variant_id", "allele_id", "trait_name", "efo_trait", "efo_id", "p_value",
        "risk_allele_frequency", "or_or_beta", "ci_95_text"])


def _equals(label: str):
    return lambda x: x == label


def summarize_annotations(annotations: DataFrame, labels: Sequence[str] = CLINICAL_LABEL_ORDER, column: str = "clinical_labels") -> DataFrame:
    """Rows per feature type and label, absent labels as zero; ``rank`` orders the report."""
    parts = F.split(F.col(column), r"\|")
    wide = annotations.groupBy("feature_type").agg(
        F.count("*").alias("ALL"),
        *[F.sum(F.size(F.filter(parts, _equals(l)))).alias(l) for l in labels])
    names = ["ALL", *labels]
    cells = F.array(*[F.struct(
        F.lit(i).alias("label_rank"), F.lit(n).alias("label"), F.coalesce(F.col(f"`{n}`"), F.lit(0)).cast("bigint").alias("count"))
        for i, n in enumerate(names)])
    order = F.array_position(F.array(*[F.lit(x) for x in FEATURE_TYPE_ORDER]), F.col("feature_type"))
    feature_rank = F.when(order > 0, order).otherwise(len(FEATURE_TYPE_ORDER) + 1).cast("int")
    return wide.select("feature_type", feature_rank.alias("feature_rank"), F.explode(cells).alias("c")).select(
        "feature_type", "c.label", "c.count", "feature_rank", "c.label_rank")


def summarize_gwas(annotations: DataFrame) -> DataFrame:
    return summarize_annotations(annotations, [GWAS_LABEL], "association_label")


# ---- VCF toolbox ----------------------------------------------------------------------------

REGION = re.compile(r"^([^:]+)(?::([0-9,]+)-([0-9,]+))?$")


def parse_region(text: str) -> tuple[str, int | None, int | None]:
    m = REGION.match(text.strip())
    if not m:
        raise ValueError(f"not a region: {text!r}")
    chrom, a, b = m.groups()
    return chrom, int(a.replace(",", "")) if a else None, int(b.replace(",", "")) if b else None


def in_regions(regions: Sequence[str]) -> Column:
    """Position test against a written list of regions (1-based inclusive)."""
    hit = F.lit(False)
    for chrom, a, b in map(parse_region, regions):
        one = F.col("chrom") == chrom
        hit = hit | (one if a is None else one & F.col("pos").between(a, b))
    return hit


def vcf_filter_reason(
    regions: Sequence[str] = (), min_qual: float | None = None, min_dp: int | None = None,
    keep_types: Sequence[str] = (), require_pass: bool = False,
) -> Column:
    """First failing check (region, qual, depth, type, filter) or null when the record is kept."""
    reason = F.when(F.lit(False), F.lit(""))
    if regions:
        reason = reason.when(~in_regions(regions), "region")
    if min_qual is not None:
        qual = to_float(F.col("qual"))
        reason = reason.when(qual.isNull() | (qual < min_qual), "qual")
    if min_dp is not None:
        depth = to_int(V.info_first(F.col("info"), "DP"))
        reason = reason.when(depth.isNull() | (depth < min_dp), "depth")
    if keep_types:
        types = V.allele_types(F.col("ref"), F.col("alts"))
        reason = reason.when(~F.arrays_overlap(types, F.array(*[F.lit(t) for t in keep_types])), "type")
    if require_pass:
        reason = reason.when(F.col("filter") != "PASS", "filter")
    return reason


def vcf_filter(vcf: DataFrame, **checks) -> DataFrame:
    return vcf.where(vcf_filter_reason(**checks).isNull())


def vcf_filter_report(vcf: DataFrame, **checks) -> DataFrame:
    return vcf.groupBy(F.coalesce(vcf_filter_reason(**checks), F.lit("kept")).alias("outcome")).agg(F.count("*").alias("n"))


def vcf_region_filter(vcf: DataFrame, regions: DataFrame) -> DataFrame:
    """Records whose position lies in any region of a table (chrom, start, end 0-based)."""
    from locusframe.operators.intervals import merge_intervals

    point = vcf.withColumns({"_s": F.col("pos") - 1, "_e": F.col("pos")})
    hits = interval_join(merge_intervals(regions), point, right_span=("_s", "_e"), short_side="right")
    return hits.select(*vcf.columns)


def vcf_query(vcf: DataFrame, info_keys: Sequence[str], format_keys: Sequence[str] = (), samples: Sequence[str] = ()) -> DataFrame:
    """Columns from INFO and, per named sample, from FORMAT; missing values are ``.``."""
    cols = [V.info_first(F.col("info"), k) for k in info_keys]
    out = [F.coalesce(c, F.lit(".")).alias(k) for c, k in zip(cols, info_keys)]
    for i, s in enumerate(samples):
        for k in format_keys:
            at = F.array_position("formats", k).cast("int")
            text = F.split(F.try_element_at("samples", F.lit(i + 1)), ":", -1)
            value = F.when(at > 0, F.try_element_at(text, at))
            out.append(F.coalesce(value, F.lit(".")).alias(f"{s}_{k}"))
    return vcf.select("chrom", "pos", "id", "ref", alt_text(F.col("alts")).alias("alt"), *out)


def extract_variants(gvcf: DataFrame) -> DataFrame:
    """Records of a gVCF with at least one real alternate allele."""
    return gvcf.where(F.exists("alts", lambda a: ~a.isin(".", "<NON_REF>", "<*>")))


def header_numbers(meta: DataFrame) -> DataFrame:
    """One row per file: path and the header Numbers by field id of INFO and of FORMAT, the last line of an id winning."""
    def numbers(kind: str) -> Column:
        lines = F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("ord", "id", "number"))))
        return F.map_from_entries(F.transform(lines, lambda x: F.struct(x["id"], x["number"])))

    stated = meta.where(F.col("kind").isin("INFO", "FORMAT") & F.col("id").isNotNull() & F.col("number").isNotNull())
    return stated.groupBy("path").agg(numbers("INFO").alias("info_numbers"), numbers("FORMAT").alias("format_numbers"))


def normalize_alleles(vcf: DataFrame, meta: DataFrame) -> DataFrame:
    """One row per alternate allele for multiallelic records; others pass unchanged.

    INFO and FORMAT values are cut by the Number that the header of the record's own file states, genotypes are recoded and diploid
    Number=G values subset; ``kept_genotype_fields`` counts G fields left whole. Headers are written as a small table, so
    that Spark broadcasts it by its size, or splits the records of a large file where it is too big for that.
    """
    numbers = materialize(header_numbers(meta))
    several = F.size("alts") > 1
    rows = vcf.join(numbers, "path", "left").select("*", F.size("alts").alias("_n"), F.posexplode_outer(F.when(several, F.col("alts"))).alias("_i", "_alt"))
    several, i, n, formats = F.col("_n") > 1, F.col("_i"), F.col("_n"), F.col("formats")
    items = F.transform(V.info_items(F.col("info")), lambda x: F.struct(x["k"].alias("k"), F.when(
        x["v"].isNotNull(), V.pick_for_allele(x["v"], F.try_element_at("info_numbers", x["k"]), i, n)).alias("v")))

    def values_of(sample: Column) -> Column:
        v = F.split(sample, ":", -1)
        pad = F.array_repeat(F.lit("."), F.greatest(F.size(formats) - F.size(v), F.lit(0)))
        return F.slice(F.concat(v, pad), 1, F.greatest(F.size(formats), F.lit(1)))

    def field(name: Column, value: Column) -> Column:
        number = F.try_element_at("format_numbers", name)
        picked = (
            F.when(name == "GT", V.recode_genotype(value, i))
            .when(value.isin(".", ""), value)
            .when(number == "G", V.pick_genotype_values(value, n, i))
            .otherwise(V.pick_for_allele(value, number, i, n)))
        return F.struct(picked.alias("picked"), value.alias("whole"))

    # per sample and field the value of the allele, null where a G field is not diploid and stays whole
    cut = several & (F.size("formats") > 0)
    rows = rows.withColumn("_cells", F.when(cut, F.transform("samples", lambda s: F.zip_with(formats, values_of(s), field))))
    texts = F.transform("_cells", lambda s: F.array_join(F.transform(s, lambda x: F.coalesce(x["picked"], x["whole"])), ":"))
    kept = F.aggregate("_cells", F.lit(0), lambda a, s: a + F.size(F.filter(s, lambda x: x["picked"].isNull())))
    return rows.withColumns({
        "info": F.when(several, V.info_text(items)).otherwise(F.col("info")), "samples": F.coalesce(texts, "samples"),
        "kept_genotype_fields": F.coalesce(kept, F.lit(0)), "alts": F.when(several, F.array("_alt")).otherwise(F.col("alts")),
    }).select(*vcf.columns, "kept_genotype_fields")


def contig_ranks(vcf: DataFrame, explicit: Sequence[str] | None = None, meta: DataFrame | None = None) -> DataFrame:
    """Contig order: an explicit list or the header's contigs, then contigs by first appearance."""
    names: list[str] = list(dict.fromkeys(explicit or []))
    if not names and meta is not None:
        rows = meta.where("kind = 'contig' and id is not null").orderBy("ord").select("id").collect()
        names = list(dict.fromkeys(r.id for r in rows))
    seen = vcf.groupBy("chrom").agg(F.min("ord").alias("first"))
    listed = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    at = F.array_position(listed, F.col("chrom"))
    return seen.select("chrom", F.when(at > 0, F.struct(F.lit(0).alias("g"), at.cast("bigint").alias("n"))).otherwise(
        F.struct(F.lit(1).alias("g"), F.col("first").alias("n"))).alias("rank"))


def sort_vcf(vcf: DataFrame, explicit: Sequence[str] | None = None, meta: DataFrame | None = None) -> DataFrame:
    """Stable sort by contig rank and position."""
    ranks = contig_ranks(vcf, explicit, meta)
    return vcf.join(ranks, "chrom").orderBy("rank", "pos", "ord").select(*vcf.columns)


def _of_type(kind: str):
    return lambda x: x["t"] == kind


def vcf_statistics(vcf: DataFrame) -> DataFrame:
    """Metric table: records, alleles by type, transitions and transversions, records per contig."""
    alleles = F.transform("alts", lambda a: F.struct(V.allele_type(F.col("ref"), a).alias("t"), V.is_transition(F.col("ref"), a).alias("ts")))

    def n(test) -> Column:
        return F.sum(F.size(F.filter("_a", test)))

    total = vcf.withColumn("_a", alleles).agg(
        F.count("*").alias("records"), F.count_if(F.col("filter") == "PASS").alias("records_pass"),
        F.count_if(F.size("alts") == 0).alias("records_no_alt"), F.count_if(F.size("alts") > 1).alias("records_multiallelic"),
        F.sum(F.size("alts")).alias("alt_alleles"),
        *[n(_of_type(t)).alias(f"alleles_{t}") for t in ("snv", "mnv", "indel", "other")],
        n(lambda x: (x["t"] == "snv") & x["ts"]).alias("transitions"),
        n(lambda x: (x["t"] == "snv") & ~x["ts"]).alias("transversions"))
    ratio = F.when(F.col("transversions") > 0, F.format_string("%.3f", F.col("transitions") / F.col("transversions"))).otherwise("NA")
    text = total.withColumn("ts_tv_ratio", ratio).select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("0")).alias(c) for c in total.columns], "ts_tv_ratio")
    per_contig = vcf.groupBy("chrom").agg(F.count("*").alias("n")).select(
        F.concat(F.lit("contig."), F.col("chrom")).alias("metric"), F.col("n").cast("string").alias("value"))
    return text.unpivot([], text.columns, "metric", "value").unionByName(per_contig)


def genotype_table(vcf: DataFrame, samples: Sequence[str]) -> DataFrame:
    """One row per variant and sample with both alleles spelled out; missing alleles are 0."""
    at = F.array_position("formats", "GT").cast("int")
    calls = vcf.select("chrom", "pos", "id", "ref", "alts", at.alias("_at"), F.posexplode("samples").alias("_s", "_v"))
    gt = F.when(F.col("_at") > 0, F.try_element_at(F.split("_v", ":", -1), F.col("_at")))
    calls = with_cells(calls, "_gt", F.split(F.replace(gt, F.lit("|"), F.lit("/")), "/"))
    bases = F.concat(F.array("ref"), F.col("alts"))

    def allele(k: int) -> Column:
        index = to_int(F.try_element_at("_gt", F.lit(k)))
        return F.coalesce(F.try_element_at(bases, (index + 1).cast("int")), F.lit("0"))

    names = F.array(*[F.lit(s) for s in samples])
    return calls.select("chrom", "pos", "id", F.element_at(names, F.col("_s") + 1).alias("sample"), allele(1).alias("a1"), allele(2).alias("a2"))


def background_check(vcf: DataFrame, background: DataFrame, bins: int = 10) -> DataFrame:
    """Share of background variants found in a call set per allele-frequency bin.

    ``background``: chrom, pos, ref, alt, af; ``vcf``: parsed records.
    """
    calls = vcf.select("chrom", "pos", "ref", F.explode("alts").alias("alt")).distinct().withColumn("hit", F.lit(1))
    slot = F.least(F.floor(F.col("af") * bins), F.lit(bins - 1)).cast("int")
    return background.join(calls, ["chrom", "pos", "ref", "alt"], "left").groupBy(slot.alias("af_bin")).agg(
        F.count("*").alias("n_expected"), F.count("hit").alias("n_found"), (F.count("hit") / F.count("*")).alias("found_share"))
