"""Feature extraction from annotation records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.functions.sequence import reverse_complement, translate_codons
from locusframe.operators.intervals import interval_join, islands
from locusframe.operators.ordered import left_lookup, position_block, running
from locusframe.sources.annotation import record_ids
from locusframe.session import materialize
from locusframe.sources.lines import ord_block

FEATURE_COLUMNS = [
    "chrom", "start", "end", "feature_type", "feature_id", "gene_id", "transcript_id", "strand", "gene_type", "transcript_type",
]
GROUP = ["chrom", "strand", "gene_id", "transcript_id"]
DEFAULT_TOKENS = ("gene", "transcript", "exon", "intron")
EXPLICIT_UTR = ("UTR", "five_prime_utr", "three_prime_utr", "5UTR", "3UTR")

# Accepted BED names and the feature type each stands for.
BED_FEATURE_NAMES = {
    "gene": "gene", "transcript": "transcript", "mrna": "transcript", "lnc_rna": "transcript", "lncrna": "transcript",
    "exon": "exon", "intron": "intron", "cds": "cds", "utr": "utr",
    "utr5": "utr5", "5utr": "utr5", "five_prime_utr": "utr5", "5_prime_utr": "utr5",
    "utr3": "utr3", "3utr": "utr3", "three_prime_utr": "utr3", "3_prime_utr": "utr3",
    "start_codon": "start_codon", "stop_codon": "stop_codon",
}


def annotated_records(records: DataFrame, resolve_parents: bool = False) -> DataFrame:
    """Records with ids, types and the folded ``kind``.

    In plain GFF3 an exon's own ID is its transcript id, so exons do not group. With
    ``resolve_parents`` child records take the transcript from ``Parent`` and the gene from the
    transcript's own ``Parent``.
    """
    def named(a: Column) -> Column:
        return F.struct(*[c.alias(n) for n, c in record_ids(a).items()], a["exon_number"].alias("exon_number"))

    kind = F.when(F.col("feature").isin("mRNA", "lnc_RNA"), F.lit("transcript")).otherwise(F.col("feature"))
    # a generator, so that the attribute map is parsed once and not again for every lookup
    ids = F.inline(F.array(named(F.col("attrs"))))
    out = records.select("*", kind.alias("kind"), ids)
    if not resolve_parents:
        return out
    links = out.where((F.col("kind") == "transcript") & F.col("attrs")["ID"].isNotNull()).groupBy(
        "path", F.col("attrs")["ID"].alias("_tx")).agg(F.max_by(F.col("attrs")["Parent"], "ord").alias("_gene"))
    child = ~F.col("kind").isin("gene", "transcript") & F.col("attrs")["Parent"].isNotNull() & F.col("attrs")["transcript_id"].isNull()
    return (
        left_lookup(out.withColumn("_tx", F.when(child, F.col("attrs")["Parent"])), links, ["path", "_tx"], ["ord"])
        .withColumn("transcript_id", F.coalesce("_tx", "transcript_id"))
        .withColumn("gene_id", F.coalesce("_gene", "gene_id"))
        .drop("_tx", "_gene")
    )


def _rows(df: DataFrame, kind: Column, fid: Column, tid: Column | None = None, ttype: Column | None = None) -> DataFrame:
    tid = F.col("transcript_id") if tid is None else tid
    ttype = F.col("transcript_type") if ttype is None else ttype
    return df.select(
        "chrom", F.greatest(F.lit(0).cast("bigint"), F.col("start") - 1).alias("start"), "end",
        kind.alias("feature_type"), fid.alias("feature_id"), "gene_id", tid.alias("transcript_id"), "strand",
        "gene_type", ttype.alias("transcript_type"))


def transcript_types(rec: DataFrame) -> DataFrame:
    """Types stated by the last record of each transcript group in file order."""
    last = rec.groupBy("path", *GROUP).agg(F.max_by(F.struct("gene_type", "transcript_type"), "ord").alias("t"))
    return last.select("path", *GROUP, "t.gene_type", "t.transcript_type")


def number_exons(exons: DataFrame) -> DataFrame:
    """Append ``exon_no``: the attribute when stated, else the running count in file order."""
    counted = running(exons, ["path", *GROUP], ["ord"], ord_block(), {"_seen": ("sum", F.lit(1).cast("bigint"))})
    return counted.withColumn(
        "exon_no", F.coalesce("exon_number", F.col("_seen").cast("string"))).drop("_seen")


def derive_introns(exons: DataFrame, keys: Sequence[str] = ("path", *GROUP)) -> DataFrame:
    """Non-empty gaps between neighbouring exons (1-based closed), numbered by position.

    Exons sharing a start leave only the gap after the farthest end among them, so they are
    folded first; that bounds a block of positions by its width whatever a key holds.
    """
    keys = list(keys)
    slim = exons.groupBy(*keys, "start").agg(F.max("end").alias("end"))
    gaps = (
        running(slim, keys, ["start"], position_block("start"), {"_prev": ("last", F.col("end"))}, exclusive=True)
        .where("_prev is not null and _prev + 1 <= start - 1")
        .select(*keys, (F.col("_prev") + 1).alias("start"), (F.col("start") - 1).alias("end"))
    )
    return running(gaps, keys, ["start"], position_block("start"), {"intron_no": ("sum", F.lit(1).cast("bigint"))})


def utr_side(strand: Column, start: Column, end: Column, cds_min: Column, cds_max: Column, stated: Column) -> Column:
    """5UTR, 3UTR or UTR when neither the name nor the coding span decides."""
    minus = strand == "-"
    return (
        F.when(stated.isin("five_prime_utr", "5UTR"), "5UTR")
        .when(stated.isin("three_prime_utr", "3UTR"), "3UTR")
        .when(end < cds_min, F.when(minus, "3UTR").otherwise("5UTR"))
        .when(start > cds_max, F.when(minus, "5UTR").otherwise("3UTR"))
        .otherwise("UTR")
    )


def derive_utrs(rec: DataFrame) -> DataFrame:
    """UTR segments (1-based closed) of transcripts with exons, labelled by side."""
    keys = ["path", *GROUP]
    exon, cds = F.col("kind") == "exon", F.col("feature") == "CDS"
    utr = F.col("feature").isin(*EXPLICIT_UTR)
    spans = rec.groupBy(*keys).agg(
        F.count_if(exon).alias("n_exon"), F.count_if(utr).alias("n_utr"),
        F.min(F.when(cds, F.col("start"))).alias("cds_min"), F.max(F.when(cds, F.col("end"))).alias("cds_max"))
    usable = spans.where("n_exon > 0 and (n_utr > 0 or cds_min is not null)")
    parts = rec.where(exon | utr).select(*keys, "start", "end", "feature", utr.alias("is_utr")).join(usable, keys)
    explicit = parts.where("is_utr").select(*keys, "start", "end", F.col("feature").alias("stated"), "cds_min", "cds_max")
    whole = F.struct(F.col("start"), F.col("end"))
    left = F.struct(F.col("start"), (F.col("cds_min") - 1).alias("end"))
    right = F.struct((F.col("cds_max") + 1).alias("start"), F.col("end"))
    outside = (F.col("end") < F.col("cds_min")) | (F.col("start") > F.col("cds_max"))
    pieces = F.when(outside, F.array(whole)).otherwise(F.filter(
        F.array(F.when(F.col("start") < F.col("cds_min"), left), F.when(F.col("end") > F.col("cds_max"), right)),
        lambda x: x.isNotNull()))
    derived = parts.where("not is_utr and n_utr = 0").select(
        *keys, F.explode(pieces).alias("p"), F.lit(None).cast("string").alias("stated"), "cds_min", "cds_max"
    ).select(*keys, "p.start", "p.end", "stated", "cds_min", "cds_max")
    both = explicit.unionByName(derived).where("start <= `end`")
    side = utr_side(F.col("strand"), F.col("start"), F.col("end"), F.col("cds_min"), F.col("cds_max"), F.coalesce("stated", F.lit("")))
    return both.select(*keys, "start", "end", side.alias("label"))


def extract_features(
    records: DataFrame, tokens: Sequence[str] = DEFAULT_TOKENS, resolve_parents: bool = False, sort: bool = False
) -> DataFrame:
    """gene / transcript / exon / intron / cds / utr (utr5, utr3) rows as the 10-column feature table.

    Coordinates become 0-based half-open. Introns and UTRs take their types from the last record
    of the transcript group in file order.
    """
    wanted = set(tokens)
    rec = annotated_records(records, resolve_parents).select(
        "path", "ord", "feature", "kind", "start", "end", *GROUP, "gene_type", "transcript_type", "exon_number")
    if wanted - {"gene", "transcript", "cds"}:
        # exons, introns, UTRs and types each read the records: parse the text once
        rec = materialize(rec)
    tid, out = F.col("transcript_id"), []
    na = F.lit("NA")
    if "gene" in wanted:
        out.append(_rows(rec.where("kind = 'gene'"), F.lit("gene"), F.col("gene_id"), na, na))
    if "transcript" in wanted:
        out.append(_rows(rec.where("kind = 'transcript'"), F.lit("transcript"), tid))
    exons = rec.where("kind = 'exon'")
    if "exon" in wanted:
        out.append(_rows(number_exons(exons.drop("feature", "kind")), F.lit("exon"), F.concat(tid, F.lit(":exon"), F.col("exon_no"))))
    if "cds" in wanted:
        out.append(_rows(rec.where("feature = 'CDS'"), F.lit("CDS"), F.concat(tid, F.lit(":CDS"))))
    if wanted & {"intron", "utr", "utr5", "utr3"}:
        types = transcript_types(rec)
        if "intron" in wanted:
            introns = derive_introns(exons).join(types, ["path", *GROUP], "left")
            out.append(_rows(introns, F.lit("intron"), F.concat(tid, F.lit(":intron"), F.col("intron_no").cast("string"))))
        labels = {"UTR"} if wanted & {"utr", "utr5", "utr3"} else set()
        labels |= {"5UTR"} if wanted & {"utr", "utr5"} else set()
        labels |= {"3UTR"} if wanted & {"utr", "utr3"} else set()
        if labels:
            utrs = derive_utrs(rec).where(F.col("label").isin(*sorted(labels))).join(types, ["path", *GROUP], "left")
            out.append(_rows(utrs, F.col("label"), F.concat(tid, F.lit(":"), F.col("label"))))
    if not out:
        raise ValueError(f"no known feature token in {tokens!r}")
    table = out[0]
    for part in out[1:]:
        table = table.unionByName(part)
    return sort_features(table) if sort else table


def extract_transcripts(records: DataFrame) -> DataFrame:
    return extract_features(records, ["transcript"])


def sort_features(features: DataFrame) -> DataFrame:
    return features.orderBy("chrom", "start", "end", "feature_type", "feature_id")


def bed_to_features(bed: DataFrame, feature_type: str | None = None) -> DataFrame:
    """BED rows as features. A known name gives the type and a positional id; another name is both type and id."""
    known = F.create_map(*[F.lit(x) for kv in BED_FEATURE_NAMES.items() for x in kv])
    name = F.coalesce("name", F.lit(""))
    canonical = F.try_element_at(known, F.lower(name))
    ftype = F.lit(feature_type) if feature_type else F.coalesce(canonical, F.when(name != "", name), F.lit("interval"))
    place = F.concat("chrom", F.lit(":"), (F.col("start") + 1).cast("string"), F.lit("-"), F.col("end").cast("string"))
    fid = F.when((name != "") & canonical.isNull(), name).otherwise(place)
    na = F.lit("NA")
    return bed.where("start >= 0 and `end` > start").select(
        "chrom", "start", "end", ftype.alias("feature_type"), fid.alias("feature_id"), na.alias("gene_id"),
        na.alias("transcript_id"), F.when(F.col("strand").isin("+", "-"), F.col("strand")).otherwise(".").alias("strand"),
        na.alias("gene_type"), na.alias("transcript_type"))


def attribute_columns(records: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Attributes as columns next to the eight fixed ones; without ``names`` all that occur, in text order.

    The names in use are a few per file format; finding them is one aggregate over the records.
    """
    if names is None:
        names = sorted(r["attribute"] for r in attribute_names(records).collect())
    fixed = ["chrom", "source", "feature", "start", "end", "score", "strand", "frame"]
    return records.select(*fixed, *[F.try_element_at("attrs", F.lit(n)).alias(n) for n in names])


def attribute_names(records: DataFrame) -> DataFrame:
    """Attribute names in use with their number of records."""
    return records.select(F.explode(F.map_keys("attrs")).alias("attribute")).groupBy("attribute").agg(F.count("*").alias("n"))


def longest_isoforms(records: DataFrame) -> DataFrame:
    """Longest transcript per gene: coding length when it codes, else exon length; ties go to the smaller id."""
    rec = annotated_records(records)
    length = F.col("end") - F.col("start") + 1
    per_tx = rec.where("kind = 'exon' or feature = 'CDS'").groupBy("gene_id", "transcript_id").agg(
        F.sum(F.when(F.col("feature") == "CDS", length).otherwise(0)).alias("cds_length"),
        F.sum(F.when(F.col("kind") == "exon", length).otherwise(0)).alias("exon_length"))
    coding = F.col("cds_length") > 0
    rank = F.struct(
        coding.alias("coding"), F.when(coding, F.col("cds_length")).otherwise(F.col("exon_length")).alias("n"))
    per_tx = per_tx.withColumn("rank", rank)
    best = per_tx.groupBy("gene_id").agg(F.max("rank").alias("rank"))
    return per_tx.join(best, ["gene_id", "rank"]).groupBy("gene_id").agg(
        F.min_by(F.struct("transcript_id", "cds_length", "exon_length"), "transcript_id").alias("t")
    ).select("gene_id", "t.*")


def merge_annotations(exons: DataFrame) -> DataFrame:
    """Isoforms of several annotations with equal structures kept once, and their locus.

    ``exons``: source, transcript_id, chrom, strand, start, end. The structure is the sorted exon
    list; a locus is a chain of overlapping transcripts on one strand.
    """
    structure = exons.groupBy("source", "transcript_id", "chrom", "strand").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("exons"))
    kept = structure.groupBy("chrom", "strand", "exons").agg(
        F.min(F.struct("source", "transcript_id")).alias("t"), F.count("*").alias("n_copies"))
    spans = kept.select(
        "t.source", "t.transcript_id", "chrom", "strand", F.col("exons")[0]["start"].alias("start"),
        F.array_max(F.transform("exons", lambda x: x["end"])).alias("end"), F.size("exons").alias("n_exons"), "n_copies")
    return islands(spans, ["chrom", "strand"]).withColumnRenamed("island", "locus_start")


def spliced_sequences(exons: DataFrame, chunks: DataFrame) -> DataFrame:
    """Transcript sequences: distinct exons in transcript order, reverse-complemented on ``-``.

    ``exons``: transcript_id, chrom, start, end (0-based), strand. The strand is the first exon's.
    Contigs are matched with and without ``chr``; exons on missing contigs are skipped.
    """
    ex = exons.select("transcript_id", "chrom", "start", "end", "strand").distinct()
    first = ex.groupBy("transcript_id").agg(F.min_by("strand", F.struct("start", "end", "chrom", "strand")).alias("tx_strand"))
    ex = match_contigs(ex, chunks.select("chrom").distinct())
    hits = interval_join(ex, chunks)
    lo, hi = F.greatest("start", "start_b"), F.least("end", "end_b")
    piece = F.substring(F.col("bases"), (lo - F.col("start_b") + 1).cast("int"), (hi - lo).cast("int"))
    parts = hits.select("transcript_id", "start", "end", "strand", lo.alias("at"), piece.alias("piece"))
    per_exon = parts.groupBy("transcript_id", "start", "end", "strand").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"]), "").alias("seq"))
    tx = per_exon.groupBy("transcript_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "seq"))).alias("e"))
    joined = F.array_join(F.transform("e", lambda x: x["seq"]), "")
    backwards = F.array_join(F.transform(F.reverse("e"), lambda x: reverse_complement(x["seq"])), "")
    return first.join(tx, "transcript_id", "left").select(
        "transcript_id", F.col("tx_strand").alias("strand"),
        F.coalesce(F.when(F.col("tx_strand") == "-", backwards).otherwise(joined), F.lit("")).alias("seq"))


def match_contigs(df: DataFrame, contigs: DataFrame) -> DataFrame:
    """Rename ``chrom`` to the spelling present in ``contigs`` (as is, without or with ``chr``); drop the rest."""
    options = F.array(
        F.struct(F.lit(0).alias("p"), F.col("chrom").alias("name")),
        F.struct(F.lit(1).alias("p"), F.when(F.col("chrom").startswith("chr"), F.substring("chrom", 4, 1 << 20)).alias("name")),
        F.struct(F.lit(2).alias("p"), F.concat(F.lit("chr"), F.col("chrom")).alias("name")))
    wanted = df.select("chrom").distinct().select("chrom", F.explode(options).alias("o")).where("o.name is not null")
    found = wanted.join(contigs.select(F.col("chrom").alias("name")), F.col("o.name") == F.col("name")).groupBy("chrom").agg(
        F.min("o").alias("o"))
    return df.join(found, "chrom").withColumn("chrom", F.col("o.name")).drop("o")


def protein_sequences(cds: DataFrame, chunks: DataFrame) -> DataFrame:
    return spliced_sequences(cds, chunks).select("transcript_id", translate_codons(F.col("seq")).alias("protein"))
