"""Alignments and chains: liftover, composition, swaps, statistics, subsets and sorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.functions.sequence import cigar_reference_length, reverse_complement
from locusframe.functions.values import safe_ratio
from locusframe.operators.intervals import interval_join, overlap_length

SPAN = ["chrom", "start", "end"]


def _chain_targets(blocks: DataFrame) -> DataFrame:
    """Chain blocks keyed by the target contig as intervals."""
    extra = [c for c in ("dataset", "min_match") if c in blocks.columns]
    return blocks.select(
        *extra, F.col("t_name").alias("chrom"), F.col("t_from").alias("start"), (F.col("t_from") + F.col("size")).alias("end"),
        "chain_id", "q_name", "q_size", "q_strand", "q_from").where("start < `end`")


def _lift_spans(spans: DataFrame, blocks: DataFrame, on: list[str], min_match: Column, carried: Sequence[str] = ()) -> DataFrame:
    """Fate and new place of distinct spans: one aggregate per (span, chain), then per span, behind one exchange by span.

    ``min_match`` may be a column of the spans that is named in ``carried``.
    """
    key = [*on, *SPAN, *carried] if "chrom" not in on else [*on, "start", "end", *carried]
    hits = interval_join(spans, _chain_targets(blocks), on=on if "chrom" in on else [*on, "chrom"], suffix="_c")
    lo, hi = F.greatest("start", "start_c"), F.least("end", "end_c")
    q_lo = F.col("q_from") + lo - F.col("start_c")
    q_hi = F.col("q_from") + hi - F.col("start_c")
    fwd = F.col("q_strand") == "+"
    a = F.when(fwd, q_lo).otherwise(F.col("q_size") - q_hi)
    b = F.when(fwd, q_hi).otherwise(F.col("q_size") - q_lo)
    placed = hits.select(*key, "chain_id", "q_name", "q_strand", a.alias("a"), b.alias("b"), (hi - lo).alias("n"))
    # one exchange by span serves both aggregates and the join with the intervals
    per_chain = placed.repartition(*[c for c in key if c not in carried]).groupBy(
        *key, "chain_id", "q_name", "q_strand").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("n").alias("n"))
    length = F.col("end") - F.col("start")
    good = F.col("n") >= length * min_match
    place = F.struct("q_name", "a", "b", "q_strand")
    fate = per_chain.groupBy(*key).agg(
        F.count("*").alias("n_chains"), F.count_if(good).alias("n_good"), F.sum("n").alias("covered"),
        F.max(F.when(good, place)).alias("to"))
    status = (
        F.when(F.col("n_good") == 1, "mapped").when(F.col("n_good") > 1, "duplicated")
        .when((F.col("n_chains") > 1) & (F.col("covered") >= length * min_match), "split").otherwise("partial"))
    return fate.select(*key, status.alias("fate"), F.when(F.col("n_good") == 1, F.col("to")).alias("to"))


def liftover(intervals: DataFrame, blocks: DataFrame, min_match: float = 0.95) -> DataFrame:
    """Append fate, new_chrom, new_start, new_end, new_strand.

    An interval is mapped when exactly one chain covers at least ``min_match`` of it; fates of the
    others are deleted (no chain), partial, split and duplicated. A ``strand`` column is flipped on
    reverse chains.
    """
    spans = intervals.select(*SPAN).distinct()
    lifted = _lift_spans(spans, blocks, ["chrom"], F.lit(float(min_match)))
    return _attach(intervals.join(lifted, SPAN, "left"), intervals.columns)


def _attach(joined: DataFrame, columns: Sequence[str]) -> DataFrame:
    flip = F.col("to.q_strand") == "-"
    if "strand" in columns:
        s = F.col("strand")
        strand = F.when(flip & (s == "+"), "-").when(flip & (s == "-"), "+").otherwise(s)
    else:
        strand = F.col("to.q_strand")
    return joined.select(
        *[F.col(c) for c in columns], F.coalesce("fate", F.lit("deleted")).alias("fate"), F.col("to.q_name").alias("new_chrom"),
        F.col("to.a").alias("new_start"), F.col("to.b").alias("new_end"), F.when(F.col("to").isNotNull(), strand).alias("new_strand"))


def liftover_report(lifted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Input, mapped and unmapped records and the mapping rate."""
    agg = lifted.groupBy(*by).agg(
        F.count("*").alias("input_records"), F.count_if(F.col("fate") == "mapped").alias("mapped_records"),
        F.count_if(F.col("fate") != "mapped").alias("unmapped_records"))
    rate = F.when(F.col("input_records") > 0, F.col("mapped_records") / F.col("input_records")).otherwise(0.0)
    return agg.withColumn("mapping_rate", F.format_string("%.4f", rate))


def liftover_datasets(
    intervals: DataFrame, datasets: DataFrame, blocks: DataFrame, min_match: float = 0.95
) -> tuple[DataFrame, DataFrame]:
    """Lift many datasets in one job; returns (lifted rows, one status row per dataset).

    ``intervals``: dataset, chrom, start, end, ...; ``datasets``: dataset, species, from, to,
    min_match (nullable); ``blocks``: chain blocks with species, from, to.
    """
    route = ["species", "from", "to"]
    known = blocks.select(*route).distinct().withColumn("has_chain", F.lit(True))
    plan = datasets.join(known, route, "left").select(
        "dataset", *route, F.coalesce("min_match", F.lit(min_match)).alias("min_match"), F.coalesce("has_chain", F.lit(False)).alias("has_chain"))
    per_dataset = blocks.join(plan.where("has_chain").select("dataset", *route), route).drop(*route)
    spans = intervals.select("dataset", *SPAN).distinct().join(plan.select("dataset", "min_match"), "dataset")
    hits = _lift_spans(spans, per_dataset, ["dataset", "chrom"], F.col("min_match"), ["min_match"]).drop("min_match")
    rows = intervals.join(plan.where("has_chain").select("dataset"), "dataset", "left_semi")
    lifted = _attach(rows.join(hits, ["dataset", *SPAN], "left"), intervals.columns)
    status = plan.join(liftover_report(lifted, ["dataset"]), "dataset", "left").select(
        "dataset", *route, F.when(F.col("has_chain"), "ok").otherwise("failed").alias("status"),
        "input_records", "mapped_records", "unmapped_records", "mapping_rate",
        F.when(F.col("has_chain"), "").otherwise("no chain registered for this species and builds").alias("message"))
    return lifted, status


def liftover_variants(vcf: DataFrame, blocks: DataFrame, chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lift biallelic or multiallelic records; returns (lifted, rejected with reason).

    The reference allele is compared with the new genome; on reverse chains alleles are
    reverse-complemented.
    """
    spanned = vcf.withColumns({"start": F.col("pos") - 1, "end": F.col("pos") - 1 + F.length("ref")})
    lifted = liftover(spanned, blocks, 1.0)
    flip = F.col("new_strand") == "-"
    ref = F.when(flip, reverse_complement(F.col("ref"))).otherwise(F.col("ref"))
    alts = F.when(flip, F.transform("alts", lambda a: F.when(a.startswith("<") | (a == "*"), a).otherwise(reverse_complement(a)))).otherwise(F.col("alts"))
    moved = lifted.where("fate = 'mapped'").withColumns({"new_ref": ref, "new_alts": alts})
    want = moved.select(F.col("new_chrom").alias("chrom"), F.col("new_start").alias("start"), F.col("new_end").alias("end")).distinct()
    bases = fetch_bases(want, chunks)
    checked = moved.join(bases.select(
        F.col("chrom").alias("new_chrom"), F.col("start").alias("new_start"), F.col("end").alias("new_end"), "bases"),
        ["new_chrom", "new_start", "new_end"], "left").withColumn("ok", F.coalesce(F.upper("bases") == F.upper("new_ref"), F.lit(False)))
    done = checked.where("ok").select(
        *[c for c in vcf.columns if c not in ("chrom", "pos", "ref", "alts")], F.col("new_chrom").alias("chrom"),
        (F.col("new_start") + 1).alias("pos"), F.col("new_ref").alias("ref"), F.col("new_alts").alias("alts"))
    rejected = lifted.where("fate != 'mapped'").select(*vcf.columns, F.col("fate").alias("reason")).unionByName(
        checked.where("not ok").select(*vcf.columns, F.lit("reference mismatch").alias("reason")))
    return done, rejected


def fetch_bases(spans: DataFrame, chunks: DataFrame) -> DataFrame:
    """Bases of short spans out of a genome chunk table."""
    hits = interval_join(spans.select(*SPAN), chunks)
    lo, hi = F.greatest("start", "start_b"), F.least("end", "end_b")
    piece = F.substring(F.col("bases"), (lo - F.col("start_b") + 1).cast("int"), (hi - lo).cast("int"))
    return hits.groupBy(*SPAN).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(lo.alias("at"), piece.alias("p")))), lambda x: x["p"]), "").alias("bases"))


# ---- PSL ------------------------------------------------------------------------------------

def psl_blocks(psl: DataFrame) -> DataFrame:
    """One row per block with its query and target start."""
    z = F.arrays_zip("block_sizes", "q_starts", "t_starts")
    return psl.select("path", "ord", "q_name", "q_size", "t_name", "t_size", "strand", F.posexplode(z).alias("block", "b")).select(
        "path", "ord", "q_name", "q_size", "t_name", "t_size", "strand", "block", F.col("b.block_sizes").alias("size"),
        F.col("b.q_starts").alias("q_from"), F.col("b.t_starts").alias("t_from"))


def map_through_chains(psl: DataFrame, blocks: DataFrame) -> DataFrame:
    """Alignments carried to the chain's query genome, one row per (alignment, chain).

    Target blocks are intersected with chain blocks and offsets added; on reverse chains both
    sides turn, so that the block list stays on the forward target strand.
    """
    b = psl_blocks(psl).withColumns({"chrom": F.col("t_name"), "start": F.col("t_from"), "end": F.col("t_from") + F.col("size")}).where("size > 0")
    c = _chain_targets(blocks).select("chrom", "start", "end", "chain_id", F.col("q_name").alias("n_name"), F.col("q_size").alias("n_size"),
                                      F.col("q_strand").alias("n_strand"), F.col("q_from").alias("n_from"))
    hits = interval_join(b, c, suffix="_c")
    lo, hi = F.greatest("start", "start_c"), F.least("end", "end_c")
    size = hi - lo
    q = F.col("q_from") + lo - F.col("start")
    n = F.col("n_from") + lo - F.col("start_c")
    rev = F.col("n_strand") == "-"
    q_at = F.when(rev, F.col("q_size") - q - size).otherwise(q)
    n_at = F.when(rev, F.col("n_size") - n - size).otherwise(n)
    plus = F.substring("strand", 1, 1) == "+"
    strand = F.when(rev, F.when(plus, "-").otherwise("+")).otherwise(F.substring("strand", 1, 1))
    pieces = hits.select("path", "ord", "q_name", "q_size", "chain_id", "n_name", "n_size", strand.alias("new_strand"),
                         n_at.alias("t"), q_at.alias("q"), size.alias("size"))
    rows = pieces.groupBy("path", "ord", "q_name", "q_size", "chain_id", "n_name", "n_size", "new_strand").agg(
        F.array_sort(F.collect_list(F.struct("t", "q", "size"))).alias("bl"), F.sum("size").alias("aligned"))
    first, last = F.col("bl")[0], F.element_at("bl", -1)
    q_lo, q_hi = first["q"], last["q"] + last["size"]
    minus = F.col("new_strand") == "-"
    return rows.select(
        "path", "ord", "chain_id", "aligned", F.col("new_strand").alias("strand"), "q_name", "q_size",
        F.when(minus, F.col("q_size") - q_hi).otherwise(q_lo).alias("q_start"), F.when(minus, F.col("q_size") - q_lo).otherwise(q_hi).alias("q_end"),
        F.col("n_name").alias("t_name"), F.col("n_size").alias("t_size"), first["t"].alias("t_start"), (last["t"] + last["size"]).alias("t_end"),
        F.size("bl").alias("block_count"), F.transform("bl", lambda x: x["size"]).alias("block_sizes"),
        F.transform("bl", lambda x: x["q"]).alias("q_starts"), F.transform("bl", lambda x: x["t"]).alias("t_starts"))


def psl_score(df: DataFrame) -> Column:
    return (F.col("matches") + F.floor(F.col("rep_matches") / 2) - F.col("mismatches") - F.col("q_num_insert") - F.col("t_num_insert")).cast("bigint")


def psl_statistics(psl: DataFrame) -> DataFrame:
    """Per alignment: aligned bases, identity, query coverage, score."""
    aligned = F.col("matches") + F.col("mismatches") + F.col("rep_matches")
    return psl.select(
        "q_name", "q_size", "t_name", "t_start", "t_end", "strand", aligned.alias("aligned"),
        safe_ratio(F.col("matches") + F.col("rep_matches"), aligned).alias("identity"), safe_ratio(aligned, F.col("q_size")).alias("q_coverage"),
        psl_score(psl).alias("score"))


def psl_summary(psl: DataFrame) -> DataFrame:
    s = psl_statistics(psl)
    return s.agg(
        F.count("*").alias("alignments"), F.count_distinct("q_name").alias("queries"), F.sum("aligned").alias("aligned"),
        F.min("identity").alias("min_identity"), F.max("identity").alias("max_identity"),
        F.min("q_coverage").alias("min_q_coverage"), F.max("q_coverage").alias("max_q_coverage"))


def best_alignments(psl: DataFrame, near_top: float = 0.01, min_cover: float = 0.0, min_identity: float = 0.0) -> DataFrame:
    """Alignments within ``near_top`` of the best score of their query (mergeable maximum, no window)."""
    aligned = F.col("matches") + F.col("mismatches") + F.col("rep_matches")
    ok = psl.withColumn("_score", psl_score(psl)).where(
        (aligned >= F.col("q_size") * min_cover) & (F.col("matches") + F.col("rep_matches") >= aligned * min_identity))
    top = ok.groupBy("q_name").agg(F.max("_score").alias("_top"))
    return ok.join(top, "q_name").where(F.col("_score") >= F.col("_top") * (1 - near_top)).select(*psl.columns)


def sort_psl(psl: DataFrame, *more: DataFrame) -> DataFrame:
    for other in more:
        psl = psl.unionByName(other)
    return psl.orderBy("q_name", "path", "ord")


# ---- chains ---------------------------------------------------------------------------------

def filter_chains(
    headers: DataFrame, blocks: DataFrame | None = None, min_score: int | None = None, strand: str | None = None,
    t_name: str | None = None, q_name: str | None = None, t_overlap: tuple[int, int] | None = None,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Chain headers by score, query strand, contigs and target range; blocks follow their header."""
    out = headers
    if min_score is not None:
        out = out.where(F.col("score") >= min_score)
    for name, value in (("q_strand", strand), ("t_name", t_name), ("q_name", q_name)):
        if value is not None:
            out = out.where(F.col(name) == value)
    if t_overlap is not None:
        out = out.where((F.col("t_start") < t_overlap[1]) & (F.col("t_end") > t_overlap[0]))
    if blocks is None:
        return out
    keys = out.select("path", F.col("ord").alias("chain_ord"))
    return out, blocks.join(keys, ["path", "chain_ord"], "left_semi")


def sort_chains(headers: DataFrame, *more: DataFrame) -> DataFrame:
    """Chains of one or several files, best score first."""
    for other in more:
        headers = headers.unionByName(other)
    return headers.orderBy(F.col("score").desc(), "path", "ord")


def swap_chains(headers: DataFrame) -> DataFrame:
    """Target and query exchanged; with a reverse query both ranges turn so that the new target is forward."""
    rev = F.col("q_strand") == "-"

    def turn(size: str, a: str) -> Column:
        return F.when(rev, F.col(size) - F.col(a)).otherwise(F.col(a))

    return headers.select(
        "path", "ord", "chain_id", "score", F.col("q_name").alias("t_name"), F.col("q_size").alias("t_size"), F.lit("+").alias("t_strand"),
        F.when(rev, F.col("q_size") - F.col("q_end")).otherwise(F.col("q_start")).alias("t_start"),
        F.when(rev, F.col("q_size") - F.col("q_start")).otherwise(F.col("q_end")).alias("t_end"),
        F.col("t_name").alias("q_name"), F.col("t_size").alias("q_size"), "q_strand",
        turn("t_size", "t_end" if False else "t_start").alias("_s"), turn("t_size", "t_end").alias("_e"),
    ).withColumns({"q_start": F.least("_s", "_e"), "q_end": F.greatest("_s", "_e")}).drop("_s", "_e")


def swap_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks of swapped chains: sides exchanged, and turned on reverse chains."""
    rev = F.col("q_strand") == "-"
    t = F.when(rev, F.col("q_size") - F.col("q_from") - F.col("size")).otherwise(F.col("q_from"))
    q = F.when(rev, F.col("t_size") - F.col("t_from") - F.col("size")).otherwise(F.col("t_from"))
    return blocks.select(
        "path", "chain_ord", "chain_id", "score", F.col("q_name").alias("t_name"), F.col("q_size").alias("t_size"),
        F.col("t_name").alias("q_name"), F.col("t_size").alias("q_size"), "q_strand", "size", t.alias("t_from"), q.alias("q_from"))


def chains_to_psl(blocks: DataFrame) -> DataFrame:
    """One alignment row per chain with its block lists; all aligned bases count as matches."""
    x = F.struct(F.col("t_from").alias("t"), F.col("q_from").alias("q"), F.col("size").alias("size"))
    rows = blocks.groupBy("path", "chain_ord", "chain_id", "t_name", "t_size", "q_name", "q_size", "q_strand").agg(
        F.array_sort(F.collect_list(x)).alias("bl"), F.sum("size").alias("matches"))
    first, last = F.col("bl")[0], F.element_at("bl", -1)
    minus = F.col("q_strand") == "-"
    q_lo, q_hi = first["q"], last["q"] + last["size"]
    return rows.select(
        "chain_id", "matches", F.col("q_strand").alias("strand"), "q_name", "q_size",
        F.when(minus, F.col("q_size") - q_hi).otherwise(q_lo).alias("q_start"), F.when(minus, F.col("q_size") - q_lo).otherwise(q_hi).alias("q_end"),
        "t_name", "t_size", first["t"].alias("t_start"), (last["t"] + last["size"]).alias("t_end"), F.size("bl").alias("block_count"),
        F.transform("bl", lambda b: b["size"]).alias("block_sizes"), F.transform("bl", lambda b: b["q"]).alias("q_starts"),
        F.transform("bl", lambda b: b["t"]).alias("t_starts"))


def psl_to_chains(psl: DataFrame) -> DataFrame:
    """Chain headers and block triples (size, dt, dq) of alignments on the forward target strand."""
    n = F.size("block_sizes")
    steps = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
        F.element_at("block_sizes", i).alias("size"),
        F.when(i < n, F.try_element_at("t_starts", i + 1) - F.element_at("t_starts", i) - F.element_at("block_sizes", i)).alias("dt"),
        F.when(i < n, F.try_element_at("q_starts", i + 1) - F.element_at("q_starts", i) - F.element_at("block_sizes", i)).alias("dq")))
    q_from, size = F.col("q_starts")[0], F.element_at("q_starts", -1) + F.element_at("block_sizes", -1)
    return psl.select(
        "path", "ord", psl_score(psl).alias("score"), "t_name", "t_size", F.lit("+").alias("t_strand"), "t_start", "t_end",
        "q_name", "q_size", F.substring("strand", 1, 1).alias("q_strand"), q_from.alias("q_start"), size.alias("q_end"), steps.alias("steps"))


# ---- SAM ------------------------------------------------------------------------------------

def sam_spans(sam: DataFrame) -> DataFrame:
    """Mapped reads with their 0-based reference span."""
    mapped = sam.where((F.col("flag").bitwiseAND(F.lit(4)) == 0) & (F.col("r_name") != "*") & (F.col("pos") > 0))
    return mapped.withColumns({
        "chrom": F.col("r_name"), "start": F.col("pos") - 1,
        "end": F.col("pos") - 1 + F.greatest(cigar_reference_length(F.col("cigar")), F.lit(1).cast("bigint"))})


def sam_view(
    sam: DataFrame, require: int = 0, exclude: int = 0, min_mapq: int = 0,
    names: DataFrame | None = None, regions: DataFrame | None = None,
) -> DataFrame:
    """Reads by flag bits, mapping quality, names (``q_name``) and regions (chrom, start, end)."""
    from locusframe.operators.intervals import merge_intervals

    flag = F.col("flag")
    out = sam.where((flag.bitwiseAND(F.lit(require)) == require) & (flag.bitwiseAND(F.lit(exclude)) == 0) & (F.col("mapq") >= min_mapq))
    if names is not None:
        out = out.join(names.select("q_name").distinct(), "q_name", "left_semi")
    if regions is None:
        return out.select(*sam.columns)
    hits = interval_join(merge_intervals(regions), sam_spans(out), suffix="_r", right_span=("start", "end"))
    # a read may touch several merged regions; it is kept at the first one only
    home = hits.groupBy("path", "ord").agg(F.min("start").alias("start"))
    return hits.join(home, ["path", "ord", "start"], "left_semi").select(*sam.columns)


def sort_sam(sam: DataFrame, by: str = "coordinate") -> DataFrame:
    if by == "name":
        return sam.orderBy("q_name", "flag", "ord")
    unmapped = F.col("r_name") == "*"
    return sam.orderBy(unmapped, "r_name", "pos", "ord")


def sam_to_bed(sam: DataFrame) -> DataFrame:
    strand = F.when(F.col("flag").bitwiseAND(F.lit(16)) != 0, "-").otherwise("+")
    return sam_spans(sam).select("chrom", "start", "end", F.col("q_name").alias("name"), F.col("mapq").alias("score"), strand.alias("strand"))


def sam_to_bed12(sam: DataFrame) -> DataFrame:
    """Reads as BED12: blocks end at reference skips (N)."""
    ops = F.arrays_zip(
        F.regexp_extract_all("cigar", F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(1)).alias("n"),
        F.regexp_extract_all("cigar", F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(2)).alias("op"))
    zero = F.lit(0).cast("bigint")
    empty = F.array().cast("array<struct<o:bigint,s:bigint>>")
    init = F.struct(zero.alias("at"), zero.alias("from"), empty.alias("done"))

    def step(acc, x):
        n, op = x["n"].cast("bigint"), x["op"]
        closes = op == "N"
        grows = op.isin("M", "D", "=", "X")
        block = F.struct(acc["from"].alias("o"), (acc["at"] - acc["from"]).alias("s"))
        return F.struct(
            F.when(closes | grows, acc["at"] + n).otherwise(acc["at"]).alias("at"),
            F.when(closes, acc["at"] + n).otherwise(acc["from"]).alias("from"),
            F.when(closes, F.concat(acc["done"], F.array(block))).otherwise(acc["done"]).alias("done"))

    walked = F.aggregate(ops, init, step, lambda acc: F.filter(
        F.concat(acc["done"], F.array(F.struct(acc["from"].alias("o"), (acc["at"] - acc["from"]).alias("s")))), lambda b: b["s"] > 0))
    strand = F.when(F.col("flag").bitwiseAND(F.lit(16)) != 0, "-").otherwise("+")
    return sam_spans(sam).withColumn("_b", walked).select(
        "chrom", "start", "end", F.col("q_name").alias("name"), F.col("mapq").alias("score"), strand.alias("strand"),
        F.size("_b").alias("block_count"), F.transform("_b", lambda b: b["s"]).alias("block_sizes"), F.transform("_b", lambda b: b["o"]).alias("block_starts"))
