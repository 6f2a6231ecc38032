"""Alignment, gene-model and signal text formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.functions.values import cell, cells, int_list, to_float, to_int, with_cells, words
from locusframe.operators.ordered import running
from locusframe.sources.lines import content, ord_block

# Column names of the formats.
PSL_COLUMNS = [
    "matches", "mismatches", "rep_matches", "n_count", "q_num_insert", "q_base_insert", "t_num_insert",
    "t_base_insert", "strand", "q_name", "q_size", "q_start", "q_end", "t_name", "t_size", "t_start", "t_end",
    "block_count", "block_sizes", "q_starts", "t_starts",
]
PSL_TEXT = {"strand", "q_name", "t_name"}
PSL_LISTS = {"block_sizes", "q_starts", "t_starts"}
CHAIN_COLUMNS = ["score", "t_name", "t_size", "t_strand", "t_start", "t_end", "q_name", "q_size", "q_strand", "q_start", "q_end"]
CHAIN_TEXT = {"t_name", "t_strand", "q_name", "q_strand"}
SAM_COLUMNS = ["q_name", "flag", "r_name", "pos", "mapq", "cigar", "r_next", "p_next", "t_len", "seq", "qual"]
SAM_INTS = {"flag", "pos", "mapq", "p_next", "t_len"}
RMSK_COLUMNS = ["score", "pct_div", "pct_del", "pct_ins", "query", "q_begin", "q_end", "q_left", "strand",
                "repeat", "class_family", "r_a", "r_b", "r_c", "id"]
BEDMETHYL_COLUMNS = ["chrom", "start", "end", "mod_code", "score", "strand", "thick_start", "thick_end", "rgb",
                     "n_valid", "percent", "n_mod", "n_canonical", "n_other", "n_delete", "n_fail", "n_diff", "n_nocall"]


def parse_psl(lines: DataFrame) -> DataFrame:
    """PSL rows of 21 or 23 cells; header lines are skipped, white-space separation is tolerated."""
    by_tab, by_space = cells(F.trim("value")), words(F.col("value"))
    rows = content(lines, "#").withColumn("_c", F.when(F.size(by_tab) == F.size(by_space), by_tab).otherwise(by_space))
    c = F.col("_c")

    def typed(i: int, name: str) -> Column:
        if name in PSL_TEXT:
            return cell(c, i)
        return int_list(cell(c, i)) if name in PSL_LISTS else to_int(cell(c, i))

    return rows.where(F.size("_c").isin(21, 23) & cell(c, 0).rlike("^[0-9]+$")).select(
        "path", "ord", *[typed(i, n).alias(n) for i, n in enumerate(PSL_COLUMNS)])


def parse_chain_headers(lines: DataFrame) -> DataFrame:
    c = F.col("_c")
    rows = lines.where(F.col("value").rlike(r"^\s*chain\s")).withColumn("_c", words(F.col("value")))
    return rows.where(F.size("_c").isin(12, 13)).select(
        "path", "ord",
        *[(cell(c, i + 1) if n in CHAIN_TEXT else to_int(cell(c, i + 1))).alias(n) for i, n in enumerate(CHAIN_COLUMNS)],
        F.coalesce(cell(c, 12), F.concat(F.lit("ord"), F.col("ord").cast("string"))).alias("chain_id"))


def parse_chain_blocks(lines: DataFrame) -> DataFrame:
    """Ungapped blocks with absolute target and query offsets (query on the chain's strand).

    The header is carried down the file and block offsets are running sums, both skew-safe.
    """
    c = F.col("_c")
    is_head = c[0] == "chain"
    used = ("score", "t_name", "t_size", "t_start", "q_name", "q_size", "q_strand", "q_start")
    head = F.when(is_head, F.struct(
        F.col("ord").alias("chain_ord"),
        F.coalesce(cell(c, 12), F.concat(F.lit("ord"), F.col("ord").cast("string"))).alias("chain_id"),
        *[(cell(c, i + 1) if n in CHAIN_TEXT else to_int(cell(c, i + 1))).alias(n) for i, n in enumerate(CHAIN_COLUMNS) if n in used]))
    numbers = {n: F.when(~is_head, to_int(cell(c, i))) for i, n in enumerate(("size", "dt", "dq"))}
    rows = with_cells(content(lines, "#"), "_c", words(F.col("value"))).where(F.size("_c") > 0)
    # what is shuffled is a header or three numbers, not the words of the line
    rows = rows.select("path", "ord", is_head.alias("is_head"), *[x.alias(n) for n, x in numbers.items()], head.alias("h"))
    tagged = running(rows, ["path"], ["ord"], ord_block(), {"h": ("last", F.col("h"))})
    zero = F.lit(0).cast("bigint")
    body = tagged.where("not is_head and h is not null").select(
        "path", "ord", "h.*", "size", F.coalesce("dt", zero).alias("dt"), F.coalesce("dq", zero).alias("dq"))
    placed = running(body, ["path", "chain_ord"], ["ord"], ord_block(), {
        "t_off": ("sum", F.col("size") + F.col("dt")), "q_off": ("sum", F.col("size") + F.col("dq"))}, exclusive=True)
    return placed.select(
        "path", "chain_ord", "chain_id", "score", "t_name", "t_size", "q_name", "q_size", "q_strand", "size", "dt", "dq",
        (F.col("t_start") + F.col("t_off")).alias("t_from"), (F.col("q_start") + F.col("q_off")).alias("q_from"))


def parse_genepred(lines: DataFrame) -> DataFrame:
    """genePred or refFlat, told apart by the strand column; exon lists as arrays."""
    c = F.col("_c")
    strands = ["+", "-", "."]
    rows = content(lines, "#").withColumn("_c", cells(F.col("value"))).withColumn(
        "_o", F.when(cell(c, 2).isin(strands), 0).when(cell(c, 3).isin(strands), 1))
    rows = rows.where("_o is not null and size(_c) >= 9 + _o")

    def at(i: int) -> Column:
        return F.try_element_at(c, F.col("_o") + i + 1)

    return rows.select(
        "path", "ord", F.when(F.col("_o") == 1, cell(c, 0)).alias("gene_name"),
        at(0).alias("name"), at(1).alias("chrom"), at(2).alias("strand"), to_int(at(3)).alias("tx_start"),
        to_int(at(4)).alias("tx_end"), to_int(at(5)).alias("cds_start"), to_int(at(6)).alias("cds_end"),
        to_int(at(7)).alias("exon_count"), int_list(at(8)).alias("exon_starts"),
        int_list(F.coalesce(at(9), F.lit(""))).alias("exon_ends"))


def parse_wig(lines: DataFrame) -> DataFrame:
    """fixedStep and variableStep values as 0-based intervals."""
    text = F.trim("value")

    def setting(name: str) -> Column:
        return F.regexp_extract(text, rf"(?:^|\s){name}=(\S+)", 1)

    one = F.lit(1).cast("bigint")
    decl = F.when(text.startswith("fixedStep") | text.startswith("variableStep"), F.struct(
        F.col("ord").alias("decl_ord"), text.startswith("fixedStep").alias("fixed"), setting("chrom").alias("chrom"),
        F.coalesce(to_int(setting("start")), one).alias("first"), F.coalesce(to_int(setting("step")), one).alias("step"),
        F.coalesce(to_int(setting("span")), one).alias("span")))
    rows = content(lines, "#", "track ", "browser ").select("path", "ord", text.alias("text"), decl.alias("_decl"))
    tagged = running(rows, ["path"], ["ord"], ord_block(), {"d": ("last", F.col("_decl"))})
    data = tagged.where("_decl is null and d is not null").select("path", "ord", "text", "d.*")
    numbered = running(data, ["path", "decl_ord"], ["ord"], ord_block(), {"i": ("sum", F.lit(1).cast("bigint"))}, exclusive=True)
    parts = words(F.col("text"))
    pos = F.when(F.col("fixed"), F.col("first") + F.col("i") * F.col("step")).otherwise(to_int(cell(parts, 0)))
    value = to_float(F.when(F.col("fixed"), F.col("text")).otherwise(cell(parts, 1)))
    return numbered.select(
        "path", "ord", "chrom", (pos - 1).alias("start"), (pos - 1 + F.col("span")).alias("end"), value.alias("value")
    ).where("start is not null and value is not null")


def parse_sam(lines: DataFrame) -> DataFrame:
    c = F.col("_c")
    rows = lines.where((F.col("value") != "") & ~F.col("value").startswith("@")).withColumn("_c", cells(F.col("value")))
    return rows.where(F.size("_c") >= 11).select(
        "path", "ord", *[(to_int(cell(c, i)) if n in SAM_INTS else cell(c, i)).alias(n) for i, n in enumerate(SAM_COLUMNS)],
        F.slice(c, 12, F.greatest(F.size(c) - 11, F.lit(0))).alias("tags"))


def parse_rmsk(lines: DataFrame) -> DataFrame:
    """RepeatMasker ``.out`` rows (14 or 15 words, starting with a score); title and other lines are skipped."""
    c = F.col("_c")
    star = F.element_at(c, -1) == "*"
    rows = content(lines).withColumn("_c", words(F.col("value")))
    rows = rows.withColumn("overlapped", star).withColumn("_c", F.when(star, F.slice(c, 1, F.size(c) - 1)).otherwise(c))
    rows = rows.where(F.size("_c").isin(14, 15) & cell(c, 0).rlike("^[0-9]+$"))

    def paren(x: Column) -> Column:
        return to_int(F.regexp_replace(x, r"[()]", ""))

    forward = cell(c, 8) == "+"
    return rows.select(
        "path", "ord", to_int(cell(c, 0)).alias("score"), *[to_float(cell(c, i)).alias(n) for i, n in ((1, "pct_div"), (2, "pct_del"), (3, "pct_ins"))],
        cell(c, 4).alias("query"), to_int(cell(c, 5)).alias("q_begin"), to_int(cell(c, 6)).alias("q_end"), paren(cell(c, 7)).alias("q_left"),
        F.when(forward, "+").otherwise("-").alias("strand"), cell(c, 9).alias("repeat"), cell(c, 10).alias("class_family"),
        paren(F.when(forward, cell(c, 11)).otherwise(cell(c, 13))).alias("r_begin"), paren(cell(c, 12)).alias("r_end"),
        paren(F.when(forward, cell(c, 13)).otherwise(cell(c, 11))).alias("r_left"), to_int(cell(c, 14)).alias("id"), "overlapped")


def parse_bedmethyl(lines: DataFrame) -> DataFrame:
    """18-column or 11-column bedMethyl; the shorter form has null counts."""
    c = F.col("_c")
    text = {"chrom", "mod_code", "strand", "rgb"}
    by_space = words(F.col("value"))
    rows = content(lines, "#", "track ", "browser ").withColumn("_c", by_space).where(F.size("_c").isin(11, 18))

    def typed(i: int, n: str) -> Column:
        x = cell(c, i)
        return x if n in text else (to_float(x) if n == "percent" else to_int(x))

    return rows.select("path", "ord", F.size("_c").alias("n_columns"), *[typed(i, n).alias(n) for i, n in enumerate(BEDMETHYL_COLUMNS)])


def parse_maf(lines: DataFrame, header: list[str]) -> DataFrame:
    """Mutation annotation rows under the given header names; comment and header lines are skipped."""
    c = F.col("_c")
    rows = content(lines, "#").where(F.col("value") != F.lit("\t".join(header))).withColumn("_c", cells(F.col("value")))
    return rows.select("path", "ord", *[cell(c, i, "").alias(n) for i, n in enumerate(header)])


def parse_plink_map(lines: DataFrame) -> DataFrame:
    c = F.col("_c")
    rows = content(lines, "#").withColumn("_c", words(F.col("value"))).where(F.size("_c").isin(3, 4))
    four = F.size("_c") == 4
    numbered = running(rows, ["path"], ["ord"], ord_block(), {"idx": ("sum", F.lit(1).cast("bigint"))}, exclusive=True)
    return numbered.select(
        "path", "idx", cell(c, 0).alias("chrom"), cell(c, 1).alias("variant_id"),
        F.when(four, to_float(cell(c, 2))).alias("morgans"), to_int(F.when(four, cell(c, 3)).otherwise(cell(c, 2))).alias("pos"))


def parse_plink_ped(lines: DataFrame) -> DataFrame:
    """One row per (individual, variant index) with both alleles."""
    c = F.col("_c")
    rows = content(lines, "#").withColumn("_c", words(F.col("value"))).where(F.size("_c") >= 6)
    last = F.expr("cast((size(_c) - 6) div 2 - 1 as int)")
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.struct(
        F.try_element_at(c, i * 2 + 7).alias("a1"), F.try_element_at(c, i * 2 + 8).alias("a2")))
    return rows.where("size(_c) >= 8").select(
        "path", "ord", cell(c, 0).alias("family"), cell(c, 1).alias("individual"), cell(c, 4).alias("sex"), cell(c, 5).alias("phenotype"),
        F.posexplode(pairs).alias("idx", "g")
    ).select("path", "ord", "family", "individual", "sex", "phenotype", F.col("idx").cast("bigint").alias("idx"), "g.a1", "g.a2")
