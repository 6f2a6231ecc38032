"""Gene-level methylation: region means, differential tests and cross-dataset aggregation.

Everything stays in long form with ``dataset`` and ``region`` columns. A missing (gene, sample)
value counts as 0.0 in the tests; those zeros are never materialised, they enter as one weighted
zero per gene and class.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.functions.values import error_function, general_number, to_float
from locusframe.operators.intervals import interval_join
from locusframe.operators.ordered import magnitude_block, running
from locusframe.session import materialize

TEST_KEYS = ["dataset", "region", "gene_id"]


def region_means(sites: DataFrame, regions: DataFrame, by: Sequence[str] = ("dataset", "sample")) -> DataFrame:
    """Unweighted mean of all sites overlapping each region; regions without sites are absent.

    ``sites``: by-columns, chrom, start, end, value. ``regions``: region, gene_id, chrom, start,
    end. Equal sites are summed before the join and the mean is a mergeable aggregate.
    """
    by = list(by)
    slim = sites.groupBy(*by, "chrom", "start", "end").agg(F.sum("value").alias("_sum"), F.count("value").alias("_n"))
    hits = interval_join(regions, slim, short_side="right")
    return hits.groupBy(*by, "region", "gene_id").agg((F.sum("_sum") / F.sum("_n")).alias("value"))


def sample_class(sample: Column, stated: Mapping[str, str] | None = None, patterns: Mapping[str, str] | None = None) -> Column:
    """Class of a sample: the stated one, else the first pattern found in its name, else ``NA``."""
    out = F.when(F.lit(False), F.lit(""))
    for name, cls in (stated or {}).items():
        out = out.when(sample == name, cls)
    for cls, pattern in (patterns or {}).items():
        out = out.when(sample.rlike(pattern), cls)
    return out.otherwise("NA")


def rescale_cells(text: Column, scale: float = 0.01) -> Column:
    """Every comma-separated number times ``scale``; other tokens unchanged."""
    return F.array_join(F.transform(F.split(text, ",", -1), lambda t: F.coalesce(
        (to_float(t) * scale).cast("string"), t)), ",")


def sample_matrix(values: DataFrame, genes: DataFrame, samples: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Genes by samples, all genes of the list, missing values 0.0; ``by`` (columns of both inputs) makes one matrix for each of its values."""
    keys = [*by, "gene_id"]
    wide = values.groupBy(*keys).pivot("sample", list(samples)).agg(F.first("value"))
    return genes.select(*keys).distinct().join(wide, keys, "left").fillna(0.0, subset=list(samples))


def class_sizes(samples: DataFrame, case: str = "case", control: str = "control") -> DataFrame:
    """Number of case and control samples per dataset (``dataset``, ``sample``, ``class``)."""
    return samples.groupBy("dataset").agg(
        F.count_if(F.col("class") == case).cast("bigint").alias("n1"), F.count_if(F.col("class") == control).cast("bigint").alias("n2"))


def _weighted(values: DataFrame, sizes: DataFrame, grid: DataFrame, case: str, control: str) -> DataFrame:
    """Distinct values per test with their multiplicity in both classes, zeros included."""
    counted = values.where(F.col("class").isin(case, control)).groupBy(*TEST_KEYS, "value").agg(
        F.count_if(F.col("class") == case).alias("a"), F.count_if(F.col("class") == control).alias("b"))
    present = counted.groupBy(*TEST_KEYS).agg(F.sum("a").alias("pa"), F.sum("b").alias("pb"))
    zero = F.lit(0).cast("bigint")
    zeros = grid.join(present, TEST_KEYS, "left").join(sizes, "dataset").select(
        *TEST_KEYS, F.lit(0.0).alias("value"),
        (F.col("n1") - F.coalesce("pa", zero)).alias("a"), (F.col("n2") - F.coalesce("pb", zero)).alias("b"))
    both = counted.join(grid, TEST_KEYS, "left_semi").unionByName(zeros).where("a > 0 or b > 0")
    return both.groupBy(*TEST_KEYS, "value").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def test_grid(genes: DataFrame, datasets: Sequence[str]) -> DataFrame:
    """All (dataset, region, gene) tests; ``genes``: region, gene_id."""
    return genes.select("region", "gene_id").distinct().withColumn("dataset", F.explode(F.array(*[F.lit(d) for d in datasets])))


def rank_statistics(values: DataFrame, sizes: DataFrame, grid: DataFrame, case: str = "case", control: str = "control") -> DataFrame:
    """Mann-Whitney U with average ranks and tie correction, and both medians, per test.

    Ranks are running counts over the distinct values, so a test with very many samples spreads
    over blocks of its values.
    """
    w = _weighted(values, sizes, grid, case, control)
    cum = running(w, TEST_KEYS, ["value"], magnitude_block("value"),
                  {"ca": ("sum", F.col("a")), "cb": ("sum", F.col("b"))}, exclusive=True).join(sizes, "dataset")
    t = F.col("a") + F.col("b")
    avg_rank = F.col("ca") + F.col("cb") + (t + 1) / 2

    def middle(cum_before: str, weight: str, total: str) -> Column:
        def at(k: Column) -> Column:
            inside = (F.col(cum_before) <= k) & (k < F.col(cum_before) + F.col(weight))
            return F.max(F.when(inside, F.col("value")))
        return (at(F.floor((F.col(total) - 1) / 2)) + at(F.floor(F.col(total) / 2))) / 2

    stats = cum.groupBy(*TEST_KEYS, "n1", "n2").agg(
        F.sum(F.col("a") * avg_rank).alias("r1"), F.sum(t * t * t - t).cast("double").alias("tie_sum"),
        middle("ca", "a", "n1").alias("median_case"), middle("cb", "b", "n2").alias("median_control"))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    u1 = F.col("r1") - n1 * (n1 + 1) / 2
    stats = stats.withColumn("u", F.least(u1, n1 * n2 - u1))
    var = (n1 * n2 / 12) * ((n + 1) - F.col("tie_sum") / (n * (n - 1)))
    z = F.when(var > 0, (F.col("u") - n1 * n2 / 2) / F.sqrt(var))
    return stats.select(*TEST_KEYS, "n1", "n2", "u", "tie_sum", z.alias("z"), "median_case", "median_control")


def two_sided_p(z: Column) -> Column:
    """Two-sided normal p-value; no statistic gives 1."""
    tail = 2.0 * (1.0 - 0.5 * (1.0 + error_function(F.abs(z) / F.sqrt(F.lit(2.0)))))
    return F.when(z.isNull() | F.isnan(z), 1.0).otherwise(tail)


def false_discovery(tests: DataFrame, keys: Sequence[str] = ("dataset", "region"), p: str = "p") -> DataFrame:
    """Benjamini-Hochberg ``q`` per family.

    Equal p-values share the largest of their ranks, so ranks and the running minimum are taken
    over distinct p-values.
    """
    keys = list(keys)
    distinct = tests.groupBy(*keys, p).agg(F.count("*").alias("_n"))
    total = distinct.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    ranked = running(distinct, keys, [p], magnitude_block(p), {"_rank": ("sum", F.col("_n"))}).join(total, keys)
    raw = ranked.withColumn("_raw", F.least(F.lit(1.0), F.col(p) * F.col("_total") / F.col("_rank")))
    q = running(raw, keys, [p], magnitude_block(p), {"q": ("min", F.col("_raw"))}, reverse=True).select(*keys, p, "q")
    return tests.join(q, [*keys, p])


def wilcox_calls(stats: DataFrame, min_median: float = 0.2) -> DataFrame:
    """p, q and direction by the larger median, which must exceed ``min_median``."""
    mc, mn = F.col("median_case"), F.col("median_control")
    tested = false_discovery(materialize(stats.withColumn("p", two_sided_p(F.col("z")))))
    direction = F.when((mc > mn) & (mc > min_median), "High").when((mn > mc) & (mn > min_median), "Low")
    return tested.withColumn("direction", direction)


def significant(calls: DataFrame, pval: float = 0.02) -> DataFrame:
    """Calls with a direction and raw p below the cut-off (the q-value is reported, not used)."""
    text = [F.lit("p="), general_number(F.col("p")), F.lit(";fdr="), general_number(F.col("q")), F.lit(";median_case="),
            general_number(F.col("median_case")), F.lit(";median_control="), general_number(F.col("median_control"))]
    return calls.where((F.col("p") < pval) & F.col("direction").isNotNull()).select(
        "dataset", "region", "gene_id", "direction", F.concat(*text).alias("evidence"), "p", "q", "median_case", "median_control")


def foldchange_calls(
    values: DataFrame, sizes: DataFrame, grid: DataFrame, fc: float = 2.0, min_abs: float = 20.0,
    case: str = "case", control: str = "control",
) -> DataFrame:
    """High when all cases exceed all controls by ``fc``; Low uses max_control / min_case."""
    w = _weighted(values, sizes, grid, case, control)
    a, b, v = F.col("a") > 0, F.col("b") > 0, F.col("value")
    ext = w.groupBy(*TEST_KEYS).agg(
        F.min(F.when(a, v)).alias("min_case"), F.max(F.when(a, v)).alias("max_case"),
        F.min(F.when(b, v)).alias("min_control"), F.max(F.when(b, v)).alias("max_control"))
    above, below = F.col("min_case") > F.col("max_control"), F.col("max_case") < F.col("min_control")
    ratio = F.when(above, F.col("min_case") / (F.col("max_control") + 1e-9)).when(
        below, F.col("max_control") / (F.col("min_case") + 1e-9))
    winner = F.when(above, F.col("max_case")).when(below, F.col("max_control"))
    ok = (ratio >= fc) & (winner > min_abs)
    return ext.select(
        *TEST_KEYS, "min_case", "max_case", "min_control", "max_control", ratio.alias("fold_change"),
        F.when(ok, F.when(above, "High").otherwise("Low")).alias("direction"))


def foldchange_significant(calls: DataFrame) -> DataFrame:
    high = F.concat(F.lit("FC="), general_number(F.col("fold_change")), F.lit(";min_case="), general_number(F.col("min_case")),
                    F.lit(";max_control="), general_number(F.col("max_control")))
    low = F.concat(F.lit("FC="), general_number(F.col("fold_change")), F.lit(";max_case="), general_number(F.col("max_case")),
                   F.lit(";min_control="), general_number(F.col("min_control")))
    return calls.where("direction is not null").select(
        "dataset", "region", "gene_id", "direction", F.when(F.col("direction") == "High", high).otherwise(low).alias("evidence"),
        "fold_change")


# ---- across datasets ------------------------------------------------------------------------

def _label(direction: Column) -> Column:
    return F.when(direction == "High", "hyper").otherwise("hypo")


def listed(calls: DataFrame, gene_list: DataFrame | None) -> DataFrame:
    return calls if gene_list is None else calls.join(gene_list.select("gene_id").distinct(), "gene_id", "left_semi")


def disease_matrix(calls: DataFrame, diseases: Sequence[str], region: str, fill: str = "-") -> DataFrame:
    """Genes by diseases with hyper / hypo; the call of the last dataset of a disease wins.

    ``calls``: disease, dataset_no, region, gene_id, direction.
    """
    return calls.where(F.col("region") == region).groupBy("gene_id").pivot("disease", list(diseases)).agg(
        F.max_by(_label(F.col("direction")), "dataset_no")).fillna(fill, subset=list(diseases))


def last_calls(calls: DataFrame) -> DataFrame:
    """One call per (region, gene, disease): the last dataset listed under the disease name."""
    return calls.groupBy("region", "gene_id", "disease").agg(
        F.max_by("direction", "dataset_no").alias("direction"), F.max_by("category", "dataset_no").alias("category"))


def disease_categories(calls: DataFrame) -> DataFrame:
    return calls.select("region", "gene_id", "category").distinct()


def consistent_genes(calls: DataFrame, categories: Sequence[str] | None = None, least: int = 5) -> DataFrame:
    """Genes called in one direction by at least ``least`` diseases and never in the other."""
    one = last_calls(calls)
    if categories is not None:
        one = one.where(F.col("category").isin(*categories))
    n = one.groupBy("region", "gene_id").agg(
        F.count_if(F.col("direction") == "High").alias("h"), F.count_if(F.col("direction") != "High").alias("l"))
    call = F.when((F.col("h") >= least) & (F.col("l") == 0), "hyper").when((F.col("l") >= least) & (F.col("h") == 0), "hypo")
    return n.select("region", "gene_id", call.alias("call")).where("call is not null")


def long_labels(calls: DataFrame) -> DataFrame:
    return calls.select(
        F.col("gene_id").alias("geneid"), F.col("evidence").alias("value"), "dataset", F.lit("Sig").alias("sig_label"),
        F.col("region").alias("locus"), F.col("disease").alias("condition"))


def database_import(calls: DataFrame, diseases: Sequence[str]) -> DataFrame:
    """One body and one promoter row per gene, ``NA`` where a disease has no call."""
    both = F.explode(F.array(F.lit("body"), F.lit("promoter"))).alias("region")
    genes = calls.select("gene_id").distinct().select("gene_id", both)
    wide = calls.groupBy("gene_id", "region").pivot("disease", list(diseases)).agg(F.max_by(_label(F.col("direction")), "dataset_no"))
    return genes.join(wide, ["gene_id", "region"], "left").fillna("NA", subset=list(diseases)).withColumnRenamed("region", "Location")
