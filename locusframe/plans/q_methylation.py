"""Queries of the methylation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.operators import methylation as M
from locusframe.plans.registry import Query, longs
from locusframe.plans.views import VIEWS, sql, view
from locusframe.sources import tables as T

DATASETS = ["ds0", "ds1", "ds2"]
# methylation sites: dataset and sample from the user, one value per site
VIEWS["sites"] = """
SELECT 'ds'||CAST(user_id%3 AS STRING) AS dataset, CASE WHEN user_id%6<3 THEN 'tumor_' ELSE 'Normal_' END||CAST(user_id%24 AS STRING) AS sample, 'chr'||CAST(event_id%4+1 AS STRING) AS chrom,
       event_id*13 AS start, event_id*13+1+event_id%3 AS end_, CAST((event_id*7)%11 AS DOUBLE)*10 AS value FROM {events}"""
VIEWS["gene_regions"] = """
SELECT CASE WHEN p_partkey%2=0 THEN 'body' ELSE 'promoter' END AS region, 'g'||CAST(p_partkey AS STRING) AS gene_id, 'chr'||CAST(p_partkey%5+1 AS STRING) AS chrom,
       p_partkey*65 AS start, p_partkey*65+200+p_size*20 AS end_ FROM {part}"""
# a test table with ties, missing samples and genes without any value
VIEWS["gene_values"] = """
SELECT 'ds'||CAST(k%3 AS STRING) AS dataset, CASE WHEN n%2=0 THEN 'body' ELSE 'promoter' END AS region, 'g'||CAST(k%200 AS STRING) AS gene_id,
       CASE WHEN sk%2=0 THEN 'case_' ELSE 'control_' END||CAST(sk%10 AS STRING) AS sample, CASE WHEN sk%2=0 THEN 'case' ELSE 'control' END AS class,
       max(CAST(CASE WHEN sk%2=0 THEN 40+(k%200)%9*5+qty%13 ELSE 10+(k%200)%7*8+qty%17 END AS DOUBLE)) AS value FROM {li} WHERE k%200<>7 GROUP BY 1, 2, 3, 4, 5"""
VIEWS["site_lines"] = """
SELECT 's1.bed' AS path, event_id AS ord, 'chr'||CAST(event_id%4+1 AS STRING)||chr(9)||CAST(event_id*13 AS STRING)||chr(9)||CAST(event_id*13+1 AS STRING)||
       CASE CAST(event_id%4 AS INT) WHEN 0 THEN '' WHEN 1 THEN chr(9)||CAST(user_id AS STRING) WHEN 2 THEN chr(9)||'x'||chr(9)||CAST(user_id AS STRING) ELSE chr(9)||'m'||chr(9)||'0'||chr(9)||'+' END AS value FROM {events}"""
VIEWS["bismark_lines"] = """
SELECT 'dir/s2_CpG_report.txt' AS path, event_id AS ord, 'chr1'||chr(9)||CAST(event_id+1 AS STRING)||chr(9)||'+'||chr(9)||CASE WHEN user_id%17=0 THEN 'x' ELSE CAST(user_id%5 AS STRING) END||chr(9)||CAST(event_id%4 AS STRING)||chr(9)||'CG' AS value FROM {events}"""
VIEWS["region_lines"] = """
SELECT CASE WHEN p_partkey%7<3 THEN 'genes.txt' ELSE 'genes2.txt' END AS path, 100000000-p_partkey AS ord, 'g'||CAST(p_partkey%900 AS STRING)||chr(9)||'chr'||CAST(p_size%5 AS STRING)||chr(9)||CASE WHEN p_partkey%41=0 THEN 'bad' ELSE CAST(p_partkey*10+1 AS STRING) END||chr(9)||CAST(p_partkey*10+500 AS STRING) AS value FROM {part}"""
VIEWS["sig_calls"] = """
SELECT DISTINCT 'dis'||CAST(sk%8 AS STRING) AS disease, CAST(sk%16 AS BIGINT) AS dataset_no, 'GSE'||CAST(sk%16 AS STRING) AS dataset, CASE WHEN sk%8<6 THEN 'cancer' ELSE 'brain' END AS category,
       CASE WHEN n%2=0 THEN 'body' ELSE 'promoter' END AS region, 'g'||CAST(k%700 AS STRING) AS gene_id, CASE WHEN (k%700)%3=0 OR (sk%16+k%700)%5=0 THEN 'High' ELSE 'Low' END AS direction, 'p='||CAST(k%700 AS STRING) AS evidence FROM {li}"""
VIEWS["p_values"] = """
SELECT 'ds'||CAST(sk%3 AS STRING) AS dataset, CASE WHEN n%2=0 THEN 'body' ELSE 'promoter' END AS region, 'g'||CAST(k*8+n AS STRING) AS gene_id, CAST((pk*31)%997 AS DOUBLE)/CAST(997 AS DOUBLE) AS p FROM {li}"""


def classed_sites(s, d):
    cls = M.sample_class(F.col("sample"), {"Normal_3": "case"}, {"case": "tumor|MB", "control": "^Normal"})
    return view(s, d, "sites").withColumn("class", cls)


def q_means(s, d):
    out = M.region_means(view(s, d, "sites"), view(s, d, "gene_regions"))
    return out.withColumn("value", F.round("value", 6))


def q_class(s, d):
    return classed_sites(s, d).groupBy("dataset", "sample", "class").agg(F.count("*").alias("n"))


def q_sizes(s, d):
    return M.class_sizes(classed_sites(s, d).select("dataset", "sample", "class").distinct())


def q_matrix(s, d):
    v = view(s, d, "gene_values")
    return M.sample_matrix(v, M.test_grid(v, DATASETS), MATRIX_NAMES, ["dataset", "region"])


def q_rescale(s, d):
    text = F.concat_ws(",", F.col("gene_id"), F.col("value").cast("bigint").cast("string"))
    return view(s, d, "gene_values").select("dataset", "region", "gene_id", "sample", M.rescale_cells(text, 0.5).alias("cell"))


def _tests(s, d):
    v = view(s, d, "gene_values")
    sizes = M.class_sizes(v.select("dataset", "sample", "class").distinct())
    grid = M.test_grid(view(s, d, "gene_regions").select("region", F.concat(F.lit("g"), (F.substring("gene_id", 2, 9).cast("int") % 200).cast("string")).alias("gene_id")), DATASETS)
    return v, sizes, grid


def q_ranks(s, d):
    out = M.rank_statistics(*_tests(s, d))
    return longs(out.withColumn("z", F.round("z", 8)))


def q_fdr(s, d):
    return M.false_discovery(view(s, d, "p_values")).select("dataset", "region", "gene_id", "p", F.round("q", 9).alias("q"))


def q_wilcox(s, d):
    """Whole test with p-values."""
    out = M.significant(M.wilcox_calls(M.rank_statistics(*_tests(s, d)), 20.0), 0.3)
    return out.withColumns({"p": F.round("p", 9), "q": F.round("q", 9)})


def q_fc(s, d):
    return M.foldchange_calls(*_tests(s, d), fc=1.05, min_abs=20.0).withColumn("fold_change", F.round("fold_change", 6))


def q_fc_sig(s, d):
    return M.foldchange_significant(M.foldchange_calls(*_tests(s, d), fc=1.05, min_abs=20.0)).withColumn("fold_change", F.round("fold_change", 6))


def calls(s, d):
    return view(s, d, "sig_calls")


NAMES = [f"dis{i}" for i in range(8)]


def q_disease_matrix(s, d):
    return M.disease_matrix(calls(s, d), NAMES, "body")


def q_listed(s, d):
    genes = view(s, d, "gene_regions").where("region = 'body'")
    return M.listed(calls(s, d), genes).select("gene_id", "disease", "dataset", "region", "direction")


def q_categories(s, d):
    return M.disease_categories(calls(s, d))


def q_consistent(s, d):
    return M.consistent_genes(calls(s, d), ["cancer"])


def q_consistent_all(s, d):
    return M.consistent_genes(calls(s, d))


def q_labels(s, d):
    return M.long_labels(calls(s, d))


def q_import(s, d):
    return M.database_import(calls(s, d), NAMES)


def q_scan_sites(s, d):
    return T.parse_sites(view(s, d, "site_lines"), 3).select("chrom", "start", "end", "value")


def q_bismark(s, d):
    out = T.parse_bismark(view(s, d, "bismark_lines"))
    return out.select(T.sample_stem(F.col("path")).alias("sample"), "chrom", "start", "end", F.round("value", 9).alias("value"))


def q_gene_regions(s, d):
    return T.parse_gene_regions(view(s, d, "region_lines"))


GRID = """
, gr AS (SELECT DISTINCT region, 'g'||CAST(CAST(substr(gene_id, 2) AS BIGINT)%200 AS VARCHAR) AS gene_id FROM gene_regions),
dsx AS (SELECT * FROM (VALUES ('ds0'), ('ds1'), ('ds2')) t(dataset)), sm AS (SELECT DISTINCT dataset, sample, class FROM gene_values),
keyed AS (SELECT dataset, region, gene_id FROM gr, dsx UNION SELECT dataset, region, gene_id FROM gene_values),
full_ AS (SELECT k.dataset, k.region, k.gene_id, sm.class, coalesce(v.value, 0.0) AS value, (k.region, k.gene_id) IN (SELECT (region, gene_id) FROM gr) AS listed, v.value IS NOT NULL AS have
  FROM keyed k JOIN sm ON sm.dataset=k.dataset LEFT JOIN gene_values v ON v.dataset=k.dataset AND v.region=k.region AND v.gene_id=k.gene_id AND v.sample=sm.sample),
use AS (SELECT * FROM full_ WHERE listed)
"""
RANKS = """
, r AS (SELECT *, rank() OVER (PARTITION BY dataset, region, gene_id ORDER BY value) + (count(*) OVER (PARTITION BY dataset, region, gene_id, value)-1)/2.0 AS ar, count(*) OVER (PARTITION BY dataset, region, gene_id, value) AS t FROM use),
g AS (SELECT dataset, region, gene_id, count(*) FILTER (WHERE class='case') AS n1, count(*) FILTER (WHERE class='control') AS n2, CAST(sum(ar) FILTER (WHERE class='case') AS DOUBLE) AS r1, CAST(sum(t*t-1) AS DOUBLE) AS tie_sum,
  median(value) FILTER (WHERE class='case') AS median_case, median(value) FILTER (WHERE class='control') AS median_control FROM r GROUP BY 1,2,3),
u AS (SELECT *, least(r1-CAST(n1 AS DOUBLE)*(n1+1)/2, CAST(n1 AS DOUBLE)*n2-(r1-CAST(n1 AS DOUBLE)*(n1+1)/2)) AS u, CAST(n1 AS DOUBLE)*n2/12*((n1+n2+1)-tie_sum/(CAST(n1+n2 AS DOUBLE)*(n1+n2-1))) AS var FROM g)
"""
# the error function as its series of positive terms
P_VALUES = """
, zs AS (SELECT *, CASE WHEN var>0 THEN abs((u-CAST(n1 AS DOUBLE)*n2/2)/sqrt(var))/sqrt(2) END AS x FROM u),
ps AS (SELECT *, CASE WHEN x IS NULL THEN 1.0 ELSE 2*(1-(1+exp(-x*x)*list_sum([pow(x, 2*i+1)/gamma(i+1.5) for i in range(0, 90)]))/2) END AS p FROM zs),
pr AS (SELECT *, row_number() OVER (PARTITION BY dataset, region ORDER BY p) AS rk, count(*) OVER (PARTITION BY dataset, region) AS m FROM ps),
pq AS (SELECT *, least(1.0, min(p*m/rk) OVER (PARTITION BY dataset, region ORDER BY rk DESC)) AS q, CASE WHEN median_case>median_control AND median_case>20 THEN 'High' WHEN median_control>median_case AND median_control>20 THEN 'Low' END AS direction FROM pr)
"""
FOLDS = """
, e AS (SELECT dataset, region, gene_id, min(value) FILTER (WHERE class='case') AS min_case, max(value) FILTER (WHERE class='case') AS max_case, min(value) FILTER (WHERE class='control') AS min_control, max(value) FILTER (WHERE class='control') AS max_control FROM use GROUP BY 1,2,3),
f AS (SELECT *, CASE WHEN min_case>max_control THEN min_case/(max_control+CAST(1e-9 AS DOUBLE)) WHEN max_case<min_control THEN max_control/(min_case+CAST(1e-9 AS DOUBLE)) END AS fc FROM e)
"""
MATRIX_NAMES = [f"{'case' if i % 2 == 0 else 'control'}_{i}" for i in range(10)]

QUERIES = {
    "methylation_region_means": Query(q_means, sql("""SELECT dataset, sample, region, gene_id, round(avg(value), 6) AS value FROM sites s JOIN gene_regions g ON g.chrom=s.chrom AND s.start<g.end_ AND g.start<s.end_ GROUP BY 1,2,3,4""", "sites", "gene_regions")),
    "methylation_sample_classes": Query(q_class, sql("""SELECT dataset, sample, CASE WHEN sample='Normal_3' OR sample LIKE 'tumor%' THEN 'case' ELSE 'control' END AS class, count(*) AS n FROM sites GROUP BY 1,2,3""", "sites")),
    "methylation_class_sizes": Query(q_sizes, sql("""SELECT dataset, count(DISTINCT sample) FILTER (WHERE sample='Normal_3' OR sample LIKE 'tumor%') AS n1, count(DISTINCT sample) FILTER (WHERE NOT (sample='Normal_3' OR sample LIKE 'tumor%')) AS n2 FROM sites GROUP BY 1""", "sites")),
    "methylation_matrix": Query(q_matrix, sql("""
, g AS (SELECT DISTINCT region, gene_id FROM gene_values), ds AS (SELECT DISTINCT dataset, region FROM gene_values), k AS (SELECT dataset, g.region, gene_id FROM ds JOIN g ON g.region=ds.region)
SELECT k.dataset, k.region, k.gene_id, """ + ", ".join(f"coalesce(max(value) FILTER (WHERE sample='{n}'), 0.0) AS {n}" for n in MATRIX_NAMES) + """
FROM k LEFT JOIN gene_values v ON v.dataset=k.dataset AND v.region=k.region AND v.gene_id=k.gene_id GROUP BY 1,2,3""", "gene_values")),
    "methylation_rescale_cells": Query(q_rescale, sql("""SELECT dataset, region, gene_id, sample, gene_id||','||CAST(value*CAST(0.5 AS DOUBLE) AS VARCHAR) AS cell FROM gene_values""", "gene_values")),
    "methylation_rank_statistics": Query(q_ranks, sql(GRID + RANKS + """
SELECT dataset, region, gene_id, n1, n2, u, tie_sum, CASE WHEN var>0 THEN round((u-CAST(n1 AS DOUBLE)*n2/2)/sqrt(var), 8) END AS z, median_case, median_control FROM u""", "gene_values", "gene_regions")),
    "methylation_false_discovery": Query(q_fdr, sql("""
, r AS (SELECT *, row_number() OVER w AS rk, count(*) OVER (PARTITION BY dataset, region) AS n FROM p_values WINDOW w AS (PARTITION BY dataset, region ORDER BY p, gene_id)),
q AS (SELECT *, least(1.0, min(p*n/rk) OVER (PARTITION BY dataset, region ORDER BY rk DESC)) AS q FROM r)
SELECT dataset, region, gene_id, p, round(q, 9) AS q FROM q""", "p_values")),
    "methylation_wilcox_significant": Query(q_wilcox, sql(GRID + RANKS + P_VALUES + """
SELECT dataset, region, gene_id, direction, printf('p=%.6g;fdr=%.6g;median_case=%.6g;median_control=%.6g', p, q, median_case, median_control) AS evidence,
  round(p, 9) AS p, round(q, 9) AS q, median_case, median_control FROM pq WHERE p<0.3 AND direction IS NOT NULL""", "gene_values", "gene_regions")),
    "methylation_foldchange": Query(q_fc, sql(GRID + FOLDS + """
SELECT dataset, region, gene_id, min_case, max_case, min_control, max_control, round(fc, 6) AS fold_change, CASE WHEN min_case>max_control AND fc>=1.05 AND max_case>20 THEN 'High' WHEN max_case<min_control AND fc>=1.05 AND max_control>20 THEN 'Low' END AS direction FROM f""", "gene_values", "gene_regions")),
    "methylation_foldchange_significant": Query(q_fc_sig, sql(GRID + FOLDS + """
, h AS (SELECT *, CASE WHEN min_case>max_control AND max_case>20 THEN 'High' WHEN max_case<min_control AND max_control>20 THEN 'Low' END AS direction FROM f WHERE fc>=1.05)
SELECT dataset, region, gene_id, direction, CASE direction WHEN 'High' THEN printf('FC=%.6g;min_case=%.6g;max_control=%.6g', fc, min_case, max_control) ELSE printf('FC=%.6g;max_case=%.6g;min_control=%.6g', fc, max_case, min_control) END AS evidence,
  round(fc, 6) AS fold_change FROM h WHERE direction IS NOT NULL""", "gene_values", "gene_regions")),
    "methylation_disease_matrix": Query(q_disease_matrix, sql("""
, o AS (SELECT gene_id, disease, max_by(direction, dataset_no) AS dr FROM sig_calls WHERE region='body' GROUP BY 1,2)
SELECT gene_id, """ + ", ".join(f"coalesce(max(CASE WHEN dr='High' THEN 'hyper' ELSE 'hypo' END) FILTER (WHERE disease='{n}'), '-') AS {n}" for n in NAMES) + " FROM o GROUP BY 1", "sig_calls")),
    "methylation_listed_genes": Query(q_listed, sql("SELECT gene_id, disease, dataset, region, direction FROM sig_calls WHERE gene_id IN (SELECT gene_id FROM gene_regions WHERE region='body')", "sig_calls", "gene_regions")),
    "methylation_disease_categories": Query(q_categories, sql("SELECT DISTINCT region, gene_id, category FROM sig_calls", "sig_calls")),
    "methylation_consistent_cancer": Query(q_consistent, sql("""
, o AS (SELECT region, gene_id, disease, max_by(direction, dataset_no) AS dr FROM sig_calls WHERE category='cancer' GROUP BY 1,2,3), c AS (SELECT region, gene_id, count(*) FILTER (WHERE dr='High') AS h, count(*) FILTER (WHERE dr<>'High') AS l FROM o GROUP BY 1,2)
SELECT region, gene_id, CASE WHEN l=0 THEN 'hyper' ELSE 'hypo' END AS call FROM c WHERE (h>=5 AND l=0) OR (l>=5 AND h=0)""", "sig_calls")),
    "methylation_consistent_all": Query(q_consistent_all, sql("""
, o AS (SELECT region, gene_id, disease, max_by(direction, dataset_no) AS dr FROM sig_calls GROUP BY 1,2,3), c AS (SELECT region, gene_id, count(*) FILTER (WHERE dr='High') AS h, count(*) FILTER (WHERE dr<>'High') AS l FROM o GROUP BY 1,2)
SELECT region, gene_id, CASE WHEN l=0 THEN 'hyper' ELSE 'hypo' END AS call FROM c WHERE (h>=5 AND l=0) OR (l>=5 AND h=0)""", "sig_calls")),
    "methylation_long_labels": Query(q_labels, sql("SELECT gene_id AS geneid, evidence AS value, dataset, 'Sig' AS sig_label, region AS locus, disease AS condition FROM sig_calls", "sig_calls")),
    "methylation_database_import": Query(q_import, sql("""
, o AS (SELECT gene_id, region, disease, max_by(direction, dataset_no) AS dr FROM sig_calls GROUP BY 1,2,3), g AS (SELECT gene_id, region FROM (SELECT DISTINCT gene_id FROM sig_calls), (VALUES ('body'), ('promoter')) t(region))
SELECT g.gene_id, g.region AS "Location", """ + ", ".join(f"coalesce(max(CASE WHEN dr='High' THEN 'hyper' ELSE 'hypo' END) FILTER (WHERE disease='{n}'), 'NA') AS {n}" for n in NAMES) + " FROM g LEFT JOIN o ON o.gene_id=g.gene_id AND o.region=g.region GROUP BY 1,2", "sig_calls")),
    "scan_methylation_sites": Query(q_scan_sites, sql("""
, r AS (SELECT string_split(value, chr(9)) AS c FROM site_lines)
SELECT c[1] AS chrom, CAST(c[2] AS BIGINT) AS start, CAST(c[3] AS BIGINT) AS "end", CASE len(c) WHEN 3 THEN CAST(c[3] AS DOUBLE) WHEN 4 THEN CAST(c[4] AS DOUBLE) WHEN 5 THEN CAST(c[5] AS DOUBLE) ELSE 0.0 END AS value FROM r""", "site_lines")),
    "scan_bismark": Query(q_bismark, sql("""
, r AS (SELECT string_split(value, chr(9)) AS c FROM bismark_lines), x AS (SELECT c, TRY_CAST(c[4] AS BIGINT) AS m, CAST(c[5] AS BIGINT) AS u FROM r)
SELECT 's2' AS sample, c[1] AS chrom, CAST(c[2] AS BIGINT)-1 AS start, CAST(c[2] AS BIGINT) AS "end", CASE WHEN m+u=0 THEN 0.0 ELSE round(m/CAST(m+u AS DOUBLE), 9) END AS value FROM x WHERE m IS NOT NULL""", "bismark_lines")),
    "scan_gene_regions": Query(q_gene_regions, sql("""
, r AS (SELECT path, ord, string_split(value, chr(9)) AS c FROM region_lines), x AS (SELECT path, ord, c[1] AS gene_id, c[2] AS chrom, TRY_CAST(c[3] AS BIGINT) AS s, CAST(c[4] AS BIGINT) AS e FROM r), y AS (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY path DESC, ord DESC) AS k FROM x WHERE s IS NOT NULL)
SELECT gene_id, chrom, s-1 AS start, e AS "end" FROM y WHERE k=1""", "region_lines")),
}
