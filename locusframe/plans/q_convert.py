"""Queries of format conversions and signal scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.operators import convert as C
from locusframe.plans.q_align import PSL
from locusframe.plans.q_features import GTF_RECORDS, gff_records, records
from locusframe.plans.registry import Query, longs
from locusframe.plans.views import VIEWS, sql, view
from locusframe.sources import alignments as S
from locusframe.sources import sinks
from locusframe.sources.annotation import parse_bed, parse_bedgraph
from locusframe.sources.tables import parse_chrom_sizes
from locusframe.sources.vcf import parse_vcf

VIEWS["genepred"] = """
SELECT 'g.gp' AS path, k*8+n AS ord, CASE WHEN n%2=0 THEN 'gene'||CAST(k AS STRING)||chr(9) ELSE '' END||'tx'||CAST(k*8+n AS STRING)||chr(9)||'chr'||CAST(k%5+1 AS STRING)||chr(9)||CASE WHEN pk%2=0 THEN '+' ELSE '-' END||chr(9)||CAST(k*37 AS STRING)||chr(9)||CAST(k*37+300 AS STRING)||chr(9)||
  CAST(k*37+50 AS STRING)||chr(9)||CAST(k*37+CASE WHEN pk%3=0 THEN 50 ELSE 250 END AS STRING)||chr(9)||'2'||chr(9)||CAST(k*37 AS STRING)||','||CAST(k*37+200 AS STRING)||','||chr(9)||CAST(k*37+100 AS STRING)||','||CAST(k*37+300 AS STRING)||',' AS value FROM {li}"""
VIEWS["wig"] = """
SELECT 'w.wig' AS path, k*16 AS ord, CASE WHEN k%2=0 THEN 'fixedStep chrom=chr'||CAST(k%5 AS STRING)||' start='||CAST(k*37+1 AS STRING)||' step=10 span=5' ELSE 'variableStep chrom=chr'||CAST(k%5 AS STRING) END AS value FROM (SELECT DISTINCT k FROM {li}) x
UNION ALL SELECT 'w.wig', k*16+n, CASE WHEN k%2=0 THEN CAST(qty AS STRING) ELSE CAST(k*37+n*3 AS STRING)||' '||CAST(qty AS STRING) END FROM {li}"""
VIEWS["rmsk"] = """
SELECT 'r.out' AS path, k*8+n AS ord, CASE WHEN pk%61=0 THEN '   SW  perc perc' ELSE '  '||CAST(qty*10 AS STRING)||' 1.5 0.2 '||CAST(disc AS STRING)||'.0 chr'||CAST(k%5+1 AS STRING)||' '||CAST(k*37+1 AS STRING)||' '||CAST(k*37+100 AS STRING)||' ('||CAST(900000000-k*37-100 AS STRING)||') '||
  CASE WHEN pk%2=0 THEN '+ Alu'||CAST(sk%7 AS STRING)||' SINE/Alu 1 99 (12) ' ELSE 'C L1'||CAST(sk%7 AS STRING)||' LINE/L1 (5) 88 3 ' END||CAST(k*8+n+1 AS STRING)||CASE WHEN pk%5=0 THEN ' *' ELSE '' END END AS value FROM {li}"""
VIEWS["bedmethyl"] = """
SELECT 'm.bed' AS path, k*8+n AS ord, 'chr'||CAST(k%5+1 AS STRING)||chr(9)||CAST(k*37+n AS STRING)||chr(9)||CAST(k*37+n+CASE WHEN pk%53=0 THEN 2 ELSE 1 END AS STRING)||chr(9)||CASE WHEN sk%9=0 THEN 'm?' ELSE 'm' END||chr(9)||CAST(qty+disc AS STRING)||chr(9)||CASE WHEN pk%2=0 THEN '+' ELSE '-' END||chr(9)||
  CAST(k*37+n AS STRING)||chr(9)||CAST(k*37+n+1 AS STRING)||chr(9)||CASE WHEN pk%31=0 THEN '300,0,0' ELSE '255,0,0' END||chr(9)||CAST(qty+disc AS STRING)||chr(9)||CASE WHEN disc=0 THEN '0.00' ELSE '50.00' END||chr(9)||CAST(disc AS STRING)||chr(9)||CAST(qty AS STRING)||chr(9)||'0'||chr(9)||'0'||chr(9)||'0'||chr(9)||'0'||chr(9)||'0' AS value FROM {li}"""
VIEWS["maf"] = """
SELECT 'x.maf' AS path, k*8+n AS ord, CASE WHEN sk%13=0 THEN '' ELSE 'G'||CAST(sk AS STRING) END||chr(9)||CASE WHEN pk%40=0 THEN '1' ELSE 'chr1' END||chr(9)||CAST(k AS STRING)||chr(9)||CAST(k+CASE WHEN pk%17=0 THEN -1 ELSE 1 END AS STRING)||chr(9)||
  CASE CAST(pk%5 AS INT) WHEN 0 THEN 'Silent' WHEN 1 THEN 'Odd' ELSE 'Intron' END||chr(9)||CASE CAST(sk%5 AS INT) WHEN 0 THEN 'SNP' WHEN 1 THEN 'DEL' WHEN 2 THEN 'INS' WHEN 3 THEN '' ELSE 'DNP' END||chr(9)||CASE WHEN pk%2=0 THEN 'A' ELSE 'AC' END||chr(9)||'A'||chr(9)||CASE WHEN pk%3=0 THEN 'A' ELSE '-' END||chr(9)||
  'S'||CAST(qty AS STRING)||CASE WHEN n=7 THEN chr(9)||'extra' ELSE '' END AS value FROM {li}"""
VIEWS["plink_map"] = """
SELECT 'p.map' AS path, p_partkey AS ord, CASE WHEN p_size%20=0 THEN 'scaffold' ELSE CAST(p_partkey%3+1 AS STRING) END||' rs'||CAST(p_partkey%1990 AS STRING)||CASE WHEN p_size%2=0 THEN ' 0' ELSE '' END||' '||CASE WHEN p_size%17=0 THEN 'x' ELSE CAST((p_partkey*31)%5000 AS STRING) END AS value FROM {part}"""
VIEWS["plink_ped"] = """
SELECT 'p.ped' AS path, c_custkey AS ord, 'F'||CAST(c_nationkey AS STRING)||' I'||CAST(c_custkey%1400 AS STRING)||' 0 0 '||CAST(c_custkey%4 AS STRING)||' '||CASE WHEN c_custkey%19=0 THEN 'x' ELSE '1' END||' A C G '||CASE WHEN c_custkey%7=0 THEN 'TT' WHEN c_custkey%5=0 THEN 'N' ELSE 'T' END AS value FROM {customer}"""
VIEWS["bedgraph"] = """
SELECT 'b.bedgraph' AS path, k*8+n AS ord, CASE WHEN pk%71=0 THEN 'track x' ELSE 'chr'||CAST(CAST(floor(k/100) AS BIGINT)%3 AS STRING)||chr(9)||CAST(k*37+CASE WHEN sk%10=0 THEN -40 ELSE n END AS STRING)||chr(9)||CASE WHEN sk%23=0 THEN 'x' ELSE CAST(k*37+n+CASE WHEN sk%29=0 THEN -90 ELSE 5 END AS STRING) END||chr(9)||
  CASE CAST(pk%37 AS INT) WHEN 0 THEN 'nan' WHEN 1 THEN 'bad' WHEN 2 THEN 'inf' ELSE CAST(qty AS STRING) END||CASE WHEN n=6 AND sk%3=0 THEN chr(9)||'more' ELSE '' END END AS value FROM {li}"""
VIEWS["size_lines"] = """
SELECT 's.sizes' AS path, p_partkey AS ord, CASE CAST(p_partkey%50 AS INT) WHEN 7 THEN '# c' WHEN 8 THEN 'a b c d e' WHEN 9 THEN 'one' ELSE CASE WHEN p_size%9=0 THEN '' ELSE 'chr' END||CASE CAST(p_size%6 AS INT) WHEN 0 THEN 'X' WHEN 1 THEN 'Un_'||CAST(p_partkey AS STRING) ELSE CAST(p_partkey%1500 AS STRING) END||
  CASE WHEN p_partkey%13=0 THEN ' ' ELSE chr(9) END||CASE WHEN p_partkey%17=0 THEN '0' WHEN p_partkey%19=0 THEN 'x' ELSE CAST(p_partkey*10 AS STRING) END END AS value FROM {part}"""


def bed(s, d):
    return parse_bed(view(s, d, "bed"))


def gp(s, d):
    return S.parse_genepred(view(s, d, "genepred"))


def q_named(s, d):
    b = C.with_default_names(bed(s, d))
    return b.select("ord", "chrom", "start", "end", "name")


def q_bed_gtf(s, d):
    return C.bed_to_gtf(bed(s, d))


def q_gtf_lines(s, d):
    return sinks.gtf_lines(C.bed_to_gtf(bed(s, d)))


def q_bed12(s, d):
    return longs(C.bed_to_bed12(bed(s, d)))


def q_bed_psl(s, d):
    return longs(C.bed_to_psl(bed(s, d)).select("matches", "strand", "q_name", "t_name", "t_size", "t_start", "t_end", "block_sizes", "t_starts"))


def q_bedmethyl(s, d):
    return C.bedmethyl_to_bed(parse_bed(view(s, d, "bedmethyl")), coverage=True, percent=True)


def q_gff3(s, d):
    return C.bed_to_gff3(bed(s, d))


def q_ann_bed(s, d):
    return C.annotation_to_bed(records(s, d)).select("chrom", "start", "end", "name", "strand", "feature")


def q_tx12(s, d):
    return longs(C.transcripts_to_bed12(records(s, d)))


def q_ann_gp(s, d):
    g = C.annotation_to_genepred(records(s, d))
    return longs(g.select("name", "chrom", "strand", "tx_start", "tx_end", "cds_start", "cds_end", "exon_count", F.array_join("exon_starts", ",").alias("exon_starts"), F.array_join("exon_ends", ",").alias("exon_ends")))


def q_bed_gp(s, d):
    g = C.bed_to_genepred(C.transcripts_to_bed12(records(s, d)))
    return longs(g.select("name", "tx_start", "tx_end", F.array_join("exon_starts", ",").alias("exon_starts"), F.array_join("exon_ends", ",").alias("exon_ends")))


def q_vcf_bed(s, d):
    return C.vcf_to_bed(parse_vcf(view(s, d, "vcf"))).drop("info")


def q_bed_vcf(s, d):
    out = C.bed_to_vcf(bed(s, d), F.lit("N"), F.lit("<REGION>"), F.concat(F.lit("END="), F.col("end").cast("string")))
    return out.select("chrom", "pos", "id", "ref", F.array_join("alts", ",").alias("alt"), "info")


def q_psl_bed(s, d):
    return longs(C.psl_to_bed(S.parse_psl(view(s, d, "psl"))))


def rm(s, d):
    return S.parse_rmsk(view(s, d, "rmsk"))


def q_rmsk(s, d):
    return rm(s, d).drop("path")


def q_rmsk_bed(s, d):
    return C.rmsk_to_bed(rm(s, d))


def q_rmsk_gff(s, d):
    return C.rmsk_to_gff3(rm(s, d))


def q_gp(s, d):
    return longs(gp(s, d).select("name", "gene_name", "chrom", "strand", "tx_start", "cds_end", "exon_count", F.array_join("exon_ends", ",").alias("exon_ends")))


def q_gp_bed(s, d):
    return longs(C.genepred_to_bed12(gp(s, d)))


def q_gp_gtf(s, d):
    return C.genepred_to_gtf(gp(s, d)).select("chrom", "feature", "start", "end", "strand", "attrs_text")


def q_gff_gtf(s, d):
    return C.gff3_to_gtf(gff_records(s, d)).select("chrom", "feature", "start", "end", "attrs_text")


def q_gtf_gff(s, d):
    return C.gtf_to_gff3(records(s, d)).select("chrom", "feature", "start", "end", "attrs_text")


def q_wig(s, d):
    return S.parse_wig(view(s, d, "wig")).drop("path")


def q_scan_bed(s, d):
    return longs(bed(s, d).select("ord", "chrom", "start", "end", "name", "score", "strand", F.size("cells").alias("n")))


def q_bedgraph(s, d):
    return parse_bedgraph(view(s, d, "bedgraph")).drop("path")


def q_scan_bedmethyl(s, d):
    return longs(S.parse_bedmethyl(view(s, d, "bedmethyl")).select("ord", "chrom", "start", "end", "mod_code", "strand", "n_valid", "percent", "n_mod", "n_canonical"))


MAF = ["Hugo_Symbol", "Chromosome", "Start_Position", "End_Position", "Variant_Classification", "Variant_Type", "Reference_Allele", "Tumor_Seq_Allele1", "Tumor_Seq_Allele2", "Tumor_Sample_Barcode"]


def q_maf(s, d):
    return S.parse_maf(view(s, d, "maf"), MAF).select("ord", *MAF)


def q_map(s, d):
    return S.parse_plink_map(view(s, d, "plink_map")).drop("path")


def q_ped(s, d):
    return S.parse_plink_ped(view(s, d, "plink_ped")).drop("path")


def q_sizes(s, d):
    return parse_chrom_sizes(view(s, d, "size_lines"))


BED = r"""
, r AS (SELECT ord, string_split(value, chr(9)) AS c FROM bed WHERE value NOT LIKE '#%'), b AS (SELECT ord, c, c[1] AS chrom, TRY_CAST(c[2] AS BIGINT) AS s, TRY_CAST(c[3] AS BIGINT) AS e FROM r WHERE len(c)>=3 AND regexp_matches(c[2], '^[0-9]+$') AND regexp_matches(c[3], '^[0-9]+$')),
nb AS (SELECT *, coalesce(c[4], 'feature_'||CAST(row_number() OVER (ORDER BY ord) AS VARCHAR)) AS name FROM b)
"""
GP = """
, r AS (SELECT string_split(value, chr(9)) AS c0, ord FROM genepred), g AS (SELECT CASE WHEN len(c0)=11 THEN c0[1] END AS gene_name, CASE WHEN len(c0)=11 THEN c0[2:] ELSE c0 END AS c FROM r),
p AS (SELECT gene_name, c[1] AS name, c[2] AS chrom, c[3] AS strand, CAST(c[4] AS BIGINT) AS a, CAST(c[5] AS BIGINT) AS z, CAST(c[6] AS BIGINT) AS cs, CAST(c[7] AS BIGINT) AS ce FROM g)
"""
TX = """
, e1 AS (SELECT DISTINCT chrom, strand, tid, s-1 AS s, e FROM rec WHERE kind='exon'), cd AS (SELECT chrom, strand, tid, min(s)-1 AS cs, max(e) AS ce FROM rec WHERE feature='CDS' GROUP BY 1,2,3),
t12 AS (SELECT chrom, strand, tid, min(s) AS a, max(e) AS z, count(*) AS n, string_agg(CAST(e-s AS VARCHAR), ',' ORDER BY s, e) AS sz, list(s ORDER BY s, e) AS ss, list(e ORDER BY s, e) AS es FROM e1 GROUP BY 1,2,3),
tb AS (SELECT t12.*, coalesce(cs, a) AS cs, coalesce(ce, a) AS ce FROM t12 LEFT JOIN cd ON cd.chrom=t12.chrom AND cd.strand=t12.strand AND cd.tid=t12.tid)
"""
RM = """
, w AS (SELECT ord, string_split(regexp_replace(trim(value), ' +', ' ', 'g'), ' ') AS c FROM rmsk WHERE value NOT LIKE '%SW  perc%'), m AS (SELECT ord, c, c[9]='+' AS fw, c[len(c)]='*' AS ov FROM w)
"""
ST = "coalesce(c[6], '.')"
QUERIES = {
    "scan_bed": Query(q_scan_bed, sql(BED + 'SELECT ord, chrom, s AS start, e AS "end", c[4] AS name, c[5] AS score, c[6] AS strand, CAST(len(c) AS BIGINT) AS n FROM b', "bed")),
    "bed_default_names": Query(q_named, sql(BED + 'SELECT ord, chrom, s AS start, e AS "end", name FROM nb', "bed")),
    "bed_to_gtf": Query(q_bed_gtf, sql(BED + f"""SELECT chrom, 'bed' AS source, 'exon' AS feature, s+1 AS start, e AS "end", coalesce(c[5], '.') AS score, {ST} AS strand, '.' AS frame, 'gene_id "'||name||'"; transcript_id "'||name||'";' AS attrs_text FROM nb""", "bed")),
    "gtf_text_lines": Query(q_gtf_lines, sql(BED + f"""SELECT concat_ws(chr(9), chrom, 'bed', 'exon', CAST(s+1 AS VARCHAR), CAST(e AS VARCHAR), coalesce(c[5], '.'), {ST}, '.', 'gene_id "'||name||'"; transcript_id "'||name||'";') AS value FROM nb""", "bed")),
    "bed_to_bed12": Query(q_bed12, sql(BED + f"""SELECT chrom, s AS start, e AS "end", coalesce(c[4], '.') AS name, coalesce(c[5], '0') AS score, {ST} AS strand, s AS thick_start, e AS thick_end, '0' AS rgb, CAST(1 AS BIGINT) AS block_count, CAST(e-s AS VARCHAR)||',' AS block_sizes, '0,' AS block_starts FROM b""", "bed")),
    "bed_to_psl": Query(q_bed_psl, sql(BED + """SELECT e-s AS matches, coalesce(c[6], '+') AS strand, name AS q_name, chrom AS t_name, max(e) OVER (PARTITION BY chrom) AS t_size, s AS t_start, e AS t_end, CAST(e-s AS VARCHAR)||',' AS block_sizes, CAST(s AS VARCHAR)||',' AS t_starts FROM nb""", "bed")),
    "bed_to_gff3": Query(q_gff3, sql(BED + f"""SELECT chrom, 'bed' AS source, 'region' AS feature, s+1 AS start, e AS "end", coalesce(c[5], '.') AS score, {ST} AS strand, '.' AS frame, 'ID='||name||';Name='||name AS attrs_text FROM nb""", "bed")),
    "bed_to_vcf": Query(q_bed_vcf, sql(BED + "SELECT chrom, s+1 AS pos, coalesce(c[4], '.') AS id, 'N' AS ref, '<REGION>' AS alt, 'END='||CAST(e AS VARCHAR) AS info FROM b", "bed")),
    "bedmethyl_to_bed": Query(q_bedmethyl, sql(", r AS (SELECT string_split(value, chr(9)) AS c FROM bedmethyl) SELECT c[1] AS chrom, CAST(c[2] AS BIGINT) AS start, CAST(c[3] AS BIGINT) AS \"end\", c[4] AS mod_code, c[5] AS score, c[6] AS strand, c[10] AS coverage, c[11] AS percent FROM r", "bedmethyl")),
    "annotation_to_bed": Query(q_ann_bed, sql(GTF_RECORDS + 'SELECT chrom, s-1 AS start, e AS "end", gid AS name, strand, feature FROM rec', "gtf")),
    "transcripts_to_bed12": Query(q_tx12, sql(GTF_RECORDS + TX + """SELECT chrom, a AS start, z AS "end", tid AS name, CAST(0 AS BIGINT) AS score, strand, cs AS thick_start, ce AS thick_end, '0' AS rgb, n AS block_count, sz||',' AS block_sizes, array_to_string([CAST(x-a AS VARCHAR) for x in ss], ',')||',' AS block_starts FROM tb""", "gtf")),
    "annotation_to_genepred": Query(q_ann_gp, sql(GTF_RECORDS + TX + "SELECT tid AS name, chrom, strand, a AS tx_start, z AS tx_end, cs AS cds_start, ce AS cds_end, n AS exon_count, array_to_string(ss, ',') AS exon_starts, array_to_string(es, ',') AS exon_ends FROM tb", "gtf")),
    "bed12_to_genepred": Query(q_bed_gp, sql(GTF_RECORDS + TX + "SELECT tid AS name, a AS tx_start, z AS tx_end, array_to_string(ss, ',') AS exon_starts, array_to_string(es, ',') AS exon_ends FROM tb", "gtf")),
    "vcf_to_bed": Query(q_vcf_bed, sql(', r AS (SELECT string_split(value, chr(9)) AS c FROM vcf) SELECT c[1] AS chrom, CAST(c[2] AS BIGINT)-1 AS start, CAST(c[2] AS BIGINT)-1+length(c[4]) AS "end", c[3] AS name, c[6] AS score, c[4] AS ref, c[5] AS alt, c[7] AS filter FROM r', "vcf")),
    "psl_to_bed": Query(q_psl_bed, sql(PSL + """SELECT t_name AS chrom, t_start AS start, t_end AS "end", q_name AS name, m AS score, strand, CAST(2 AS BIGINT) AS block_count, bs||',' AS block_sizes, CAST(ts[1]-t_start AS VARCHAR)||','||CAST(ts[2]-t_start AS VARCHAR)||',' AS block_starts FROM p""", "psl")),
    "scan_rmsk": Query(q_rmsk, sql(RM + """SELECT ord, CAST(c[1] AS BIGINT) AS score, CAST(c[2] AS DOUBLE) AS pct_div, CAST(c[3] AS DOUBLE) AS pct_del, CAST(c[4] AS DOUBLE) AS pct_ins, c[5] AS query, CAST(c[6] AS BIGINT) AS q_begin, CAST(c[7] AS BIGINT) AS q_end, CAST(trim(c[8], '()') AS BIGINT) AS q_left, CASE WHEN fw THEN '+' ELSE '-' END AS strand, c[10] AS repeat,
 c[11] AS class_family, CAST(CASE WHEN fw THEN 1 ELSE 3 END AS BIGINT) AS r_begin, CAST(CASE WHEN fw THEN 99 ELSE 88 END AS BIGINT) AS r_end, CAST(CASE WHEN fw THEN 12 ELSE 5 END AS BIGINT) AS r_left, CAST(c[15] AS BIGINT) AS id, ov AS overlapped FROM m""", "rmsk")),
    "rmsk_to_bed": Query(q_rmsk_bed, sql(RM + """SELECT c[5] AS chrom, CAST(c[6] AS BIGINT)-1 AS start, CAST(c[7] AS BIGINT) AS "end", c[10] AS name, CAST(c[1] AS BIGINT) AS score, CASE WHEN fw THEN '+' ELSE '-' END AS strand, c[11] AS class_family, CAST(c[2] AS DOUBLE) AS pct_div FROM m""", "rmsk")),
    "rmsk_to_gff3": Query(q_rmsk_gff, sql(RM + """SELECT c[5] AS chrom, 'RepeatMasker' AS source, 'dispersed_repeat' AS feature, CAST(c[6] AS BIGINT) AS start, CAST(c[7] AS BIGINT) AS "end", c[1] AS score, CASE WHEN fw THEN '+' ELSE '-' END AS strand, '.' AS frame, 'Target='||c[10]||CASE WHEN fw THEN ' 1 99' ELSE ' 3 88' END AS attrs_text FROM m""", "rmsk")),
    "scan_genepred": Query(q_gp, sql(GP + "SELECT name, gene_name, chrom, strand, a AS tx_start, ce AS cds_end, CAST(2 AS BIGINT) AS exon_count, CAST(a+100 AS VARCHAR)||','||CAST(a+300 AS VARCHAR) AS exon_ends FROM p", "genepred")),
    "genepred_to_bed12": Query(q_gp_bed, sql(GP + "SELECT chrom, a AS start, z AS \"end\", name, CAST(0 AS BIGINT) AS score, strand, cs AS thick_start, ce AS thick_end, '0' AS rgb, CAST(2 AS BIGINT) AS block_count, '100,100,' AS block_sizes, '0,200,' AS block_starts FROM p", "genepred")),
    "genepred_to_gtf": Query(q_gp_gtf, sql(GP + """, x AS (SELECT p.*, i, a+o AS s, a+o+100 AS e FROM p, (VALUES (1, 0), (2, 200)) v(i, o)), f AS (SELECT *, 'gene_id "'||name||'"; transcript_id "'||name||'"; exon_number "'||CAST(i AS VARCHAR)||'";' AS t FROM x)
SELECT chrom, 'exon' AS feature, s+1 AS start, e AS "end", strand, t AS attrs_text FROM f UNION ALL SELECT chrom, 'CDS', greatest(s, cs)+1, least(e, ce), strand, t FROM f WHERE greatest(s, cs)<least(e, ce)""", "genepred")),
    "gff3_to_gtf": Query(q_gff_gtf, sql("""
, r AS (SELECT string_split(value, chr(9)) AS c FROM gff3), x AS (SELECT c, c[3] AS f, regexp_extract(c[9], '(^|;)ID=([^;]*)', 2) AS id, regexp_extract(c[9], '(^|;)Parent=([^;]*)', 2) AS p FROM r), g AS (SELECT id AS tid, p AS gid FROM x WHERE f='mRNA')
SELECT x.c[1] AS chrom, 'transcript' AS feature, CAST(x.c[4] AS BIGINT) AS start, CAST(x.c[5] AS BIGINT) AS "end", 'gene_id "'||p||'"; transcript_id "'||id||'";' AS attrs_text FROM x WHERE f='mRNA'
UNION ALL SELECT x.c[1], f, CAST(x.c[4] AS BIGINT), CAST(x.c[5] AS BIGINT), 'gene_id "'||gid||'"; transcript_id "'||tid||'"; biotype "lncRNA"; flag "";' FROM x JOIN g ON tid=p WHERE f='exon'""", "gff3")),
    "gtf_to_gff3": Query(q_gtf_gff, sql(GTF_RECORDS + r"""
SELECT chrom, kind AS feature, s AS start, e AS "end", CASE kind WHEN 'gene' THEN 'ID='||gid WHEN 'transcript' THEN 'ID='||tid||';Parent='||gid ELSE 'Parent='||tid END||CASE WHEN en<>'' THEN ';exon_number='||en ELSE '' END||CASE WHEN feature='CDS' THEN ';gene_biotype=protein_coding' ELSE '' END||';gene_id='||gid||
 CASE WHEN regexp_extract(a9, 'gene_type "([^"]*)"', 1)<>'' THEN ';gene_type=lncRNA' ELSE '' END||';transcript_id='||tid||CASE WHEN tt<>'NA' THEN ';transcript_type=lnc' ELSE '' END AS attrs_text FROM rec""", "gtf")),
    "scan_wig": Query(q_wig, sql("""
, h AS (SELECT k, n, qty, row_number() OVER (PARTITION BY k ORDER BY n)-1 AS i FROM li)
SELECT k*16+n AS ord, 'chr'||CAST(k%5 AS VARCHAR) AS chrom, CASE WHEN k%2=0 THEN k*37+i*10 ELSE k*37+n*3-1 END AS start, CASE WHEN k%2=0 THEN k*37+i*10+5 ELSE k*37+n*3 END AS "end", CAST(qty AS DOUBLE) AS value FROM h""", "wig")),
    "scan_bedgraph": Query(q_bedgraph, sql(r"""
, r AS (SELECT ord, string_split(value, chr(9)) AS c FROM bedgraph WHERE value NOT LIKE 'track%') SELECT ord, c[1] AS chrom, CAST(c[2] AS BIGINT) AS start, TRY_CAST(c[3] AS BIGINT) AS "end", TRY_CAST(c[4] AS DOUBLE) AS value FROM r WHERE len(c)=4 AND regexp_matches(c[3], '^-?[0-9]+$') AND regexp_matches(c[4], '^[0-9]+$')""", "bedgraph")),
    "scan_bedmethyl": Query(q_scan_bedmethyl, sql(", r AS (SELECT ord, string_split(value, chr(9)) AS c FROM bedmethyl) SELECT ord, c[1] AS chrom, CAST(c[2] AS BIGINT) AS start, CAST(c[3] AS BIGINT) AS \"end\", c[4] AS mod_code, c[6] AS strand, CAST(c[10] AS BIGINT) AS n_valid, CAST(c[11] AS DOUBLE) AS percent, CAST(c[12] AS BIGINT) AS n_mod, CAST(c[13] AS BIGINT) AS n_canonical FROM r", "bedmethyl")),
    "scan_maf": Query(q_maf, sql(", r AS (SELECT ord, string_split(value, chr(9)) AS c FROM maf) SELECT ord, " + ", ".join(f'c[{i + 1}] AS "{n}"' for i, n in enumerate(MAF)) + " FROM r", "maf")),
    "scan_plink_map": Query(q_map, sql("""
, r AS (SELECT row_number() OVER (ORDER BY ord)-1 AS idx, string_split(value, ' ') AS c FROM plink_map) SELECT idx, c[1] AS chrom, c[2] AS variant_id, CASE WHEN len(c)=4 THEN CAST(0 AS DOUBLE) END AS morgans, TRY_CAST(c[len(c)] AS BIGINT) AS pos FROM r""", "plink_map")),
    "scan_plink_ped": Query(q_ped, sql(", r AS (SELECT ord, string_split(value, ' ') AS c FROM plink_ped) SELECT ord, c[1] AS family, c[2] AS individual, c[5] AS sex, c[6] AS phenotype, CAST(i AS BIGINT) AS idx, c[7+2*i] AS a1, c[8+2*i] AS a2 FROM r, (VALUES (0), (1)) v(i)", "plink_ped")),
    "scan_chrom_sizes": Query(q_sizes, sql("""
, r AS (SELECT string_split(replace(trim(value), chr(9), ' '), ' ') AS c FROM size_lines WHERE value NOT LIKE '#%') SELECT c[1] AS chrom, TRY_CAST(c[2] AS BIGINT) AS size FROM r WHERE len(c)>=2 AND TRY_CAST(c[2] AS BIGINT) IS NOT NULL""", "size_lines")),
}
