"""Queries of annotation scans and feature extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.operators import features as X
from locusframe.operators.ordered import with_rank
from locusframe.plans.registry import Query, longs
from locusframe.plans.views import VIEWS, sql, view
from locusframe.sources import annotation as A
from locusframe.sources.sequences import genome_chunks, mature_mirnas, parse_fasta

# genome text: one contig per line group, 60 bases per line, from the part names' numbers
VIEWS["genome"] = """
SELECT 'g.fa' AS path, CAST(c AS BIGINT)*1000000 AS ord, '>chr'||CAST(c AS STRING)||' note' AS value FROM (SELECT DISTINCT p_partkey%5+1 AS c FROM {part}) a
UNION ALL
SELECT 'g.fa', (p_partkey%5+1)*1000000+p_partkey+1,
       repeat(CASE CAST(p_partkey%4 AS INT) WHEN 0 THEN 'ACGTTGCAAC' WHEN 1 THEN 'ggatcNTTAC' WHEN 2 THEN 'TTTACGACGT' ELSE 'CAGTACCATG' END, 6) FROM {part}"""
# transcripts of two or three exons inside the genome; contig names without the prefix for some
VIEWS["tx_exons"] = """
SELECT 'tx'||CAST(p_partkey AS STRING) AS transcript_id, CASE WHEN p_partkey%3=0 THEN '' ELSE 'chr' END||CAST(p_partkey%6+1 AS STRING) AS chrom,
       (p_partkey*7)%900+e*150 AS start, (p_partkey*7)%900+e*150+20+p_size AS end_, CASE WHEN p_partkey%2=0 THEN '+' ELSE '-' END AS strand
FROM {part}, (SELECT CAST(0 AS BIGINT) AS e UNION ALL SELECT 1 UNION ALL SELECT 2) x WHERE e<2 OR p_partkey%2=0"""
VIEWS["fasta_blocks"] = """
SELECT CASE WHEN p_partkey%7<3 THEN 't.fa' ELSE 's.fa' END AS path, p_partkey AS ord, CASE WHEN p_partkey%2=0 THEN '>' ELSE '' END||'seq'||CAST(p_partkey%1500 AS STRING)||' '||CASE WHEN p_partkey%3=0 THEN 'Homo sapiens' ELSE 'Mus musculus' END||' x'||chr(10)||
       CASE CAST(p_partkey%3 AS INT) WHEN 0 THEN 'UGAGGUAGUAGG'||chr(10)||'uugu' WHEN 1 THEN 'ACGU' ELSE 'CCAA'||chr(10)||'GGTT'||chr(10) END||CAST('' AS STRING) AS value
FROM {part}"""
VIEWS["multi_ann"] = """
SELECT 'src'||CAST(k%3 AS STRING) AS source, 't'||CAST(k AS STRING) AS transcript_id, 'chr'||CAST((k%1000)%5+1 AS STRING) AS chrom, CASE WHEN (k%1000)%2=0 THEN '+' ELSE '-' END AS strand,
       (k%1000)*900+n*300 AS start, (k%1000)*900+n*300+100+(k%2)*n AS end_ FROM {li}"""

# steps shared by the SQL texts: records, ids, folded kinds
ATTRIBUTES = ["exon_number", "gene_biotype", "gene_id", "gene_type", "transcript_id", "transcript_type"]
GTF_RECORDS = """
, raw AS (SELECT path, ord, value, string_split(value, chr(9)) AS c FROM gtf WHERE value<>'' AND value NOT LIKE '#%'),
rec AS (SELECT ord, c[1] AS chrom, c[3] AS feature, CAST(c[4] AS BIGINT) AS s, CAST(c[5] AS BIGINT) AS e, c[7] AS strand,
  coalesce(nullif(regexp_extract(c[9], 'gene_id "([^"]*)"', 1), ''), 'NA') AS gid, coalesce(nullif(regexp_extract(c[9], 'transcript_id "([^"]*)"', 1), ''), 'NA') AS tid,
  coalesce(nullif(regexp_extract(c[9], 'gene_type "([^"]*)"', 1), ''), nullif(regexp_extract(c[9], 'gene_biotype "([^"]*)"', 1), ''), 'NA') AS gt,
  coalesce(nullif(regexp_extract(c[9], 'transcript_type "([^"]*)"', 1), ''), 'NA') AS tt, regexp_extract(c[9], 'exon_number "([^"]*)"', 1) AS en,
  CASE WHEN c[3] IN ('mRNA','lnc_RNA') THEN 'transcript' ELSE c[3] END AS kind, c[9] AS a9
  FROM raw WHERE len(c)=9 AND regexp_matches(c[4], '^[0-9]+$') AND regexp_matches(c[5], '^[0-9]+$')),
meta AS (SELECT chrom, strand, gid, tid, max_by(gt, ord) AS gt, max_by(tt, ord) AS tt FROM rec GROUP BY 1,2,3,4),
ex AS (SELECT *, CASE WHEN en<>'' THEN en ELSE CAST(row_number() OVER (PARTITION BY chrom, strand, gid, tid ORDER BY ord) AS VARCHAR) END AS num FROM rec WHERE kind='exon'),
gaps AS (SELECT chrom, strand, gid, tid, lag(e) OVER (PARTITION BY chrom, strand, gid, tid ORDER BY s, e)+1 AS gs, s-1 AS ge FROM ex),
intr AS (SELECT *, row_number() OVER (PARTITION BY chrom, strand, gid, tid ORDER BY gs) AS num FROM gaps WHERE gs<=ge),
span AS (SELECT chrom, strand, gid, tid, min(s) FILTER (WHERE feature='CDS') AS cmin, max(e) FILTER (WHERE feature='CDS') AS cmax FROM rec GROUP BY 1,2,3,4),
seg AS (SELECT ex.chrom, ex.strand, ex.gid, ex.tid, cmin, cmax, unnest(CASE WHEN e<cmin OR s>cmax THEN [[s, e]] ELSE [[s, cmin-1], [cmax+1, e]] END) AS p FROM ex JOIN span USING (chrom, strand, gid, tid) WHERE cmin IS NOT NULL),
utr AS (SELECT chrom, strand, gid, tid, p[1] AS s, p[2] AS e, CASE WHEN p[2]<cmin THEN CASE WHEN strand='-' THEN '3UTR' ELSE '5UTR' END WHEN p[1]>cmax THEN CASE WHEN strand='-' THEN '5UTR' ELSE '3UTR' END ELSE 'UTR' END AS label FROM seg WHERE p[1]<=p[2])
"""
FEATURE_ROWS = """SELECT chrom, s-1 AS start, e AS "end", 'gene' AS feature_type, gid AS feature_id, gid AS gene_id, 'NA' AS transcript_id, strand, gt AS gene_type, 'NA' AS transcript_type FROM rec WHERE kind='gene'
UNION ALL SELECT chrom, s-1, e, 'transcript', tid, gid, tid, strand, gt, tt FROM rec WHERE kind='transcript'
UNION ALL SELECT chrom, s-1, e, 'exon', tid||':exon'||num, gid, tid, strand, gt, tt FROM ex
UNION ALL SELECT i.chrom, gs-1, ge, 'intron', i.tid||':intron'||num, i.gid, i.tid, i.strand, gt, tt FROM intr i JOIN meta USING (chrom, strand, gid, tid)"""


def records(s, d):
    return A.parse_annotation(view(s, d, "gtf"), "gtf")


def gff_records(s, d):
    return A.parse_annotation(view(s, d, "gff3"), "gff3")


def q_records(s, d):
    r = A.parse_annotation(view(s, d, "gtf"))
    a = F.col("attrs")
    return r.select("chrom", "feature", "start", "end", "strand", a["gene_id"].alias("gene_id"), a["exon_number"].alias("exon_number"), a["gene_biotype"].alias("biotype"),
                    F.size(a).cast("bigint").alias("n_attrs"))


def q_rejects(s, d):
    return A.annotation_rejects(view(s, d, "gtf")).select("path", "ord", "reason")


def q_gff3(s, d):
    a = F.col("attrs")
    return gff_records(s, d).select("chrom", "start", "end", a["ID"].alias("id"), a["Parent"].alias("parent"), a["flag"].alias("flag"), F.size(a).cast("bigint").alias("n_attrs"))


def q_features(s, d):
    return X.extract_features(records(s, d))


def q_features_all(s, d):
    return X.extract_features(records(s, d), ["cds", "utr"])


def q_gff_plain(s, d):
    return X.extract_features(gff_records(s, d))


def q_gff_resolved(s, d):
    return X.extract_features(gff_records(s, d), ["exon", "intron"], resolve_parents=True).select("chrom", "start", "end", "feature_type", "gene_id", "transcript_id")


def q_transcripts(s, d):
    return X.extract_transcripts(records(s, d))


def q_bed_features(s, d):
    return X.bed_to_features(A.parse_bed(view(s, d, "bed")))


def q_attr_columns(s, d):
    return X.attribute_columns(records(s, d)).drop("source", "score", "frame")


def q_attr_names(s, d):
    return X.attribute_names(records(s, d))


def q_longest(s, d):
    return X.longest_isoforms(records(s, d))


def q_merge_ann(s, d):
    m = X.merge_annotations(view(s, d, "multi_ann"))
    return longs(m.select("source", "transcript_id", "chrom", "strand", "start", "end", "n_exons", "n_copies", "locus_start"))


def q_spliced(s, d):
    return X.spliced_sequences(view(s, d, "tx_exons"), genome_chunks(view(s, d, "genome")))


def q_protein(s, d):
    return X.protein_sequences(view(s, d, "tx_exons"), genome_chunks(view(s, d, "genome")))


def q_chunks(s, d):
    return longs(genome_chunks(view(s, d, "genome")))


def q_fasta(s, d):
    return parse_fasta(view(s, d, "fasta_blocks"), upper=True).select("id", "seq")


def q_mirna(s, d):
    return mature_mirnas(view(s, d, "fasta_blocks"))


GENOME_SQL = """
, ln AS (SELECT 'chr'||CAST(ord//1000000 AS VARCHAR) AS chrom, ord, upper(value) AS b FROM genome WHERE value NOT LIKE '>%'),
chk AS (SELECT chrom, CAST(sum(length(b)) OVER (PARTITION BY chrom ORDER BY ord) - length(b) AS BIGINT) AS start, b FROM ln),
gen AS (SELECT chrom, string_agg(b, '' ORDER BY start) AS g FROM chk GROUP BY 1),
t0 AS (SELECT transcript_id, arg_min(strand, start) AS strand FROM tx_exons GROUP BY 1),
m AS (SELECT e.*, substr(g, CAST(e.start+1 AS BIGINT), CAST(end_-e.start AS BIGINT)) AS sub FROM tx_exons e JOIN gen ON gen.chrom = CASE WHEN e.chrom LIKE 'chr%' THEN e.chrom ELSE 'chr'||e.chrom END),
j AS (SELECT transcript_id, string_agg(sub, '' ORDER BY start) AS q FROM m GROUP BY 1),
spl AS (SELECT t0.transcript_id, strand, CASE WHEN q IS NULL THEN '' WHEN strand='-' THEN reverse(translate(q, 'ACGTNacgtn', 'TGCANtgcan')) ELSE q END AS seq FROM t0 LEFT JOIN j ON j.transcript_id=t0.transcript_id)
"""
_AA = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"

def q_sorted(s, d):
    """Place of every feature in the sorted table."""
    return with_rank(X.sort_features(view(s, d, "feat")).select("feature_id"))


QUERIES = {
    "scan_gtf_records": Query(q_records, sql(r"""
, raw AS (SELECT string_split(value, chr(9)) AS c FROM gtf WHERE value<>'' AND value NOT LIKE '#%')
SELECT c[1] AS chrom, c[3] AS feature, CAST(c[4] AS BIGINT) AS start, CAST(c[5] AS BIGINT) AS "end", c[7] AS strand, nullif(regexp_extract(c[9], 'gene_id "([^"]*)"', 1), '') AS gene_id,
 nullif(regexp_extract(c[9], 'exon_number "([^"]*)"', 1), '') AS exon_number, nullif(regexp_extract(c[9], 'gene_biotype "([^"]*)"', 1), '') AS biotype,
 CAST(len(regexp_extract_all(c[9], '([^\s;]+)\s+"([^"]*)"\s*;?')) AS BIGINT) AS n_attrs
FROM raw WHERE len(c)=9 AND regexp_matches(c[4], '^[0-9]+$') AND regexp_matches(c[5], '^[0-9]+$')""", "gtf")),
    "scan_gtf_rejects": Query(q_rejects, sql("""
, raw AS (SELECT path, ord, string_split(value, chr(9)) AS c FROM gtf WHERE value<>'' AND value NOT LIKE '#%')
SELECT path, ord, CASE WHEN len(c)<>9 THEN 'Expected 9 columns, got '||CAST(len(c) AS VARCHAR) ELSE 'Start/End are not integers' END AS reason
FROM raw WHERE len(c)<>9 OR NOT regexp_matches(c[4], '^[0-9]+$') OR NOT regexp_matches(c[5], '^[0-9]+$')""", "gtf")),
    "scan_gff3_attributes": Query(q_gff3, sql("""
, raw AS (SELECT string_split(value, chr(9)) AS c FROM gff3)
SELECT c[1] AS chrom, CAST(c[4] AS BIGINT) AS start, CAST(c[5] AS BIGINT) AS "end", nullif(regexp_extract(c[9], '(^|;)ID=([^;]*)', 2), '') AS id, nullif(regexp_extract(c[9], '(^|;)Parent=([^;]*)', 2), '') AS parent,
 CASE WHEN c[9] LIKE '%;flag' THEN '' END AS flag, CAST(len(string_split(c[9], ';')) AS BIGINT) AS n_attrs FROM raw""", "gff3")),
    "sort_features": Query(q_sorted, sql("SELECT feature_id, row_number() OVER (ORDER BY chrom, start, end_, feature_type, feature_id) AS rank FROM feat", "feat")),
    "extract_features": Query(q_features, sql(GTF_RECORDS + FEATURE_ROWS, "gtf")),
    "extract_cds_utr": Query(q_features_all, sql(GTF_RECORDS + """
SELECT chrom, s-1 AS start, e AS "end", 'CDS' AS feature_type, tid||':CDS' AS feature_id, gid AS gene_id, tid AS transcript_id, strand, gt AS gene_type, tt AS transcript_type FROM rec WHERE feature='CDS'
UNION ALL SELECT u.chrom, s-1, e, label, u.tid||':'||label, u.gid, u.tid, u.strand, gt, tt FROM utr u JOIN meta USING (chrom, strand, gid, tid)""", "gtf")),
    "extract_features_gff3": Query(q_gff_plain, sql("""
, raw AS (SELECT string_split(value, chr(9)) AS c FROM gff3),
r AS (SELECT c[1] AS chrom, CAST(c[4] AS BIGINT)-1 AS s, CAST(c[5] AS BIGINT) AS e, c[3] AS f, c[7] AS strand, regexp_extract(c[9], '(^|;)ID=([^;]*)', 2) AS id, regexp_extract(c[9], '(^|;)Parent=([^;]*)', 2) AS p, CASE WHEN c[9] LIKE '%biotype=lncRNA%' THEN 'lncRNA' ELSE 'NA' END AS bt FROM raw)
SELECT chrom, s AS start, e AS "end", CASE f WHEN 'mRNA' THEN 'transcript' ELSE f END AS feature_type, CASE f WHEN 'mRNA' THEN id ELSE id||':exon1' END AS feature_id, p AS gene_id, id AS transcript_id, strand, bt AS gene_type, bt AS transcript_type FROM r""", "gff3")),
    "extract_features_gff3_resolved": Query(q_gff_resolved, sql("""
, raw AS (SELECT string_split(value, chr(9)) AS c FROM gff3),
r AS (SELECT c[1] AS chrom, CAST(c[4] AS BIGINT)-1 AS s, CAST(c[5] AS BIGINT) AS e, c[3] AS f, regexp_extract(c[9], '(^|;)ID=([^;]*)', 2) AS id, regexp_extract(c[9], '(^|;)Parent=([^;]*)', 2) AS p FROM raw),
x AS (SELECT e.chrom, e.s, e.e, t.p AS gid, e.p AS tid FROM r e JOIN r t ON t.id=e.p AND t.f='mRNA' WHERE e.f='exon'), g AS (SELECT *, lag(e) OVER (PARTITION BY tid ORDER BY s, e) AS pe FROM x)
SELECT chrom, s AS start, e AS "end", 'exon' AS feature_type, gid AS gene_id, tid AS transcript_id FROM x UNION ALL SELECT chrom, pe, s, 'intron', gid, tid FROM g WHERE pe<s""", "gff3")),
    "extract_transcripts": Query(q_transcripts, sql(GTF_RECORDS + """SELECT chrom, s-1 AS start, e AS "end", 'transcript' AS feature_type, tid AS feature_id, gid AS gene_id, tid AS transcript_id, strand, gt AS gene_type, tt AS transcript_type FROM rec WHERE kind='transcript'""", "gtf")),
    "bed_to_features": Query(q_bed_features, sql("""
, raw AS (SELECT string_split(value, chr(9)) AS c FROM bed WHERE value NOT LIKE '#%'), b AS (SELECT c[1] AS chrom, TRY_CAST(c[2] AS BIGINT) AS s, TRY_CAST(c[3] AS BIGINT) AS e, coalesce(c[4], '') AS name, c[6] AS st FROM raw WHERE len(c)>=3)
SELECT chrom, s AS start, e AS "end", CASE name WHEN 'lnc_RNA' THEN 'transcript' WHEN '5UTR' THEN 'utr5' WHEN '' THEN 'interval' ELSE name END AS feature_type,
 CASE WHEN name IN ('', 'lnc_RNA', '5UTR') THEN chrom||':'||CAST(s+1 AS VARCHAR)||'-'||CAST(e AS VARCHAR) ELSE name END AS feature_id, 'NA' AS gene_id, 'NA' AS transcript_id, CASE WHEN st IN ('+', '-') THEN st ELSE '.' END AS strand, 'NA' AS gene_type, 'NA' AS transcript_type
FROM b WHERE s>=0 AND e>s""", "bed")),
    "attributes_to_columns": Query(q_attr_columns, sql(GTF_RECORDS + """SELECT chrom, feature, s AS start, e AS "end", strand, """ + ", ".join(f"""nullif(regexp_extract(a9, '{a} "([^"]*)"', 1), '') AS {a}""" for a in ATTRIBUTES) + " FROM rec", "gtf")),
    "attribute_names": Query(q_attr_names, sql(GTF_RECORDS + r"""SELECT attribute, count(*) AS n FROM (SELECT unnest(regexp_extract_all(a9, '([^\s;]+)\s+"[^"]*"', 1)) AS attribute FROM rec) GROUP BY 1""", "gtf")),
    "longest_isoform": Query(q_longest, sql(GTF_RECORDS + """
, l AS (SELECT gid AS gene_id, tid AS transcript_id, CAST(coalesce(sum(e-s+1) FILTER (WHERE feature='CDS'), 0) AS BIGINT) AS cds_length, CAST(coalesce(sum(e-s+1) FILTER (WHERE kind='exon'), 0) AS BIGINT) AS exon_length FROM rec WHERE kind='exon' OR feature='CDS' GROUP BY 1,2)
SELECT gene_id, transcript_id, cds_length, exon_length FROM (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY cds_length>0 DESC, CASE WHEN cds_length>0 THEN cds_length ELSE exon_length END DESC, transcript_id) AS r FROM l) WHERE r=1""", "gtf")),
    "merge_annotations": Query(q_merge_ann, sql("""
, st AS (SELECT source, transcript_id, chrom, strand, list(DISTINCT {'s': start, 'e': end_} ORDER BY {'s': start, 'e': end_}) AS ex FROM multi_ann GROUP BY 1,2,3,4),
k AS (SELECT min({'a': source, 'b': transcript_id}) AS t, chrom, strand, ex, count(*) AS n_copies FROM st GROUP BY chrom, strand, ex),
p AS (SELECT t.a AS source, t.b AS transcript_id, chrom, strand, ex[1].s AS start, list_max([x.e for x in ex]) AS e, CAST(len(ex) AS BIGINT) AS n_exons, n_copies FROM k),
o AS (SELECT *, max(e) OVER (PARTITION BY chrom, strand ORDER BY start, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM p),
g AS (SELECT *, max(CASE WHEN m IS NULL OR start>m THEN start END) OVER (PARTITION BY chrom, strand ORDER BY start, e) AS locus_start FROM o)
SELECT source, transcript_id, chrom, strand, start, e AS "end", n_exons, n_copies, locus_start FROM g""", "multi_ann")),
    "genome_chunks": Query(q_chunks, sql(GENOME_SQL + 'SELECT chrom, start, start+length(b) AS "end", b AS bases FROM chk', "genome", "tx_exons")),
    "spliced_sequences": Query(q_spliced, sql(GENOME_SQL + "SELECT transcript_id, strand, seq FROM spl", "genome", "tx_exons")),
    "protein_sequences": Query(q_protein, sql(GENOME_SQL + f"""
, cod AS (SELECT transcript_id, i, substr(seq, i*3+1, 3) AS c3 FROM spl, unnest(range(length(seq)//3)) AS u(i)),
aa AS (SELECT transcript_id, string_agg(CASE WHEN instr(c3, 'N')>0 THEN 'X' ELSE substr('{_AA}', (instr('TCAG', substr(c3,1,1))-1)*16+(instr('TCAG', substr(c3,2,1))-1)*4+instr('TCAG', substr(c3,3,1)), 1) END, '' ORDER BY i) AS p FROM cod GROUP BY 1)
SELECT spl.transcript_id, coalesce(p, '') AS protein FROM spl LEFT JOIN aa ON aa.transcript_id=spl.transcript_id""", "genome", "tx_exons")),
    "scan_fasta": Query(q_fasta, sql("""
, r AS (SELECT path, ord, ltrim(value, '>') AS v FROM fasta_blocks), x AS (SELECT path, ord, split_part(v, ' ', 1) AS id, upper(replace(substr(v, instr(v, chr(10))+1), chr(10), '')) AS seq FROM r)
SELECT id, seq FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY path DESC, ord DESC) AS i FROM x) AS y WHERE i=1""", "fasta_blocks")),
    "mature_mirnas": Query(q_mirna, sql("""
, r AS (SELECT path, ord, ltrim(value, '>') AS v FROM fasta_blocks), x AS (SELECT path, ord, split_part(v, ' ', 1) AS id, replace(upper(replace(substr(v, instr(v, chr(10))+1), chr(10), '')), 'U', 'T') AS seq FROM r WHERE split_part(v, chr(10), 1) LIKE '%Homo sapiens%'),
f AS (SELECT id, seq FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY path, ord) AS i FROM x) AS y WHERE i=1) SELECT id AS mirna, seq, substr(seq, 2, 7) AS seed FROM f WHERE length(seq)>=8""", "fasta_blocks")),
}
