"""Genomic inputs derived from the given tables.

Each view is one SQL text both engines run. ``{name}`` stands for a base table or another
view. A trailing underscore in ``end_`` avoids the reserved word and is removed on the Spark side.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from locusframe.operators.ordered import evaluated_once

TABLES = {
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
}

VIEWS: dict[str, str] = {}

# one row per (order, line number): a dense, unique key for texts with an order
VIEWS["li"] = """
SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS n, min(l_partkey) AS pk, min(l_suppkey) AS sk,
       CAST(min(l_quantity) AS BIGINT) AS qty, CAST(round(max(l_discount)*100) AS BIGINT) AS disc,
       min(l_returnflag) AS rf, min(l_linestatus) AS ls
FROM {lineitem} GROUP BY l_orderkey, CAST(l_linenumber AS BIGINT)"""

# feature intervals of length 50-999, density independent of the scale factor
VIEWS["feat"] = """
SELECT 'chr'||CAST(o_custkey%5+1 AS STRING) AS chrom, o_orderkey*37 AS start, o_orderkey*37+50+(o_orderkey*13)%950 AS end_,
       CASE CAST(o_orderkey%6 AS INT) WHEN 0 THEN 'gene' WHEN 1 THEN 'transcript' WHEN 2 THEN 'exon' WHEN 3 THEN 'intron' WHEN 4 THEN 'CDS' ELSE '5UTR' END AS feature_type,
       'f'||CAST(o_orderkey AS STRING) AS feature_id, 'g'||CAST(o_custkey AS STRING) AS gene_id,
       't'||CAST(o_orderkey%4000 AS STRING) AS transcript_id, CASE WHEN o_orderkey%2=0 THEN '+' ELSE '-' END AS strand,
       'lncRNA' AS gene_type, 'NA' AS transcript_type
FROM {orders}"""

VIEWS["var"] = """
SELECT 'chr'||CAST(l_suppkey%5+1 AS STRING) AS chrom, l_orderkey*37+l_linenumber*101+l_partkey%37 AS start,
       l_orderkey*37+l_linenumber*101+l_partkey%37+1+l_partkey%3 AS end_,
       'v'||CAST(l_orderkey AS STRING)||'_'||CAST(l_linenumber AS STRING) AS variant_id,
       l_discount AS score, l_returnflag AS label, l_partkey AS part, l_suppkey AS supp
FROM {lineitem}"""

# annotation text: gene, transcript, exon and CDS lines of each order
VIEWS["gtf"] = """
SELECT 'ann.gtf' AS path, k*40+n*4+1 AS ord,
       'chr'||CAST(k%5+1 AS STRING)||chr(9)||'src'||chr(9)||'exon'||chr(9)||CAST(k*37+n*600+pk%100+1 AS STRING)||chr(9)||CAST(k*37+n*600+pk%100+50+pk%300 AS STRING)||chr(9)||'.'||chr(9)||
       CASE WHEN k%2=0 THEN '+' ELSE '-' END||chr(9)||'.'||chr(9)||'gene_id "g'||CAST(k%1500 AS STRING)||'"; transcript_id "t'||CAST(k AS STRING)||'";'||
       CASE WHEN pk%3=0 THEN ' exon_number "'||CAST(n AS STRING)||'";' ELSE '' END||CASE WHEN pk%5=0 THEN ' gene_type "lncRNA"; transcript_type "lnc";' ELSE '' END AS value
FROM {li}
UNION ALL
SELECT 'ann.gtf', k*40+n*4+2,
       'chr'||CAST(k%5+1 AS STRING)||chr(9)||'src'||chr(9)||'CDS'||chr(9)||CAST(k*37+n*600+pk%100+11 AS STRING)||chr(9)||CAST(k*37+n*600+pk%100+40+pk%300 AS STRING)||chr(9)||'.'||chr(9)||
       CASE WHEN k%2=0 THEN '+' ELSE '-' END||chr(9)||'0'||chr(9)||'gene_id "g'||CAST(k%1500 AS STRING)||'"; transcript_id "t'||CAST(k AS STRING)||'"; gene_biotype "protein_coding";'
FROM {li} WHERE n BETWEEN 3 AND 4
UNION ALL
SELECT 'ann.gtf', k*40,
       'chr'||CAST(k%5+1 AS STRING)||chr(9)||'src'||chr(9)||CASE WHEN k%7=0 THEN 'gene' WHEN k%7=1 THEN 'mRNA' ELSE 'transcript' END||chr(9)||CAST(k*37+1 AS STRING)||chr(9)||CAST(k*37+5000 AS STRING)||chr(9)||'.'||chr(9)||
       CASE WHEN k%2=0 THEN '+' ELSE '-' END||chr(9)||'.'||chr(9)||'gene_id "g'||CAST(k%1500 AS STRING)||'"; transcript_id "t'||CAST(k AS STRING)||'"; gene_type "lncRNA";'
FROM (SELECT DISTINCT k FROM {li}) d
UNION ALL
SELECT 'ann.gtf', k*40+3, CASE WHEN k%3=0 THEN '# comment' WHEN k%3=1 THEN 'short'||chr(9)||'line' ELSE 'chr1'||chr(9)||'s'||chr(9)||'exon'||chr(9)||'x'||chr(9)||'9'||chr(9)||'.'||chr(9)||'+'||chr(9)||'.'||chr(9)||'a' END
FROM (SELECT DISTINCT k FROM {li} WHERE k%50<3) d"""

VIEWS["gff3"] = """
SELECT 'ann.gff3' AS path, k*8+n AS ord,
       'chr'||CAST(k%5+1 AS STRING)||chr(9)||'src'||chr(9)||'exon'||chr(9)||CAST(k*37+n*600+1 AS STRING)||chr(9)||CAST(k*37+n*600+100 AS STRING)||chr(9)||'.'||chr(9)||
       CASE WHEN k%2=0 THEN '+' ELSE '-' END||chr(9)||'.'||chr(9)||'ID=exon'||CAST(k*8+n AS STRING)||';Parent=tx'||CAST(k AS STRING)||';biotype=lncRNA;flag' AS value
FROM {li}
UNION ALL
SELECT 'ann.gff3', k*8,
       'chr'||CAST(k%5+1 AS STRING)||chr(9)||'src'||chr(9)||'mRNA'||chr(9)||CAST(k*37+1 AS STRING)||chr(9)||CAST(k*37+5000 AS STRING)||chr(9)||'.'||chr(9)||
       CASE WHEN k%2=0 THEN '+' ELSE '-' END||chr(9)||'.'||chr(9)||'ID=tx'||CAST(k AS STRING)||';Parent=gene'||CAST(k%1500 AS STRING)
FROM (SELECT DISTINCT k FROM {li}) d"""

# variant text with two samples
VIEWS["vcf"] = """
SELECT 'v.vcf' AS path, k*8+n AS ord,
       CASE CAST(sk%7 AS INT) WHEN 0 THEN 'chr1' WHEN 1 THEN '2' WHEN 2 THEN 'X' WHEN 3 THEN 'MT' WHEN 4 THEN 'chr9' WHEN 5 THEN 'chrUn7' ELSE '3' END||chr(9)||
       CAST(k*37+n*101+pk%37+1 AS STRING)||chr(9)||CASE CAST(pk%3 AS INT) WHEN 0 THEN 'rs'||CAST(pk AS STRING) WHEN 1 THEN '.' ELSE 'id'||CAST(pk AS STRING) END||chr(9)||
       CASE CAST(pk%4 AS INT) WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'GT' ELSE 'T' END||chr(9)||
       CASE CAST(sk%6 AS INT) WHEN 0 THEN 'G' WHEN 1 THEN 'A,T' WHEN 2 THEN 'CA' WHEN 3 THEN '<DEL>' WHEN 4 THEN '.' ELSE 'C,GG,T' END||chr(9)||
       CASE WHEN qty%5=0 THEN '.' ELSE CAST(qty AS STRING) END||chr(9)||CASE WHEN disc<6 THEN 'PASS' WHEN disc<9 THEN 'q10' ELSE '.' END||chr(9)||
       'CLNSIG='||CASE CAST(pk%8 AS INT) WHEN 0 THEN 'Pathogenic' WHEN 1 THEN 'Likely_benign' WHEN 2 THEN 'Conflicting_interpretations_of_pathogenicity' WHEN 3 THEN 'drug_response'
         WHEN 4 THEN 'Uncertain_significance' WHEN 5 THEN 'risk_factor,Affects' WHEN 6 THEN 'not_provided' ELSE 'Benign/protective' END||
       CASE WHEN pk%5=0 THEN '' ELSE ';ALLELEID='||CAST(pk*3 AS STRING) END||';DP='||CAST(qty AS STRING)||';AC='||
       CASE CAST(sk%6 AS INT) WHEN 1 THEN '1,2' WHEN 5 THEN '4,5,6' ELSE '7' END||';RS='||CASE WHEN sk%2=0 THEN CAST(sk AS STRING) ELSE '' END||';FLAG'||chr(9)||
       'GT:AD:PL'||chr(9)||CASE CAST(sk%6 AS INT) WHEN 1 THEN '1/2:3,4,5:1,2,3,4,5,6' WHEN 5 THEN '0|3:9,8,7,6:1,2' ELSE '0/1:3,4:1,2,3' END||chr(9)||
       CASE CAST(sk%6 AS INT) WHEN 1 THEN '0/2:1,0,2' WHEN 5 THEN './1:.:.' ELSE '1/1:0,4:9,2,3' END AS value
FROM {li}"""

# header lines of a growing number of fields and contigs
VIEWS["vcf_header"] = """
SELECT 'h.vcf' AS path, p_partkey AS ord, CASE CAST(p_partkey%3 AS INT) WHEN 0 THEN '##contig=<ID=c'||CAST(p_partkey AS STRING)||',length='||CAST(p_size*1000 AS STRING)||'>'
  WHEN 1 THEN '##INFO=<ID=I'||CAST(p_partkey AS STRING)||',Number='||CASE WHEN p_size%2=0 THEN 'A' ELSE '1' END||',Type=String,Description="'||p_name||', '||p_brand||'">'
  ELSE '##FORMAT=<ID=F'||CAST(p_partkey AS STRING)||',Number=G,Type=Integer,Description="'||p_type||'">' END AS value FROM {part}
UNION ALL SELECT 'h.vcf', 0, '##fileformat=VCFv4.2'"""

VIEWS["vcf_meta"] = """
SELECT 'v.vcf' AS path, CAST(-20 AS BIGINT) AS ord, '##fileformat=VCFv4.2' AS value
UNION ALL SELECT 'v.vcf', -19, '##INFO=<ID=AC,Number=A,Type=Integer,Description="Allele, count">'
UNION ALL SELECT 'v.vcf', -18, '##INFO=<ID=CLNSIG,Number=.,Type=String,Description="x">'
UNION ALL SELECT 'v.vcf', -17, '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="d">'
UNION ALL SELECT 'v.vcf', -16, '##FORMAT=<ID=PL,Number=G,Type=Integer,Description="p">'
UNION ALL SELECT 'v.vcf', -15, '##contig=<ID=X>'
UNION ALL SELECT 'v.vcf', -14, '##contig=<ID=chr9>'
UNION ALL SELECT 'v.vcf', -13, '##FILTER=<ID=q10,Description="low">'
UNION ALL SELECT 'v.vcf', -10, '#CHROM'||chr(9)||'POS'||chr(9)||'ID'||chr(9)||'REF'||chr(9)||'ALT'||chr(9)||'QUAL'||chr(9)||'FILTER'||chr(9)||'INFO'||chr(9)||'FORMAT'||chr(9)||'s1'||chr(9)||'s2'"""

# parsed record columns for the DuckDB side
VIEWS["vcf_rec"] = """
SELECT ord, string_split(value, chr(9)) AS c FROM {vcf}"""

VIEWS["bed"] = """
SELECT 'x.bed' AS path, k*8+n AS ord,
       CASE WHEN pk%97=0 THEN '# note' WHEN pk%89=0 THEN 'chr1'||chr(9)||'9' WHEN pk%83=0 THEN 'chr1'||chr(9)||'x'||chr(9)||'9' WHEN pk%79=0 THEN 'chr1'||chr(9)||'9'||chr(9)||'9' ELSE
       'chr'||CAST(sk%5+1 AS STRING)||chr(9)||CAST(k*37+n*101 AS STRING)||chr(9)||CAST(k*37+n*101+20+pk%200 AS STRING)||
       CASE CAST(pk%4 AS INT) WHEN 0 THEN '' WHEN 1 THEN chr(9)||'name'||CAST(pk AS STRING) WHEN 2 THEN chr(9)||CASE WHEN sk%2=0 THEN 'lnc_RNA' ELSE '5UTR' END||chr(9)||CAST(qty AS STRING)||chr(9)||'-'
         ELSE chr(9)||'b'||CAST(sk AS STRING)||chr(9)||'0'||chr(9)||'+'||chr(9)||'more' END END AS value
FROM {li}"""

VIEWS["cosmic"] = """
SELECT CASE WHEN sk%3=0 THEN 'chr' ELSE '' END||CAST(sk%5+1 AS STRING) AS chrom, CAST(k*37+n*101+pk%37+1 AS STRING) AS pos,
       CASE CAST(pk%3 AS INT) WHEN 0 THEN 'A' WHEN 1 THEN ' GT ' ELSE '' END AS ref, CASE WHEN pk%2=0 THEN 'T' ELSE '' END AS alt,
       CASE WHEN pk%4=0 THEN '' ELSE 'COSV'||CAST(pk AS STRING) END AS cosmic_id,
       CASE CAST(pk%9 AS INT) WHEN 0 THEN 'NA' WHEN 1 THEN '.' WHEN 2 THEN 'bad' WHEN 3 THEN '0.70' WHEN 4 THEN '1d' ELSE '0.'||CAST(60+pk%40 AS STRING) END AS fathmm_mkl_score,
       CASE WHEN qty%4=0 THEN '' ELSE 'disease'||CAST(qty AS STRING) END AS disease_name
FROM {li}"""

VIEWS["gwas"] = """
SELECT CAST(sk%5+1 AS STRING) AS chrom, CASE WHEN pk%11=0 THEN '' WHEN pk%13=0 THEN '12;15' ELSE CAST(k*37+n*101+pk%37+1 AS STRING) END AS pos,
       CASE CAST(pk%4 AS INT) WHEN 0 THEN '' WHEN 1 THEN 'rs1-A' WHEN 2 THEN 'rs-2-' ELSE 'C' END AS alt, CASE WHEN pk%10=0 THEN ' ' ELSE 'rs'||CAST(pk AS STRING) END AS variant_id,
       CASE CAST(pk%7 AS INT) WHEN 0 THEN '5e-8' WHEN 1 THEN '4.9E-8' WHEN 2 THEN 'x' WHEN 3 THEN '1e-20' ELSE '0.0000000'||CAST(1+pk%9 AS STRING) END AS p_value,
       CASE WHEN qty%6=0 THEN '' ELSE 'trait'||CAST(qty AS STRING) END AS trait_name, CASE WHEN qty%5=0 THEN '' ELSE 'm'||CAST(qty AS STRING)||', other' END AS mapped_trait,
       CASE WHEN qty%3=0 THEN '' ELSE 'http://x/efo/EFO_'||CAST(qty AS STRING)||'/, http://x/2' END AS mapped_trait_uri, '' AS or_or_beta
FROM {li}"""

VIEWS["smprot"] = """
SELECT CASE WHEN pk%31=0 THEN '' ELSE CAST(sk%5+1 AS STRING) END AS chrom, CASE WHEN pk%29=0 THEN 'x' ELSE CAST(k*37+n*101 AS STRING) END AS start,
       CAST(k*37+n*101+CASE WHEN pk%23=0 THEN 0 ELSE 9+pk%90 END AS STRING) AS end_, CASE WHEN pk%19=0 THEN '' ELSE 'SPROT'||CAST(k*8+n AS STRING) END AS protein_id,
       CASE WHEN qty%2=0 THEN '' ELSE 'MS' END AS evidence
FROM {li}"""

_NAME = re.compile(r"\{(\w+)\}")


def deps(name: str) -> list[str]:
    return list(dict.fromkeys(_NAME.findall(VIEWS[name])))


def cte(*names: str) -> str:
    """``WITH`` clause defining the views (and those they use) for the SQL side."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in TABLES or n in order:
            return
        for d in deps(n):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n].strip().format(**{d: d for d in deps(n)})})" for n in order)


def sql(text: str, *names: str) -> str:
    """Oracle text: the views and a query over them; a leading ``, name AS (...)`` adds local steps."""
    head = cte(*names)
    body = text.strip()
    return head + ("" if body.startswith(",") else "\n") + body


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in TABLES:
        return table(spark, sf_dir, name)
    return spark.sql(VIEWS[name], **{d: _raw(spark, sf_dir, d) for d in deps(name)})


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = _raw(spark, sf_dir, name)
    if df.columns == ["path", "ord", "value"]:
        # stands for the file boundary: derived text is built once, not again for every cell cut from it or condition on it
        df = evaluated_once(df, "ord")
    return df.withColumnsRenamed({c: c[:-1] for c in df.columns if c.endswith("_")})
