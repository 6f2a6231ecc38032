"""Queries of variant filters, annotation and the VCF toolbox."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.operators import smprot as P
from locusframe.operators import variants as V
from locusframe.plans.q_features import GTF_RECORDS, records
from locusframe.operators.ordered import with_rank
from locusframe.plans.registry import Query, longs
from locusframe.plans.views import VIEWS, sql, view
from locusframe.operators.features import extract_features
from locusframe.sources import sinks
from locusframe.sources.vcf import alt_text, parse_vcf, parse_vcf_meta, vcf_line

VIEWS["background"] = """
SELECT CASE CAST(sk%3 AS INT) WHEN 0 THEN 'chr1' WHEN 1 THEN '2' ELSE 'X' END AS chrom, k*37+n*101+pk%37+1 AS pos, CASE CAST(pk%4 AS INT) WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'GT' ELSE 'T' END AS ref,
       CASE WHEN sk%2=0 THEN 'G' ELSE 'A' END AS alt, CAST(pk%101 AS DOUBLE)/CAST(100 AS DOUBLE) AS af FROM {li}"""
VIEWS["regions"] = """
SELECT CASE WHEN o_orderkey%2=0 THEN 'chr1' ELSE 'X' END AS chrom, o_orderkey*37 AS start, o_orderkey*37+200 AS end_ FROM {orders} WHERE o_custkey%4=0"""


def recs(s, d):
    return parse_vcf(view(s, d, "vcf"))


def metas(s, d):
    return parse_vcf_meta(view(s, d, "vcf_meta"))


def clinvar(s, d):
    return V.clinvar_filter(recs(s, d))


def cosmic(s, d):
    return V.cosmic_filter(view(s, d, "cosmic"))


def gwas(s, d):
    return V.gwas_filter(view(s, d, "gwas"))


def feats(s, d):
    return view(s, d, "feat")


# the variants lie on contigs chr1..chr5 for the annotation queries
def clinvar_on_features(s, d):
    v = clinvar(s, d).withColumn("chrom", F.concat(F.lit("chr"), (F.col("start") % 5 + 1).cast("string")))
    return V.annotate_clinvar(feats(s, d), v)


def flagship(s, d):
    """Annotation text to features, variant text to labelled variants, overlap, summary."""
    v = clinvar(s, d).withColumn("chrom", F.concat(F.lit("chr"), (F.col("start") % 5 + 1).cast("string")))
    f = extract_features(records(s, d), ["gene", "transcript", "exon", "intron", "cds", "utr"])
    return longs(V.summarize_annotations(V.annotate_clinvar(f, v)))


def cosmic_on_features(s, d):
    return V.annotate_cosmic(feats(s, d), cosmic(s, d))


def gwas_on_features(s, d):
    return V.annotate_gwas(feats(s, d), gwas(s, d))


def q_summary(s, d):
    return longs(V.summarize_annotations(clinvar_on_features(s, d)))


def q_gwas_summary(s, d):
    return longs(V.summarize_gwas(gwas_on_features(s, d)))


def q_cosmic_summary(s, d):
    return longs(V.summarize_annotations(cosmic_on_features(s, d)))


def q_label_counts(s, d):
    return V.label_counts(clinvar(s, d), V.CLINICAL_LABEL_ORDER)


def proteins(s, d):
    return P.smprot_filter(view(s, d, "smprot"))


def q_place(s, d):
    return P.place_proteins(feats(s, d), proteins(s, d))


def q_place_metrics(s, d):
    return P.placement_metrics(P.place_proteins(feats(s, d), proteins(s, d)))


def q_smprot_report(s, d):
    return P.smprot_filter_report(view(s, d, "smprot"))


CHECKS = dict(regions=["chr1:1-400,000", "X", "2"], min_qual=8.0, min_dp=12, keep_types=["snv", "indel"], require_pass=True)


def q_filter(s, d):
    return V.vcf_filter(recs(s, d), **CHECKS).select("ord", vcf_line(None).alias("line"))


def q_filter_report(s, d):
    return V.vcf_filter_report(recs(s, d), **CHECKS)


def q_region_table(s, d):
    return V.vcf_region_filter(recs(s, d), view(s, d, "regions")).select("ord", "chrom", "pos")


def q_query(s, d):
    return V.vcf_query(recs(s, d), ["DP", "ALLELEID"], ["GT", "AD"], ["s1", "s2"])


def q_gvcf(s, d):
    r = recs(s, d).withColumn("alts", F.transform("alts", lambda a: F.when(a == "<DEL>", "<NON_REF>").otherwise(a)))
    return V.extract_variants(r).select("ord", "chrom", "pos")


def q_normalize(s, d):
    out = V.normalize_alleles(recs(s, d), metas(s, d))
    return longs(out.select("ord", "chrom", "pos", "ref", alt_text(F.col("alts")).alias("alt"), "info", F.array_join("samples", " ").alias("samples"), "kept_genotype_fields"))


def q_sort(s, d):
    ranks = V.contig_ranks(recs(s, d), meta=metas(s, d))
    return ranks.select("chrom", F.col("rank.g").cast("bigint").alias("g"), F.col("rank.n").alias("n"))


def q_sorted(s, d):
    return with_rank(V.sort_vcf(recs(s, d), meta=metas(s, d)).select("chrom", "pos", "ord"))


def q_stats(s, d):
    return V.vcf_statistics(recs(s, d))


def q_types(s, d):
    from locusframe.functions.variant import allele_types

    return recs(s, d).select("ord", F.array_join(F.array_sort(allele_types(F.col("ref"), F.col("alts"))), ",").alias("types"))


def q_meta(s, d):
    lines = parse_vcf_meta(view(s, d, "vcf_header"))
    return lines.select("ord", "kind", "id", "number", F.col("attrs")["Description"].alias("description"))


def q_document(s, d):
    return longs(sinks.vcf_document(recs(s, d), view(s, d, "vcf_meta"), ["s1", "s2"]))


def q_genotypes(s, d):
    return V.genotype_table(recs(s, d), ["s1", "s2"])


def q_background(s, d):
    out = V.background_check(recs(s, d), view(s, d, "background"))
    return longs(out.withColumn("found_share", F.round("found_share", 9)))


def q_sql_export(s, d):
    return sinks.sql_export(clinvar_on_features(s, d), "gtf_clinvar_annotation").select(F.col("section").cast("bigint").alias("section"), "value")


def q_sql_export_gwas(s, d):
    return sinks.sql_statements(gwas_on_features(s, d), "gtf_gwas_catalog_annotation")


def q_sql_export_cosmic(s, d):
    return sinks.sql_statements(cosmic_on_features(s, d), "gtf_cosmic_annotation")


def q_sql_export_smprot(s, d):
    return sinks.sql_statements(q_place(s, d), "gtf_smprot_annotation")


def q_track(s, d):
    return sinks.track_export(clinvar_on_features(s, d), "gtf_clinvar_annotation").select(F.col("section").cast("bigint").alias("section"), "value")


def q_track_cosmic(s, d):
    return longs(sinks.track_rows(cosmic_on_features(s, d), "gtf_cosmic_annotation"))


def q_track_line(s, d):
    out = sinks.with_track_line(view(s, d, "bed"), sinks.track_line("mine", "my intervals", colour="0,0,178", visibility="dense", priority=3))
    return out.select(F.col("section").cast("bigint").alias("section"), "ord", "value")


def q_split_samples(s, d):
    r = sinks.sample_records(recs(s, d), ["s1", "s2"])
    return r.select("sample", "ord", vcf_line(r).alias("line"))


def q_split_counts(s, d):
    return sinks.split_counts(recs(s, d))


ALT = "CASE WHEN c[5]='.' THEN '.' ELSE c[5] END"
NCHROM = "CASE WHEN c[1] LIKE 'chr%' THEN c[1] WHEN c[1]='MT' THEN 'chrM' ELSE 'chr'||c[1] END"
CLINVAR_SQL = f"""
, raw AS (SELECT string_split(value, chr(9)) AS c, ord FROM vcf),
lab AS (SELECT c, ord, {NCHROM} AS ch, CAST(c[2] AS BIGINT) AS pos, replace(lower(regexp_extract(c[8], 'CLNSIG=([^;]*)', 1)), '_', ' ') AS sig, regexp_extract(c[8], 'ALLELEID=([^;]*)', 1) AS aid, regexp_extract(c[8], 'RS=([^;]*)', 1) AS rs FROM raw),
l2 AS (SELECT *, list_filter([CASE WHEN sig LIKE '%benign%' THEN 'Benign' END, CASE WHEN sig LIKE '%pathogenic%' THEN 'Pathogenic' END, CASE WHEN sig LIKE '%drug response%' THEN 'Drug response' END, CASE WHEN sig LIKE '%protective%' THEN 'Protective' END, CASE WHEN sig LIKE '%risk factor%' THEN 'Risk factor' END, CASE WHEN sig LIKE '%affects%' THEN 'Affects' END], lambda x: x IS NOT NULL) AS ls FROM lab),
acc AS (SELECT * FROM (VALUES ('chr1','NC_000001.11'),('chr2','NC_000002.12'),('chr3','NC_000003.12'),('chr9','NC_000009.12'),('chrX','NC_000023.11'),('chrM','NC_012920.1')) t(n, a)),
cv AS (SELECT ch AS chrom, pos-1 AS start, pos-1+greatest(1, length(c[4])) AS end_, CASE WHEN c[3] IN ('', '.') THEN ch||':'||c[2]||':'||c[4]||':'||c[5] ELSE c[3] END AS variant_id, array_to_string(ls, '|') AS clinical_labels,
  CASE WHEN aid='' THEN 'NA' ELSE aid END AS allele_id, 'NA' AS disease_name, coalesce(a, ch)||':g.'||c[2]||c[4]||'>'||CASE WHEN c[5]='.' THEN '?' ELSE split_part(c[5], ',', 1) END AS variant_name,
  CASE WHEN lower(c[3]) LIKE 'rs%' THEN c[3] WHEN rs<>'' THEN 'rs'||rs ELSE 'NA' END AS dbsnp_id FROM l2 LEFT JOIN acc ON acc.n=ch WHERE len(ls)>0)
"""
CV5 = """, cv5 AS (SELECT * REPLACE ('chr'||CAST(start%5+1 AS VARCHAR) AS chrom) FROM cv),
ann AS (SELECT f.chrom, f.start+1 AS start, f.end_ AS "end", feature_type, feature_id, gene_id, transcript_id, gene_type, transcript_type, strand, variant_id, variant_name, dbsnp_id, clinical_labels, allele_id, disease_name
  FROM feat f JOIN cv5 v ON f.chrom=v.chrom AND f.start<v.end_ AND v.start<f.end_ WHERE feature_type NOT IN ('gene', 'transcript'))
"""
SUMMARY = """
, lbl AS (SELECT * FROM (VALUES ('ALL', 0), ('Pathogenic', 1), ('Benign', 2), ('Affects', 3), ('Drug response', 4), ('Protective', 5), ('Risk factor', 6)) t(label, label_rank)),
ft AS (SELECT feature_type, coalesce(list_position(['CDS', '5UTR', '3UTR', 'exon', 'intron', 'gene', 'transcript'], feature_type), 8) AS feature_rank, count(*) AS n FROM ann GROUP BY 1),
pl AS (SELECT feature_type, unnest(string_split(clinical_labels, '|')) AS label FROM ann), pc AS (SELECT feature_type, label, count(*) AS n FROM pl GROUP BY 1,2)
SELECT ft.feature_type, lbl.label, CASE WHEN lbl.label='ALL' THEN ft.n ELSE coalesce(pc.n, 0) END AS count, CAST(feature_rank AS BIGINT) AS feature_rank, CAST(label_rank AS BIGINT) AS label_rank
FROM ft CROSS JOIN lbl LEFT JOIN pc ON pc.feature_type=ft.feature_type AND pc.label=lbl.label"""
COSMIC_SQL = r"""
, cs AS (SELECT *, CASE WHEN regexp_matches(trim(fathmm_mkl_score), '^[0-9.]+$') THEN TRY_CAST(trim(fathmm_mkl_score) AS DOUBLE) END AS sc, CASE WHEN chrom LIKE 'chr%' THEN chrom ELSE 'chr'||chrom END AS ch, CAST(pos AS BIGINT) AS p,
  CASE WHEN trim(ref)='' THEN 'N' ELSE trim(ref) END AS rf, CASE WHEN alt='' THEN '.' ELSE alt END AS al FROM cosmic),
co AS (SELECT ch AS chrom, p-1 AS start, p-1+length(rf) AS end_, CASE WHEN cosmic_id='' THEN ch||':'||pos||':'||rf||':'||al ELSE cosmic_id END AS variant_id, 'Pathogenic' AS clinical_labels,
  CASE WHEN cosmic_id='' THEN ch||':'||pos||':'||rf||':'||al ELSE cosmic_id END AS cosmic_id, CASE WHEN disease_name='' THEN 'NA' ELSE disease_name END AS disease_name, sc AS fathmm_mkl_score FROM cs WHERE sc>0.7)
"""
ANN_COSMIC = """, ann AS (SELECT f.chrom, f.start+1 AS start, f.end_ AS "end", feature_type, feature_id, gene_id, transcript_id, gene_type, transcript_type, strand, variant_id, clinical_labels, cosmic_id, disease_name, fathmm_mkl_score
  FROM feat f JOIN co v ON f.chrom=v.chrom AND f.start<v.end_ AND v.start<f.end_ WHERE feature_type NOT IN ('gene', 'transcript'))
"""
GWAS_SQL = r"""
, gw AS (SELECT *, TRY_CAST(p_value AS DOUBLE) AS pv, TRY_CAST(pos AS BIGINT) AS p, CASE CAST(instr(alt, '-')>0 AS INT) WHEN 1 THEN CASE WHEN regexp_extract(alt, '-([^-]*)$', 1)<>'' THEN regexp_extract(alt, '-([^-]*)$', 1) ELSE alt END ELSE CASE WHEN alt='' THEN '.' ELSE alt END END AS al FROM gwas WHERE regexp_matches(p_value, '^[0-9.eE-]+$')),
gk AS (SELECT 'chr'||chrom AS chrom, p-1 AS start, p AS end_, CASE WHEN trim(variant_id)='' THEN 'chr'||chrom||':'||pos||':N:'||al ELSE variant_id END AS variant_id, 'Genome-wide significant' AS association_label,
  CASE WHEN trait_name='' THEN 'NA' ELSE trait_name END AS trait_name, pv AS p_value, 'NA' AS allele_id, CASE WHEN mapped_trait='' THEN 'NA' ELSE split_part(mapped_trait, ',', 1) END AS efo_trait,
  CASE WHEN mapped_trait_uri='' THEN 'NA' ELSE regexp_extract(mapped_trait_uri, '(EFO_[0-9]+)', 1) END AS efo_id, 'NA' AS risk_allele_frequency, 'NA' AS or_or_beta, 'NA' AS ci_95_text FROM gw WHERE pv<5e-8 AND p IS NOT NULL)
"""
ANN_GWAS = """, ann AS (SELECT f.chrom, f.start+1 AS start, f.end_ AS "end", feature_type, feature_id, gene_id, transcript_id, gene_type, transcript_type, strand, variant_id, association_label, variant_id AS gwas_variant_id, allele_id, trait_name, efo_trait, efo_id, p_value, risk_allele_frequency, or_or_beta, ci_95_text
  FROM feat f JOIN gk v ON f.chrom=v.chrom AND f.start<v.end_ AND v.start<f.end_ WHERE feature_type NOT IN ('gene', 'transcript'))
"""
SMPROT_SQL = """
, sp AS (SELECT 'chr'||chrom AS chrom, TRY_CAST(start AS BIGINT) AS start, TRY_CAST(end_ AS BIGINT) AS end_, protein_id, CASE WHEN evidence='' THEN 'NA' ELSE evidence END AS evidence, 'SmProt' AS source FROM smprot WHERE chrom<>'' AND protein_id<>'' AND TRY_CAST(end_ AS BIGINT)>TRY_CAST(start AS BIGINT)),
hit AS (SELECT f.chrom, p.start, p.end_ AS e, protein_id, evidence, source, transcript_id, gene_id, gene_type, transcript_type, strand, f.start AS ts, f.end_ AS te FROM feat f JOIN sp p ON f.chrom=p.chrom AND p.start>=f.start AND p.end_<=f.end_ WHERE feature_type NOT IN ('gene', 'transcript')),
one AS (SELECT protein_id FROM hit GROUP BY 1 HAVING count(DISTINCT transcript_id)=1),
pl AS (SELECT chrom, start, e AS "end", hit.protein_id, evidence, source, transcript_id, gene_id, gene_type, transcript_type, strand, ts AS transcript_start, te AS transcript_end, 'entirely_within_unique_transcript' AS mapping_type FROM hit JOIN one ON one.protein_id=hit.protein_id)
"""
AT = "CASE WHEN r='' OR a='' OR a LIKE '<%' OR a='*' THEN 'other' WHEN length(r)=1 AND length(a)=1 THEN 'snv' WHEN length(r)=length(a) THEN 'mnv' ELSE 'indel' END"
FILTER_SQL = """
, raw AS (SELECT string_split(value, chr(9)) AS c, ord, value FROM vcf),
t AS (SELECT *, CAST(c[2] AS BIGINT) AS pos, TRY_CAST(c[6] AS DOUBLE) AS q, TRY_CAST(regexp_extract(c[8], ';DP=([^;]*)', 1) AS BIGINT) AS dp, c[5] NOT IN ('.', '<DEL>') AND NOT (length(c[4])>1 AND c[5]='CA') AS ok FROM raw),
w AS (SELECT *, CASE WHEN NOT ((c[1]='chr1' AND pos BETWEEN 1 AND 400000) OR c[1] IN ('X', '2')) THEN 'region' WHEN q IS NULL OR q<8 THEN 'qual' WHEN dp IS NULL OR dp<12 THEN 'depth'
  WHEN NOT ok THEN 'type' WHEN c[7]<>'PASS' THEN 'filter' ELSE 'kept' END AS outcome FROM t)
"""


def _esc(*cols):
    return "||', '||".join(f"''''||replace({c}, '''', '''''')||''''" for c in cols)


_CV_HEAD = "INSERT INTO gtf_clinvar_annotation (chrom, start, end, feature_type, feature_id, gene_id, transcript_id, gene_type, transcript_type, strand, variant_id, variant_name, dbsnp_id, clinical_labels, allele_id, disease_name) VALUES ("
_CV_TABLE = ("CREATE TABLE IF NOT EXISTS gtf_clinvar_annotation (chrom TEXT, start INTEGER, end INTEGER, feature_type TEXT, feature_id TEXT, gene_id TEXT, transcript_id TEXT, gene_type TEXT, "
             "transcript_type TEXT, strand TEXT, variant_id TEXT, variant_name TEXT, dbsnp_id TEXT, clinical_labels TEXT, allele_id TEXT, disease_name TEXT);")
_CO_HEAD = "INSERT INTO gtf_cosmic_annotation (chrom, start, end, feature_type, feature_id, gene_id, transcript_id, gene_type, transcript_type, strand, variant_id, clinical_labels, cosmic_id, disease_name, fathmm_mkl_score) VALUES ("
_GW_HEAD = "INSERT INTO gtf_gwas_catalog_annotation (chrom, start, end, feature_type, feature_id, gene_id, transcript_id, gene_type, transcript_type, strand, variant_id, association_label, gwas_variant_id, allele_id, trait_name, efo_trait, efo_id, p_value, risk_allele_frequency, or_or_beta, ci_95_text) VALUES ("
_SP_HEAD = "INSERT INTO gtf_smprot_annotation (chrom, start, end, protein_id, evidence, source, transcript_id, gene_id, gene_type, transcript_type, strand, transcript_start, transcript_end, mapping_type) VALUES ("
_SE = "CAST(start AS VARCHAR)||', '||CAST(\"end\" AS VARCHAR)"
_RGB = ("CASE WHEN clinical_labels ILIKE '%pathogenic%' THEN '255,0,0' WHEN clinical_labels ILIKE '%benign%' THEN '0,128,0' WHEN clinical_labels ILIKE '%risk factor%' THEN '255,140,0' "
        "WHEN clinical_labels ILIKE '%drug response%' THEN '0,0,255' WHEN clinical_labels ILIKE '%protective%' THEN '0,128,255' WHEN clinical_labels ILIKE '%affects%' THEN '128,0,128' ELSE '80,80,80' END")
PICK = """
, raw AS (SELECT string_split(value, chr(9)) AS c, ord FROM vcf), al AS (SELECT *, CASE WHEN c[5]='.' THEN 0 ELSE len(string_split(c[5], ',')) END AS n FROM raw),
m AS (SELECT ord, c, n, unnest(range(n)) AS i FROM al WHERE n>1),
f AS (SELECT ord, c, n, i, string_split(c[8], ';') AS inf, [string_split(c[10], ':'), string_split(c[11], ':')] AS sm FROM m),
one AS (SELECT ord, c[1] AS chrom, CAST(c[2] AS BIGINT) AS pos, c[4] AS ref, c[5] AS alt, c[8] AS info, c[10]||' '||c[11] AS samples, CAST(0 AS BIGINT) AS kept_genotype_fields FROM al WHERE n<=1),
x AS (SELECT ord, c, n, i, string_split(c[5], ',')[i+1] AS alt,
  array_to_string([CASE WHEN t LIKE 'AC=%' THEN 'AC='||string_split(substr(t, 4), ',')[i+1] WHEN t LIKE 'CLNSIG=%' AND len(string_split(substr(t, 8), ','))=n THEN 'CLNSIG='||string_split(substr(t, 8), ',')[i+1]
     WHEN t LIKE 'DP=%' OR t LIKE 'RS=%' OR t LIKE 'ALLELEID=%' THEN t ELSE t END for t in inf], ';') AS info,
  [ array_to_string([CASE WHEN g IN ('/', '|', '.') THEN g WHEN g='0' THEN '0' WHEN g=CAST(i+1 AS VARCHAR) THEN '1' ELSE '.' END for g in string_split(s[1], '')], '')
    ||':'||CASE WHEN s[2]='.' THEN '.' ELSE string_split(s[2], ',')[1]||','||string_split(s[2], ',')[i+2] END
    ||':'||CASE WHEN coalesce(s[3], '.')='.' THEN '.' WHEN len(string_split(s[3], ','))=(n+1)*(n+2)//2 THEN string_split(s[3], ',')[1]||','||string_split(s[3], ',')[(i+1)*(i+2)//2+1]||','||string_split(s[3], ',')[(i+1)*(i+2)//2+(i+1)+1] ELSE s[3] END for s in sm] AS sl,
  list_sum([CASE WHEN s[3] IS NOT NULL AND s[3]<>'.' AND len(string_split(s[3], ','))<>(n+1)*(n+2)//2 THEN 1 ELSE 0 END for s in sm]) AS kept FROM f)
SELECT ord, chrom, pos, ref, alt, info, samples, kept_genotype_fields FROM one
UNION ALL SELECT ord, c[1], CAST(c[2] AS BIGINT), c[4], alt, info, sl[1]||' '||sl[2], CAST(kept AS BIGINT) FROM x"""

QUERIES = {
    "clinvar_filter": Query(clinvar, sql(CLINVAR_SQL + 'SELECT chrom, start, end_ AS "end", variant_id, clinical_labels, allele_id, disease_name, variant_name, dbsnp_id FROM cv', "vcf")),
    "clinvar_label_counts": Query(q_label_counts, sql(CLINVAR_SQL + """
, s AS (SELECT unnest(string_split(clinical_labels, '|')) AS l FROM cv) SELECT 'kept_variants' AS metric, count(*) AS value FROM cv
UNION ALL SELECT 'label_'||replace(k, ' ', '_'), (SELECT count(*) FROM s WHERE l=k) FROM (VALUES ('Pathogenic'), ('Benign'), ('Affects'), ('Drug response'), ('Protective'), ('Risk factor')) t(k)""", "vcf")),
    "annotate_clinvar": Query(clinvar_on_features, sql(CLINVAR_SQL + CV5 + "SELECT * FROM ann", "vcf", "feat")),
    "summarize_clinvar": Query(q_summary, sql(CLINVAR_SQL + CV5 + SUMMARY, "vcf", "feat")),
    "clinvar_from_text_to_summary": Query(flagship, sql(CLINVAR_SQL + ", cv5 AS (SELECT * REPLACE ('chr'||CAST(start%5+1 AS VARCHAR) AS chrom) FROM cv)\n" + GTF_RECORDS.replace(", raw AS", ", graw AS").replace("FROM raw WHERE", "FROM graw WHERE") + """
, fe AS (SELECT chrom, s-1 AS s, e, 'exon' AS feature_type FROM ex UNION ALL SELECT chrom, gs-1, ge, 'intron' FROM intr UNION ALL SELECT chrom, s-1, e, 'CDS' FROM rec WHERE feature='CDS' UNION ALL SELECT chrom, s-1, e, label FROM utr),
ann AS (SELECT feature_type, clinical_labels FROM fe f JOIN cv5 v ON f.chrom=v.chrom AND f.s<v.end_ AND v.start<f.e)
""" + SUMMARY, "vcf", "gtf")),
    "cosmic_filter": Query(cosmic, sql(COSMIC_SQL + 'SELECT chrom, start, end_ AS "end", variant_id, clinical_labels, cosmic_id, disease_name, fathmm_mkl_score FROM co', "cosmic")),
    "annotate_cosmic": Query(cosmic_on_features, sql(COSMIC_SQL + ANN_COSMIC + "SELECT * FROM ann", "cosmic", "feat")),
    "summarize_cosmic": Query(q_cosmic_summary, sql(COSMIC_SQL + ANN_COSMIC + SUMMARY, "cosmic", "feat")),
    "gwas_filter": Query(gwas, sql(GWAS_SQL + 'SELECT chrom, start, end_ AS "end", variant_id, association_label, variant_id AS gwas_variant_id, trait_name, p_value, allele_id, efo_trait, efo_id, risk_allele_frequency, or_or_beta, ci_95_text FROM gk', "gwas")),
    "annotate_gwas": Query(gwas_on_features, sql(GWAS_SQL + ANN_GWAS + "SELECT * FROM ann", "gwas", "feat")),
    "summarize_gwas": Query(q_gwas_summary, sql(GWAS_SQL + ANN_GWAS + """
, ft AS (SELECT feature_type, coalesce(list_position(['CDS', '5UTR', '3UTR', 'exon', 'intron', 'gene', 'transcript'], feature_type), 8) AS r, count(*) AS n FROM ann GROUP BY 1)
SELECT feature_type, label, n AS count, CAST(r AS BIGINT) AS feature_rank, CAST(k AS BIGINT) AS label_rank FROM ft, (VALUES ('ALL', 0), ('Genome-wide significant', 1)) t(label, k)""", "gwas", "feat")),
    "smprot_filter": Query(proteins, sql(SMPROT_SQL + 'SELECT chrom, start, end_ AS "end", protein_id, evidence, source FROM sp', "smprot", "feat")),
    "smprot_filter_report": Query(q_smprot_report, sql(SMPROT_SQL + "SELECT 'kept_records' AS metric, (SELECT count(*) FROM sp) AS value UNION ALL SELECT 'skipped_records', (SELECT count(*) FROM smprot)-(SELECT count(*) FROM sp)", "smprot", "feat")),
    "place_proteins_uniquely": Query(q_place, sql(SMPROT_SQL + "SELECT * FROM pl", "smprot", "feat")),
    "placement_metrics": Query(q_place_metrics, sql(SMPROT_SQL + """SELECT 'retained_rows' AS metric, count(*) AS value FROM pl UNION ALL SELECT 'retained_small_proteins', count(DISTINCT protein_id) FROM pl
UNION ALL SELECT 'retained_lncRNA_genes', count(DISTINCT gene_id) FROM pl UNION ALL SELECT 'retained_lncRNA_transcripts', count(DISTINCT transcript_id) FROM pl""", "smprot", "feat")),
    "vcf_filter": Query(q_filter, sql(FILTER_SQL + "SELECT ord, value AS line FROM w WHERE outcome='kept'", "vcf")),
    "vcf_filter_report": Query(q_filter_report, sql(FILTER_SQL + "SELECT outcome, count(*) AS n FROM w GROUP BY 1", "vcf")),
    "vcf_region_table_filter": Query(q_region_table, sql("""
, raw AS (SELECT ord, string_split(value, chr(9)) AS c FROM vcf), v AS (SELECT ord, c[1] AS chrom, CAST(c[2] AS BIGINT) AS pos FROM raw)
SELECT ord, chrom, pos FROM v WHERE EXISTS (SELECT 1 FROM regions r WHERE r.chrom=v.chrom AND v.pos>r.start AND v.pos<=r.end_)""", "vcf", "regions")),
    "vcf_query_fields": Query(q_query, sql("""
, raw AS (SELECT string_split(value, chr(9)) AS c FROM vcf)
SELECT c[1] AS chrom, CAST(c[2] AS BIGINT) AS pos, c[3] AS id, c[4] AS ref, c[5] AS alt, regexp_extract(c[8], ';DP=([^;]*)', 1) AS "DP", CASE WHEN c[8] LIKE '%ALLELEID=%' THEN regexp_extract(c[8], 'ALLELEID=([^;]*)', 1) ELSE '.' END AS "ALLELEID",
 split_part(c[10], ':', 1) AS "s1_GT", split_part(c[10], ':', 2) AS "s1_AD", split_part(c[11], ':', 1) AS "s2_GT", split_part(c[11], ':', 2) AS "s2_AD" FROM raw""", "vcf")),
    "gvcf_extract_variants": Query(q_gvcf, sql("""
, raw AS (SELECT ord, string_split(value, chr(9)) AS c FROM vcf) SELECT ord, c[1] AS chrom, CAST(c[2] AS BIGINT) AS pos FROM raw WHERE c[5] NOT IN ('.', '<DEL>')""", "vcf")),
    "vcf_normalize_alleles": Query(q_normalize, sql(PICK, "vcf")),
    "vcf_contig_ranks": Query(q_sort, sql("""
, f AS (SELECT split_part(value, chr(9), 1) AS chrom, min(ord) AS o FROM vcf GROUP BY 1)
SELECT chrom, CASE WHEN chrom IN ('X', 'chr9') THEN 0 ELSE 1 END AS g, CASE chrom WHEN 'X' THEN 1 WHEN 'chr9' THEN 2 ELSE o END AS n FROM f""", "vcf").replace("THEN 0 ELSE 1 END AS g", "THEN CAST(0 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS g")),
    "vcf_sort": Query(q_sorted, sql("""
, f AS (SELECT split_part(value, chr(9), 1) AS chrom, CAST(split_part(value, chr(9), 2) AS BIGINT) AS pos, ord FROM vcf), m AS (SELECT chrom, min(ord) AS o FROM f GROUP BY 1)
SELECT f.chrom, pos, ord, row_number() OVER (ORDER BY CASE f.chrom WHEN 'X' THEN -2 WHEN 'chr9' THEN -1 ELSE o END, pos, ord) AS rank FROM f JOIN m ON m.chrom=f.chrom""", "vcf")),
    "vcf_statistics": Query(q_stats, sql(f"""
, raw AS (SELECT string_split(value, chr(9)) AS c FROM vcf), x AS (SELECT c[4] AS r, unnest(string_split(c[5], ',')) AS a FROM raw WHERE c[5]<>'.'), y AS (SELECT r, a, {AT} AS t, r||a IN ('AG', 'GA', 'CT', 'TC') AS ts FROM x),
n AS (SELECT count(*) FILTER (WHERE t='snv' AND ts) AS ts, count(*) FILTER (WHERE t='snv' AND NOT ts) AS tv FROM y)
SELECT 'records' AS metric, CAST(count(*) AS VARCHAR) AS value FROM raw UNION ALL SELECT 'records_pass', CAST(count(*) AS VARCHAR) FROM raw WHERE c[7]='PASS' UNION ALL SELECT 'records_no_alt', CAST(count(*) AS VARCHAR) FROM raw WHERE c[5]='.'
UNION ALL SELECT 'records_multiallelic', CAST(count(*) AS VARCHAR) FROM raw WHERE c[5] LIKE '%,%' UNION ALL SELECT 'alt_alleles', CAST(count(*) AS VARCHAR) FROM y
UNION ALL SELECT 'alleles_'||k, CAST((SELECT count(*) FROM y WHERE t=k) AS VARCHAR) FROM (VALUES ('snv'), ('mnv'), ('indel'), ('other')) v(k)
UNION ALL SELECT 'transitions', CAST(ts AS VARCHAR) FROM n UNION ALL SELECT 'transversions', CAST(tv AS VARCHAR) FROM n UNION ALL SELECT 'ts_tv_ratio', CASE WHEN tv=0 THEN 'NA' ELSE printf('%.3f', CAST(ts AS DOUBLE)/tv) END FROM n
UNION ALL SELECT 'contig.'||c[1], CAST(count(*) AS VARCHAR) FROM raw GROUP BY c[1]""", "vcf")),
    "vcf_allele_types": Query(q_types, sql(f"""
, raw AS (SELECT ord, string_split(value, chr(9)) AS c FROM vcf), x AS (SELECT ord, c[4] AS r, unnest(string_split(c[5], ',')) AS a FROM raw), y AS (SELECT ord, CASE WHEN a='.' THEN 'other' ELSE {AT} END AS t FROM x)
SELECT ord, string_agg(DISTINCT t, ',' ORDER BY t) AS types FROM y GROUP BY 1""", "vcf")),
    "vcf_header_fields": Query(q_meta, sql(r"""SELECT ord, regexp_extract(value, '^##([A-Za-z]+)=<', 1) AS kind, regexp_extract(value, '<ID=([^,>]*)', 1) AS id, nullif(regexp_extract(value, 'Number=([^,>]*)', 1), '') AS number, nullif(regexp_extract(value, 'Description="([^"]*)"', 1), '') AS description
FROM vcf_header WHERE value LIKE '##%=<%'""", "vcf_header")),
    "vcf_document_lines": Query(q_document, sql("""SELECT CAST(1 AS BIGINT) AS section, ord, value FROM vcf
UNION ALL SELECT 0, ord, value FROM vcf_meta WHERE value LIKE '##%'
UNION ALL SELECT 0, 4611686018427387904, concat_ws(chr(9), '#CHROM', 'POS', 'ID', 'REF', 'ALT', 'QUAL', 'FILTER', 'INFO', 'FORMAT', 's1', 's2')""", "vcf", "vcf_meta")),
    "vcf_genotype_table": Query(q_genotypes, sql("""
, raw AS (SELECT string_split(value, chr(9)) AS c FROM vcf), g AS (SELECT c, s, string_split(replace(split_part(c[9+s], ':', 1), '|', '/'), '/') AS gt, list_concat([c[4]], CASE WHEN c[5]='.' THEN [] ELSE string_split(c[5], ',') END) AS b FROM raw, (VALUES (1), (2)) t(s))
SELECT c[1] AS chrom, CAST(c[2] AS BIGINT) AS pos, c[3] AS id, 's'||CAST(s AS VARCHAR) AS sample, coalesce(b[TRY_CAST(gt[1] AS INT)+1], '0') AS a1, coalesce(b[TRY_CAST(gt[2] AS INT)+1], '0') AS a2 FROM g""", "vcf")),
    "background_frequency_check": Query(q_background, sql("""
, raw AS (SELECT string_split(value, chr(9)) AS c FROM vcf), k AS (SELECT DISTINCT c[1] AS chrom, CAST(c[2] AS BIGINT) AS pos, c[4] AS ref, unnest(string_split(c[5], ',')) AS alt FROM raw),
j AS (SELECT least(CAST(floor(af*10) AS BIGINT), 9) AS af_bin, k.chrom IS NOT NULL AS hit FROM background b LEFT JOIN k ON k.chrom=b.chrom AND k.pos=b.pos AND k.ref=b.ref AND k.alt=b.alt)
SELECT af_bin, count(*) AS n_expected, count(*) FILTER (WHERE hit) AS n_found, round(count(*) FILTER (WHERE hit)/CAST(count(*) AS DOUBLE), 9) AS found_share FROM j GROUP BY 1""", "vcf", "background")),
    "export_sql_clinvar": Query(q_sql_export, sql(CLINVAR_SQL + CV5 + f"""
SELECT CAST(1 AS BIGINT) AS section, '{_CV_HEAD}'||{_esc('chrom')}||', '||{_SE}||', '||{_esc('feature_type', 'feature_id', 'gene_id', 'transcript_id', 'gene_type', 'transcript_type', 'strand', 'variant_id', 'variant_name', 'dbsnp_id', 'clinical_labels', 'allele_id', 'disease_name')}||');' AS value FROM ann
UNION ALL SELECT 0, 'BEGIN TRANSACTION;' UNION ALL SELECT 0, '{_CV_TABLE}' UNION ALL SELECT 2, 'COMMIT;'""", "vcf", "feat")),
    "export_sql_gwas": Query(q_sql_export_gwas, sql(GWAS_SQL + ANN_GWAS + f"""
SELECT '{_GW_HEAD}'||{_esc('chrom')}||', '||{_SE}||', '||{_esc('feature_type', 'feature_id', 'gene_id', 'transcript_id', 'gene_type', 'transcript_type', 'strand', 'variant_id', 'association_label', 'gwas_variant_id', 'allele_id', 'trait_name', 'efo_trait', 'efo_id')}||', '||CAST(p_value AS VARCHAR)||', '||{_esc('risk_allele_frequency', 'or_or_beta', 'ci_95_text')}||');' AS value FROM ann""", "gwas", "feat")),
    "export_sql_cosmic": Query(q_sql_export_cosmic, sql(COSMIC_SQL + ANN_COSMIC + f"""
SELECT '{_CO_HEAD}'||{_esc('chrom')}||', '||{_SE}||', '||{_esc('feature_type', 'feature_id', 'gene_id', 'transcript_id', 'gene_type', 'transcript_type', 'strand', 'variant_id', 'clinical_labels', 'cosmic_id', 'disease_name')}||', '||CAST(fathmm_mkl_score AS VARCHAR)||');' AS value FROM ann""", "cosmic", "feat")),
    "export_sql_smprot": Query(q_sql_export_smprot, sql(SMPROT_SQL + f"""
SELECT '{_SP_HEAD}'||{_esc('chrom')}||', '||{_SE}||', '||{_esc('protein_id', 'evidence', 'source', 'transcript_id', 'gene_id', 'gene_type', 'transcript_type', 'strand')}||', '||CAST(transcript_start AS VARCHAR)||', '||CAST(transcript_end AS VARCHAR)||', '||{_esc('mapping_type')}||');' AS value FROM pl""", "smprot", "feat")),
    "export_track_clinvar": Query(q_track, sql(CLINVAR_SQL + CV5 + f"""
SELECT CAST(1 AS BIGINT) AS section, concat_ws(chr(9), chrom, CAST(start-1 AS VARCHAR), CAST("end" AS VARCHAR), feature_type||'|'||variant_id||'|'||clinical_labels, '0', strand, CAST(start-1 AS VARCHAR), CAST("end" AS VARCHAR), {_RGB}) AS value FROM ann
UNION ALL SELECT 0, 'track name="ClinVar_GTF_Site_Annotation" description="ClinVar labels on GTF gene/transcript/exon/intron" visibility=2 itemRgb="On"'""", "vcf", "feat")),
    "export_track_cosmic": Query(q_track_cosmic, sql(COSMIC_SQL + ANN_COSMIC + """SELECT chrom, start-1 AS start, "end", feature_type||'|'||cosmic_id||'|'||disease_name AS name, CAST(0 AS BIGINT) AS score, strand, start-1 AS thick_start, "end" AS thick_end, '255,0,0' AS rgb FROM ann""", "cosmic", "feat")),
    "track_header_line": Query(q_track_line, sql("""SELECT CAST(1 AS BIGINT) AS section, ord, value FROM bed WHERE value<>'' UNION ALL SELECT 0, NULL, 'track name="mine" description="my intervals" color=0,0,178 visibility=dense priority=3'""", "bed")),
    "vcf_split_by_sample": Query(q_split_samples, sql("""
, raw AS (SELECT ord, string_split(value, chr(9)) AS c FROM vcf) SELECT 's'||CAST(s AS VARCHAR) AS sample, ord, array_to_string(list_concat(c[1:9], [c[9+s]]), chr(9)) AS line FROM raw, (VALUES (1), (2)) t(s)""", "vcf")),
    "vcf_split_counts": Query(q_split_counts, sql("SELECT split_part(value, chr(9), 1) AS part, count(*) AS n FROM vcf GROUP BY 1", "vcf")),
}
