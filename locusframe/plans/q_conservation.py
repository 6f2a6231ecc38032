"""Queries of the conservation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.operators import conservation as C
from locusframe.operators.intervals import union_length
from locusframe.plans.registry import Query, longs
from locusframe.plans.views import VIEWS, sql, view
from locusframe.session import materialize
from locusframe.functions.sequence import identity_count
from locusframe.sources.tables import parse_block_table

_KEY = "CASE WHEN k%2=0 THEN 'mouse' ELSE 'rat' END AS species, 'lnc' AS mode"
VIEWS["seg"] = f"""
SELECT {_KEY}, 'tx'||CAST(k AS STRING)||'_'||CAST(n AS STRING) AS segment_id, k, n, pk, sk,
       repeat(CASE CAST(pk%3 AS INT) WHEN 0 THEN 'ACGTA' WHEN 1 THEN 'ggcaT' ELSE 'TTTAC' END, CAST(2+pk%4 AS INT)) AS q, repeat(CASE CAST(sk%3 AS INT) WHEN 0 THEN 'ACGTT' WHEN 1 THEN 'GGCAT' ELSE 'TTNAC' END, CAST(2+pk%4 AS INT)) AS t FROM {{li}}"""
VIEWS["seg_blocks"] = """
SELECT species, mode, segment_id AS ids, 'chr1' AS chrom, k%7*10+n*CASE WHEN k%3=0 THEN 8 ELSE 60 END+CASE WHEN pk%5=0 THEN 300000 ELSE 0 END AS start, k%7*10+n*CASE WHEN k%3=0 THEN 8 ELSE 60 END+CASE WHEN pk%5=0 THEN 300000 ELSE 0 END+40 AS end_,
       CASE WHEN sk%4=0 THEN '-' ELSE '+' END AS strand, CASE WHEN pk%2=0 THEN '10,15,' ELSE '40' END AS sizes_text, CASE WHEN pk%2=0 THEN '0,25,' ELSE '0,' END AS starts_text FROM {seg}"""
VIEWS["tx_blocks"] = f"""SELECT {_KEY}, 'tx'||CAST(k AS STRING) AS ids, 'chr1' AS chrom, CAST(0 AS BIGINT) AS start, CAST(600 AS BIGINT) AS end_, '+' AS strand, '40,50,60,70,' AS sizes_text, '0,100,200,400,' AS starts_text FROM (SELECT DISTINCT k FROM {{li}} WHERE k%11<>3) x"""
VIEWS["target_info"] = "SELECT o_orderkey AS ord, 'tx'||CAST(o_orderkey%9000 AS STRING) AS ids, 'target'||CAST(o_custkey AS STRING) AS target_transcript_id, 'ratio'||CAST(o_custkey AS STRING) AS match_ratio FROM {orders}"
VIEWS["cds_table"] = f"""SELECT {_KEY}, 'tx'||CAST(k AS STRING)||CASE WHEN k%2=0 THEN '' ELSE '_1' END AS ids, CAST(1+k%4 AS BIGINT) AS cds_start, CAST(2+k%9 AS BIGINT) AS cds_end FROM (SELECT DISTINCT k FROM {{li}}) x"""
VIEWS["cons_rows"] = """
SELECT 'sp'||CAST(sk%6 AS STRING) AS species, 'tx'||CAST(k AS STRING) AS ids, 'tx'||CAST(k AS STRING)||'_'||CAST(n AS STRING) AS grouped_id, CASE WHEN k%5=0 THEN '' ELSE 'g'||CAST(k%3000 AS STRING) END AS geneID,
       CASE WHEN k%4=0 THEN '' ELSE 'tg'||CAST(pk%50 AS STRING) END AS target_gene_id, 'tt'||CAST(pk AS STRING) AS target_transcript_id, 20+pk%90 AS true_mapped_length, 20+pk%95 AS mapped_length, CAST(qty AS DOUBLE)/CAST(64 AS DOUBLE) AS match_ratio,
       200+pk%100 AS transcript_length, CASE WHEN pk%3=0 THEN CAST(0 AS DOUBLE) ELSE CAST(pk%64 AS DOUBLE)/CAST(64 AS DOUBLE) END AS transcript_coverage, CASE WHEN sk%3=0 THEN '' WHEN sk%3=1 THEN '-0.5' ELSE '0.5' END AS intron_coverage, CAST(sk%8 AS DOUBLE)/CAST(8 AS DOUBLE) AS exon_covered_ratio FROM {li}"""
VIEWS["sp_order"] = "SELECT CAST(n_nationkey AS BIGINT) AS ord, 'sp'||CAST(n_nationkey%5 AS STRING) AS species, CASE WHEN n_nationkey%4=0 THEN 'old' ELSE CAST((n_nationkey*7)%5 AS STRING) END AS rank, CASE WHEN n_nationkey%3=0 THEN '' ELSE 'clade'||CAST(n_nationkey%5 AS STRING) END AS clade FROM {nation}"
VIEWS["anchor"] = "SELECT 'g'||CAST(o_orderkey%3000 AS STRING) AS human_gene, 'sp'||CAST(o_custkey%6 AS STRING) AS species, 'tg'||CAST(o_custkey%50 AS STRING) AS target_gene FROM {orders}"
VIEWS["block_lines"] = """
SELECT CASE WHEN n%2=0 THEN 'b.txt' ELSE 'a.txt' END AS path, k*8+n AS ord, 'chr1'||chr(9)||CAST(k AS STRING)||'.7'||chr(9)||CASE WHEN n=3 THEN 'x' ELSE CAST(k+100 AS STRING) END||chr(9)||'id'||CAST(k%5000 AS STRING)||CASE WHEN n<3 THEN chr(9)||'+'||chr(9)||'2'||chr(9)||'10,x,5,'||chr(9)||'0,20' ELSE '' END AS value FROM {li}"""


def q_and_t(s, d):
    g = view(s, d, "seg")
    return g.select(*C.RUN, "segment_id", F.col("q").alias("seq")), g.select(*C.RUN, "segment_id", F.col("t").alias("seq"))


def blocks(s, d, name):
    from locusframe.functions.values import int_list

    b = view(s, d, name)
    return b.withColumns({"sizes": int_list(F.col("sizes_text")), "starts": int_list(F.col("starts_text"))})


def scores(s, d):
    return C.segment_scores(*q_and_t(s, d))


def q_scores(s, d):
    return scores(s, d)


def q_problems(s, d):
    q, t = q_and_t(s, d)
    broken = t.where("segment_id not like '%9_2'").withColumn("seq", F.when(F.col("segment_id").endswith("7_1"), F.concat("seq", F.lit("A"))).otherwise(F.col("seq")))
    return longs(C.pair_problems(q, broken))


def q_identity(s, d):
    g = view(s, d, "seg")
    return g.select("segment_id", identity_count(F.col("q"), F.concat(F.col("t"), F.lit("AC"))).alias("same"))


def q_block_table(s, d):
    b = parse_block_table(view(s, d, "block_lines"))
    return b.select("ids", "chrom", "start", "end", "strand", F.array_join("sizes", ",").alias("sizes"), F.array_join("starts", ",").alias("starts"))


def q_block_union(s, d):
    b = blocks(s, d, "seg_blocks")
    iv = C.block_intervals(F.col("start"), F.col("end"), F.col("sizes"), F.col("starts"))
    rows = b.select(C.base_id(F.col("ids")).alias("base_id"), F.explode(iv).alias("b")).select("base_id", "b.start", "b.end")
    return union_length(rows, ["base_id"])


def drops(s, d):
    return scored_and_dropped(s, d)[1]


def scored_and_dropped(s, d):
    """Scores, written as several steps read them, and the segments dropped among them."""
    sc = materialize(scores(s, d))
    return sc, C.duplicate_segments(sc, blocks(s, d, "seg_blocks"))


def groups_of(s, d, sc, gone):
    return C.nearby_groups(sc.join(gone, [*C.RUN, "segment_id"], "left_anti"), blocks(s, d, "seg_blocks"))


def grouped(s, d):
    return groups_of(s, d, *scored_and_dropped(s, d))


def q_fraction(s, d):
    """Block overlap of touching segments of a base id, as a share of the smaller union."""
    out = C.overlapping_pairs(scores(s, d), blocks(s, d, "seg_blocks"))
    return out.select(*C.RUN, F.col("segment_id").alias("seg_a"), F.col("segment_id_b").alias("seg_b"), F.round("fraction", 9).alias("fraction"))


def q_drops(s, d):
    return drops(s, d)


def q_groups(s, d):
    return grouped(s, d).select(*C.RUN, "segment_id", "grouped_id", "modified_group")


def one_group(s, d):
    """A plain grouping for the aggregate's check: one group per base id."""
    return _one_group(scores(s, d))


def _one_group(sc):
    return sc.select(*C.RUN, "segment_id", F.col("base_id").alias("grouped_id"), F.lit(False).alias("modified_group"))


def q_aggregate(s, d):
    sc = materialize(scores(s, d))
    out = C.aggregate_groups(sc, _one_group(sc), blocks(s, d, "seg_blocks"), blocks(s, d, "tx_blocks"))
    return longs(out.select(*C.RUN, "grouped_id", "ids", "segment_id", "mapped_length", "matched_length", "true_mapped_length", "exon_counts", "exon_covered", "exon_covered_num",
                            F.round("match_ratio", 9).alias("match_ratio"), F.round("exon_covered_ratio", 9).alias("exon_covered_ratio")))


def q_statistics(s, d):
    """Whole chain: duplicates, groups, statistics (rows only: the passes depend on the order of ids)."""
    sc, gone = scored_and_dropped(s, d)
    return C.aggregate_groups(sc, groups_of(s, d, sc, gone), blocks(s, d, "seg_blocks"), blocks(s, d, "tx_blocks"))


def q_qc(s, d):
    sc, gone = scored_and_dropped(s, d)
    return C.qc(sc, gone, groups_of(s, d, sc, gone))


def q_enrich(s, d):
    rows = scores(s, d).select(*C.RUN, "segment_id", F.col("base_id").alias("ids"), F.lit("own").alias("match_ratio"))
    return C.enrich(rows, view(s, d, "target_info"), "ids")


def q_cds(s, d):
    q, t = q_and_t(s, d)
    rows = scores(s, d).select(*C.RUN, "segment_id", F.col("base_id").alias("ids"))
    out = C.cds_metrics(rows, q, t, view(s, d, "cds_table"))
    return out.withColumn("cds_match_ratio", F.round("cds_match_ratio", 9))


def classified(s, d):
    return C.classify(view(s, d, "cons_rows").withColumn("transcript_coverage", F.col("transcript_coverage").cast("string")))


def q_classify(s, d):
    c = classified(s, d)
    return c.select("species", "ids", "grouped_id", F.round("transcript_coverage", 9).alias("transcript_coverage"), "pass_length_filter", "pass_transcript_coverage_filter", "pass_intron_coverage_filter", "is_conserved")


def evidence(s, d):
    return C.homology_evidence(classified(s, d))


def best(s, d):
    return C.best_homologs(evidence(s, d))


def q_evidence(s, d):
    return evidence(s, d).withColumn("transcript_coverage", F.round("transcript_coverage", 9))


def q_best(s, d):
    return best(s, d).withColumn("transcript_coverage", F.round("transcript_coverage", 9))


def q_synteny(s, d):
    return C.synteny(best(s, d), view(s, d, "anchor")).select("human_gene_id", "target_species", "target_gene_id", "syntenic_support")


def q_order(s, d):
    return C.parse_species_order(view(s, d, "sp_order"))


def q_age(s, d):
    return C.gene_age(best(s, d), C.parse_species_order(view(s, d, "sp_order")))


EVIDENCE = """
, cl AS (SELECT *, CASE WHEN transcript_coverage=0 THEN true_mapped_length/CAST(transcript_length AS DOUBLE) ELSE transcript_coverage END AS tc FROM cons_rows),
cf AS (SELECT *, true_mapped_length>=50 AS p1, tc>=CAST(0.2 AS DOUBLE) AS p2, intron_coverage<>'-0.5' AS p3 FROM cl),
ev AS (SELECT CASE WHEN geneID='' THEN ids ELSE geneID END AS human_gene_id, ids AS human_transcript_id, species AS target_species, CASE WHEN target_gene_id='' THEN target_transcript_id ELSE target_gene_id END AS target_gene_id, target_transcript_id, true_mapped_length, match_ratio, tc AS transcript_coverage, exon_covered_ratio, grouped_id AS evidence_group FROM cf WHERE p1 AND p2 AND p3),
bh AS (SELECT *, row_number() OVER (PARTITION BY human_gene_id, target_species, target_gene_id ORDER BY true_mapped_length DESC, match_ratio DESC, transcript_coverage DESC, exon_covered_ratio DESC, evidence_group) AS r,
  count(*) OVER (PARTITION BY human_gene_id, target_species, target_gene_id) AS supporting_segment_count FROM ev),
tx AS (SELECT human_gene_id, target_species, target_gene_id, count(DISTINCT human_transcript_id) AS supporting_transcript_count FROM ev GROUP BY 1,2,3),
be AS (SELECT bh.* EXCLUDE (r), supporting_transcript_count FROM bh JOIN tx USING (human_gene_id, target_species, target_gene_id) WHERE r=1)
"""
ORDER_SQL = """
, so AS (SELECT ord, species, coalesce(TRY_CAST(rank AS BIGINT), row_number() OVER (ORDER BY ord)-1) AS rank, CASE WHEN clade='' THEN species ELSE clade END AS clade FROM sp_order)
"""
SAME = "(SELECT count(*) FROM unnest(range(1, CAST(least(length(a), length(b)) AS BIGINT)+1)) AS u(i) WHERE upper(substr(a, i, 1))=upper(substr(b, i, 1)))"
IDENTITY = "list_sum([CASE WHEN upper(substr({a}, i, 1))=upper(substr({b}, i, 1)) THEN 1 ELSE 0 END for i in range(1, least(length({a}), length({b}))+1)])"

# segments in the order of their ids within a base id, their blocks, and block overlaps of touching pairs
SEGMENTS = """
, sc0 AS (SELECT seg.species, seg.mode, segment_id, 'tx'||CAST(k AS VARCHAR) AS base_id, {same} AS mt FROM seg),
s AS (SELECT sc0.*, b.start AS s, b.end_ AS e, strand, CASE WHEN sizes_text='40' THEN 40 ELSE 25 END AS covered, sizes_text AS z,
  row_number() OVER (PARTITION BY sc0.species, sc0.mode, base_id ORDER BY segment_id) AS r FROM sc0 JOIN seg_blocks b ON b.species=sc0.species AND b.mode=sc0.mode AND b.ids=segment_id),
bl AS (SELECT species, mode, base_id, r, s AS bs, CASE WHEN z='40' THEN s+40 ELSE s+10 END AS be FROM s UNION ALL SELECT species, mode, base_id, r, s+25, s+40 FROM s WHERE z<>'40'),
ov AS (SELECT x.species, x.mode, x.base_id, x.r AS i, y.r AS j, sum(greatest(0, least(x.be, y.be)-greatest(x.bs, y.bs))) AS o
  FROM bl x JOIN bl y ON y.species=x.species AND y.mode=x.mode AND y.base_id=x.base_id AND x.r<y.r GROUP BY ALL),
pr AS (SELECT a.species, a.mode, a.base_id, i, j, a.segment_id AS seg_a, b.segment_id AS seg_b, CAST(o AS DOUBLE)/least(a.covered, b.covered) AS f, a.mt>=b.mt AS w FROM ov
  JOIN s a ON a.species=ov.species AND a.mode=ov.mode AND a.base_id=ov.base_id AND a.r=i JOIN s b ON b.species=ov.species AND b.mode=ov.mode AND b.base_id=ov.base_id AND b.r=j WHERE b.s<=a.e AND b.e>=a.s)
""".replace("{same}", IDENTITY.format(a="q", b="t"))
DROPS = SEGMENTS + """
, ed AS (SELECT species, mode, base_id, list({'i': i, 'j': j, 'w': w} ORDER BY i, j) AS l FROM pr WHERE f>=0.5 GROUP BY 1,2,3),
st AS (SELECT species, mode, base_id, 0 AS n, CAST([] AS BIGINT[]) AS gone FROM ed UNION ALL
  SELECT species, mode, base_id, n+1, CASE WHEN list_contains(gone, l[n+1].i) OR list_contains(gone, l[n+1].j) THEN gone ELSE list_append(gone, CASE WHEN l[n+1].w THEN l[n+1].j ELSE l[n+1].i END) END
  FROM st JOIN ed USING (species, mode, base_id) WHERE n<len(l)),
dr AS (SELECT s.species, s.mode, s.segment_id FROM st JOIN ed USING (species, mode, base_id) JOIN s USING (species, mode, base_id) WHERE n=len(l) AND list_contains(gone, s.r))
"""
GROUPS = DROPS + """
, kp AS (SELECT species, mode, base_id, segment_id, s, e, strand, row_number() OVER (PARTITION BY species, mode, base_id ORDER BY segment_id) AS r FROM s ANTI JOIN dr USING (species, mode, segment_id)),
ne AS (SELECT a.species, a.mode, a.base_id, list({'i': a.r, 'j': b.r} ORDER BY a.r, b.r) AS l FROM kp a JOIN kp b ON b.species=a.species AND b.mode=a.mode AND b.base_id=a.base_id AND a.r<b.r AND a.strand=b.strand
  AND b.s-a.e<=100000 AND a.s-b.e<=100000 GROUP BY 1,2,3),
lb AS (SELECT species, mode, base_id, 0 AS n, range(1, count(*)+1) AS v FROM kp GROUP BY 1,2,3 UNION ALL
  SELECT species, mode, base_id, n+1, list_transform(v, lambda x, k: CASE WHEN k=l[n+1].i OR k=l[n+1].j THEN least(v[l[n+1].i], v[l[n+1].j]) ELSE x END) FROM lb JOIN ne USING (species, mode, base_id) WHERE n<len(l)),
la AS (SELECT kp.*, v[r] AS label, len(v) AS members FROM lb LEFT JOIN ne USING (species, mode, base_id) JOIN kp USING (species, mode, base_id) WHERE n=coalesce(len(l), 0)),
gp AS (SELECT species, mode, segment_id, members>1 AS modified_group, CASE WHEN members>1 THEN base_id||'_'||CAST(dense_rank() OVER (PARTITION BY species, mode, base_id ORDER BY label) AS VARCHAR) ELSE base_id END AS grouped_id FROM la)
"""


def recursive(text: str, *names: str) -> str:
    return sql(text, *names).replace("WITH ", "WITH RECURSIVE ", 1)


QUERIES = {
    "segment_overlap_fraction": Query(q_fraction, sql(SEGMENTS + "SELECT species, mode, seg_a, seg_b, round(f, 9) AS fraction FROM pr", "seg", "seg_blocks")),
    "segment_scores": Query(q_scores, sql(f"SELECT species, mode, segment_id, 'tx'||CAST(k AS VARCHAR) AS base_id, CAST(length(q) AS BIGINT) AS mapped_length, CAST({IDENTITY.format(a='q', b='t')} AS BIGINT) AS matched_length FROM seg", "seg")),
    "segment_pair_problems": Query(q_problems, sql("""
, b AS (SELECT segment_id, CAST(length(t)+CASE WHEN segment_id LIKE '%7\\_1' ESCAPE '\\' THEN 1 ELSE 0 END AS BIGINT) AS n FROM seg WHERE segment_id NOT LIKE '%9_2')
SELECT species, mode, s.segment_id, CAST(length(q) AS BIGINT) AS q_length, b.n AS t_length FROM seg s LEFT JOIN b ON b.segment_id=s.segment_id WHERE b.n IS NULL OR b.n<>length(q)""", "seg")),
    "identity_count": Query(q_identity, sql(f"SELECT segment_id, CAST({IDENTITY.format(a='q', b='concat(t, chr(65), chr(67))')} AS BIGINT) AS same FROM seg", "seg")),
    "scan_block_table": Query(q_block_table, sql("""
, r AS (SELECT path, ord, string_split(value, chr(9)) AS c FROM block_lines), w AS (SELECT c, row_number() OVER (PARTITION BY c[4] ORDER BY path DESC, ord DESC) AS k FROM r)
SELECT c[4] AS ids, 'chr1' AS chrom, CAST(split_part(c[2], '.', 1) AS BIGINT) AS start, coalesce(TRY_CAST(c[3] AS BIGINT), 0) AS "end", CASE WHEN len(c)>4 THEN '+' ELSE '.' END AS strand, CASE WHEN len(c)>4 THEN '10,0,5' ELSE '' END AS sizes, CASE WHEN len(c)>4 THEN '0,20' ELSE '' END AS starts FROM w WHERE k=1""", "block_lines")),
    "block_union_length": Query(q_block_union, sql("""
, b AS (SELECT regexp_replace(ids, '_[^_]*$', '') AS base_id, start, sizes_text AS z FROM seg_blocks), x AS (SELECT base_id, start AS s, start+CASE WHEN z='40' THEN 40 ELSE 10 END AS e FROM b UNION ALL SELECT base_id, start+25, start+40 FROM b WHERE z<>'40'),
p AS (SELECT DISTINCT base_id, unnest(range(s, e)) AS i FROM x) SELECT base_id, count(*) AS union_length FROM p GROUP BY 1""", "seg_blocks")),
    "duplicate_segments": Query(q_drops, recursive(DROPS + "SELECT species, mode, segment_id FROM dr", "seg", "seg_blocks")),
    "nearby_groups": Query(q_groups, recursive(GROUPS + "SELECT species, mode, segment_id, grouped_id, modified_group FROM gp", "seg", "seg_blocks")),
    "group_statistics": Query(q_aggregate, sql(f"""
, sc AS (SELECT species, mode, segment_id, 'tx'||CAST(k AS VARCHAR) AS base, length(q) AS ml, {IDENTITY.format(a='q', b='t')} AS mt FROM seg),
a AS (SELECT species, mode, base, CAST(sum(ml) AS BIGINT) AS mapped_length, CAST(sum(mt) AS BIGINT) AS matched_length FROM sc GROUP BY 1,2,3), rp AS (SELECT base, segment_id, row_number() OVER (PARTITION BY base ORDER BY mt DESC, segment_id) AS r FROM sc),
b AS (SELECT regexp_replace(ids, '_[^_]*$', '') AS base, start, sizes_text AS z FROM seg_blocks), x AS (SELECT base, start AS s, start+CASE WHEN z='40' THEN 40 ELSE 10 END AS e FROM b UNION ALL SELECT base, start+25, start+40 FROM b WHERE z<>'40'),
p AS (SELECT DISTINCT base, unnest(range(s, e)) AS i FROM x), un AS (SELECT base, count(*) AS n FROM p GROUP BY 1),
ex AS (SELECT ids AS base, i, s, e FROM tx_blocks, (VALUES (1, 0, 40), (2, 100, 150), (3, 200, 260), (4, 400, 470)) t(i, s, e)), cv AS (SELECT DISTINCT x.base, i FROM x JOIN ex ON ex.base=x.base AND x.s<ex.e AND ex.s<x.e),
cx AS (SELECT base, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS l, count(*) AS n FROM cv GROUP BY 1)
SELECT a.species, a.mode, a.base AS grouped_id, a.base AS ids, rp.segment_id, mapped_length, matched_length, un.n AS true_mapped_length, CAST(CASE WHEN tb.ids IS NULL THEN 0 ELSE 4 END AS BIGINT) AS exon_counts, coalesce(cx.l, '') AS exon_covered, coalesce(cx.n, 0) AS exon_covered_num,
 round(matched_length/CAST(mapped_length AS DOUBLE), 9) AS match_ratio, CASE WHEN tb.ids IS NOT NULL THEN round(coalesce(cx.n, 0)/CAST(4 AS DOUBLE), 9) END AS exon_covered_ratio
FROM a JOIN rp ON rp.base=a.base AND r=1 JOIN un ON un.base=a.base LEFT JOIN tx_blocks tb ON tb.ids=a.base LEFT JOIN cx ON cx.base=a.base""", "seg", "seg_blocks", "tx_blocks")),
    "conservation_statistics": Query(q_statistics),
    "conservation_qc": Query(q_qc),
    "enrich_by_key": Query(q_enrich, sql("""
, ti AS (SELECT ids, max_by(target_transcript_id, ord) AS tt, max_by(match_ratio, ord) AS mr FROM target_info GROUP BY 1)
SELECT species, mode, segment_id, 'tx'||CAST(k AS VARCHAR) AS ids, 'own' AS match_ratio, tt AS target_transcript_id, mr AS context_match_ratio FROM seg LEFT JOIN ti ON ti.ids='tx'||CAST(k AS VARCHAR)""", "seg", "target_info")),
    "cds_window_identity": Query(q_cds, sql(f"""
, j AS (SELECT species, mode, segment_id, 'tx'||CAST(k AS VARCHAR) AS ids, q, t, CASE WHEN k%2=0 OR n=1 THEN 1+k%4 END AS a, CASE WHEN k%2=0 OR n=1 THEN 2+k%9 END AS b FROM seg),
w AS (SELECT *, CASE WHEN b>a-1 THEN substr(q, CAST(a AS BIGINT), CAST(b-a+1 AS BIGINT)) END AS qs, CASE WHEN b>a-1 THEN substr(t, CAST(a AS BIGINT), CAST(b-a+1 AS BIGINT)) END AS ts FROM j),
v AS (SELECT *, CAST({IDENTITY.format(a='qs', b='ts')} AS BIGINT) AS same FROM w)
SELECT species, mode, segment_id, ids, CAST(length(qs) AS BIGINT) AS cds_mapped_length, CASE WHEN qs IS NOT NULL THEN same END AS cds_matched_length, round(same/CAST(length(qs) AS DOUBLE), 9) AS cds_match_ratio FROM v""", "seg")),
    "classify_conservation": Query(q_classify, sql(EVIDENCE + "SELECT species, ids, grouped_id, round(tc, 9) AS transcript_coverage, p1 AS pass_length_filter, p2 AS pass_transcript_coverage_filter, p3 AS pass_intron_coverage_filter, p1 AND p2 AND p3 AS is_conserved FROM cf", "cons_rows")),
    "homology_evidence": Query(q_evidence, sql(EVIDENCE + "SELECT * REPLACE (round(transcript_coverage, 9) AS transcript_coverage) FROM ev", "cons_rows")),
    "best_homologs": Query(q_best, sql(EVIDENCE + "SELECT * REPLACE (round(transcript_coverage, 9) AS transcript_coverage) FROM be", "cons_rows")),
    "synteny_support": Query(q_synteny, sql(EVIDENCE + "SELECT human_gene_id, target_species, target_gene_id, CASE WHEN (human_gene_id, target_species, target_gene_id) IN (SELECT (human_gene, species, target_gene) FROM anchor) THEN '1' ELSE '0' END AS syntenic_support FROM be", "cons_rows", "anchor")),
    "species_order": Query(q_order, sql(ORDER_SQL + "SELECT * FROM so", "sp_order")),
    "gene_age": Query(q_age, sql(EVIDENCE + ORDER_SQL + """
, o AS (SELECT species, max_by(rank, ord) AS rank, max_by(clade, ord) AS clade FROM so GROUP BY 1), g AS (SELECT be.*, coalesce(o.rank, 1000000000) AS rank, coalesce(clade, target_species) AS clade FROM be LEFT JOIN o ON o.species=target_species),
f AS (SELECT human_gene_id, target_species AS sp, target_gene_id AS tg, clade, row_number() OVER (PARTITION BY human_gene_id ORDER BY rank, target_species, target_gene_id) AS r FROM g),
s AS (SELECT g.* EXCLUDE (clade), f.sp, f.clade FROM g JOIN f ON f.human_gene_id=g.human_gene_id AND r=1 WHERE (target_species, target_gene_id)>=(f.sp, f.tg))
SELECT human_gene_id, min(sp) AS oldest_detected_species, min(clade) AS oldest_detected_clade, count(DISTINCT target_species) AS species_count, string_agg(DISTINCT target_gene_id, ',' ORDER BY target_gene_id) AS supporting_target_genes,
 string_agg(DISTINCT human_transcript_id, ',' ORDER BY human_transcript_id) AS supporting_transcripts FROM s GROUP BY 1""", "cons_rows", "sp_order")),
}
