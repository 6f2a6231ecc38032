"""Queries of alignments, chains and liftover."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.operators import align as A
from locusframe.functions.sequence import cigar_query_length, cigar_reference_length
from locusframe.operators.ordered import with_rank
from locusframe.plans.registry import Query, longs
from locusframe.plans.views import VIEWS, sql, view
from locusframe.sources import alignments as S
from locusframe.sources.sequences import genome_chunks
from locusframe.sources.vcf import parse_vcf

# one chain of two blocks per order: header, block with gaps, last block
VIEWS["chain"] = """
SELECT 'c.chain' AS path, o_orderkey*4 AS ord, 'chain '||CAST(o_custkey AS STRING)||' chr'||CAST(o_custkey%5+1 AS STRING)||' 900000000 + '||CAST(o_orderkey*37 AS STRING)||' '||CAST(o_orderkey*37+100+o_orderkey%5+60 AS STRING)||
  ' new'||CAST(o_custkey%3 AS STRING)||' 800000000 '||CASE WHEN o_orderkey%3=0 THEN '-' ELSE '+' END||' '||CAST(o_orderkey*11 AS STRING)||' '||CAST(o_orderkey*11+100+o_orderkey%4+60 AS STRING)||' '||CAST(o_orderkey+1 AS STRING) AS value FROM {orders}
UNION ALL SELECT 'c.chain', o_orderkey*4+1, '100'||chr(9)||CAST(o_orderkey%5 AS STRING)||chr(9)||CAST(o_orderkey%4 AS STRING) FROM {orders}
UNION ALL SELECT 'c.chain', o_orderkey*4+2, '60' FROM {orders}
UNION ALL SELECT 'c.chain', o_orderkey*4+3, '' FROM {orders}"""
VIEWS["lift_in"] = """
SELECT 'chr'||CAST(l_suppkey%5+1 AS STRING) AS chrom, l_orderkey*37+l_linenumber*20 AS start, l_orderkey*37+l_linenumber*20+5+l_partkey%40 AS end_, CASE WHEN l_partkey%2=0 THEN '+' ELSE '-' END AS strand, 'set'||CAST(l_suppkey%3 AS STRING) AS dataset FROM {lineitem}"""
VIEWS["psl"] = """
SELECT 'a.psl' AS path, k*8+n AS ord, CAST(90+pk%9-sk%4 AS STRING)||chr(9)||CAST(sk%4 AS STRING)||chr(9)||'0'||chr(9)||'1'||chr(9)||CASE WHEN pk%2=0 THEN '1' ELSE '0' END||chr(9)||CASE WHEN pk%2=0 THEN '7' ELSE '0' END||chr(9)||'1'||chr(9)||'20'||chr(9)||
  CASE WHEN sk%2=0 THEN '+' ELSE '-' END||chr(9)||'q'||CAST(k AS STRING)||chr(9)||'500'||chr(9)||'10'||chr(9)||CAST(10+91+pk%9+CASE WHEN pk%2=0 THEN 7 ELSE 0 END AS STRING)||chr(9)||'chr'||CAST(k%5+1 AS STRING)||chr(9)||'900000000'||chr(9)||
  CAST(k*37 AS STRING)||chr(9)||CAST(k*37+91+pk%9+20 AS STRING)||chr(9)||'2'||chr(9)||'40,'||CAST(51+pk%9 AS STRING)||','||chr(9)||'10,'||CAST(50+CASE WHEN pk%2=0 THEN 7 ELSE 0 END AS STRING)||','||chr(9)||CAST(k*37 AS STRING)||','||CAST(k*37+60 AS STRING)||',' AS value FROM {li}"""
VIEWS["sam"] = """
SELECT 'x.sam' AS path, k*8+n AS ord, 'r'||CAST(k AS STRING)||chr(9)||CASE CAST(pk%6 AS INT) WHEN 0 THEN '4' WHEN 1 THEN '16' WHEN 2 THEN '1040' ELSE '0' END||chr(9)||CASE WHEN pk%6=0 THEN '*' ELSE 'chr'||CAST(sk%5+1 AS STRING) END||chr(9)||CASE WHEN pk%6=0 THEN '0' ELSE CAST(k*37+n*50+1 AS STRING) END||chr(9)||
  CAST(qty AS STRING)||chr(9)||CASE CAST(sk%3 AS INT) WHEN 0 THEN '8M' WHEN 1 THEN '2S3M2D3M' ELSE '3M1I20N4M' END||chr(9)||'*'||chr(9)||'0'||chr(9)||'0'||chr(9)||'ACGTACGT'||chr(9)||'IIIIIIII'||CASE WHEN n%2=0 THEN chr(9)||'NM:i:0' ELSE '' END AS value FROM {li}
UNION ALL SELECT 'x.sam', CAST(-1 AS BIGINT), '@HD'||chr(9)||'VN:1.6'"""
VIEWS["sam_regions"] = "SELECT 'chr'||CAST(o_custkey%5+1 AS STRING) AS chrom, o_orderkey*37 AS start, o_orderkey*37+90 AS end_ FROM {orders} WHERE o_custkey%3=0"
# datasets with their species and builds; the last one has no chain
VIEWS["lift_sets"] = """
SELECT DISTINCT dataset, 'human' AS species, CASE WHEN dataset='set2' THEN 'old' ELSE 'a' END AS "from", 'b' AS "to", CASE WHEN dataset='set1' THEN CAST(0.5 AS DOUBLE) END AS min_match FROM {lift_in}"""
VIEWS["sam_names"] = "SELECT DISTINCT 'r'||CAST(o_orderkey AS STRING) AS q_name FROM {orders} WHERE o_custkey%2=0"


def chain_blocks(s, d):
    return S.parse_chain_blocks(view(s, d, "chain"))


def headers(s, d):
    return S.parse_chain_headers(view(s, d, "chain"))


def psl(s, d):
    return S.parse_psl(view(s, d, "psl"))


def sam(s, d):
    return S.parse_sam(view(s, d, "sam"))


def q_chain_headers(s, d):
    return headers(s, d).drop("path")


def q_chain_blocks(s, d):
    return chain_blocks(s, d).select("chain_id", "t_name", "q_name", "q_strand", "size", "dt", "dq", "t_from", "q_from")


def q_lift(s, d):
    return A.liftover(view(s, d, "lift_in").drop("dataset"), chain_blocks(s, d), 0.8)


def q_lift_report(s, d):
    return A.liftover_report(q_lift(s, d))


def _sets(s, d):
    rows = view(s, d, "lift_in").select("dataset").distinct()
    sets = rows.select("dataset", F.lit("human").alias("species"), F.when(F.col("dataset") == "set2", "old").otherwise("a").alias("from"), F.lit("b").alias("to"),
                       F.when(F.col("dataset") == "set1", 0.5).alias("min_match"))
    blocks = chain_blocks(s, d).withColumns({"species": F.lit("human"), "from": F.lit("a"), "to": F.lit("b")})
    return A.liftover_datasets(view(s, d, "lift_in"), sets, blocks, 0.9)


def q_lift_sets(s, d):
    return _sets(s, d)[0].groupBy("dataset", "fate").agg(F.count("*").alias("n"), F.sum("new_start").alias("starts"))


def q_lift_status(s, d):
    return _sets(s, d)[1]


def _lift_vcf(s, d):
    v = parse_vcf(view(s, d, "vcf")).withColumn("chrom", F.concat(F.lit("chr"), (F.col("pos") % 5 + 1).cast("string")))
    blocks = chain_blocks(s, d).withColumns({"q_name": F.concat(F.lit("chr"), (F.col("q_from") % 5 + 1).cast("string")), "q_from": F.col("q_from") % 10000, "q_size": F.lit(12000).cast("bigint")})
    return A.liftover_variants(v, blocks, genome_chunks(view(s, d, "genome")))


def q_lift_variants(s, d):
    done, _ = _lift_vcf(s, d)
    return done.select("ord", "chrom", "pos", "ref", F.array_join("alts", ",").alias("alt"))


def q_lift_rejects(s, d):
    return _lift_vcf(s, d)[1].groupBy("reason").agg(F.count("*").alias("n"))


def q_psl(s, d):
    return psl(s, d).select("ord", "matches", "mismatches", "strand", "q_name", "q_start", "q_end", "t_name", "t_start", "t_end", F.array_join("block_sizes", ",").alias("block_sizes"))


def q_psl_stats(s, d):
    p = A.psl_statistics(psl(s, d))
    return p.withColumns({"identity": F.round("identity", 9), "q_coverage": F.round("q_coverage", 9)})


def q_psl_summary(s, d):
    p = A.psl_summary(psl(s, d))
    return p.select("alignments", "queries", "aligned", F.round("min_identity", 9).alias("min_identity"), F.round("max_q_coverage", 9).alias("max_q_coverage"))


def q_best(s, d):
    return A.best_alignments(psl(s, d), 0.02, 0.18, 0.9).select("ord", "q_name")


def q_psl_sort(s, d):
    return with_rank(A.sort_psl(psl(s, d)).select("q_name", "ord"))


def q_psl_map(s, d):
    m = A.map_through_chains(psl(s, d), chain_blocks(s, d))
    return longs(m.select("ord", "chain_id", "aligned", "strand", "q_start", "q_end", "t_name", "t_start", "t_end", "block_count"))


def q_chain_filter(s, d):
    h, b = A.filter_chains(headers(s, d), chain_blocks(s, d), min_score=50, strand="+", t_overlap=(1000, 200000))
    n = b.groupBy("chain_ord").agg(F.count("*").alias("blocks"), F.sum("size").alias("bases"))
    return h.join(n, h.ord == n.chain_ord).select("chain_id", "score", "t_name", "blocks", "bases")


def q_chain_sort(s, d):
    h = headers(s, d)
    return with_rank(A.sort_chains(h.where("score >= 70"), h.where("score < 70")).select("chain_id", "score"))


def q_chain_swap(s, d):
    return A.swap_chains(headers(s, d)).drop("path", "t_strand")


def q_swap_blocks(s, d):
    return A.swap_blocks(chain_blocks(s, d)).select("chain_id", "t_name", "q_name", "size", "t_from", "q_from")


def q_chain_psl(s, d):
    p = A.chains_to_psl(chain_blocks(s, d))
    return longs(p.select("chain_id", "matches", "strand", "q_start", "q_end", "t_start", "t_end", "block_count", F.array_join("t_starts", ",").alias("t_starts")))


def q_psl_chain(s, d):
    c = A.psl_to_chains(psl(s, d))
    return longs(c.select("ord", "score", "q_strand", "q_start", "q_end", F.size("steps").alias("blocks"), F.col("steps")[0]["dt"].alias("dt"), F.col("steps")[0]["dq"].alias("dq")))


def q_sam(s, d):
    r = sam(s, d)
    return longs(r.select("q_name", "flag", "r_name", "pos", "mapq", "cigar", cigar_query_length(F.col("cigar")).alias("q_length"), cigar_reference_length(F.col("cigar")).alias("r_length"), F.size("tags").alias("tags")))


def q_sam_view(s, d):
    return A.sam_view(sam(s, d), exclude=1024, min_mapq=5, names=view(s, d, "sam_names"), regions=view(s, d, "sam_regions")).select("ord", "q_name", "r_name", "pos")


def q_sam_sort(s, d):
    return with_rank(A.sort_sam(sam(s, d)).select("r_name", "pos", "ord"))


def q_sam_bed(s, d):
    return A.sam_to_bed(sam(s, d))


def q_sam_bed12(s, d):
    b = A.sam_to_bed12(sam(s, d))
    return longs(b.select("chrom", "start", "end", "name", "strand", "block_count", F.array_join("block_sizes", ",").alias("block_sizes"), F.array_join("block_starts", ",").alias("block_starts")))


CHAIN = """
, ck AS (SELECT o_orderkey AS k, CAST(o_orderkey+1 AS VARCHAR) AS chain_id, o_custkey AS score, 'chr'||CAST(o_custkey%5+1 AS VARCHAR) AS t_name, 'new'||CAST(o_custkey%3 AS VARCHAR) AS q_name, CASE WHEN o_orderkey%3=0 THEN '-' ELSE '+' END AS q_strand FROM orders),
cb AS (SELECT ck.*, 0 AS bi, CAST(100 AS BIGINT) AS size, k%5 AS dt, k%4 AS dq, k*37 AS t_from, k*11 AS q_from FROM ck UNION ALL SELECT ck.*, 1, 60, 0, 0, k*37+100+k%5, k*11+100+k%4 FROM ck)
"""
LIFT = """
, sp AS (SELECT *, row_number() OVER () AS rid FROM lift_in), hit AS (SELECT sp.*, chain_id, q_name, q_strand, greatest(sp.start, t_from) AS lo, least(end_, t_from+size) AS hi, q_from+greatest(sp.start, t_from)-t_from AS ql, q_from+least(end_, t_from+size)-t_from AS qh
  FROM sp JOIN cb ON t_name=sp.chrom AND sp.start<t_from+size AND t_from<end_),
pc AS (SELECT rid, chain_id, q_name, q_strand, min(CASE WHEN q_strand='+' THEN ql ELSE 800000000-qh END) AS a, max(CASE WHEN q_strand='+' THEN qh ELSE 800000000-ql END) AS b, sum(hi-lo) AS n FROM hit GROUP BY 1,2,3,4)
"""


def _fates(rate):
    return f"""
, ft AS (SELECT sp.*, count(chain_id) AS nc, count(*) FILTER (WHERE n>=(end_-start)*{rate}) AS ng, coalesce(sum(n), 0) AS cov, max({{'q': q_name, 'a': a, 'b': b, 's': q_strand}}) FILTER (WHERE n>=(end_-start)*{rate}) AS t
  FROM sp LEFT JOIN pc ON pc.rid=sp.rid GROUP BY ALL),
lf AS (SELECT *, CASE WHEN nc=0 THEN 'deleted' WHEN ng=1 THEN 'mapped' WHEN ng>1 THEN 'duplicated' WHEN nc>1 AND cov>=(end_-start)*{rate} THEN 'split' ELSE 'partial' END AS fate FROM ft)
"""


ONE = "CASE WHEN fate='mapped' THEN {} END"
FATES = _fates("CAST(0.8 AS DOUBLE)")
SETS = _fates("CASE WHEN dataset='set1' THEN CAST(0.5 AS DOUBLE) ELSE CAST(0.9 AS DOUBLE) END")
PSL = """
, r AS (SELECT ord, string_split(value, chr(9)) AS c FROM psl), p AS (SELECT ord, CAST(c[1] AS BIGINT) AS m, CAST(c[2] AS BIGINT) AS mm, c[9] AS strand, c[10] AS q_name, CAST(c[12] AS BIGINT) AS q_start, CAST(c[13] AS BIGINT) AS q_end, c[14] AS t_name, CAST(c[16] AS BIGINT) AS t_start, CAST(c[17] AS BIGINT) AS t_end,
  rtrim(c[19], ',') AS bs, CAST(c[5] AS BIGINT) AS qi, CAST(c[7] AS BIGINT) AS ti, [CAST(x AS BIGINT) for x in string_split(rtrim(c[19], ','), ',')] AS sz, [CAST(x AS BIGINT) for x in string_split(rtrim(c[20], ','), ',')] AS qs, [CAST(x AS BIGINT) for x in string_split(rtrim(c[21], ','), ',')] AS ts FROM r)
"""
SAM = """
, r AS (SELECT ord, string_split(value, chr(9)) AS c FROM sam WHERE value NOT LIKE '@%'), m AS (SELECT ord, c, c[1] AS q_name, CAST(c[2] AS BIGINT) AS flag, c[3] AS r_name, CAST(c[4] AS BIGINT) AS pos, CAST(c[5] AS BIGINT) AS mapq, c[6] AS cg,
  CASE c[6] WHEN '8M' THEN 8 WHEN '2S3M2D3M' THEN 8 ELSE 27 END AS rl FROM r)
"""

QUERIES = {
    "scan_chain_headers": Query(q_chain_headers, sql(CHAIN + """SELECT k*4 AS ord, score, t_name, CAST(900000000 AS BIGINT) AS t_size, '+' AS t_strand, k*37 AS t_start, k*37+160+k%5 AS t_end, q_name, CAST(800000000 AS BIGINT) AS q_size, q_strand, k*11 AS q_start, k*11+160+k%4 AS q_end, chain_id FROM ck""", "chain")),
    "scan_chain_blocks": Query(q_chain_blocks, sql(CHAIN + "SELECT chain_id, t_name, q_name, q_strand, size, dt, dq, t_from, q_from FROM cb", "chain")),
    "liftover_intervals": Query(q_lift, sql(CHAIN + LIFT + FATES + f"""
SELECT chrom, start, end_ AS "end", strand, fate, {ONE.format('t.q')} AS new_chrom, {ONE.format('t.a')} AS new_start, {ONE.format('t.b')} AS new_end, {ONE.format("CASE WHEN t.s='-' THEN CASE strand WHEN '+' THEN '-' ELSE '+' END ELSE strand END")} AS new_strand FROM lf""", "lift_in")),
    "liftover_report": Query(q_lift_report, sql(CHAIN + LIFT + FATES + "SELECT count(*) AS input_records, count(*) FILTER (WHERE fate='mapped') AS mapped_records, count(*) FILTER (WHERE fate<>'mapped') AS unmapped_records, printf('%.4f', count(*) FILTER (WHERE fate='mapped')/CAST(count(*) AS DOUBLE)) AS mapping_rate FROM lf", "lift_in")),
    "liftover_datasets": Query(q_lift_sets, sql(CHAIN + LIFT + SETS + "SELECT dataset, fate, count(*) AS n, CAST(sum(CASE WHEN fate='mapped' THEN t.a END) AS BIGINT) AS starts FROM lf WHERE dataset<>'set2' GROUP BY 1,2", "lift_in")),
    "liftover_dataset_status": Query(q_lift_status, sql(CHAIN + LIFT + SETS + """
, g AS (SELECT dataset, count(*) AS n, count(*) FILTER (WHERE fate='mapped') AS m FROM lf GROUP BY 1)
SELECT dataset, 'human' AS species, CASE WHEN dataset='set2' THEN 'old' ELSE 'a' END AS "from", 'b' AS "to", CASE WHEN dataset='set2' THEN 'failed' ELSE 'ok' END AS status, CASE WHEN dataset<>'set2' THEN n END AS input_records, CASE WHEN dataset<>'set2' THEN m END AS mapped_records,
 CASE WHEN dataset<>'set2' THEN n-m END AS unmapped_records, CASE WHEN dataset<>'set2' THEN printf('%.4f', m/CAST(n AS DOUBLE)) END AS mapping_rate, CASE WHEN dataset='set2' THEN 'no chain registered for this species and builds' ELSE '' END AS message FROM g""", "lift_in")),
    "liftover_variants": Query(q_lift_variants),
    "liftover_variant_rejects": Query(q_lift_rejects),
    "scan_psl": Query(q_psl, sql(PSL + "SELECT ord, m AS matches, mm AS mismatches, strand, q_name, q_start, q_end, t_name, t_start, t_end, bs AS block_sizes FROM p", "psl")),
    "psl_statistics": Query(q_psl_stats, sql(PSL + "SELECT q_name, CAST(500 AS BIGINT) AS q_size, t_name, t_start, t_end, strand, m+mm AS aligned, round(m/CAST(m+mm AS DOUBLE), 9) AS identity, round((m+mm)/CAST(500 AS DOUBLE), 9) AS q_coverage, m-mm-qi-ti AS score FROM p", "psl")),
    "psl_summary": Query(q_psl_summary, sql(PSL + "SELECT count(*) AS alignments, count(DISTINCT q_name) AS queries, CAST(sum(m+mm) AS BIGINT) AS aligned, round(min(m/CAST(m+mm AS DOUBLE)), 9) AS min_identity, round(max((m+mm)/CAST(500 AS DOUBLE)), 9) AS max_q_coverage FROM p", "psl")),
    "psl_best_alignments": Query(q_best, sql(PSL + ", o AS (SELECT *, m-mm-qi-ti AS sc FROM p WHERE m+mm>=500*CAST(0.18 AS DOUBLE) AND m>=(m+mm)*CAST(0.9 AS DOUBLE)), t AS (SELECT *, max(sc) OVER (PARTITION BY q_name) AS top FROM o) SELECT ord, q_name FROM t WHERE sc>=top*CAST(0.98 AS DOUBLE)", "psl")),
    "psl_sort": Query(q_psl_sort, sql(PSL + "SELECT q_name, ord, row_number() OVER (ORDER BY q_name, ord) AS rank FROM p", "psl")),
    "psl_map_through_chains": Query(q_psl_map, sql(CHAIN + PSL + """
, b AS (SELECT p.*, sz[i] AS w, qs[i] AS qf, ts[i] AS tf FROM p, (VALUES (1), (2)) v(i)),
h AS (SELECT ord, b.strand, cb.chain_id, cb.q_name AS nn, cb.q_strand, greatest(tf, t_from) AS lo, least(tf+w, t_from+size) AS hi, qf+greatest(tf, t_from)-tf AS q, q_from+greatest(tf, t_from)-t_from AS n FROM b JOIN cb ON cb.t_name=b.t_name AND tf<t_from+size AND t_from<tf+w),
z AS (SELECT *, hi-lo AS sz, CASE WHEN q_strand='-' THEN 500-q-(hi-lo) ELSE q END AS qa, CASE WHEN q_strand='-' THEN 800000000-n-(hi-lo) ELSE n END AS na, CASE WHEN q_strand='-' THEN CASE strand WHEN '+' THEN '-' ELSE '+' END ELSE strand END AS ns FROM h),
g AS (SELECT ord, chain_id, nn, ns, CAST(sum(sz) AS BIGINT) AS aligned, min(qa) AS qlo, max(qa+sz) AS qhi, min(na) AS tlo, max(na+sz) AS thi, count(*) AS block_count FROM z GROUP BY 1,2,3,4)
SELECT ord, chain_id, aligned, ns AS strand, CASE WHEN ns='-' THEN 500-qhi ELSE qlo END AS q_start, CASE WHEN ns='-' THEN 500-qlo ELSE qhi END AS q_end, nn AS t_name, tlo AS t_start, thi AS t_end, block_count FROM g""", "psl")),
    "chain_filter": Query(q_chain_filter, sql(CHAIN + "SELECT chain_id, score, t_name, CAST(2 AS BIGINT) AS blocks, CAST(160 AS BIGINT) AS bases FROM ck WHERE score>=50 AND q_strand='+' AND k*37<200000 AND k*37+160+k%5>1000", "chain")),
    "chain_sort": Query(q_chain_sort, sql(CHAIN + "SELECT chain_id, score, row_number() OVER (ORDER BY score DESC, k) AS rank FROM ck", "chain")),
    "chain_swap": Query(q_chain_swap, sql(CHAIN + """SELECT k*4 AS ord, chain_id, score, q_name AS t_name, CAST(800000000 AS BIGINT) AS t_size, CASE WHEN q_strand='-' THEN 800000000-(k*11+160+k%4) ELSE k*11 END AS t_start, CASE WHEN q_strand='-' THEN 800000000-k*11 ELSE k*11+160+k%4 END AS t_end,
 t_name AS q_name, CAST(900000000 AS BIGINT) AS q_size, q_strand, CASE WHEN q_strand='-' THEN 900000000-(k*37+160+k%5) ELSE k*37 END AS q_start, CASE WHEN q_strand='-' THEN 900000000-k*37 ELSE k*37+160+k%5 END AS q_end FROM ck""", "chain")),
    "chain_swap_blocks": Query(q_swap_blocks, sql(CHAIN + "SELECT chain_id, q_name AS t_name, t_name AS q_name, size, CASE WHEN q_strand='-' THEN 800000000-q_from-size ELSE q_from END AS t_from, CASE WHEN q_strand='-' THEN 900000000-t_from-size ELSE t_from END AS q_from FROM cb", "chain")),
    "chain_to_psl": Query(q_chain_psl, sql(CHAIN + """SELECT chain_id, CAST(160 AS BIGINT) AS matches, q_strand AS strand, CASE WHEN q_strand='-' THEN 800000000-(k*11+160+k%4) ELSE k*11 END AS q_start, CASE WHEN q_strand='-' THEN 800000000-k*11 ELSE k*11+160+k%4 END AS q_end, k*37 AS t_start, k*37+160+k%5 AS t_end,
 CAST(2 AS BIGINT) AS block_count, CAST(k*37 AS VARCHAR)||','||CAST(k*37+100+k%5 AS VARCHAR) AS t_starts FROM ck""", "chain")),
    "psl_to_chain": Query(q_psl_chain, sql(PSL + "SELECT ord, m-mm-qi-ti AS score, strand AS q_strand, qs[1] AS q_start, qs[2]+sz[2] AS q_end, CAST(2 AS BIGINT) AS blocks, ts[2]-ts[1]-sz[1] AS dt, qs[2]-qs[1]-sz[1] AS dq FROM p", "psl")),
    "scan_sam": Query(q_sam, sql(SAM + "SELECT q_name, flag, r_name, pos, mapq, cg AS cigar, CAST(CASE cg WHEN '8M' THEN 8 WHEN '2S3M2D3M' THEN 8 ELSE 8 END AS BIGINT) AS q_length, CAST(rl AS BIGINT) AS r_length, CAST(len(c)-11 AS BIGINT) AS tags FROM m", "sam")),
    "sam_view": Query(q_sam_view, sql(SAM + "SELECT ord, q_name, r_name, pos FROM m WHERE flag & 1024=0 AND flag & 4=0 AND mapq>=5 AND q_name IN (SELECT q_name FROM sam_names) AND EXISTS (SELECT 1 FROM sam_regions g WHERE g.chrom=r_name AND pos-1<g.end_ AND g.start<pos-1+rl)", "sam", "sam_names", "sam_regions")),
    "sam_sort": Query(q_sam_sort, sql(SAM + "SELECT r_name, pos, ord, row_number() OVER (ORDER BY r_name='*', r_name, pos, ord) AS rank FROM m", "sam")),
    "sam_to_bed": Query(q_sam_bed, sql(SAM + "SELECT r_name AS chrom, pos-1 AS start, pos-1+rl AS \"end\", q_name AS name, mapq AS score, CASE WHEN flag & 16<>0 THEN '-' ELSE '+' END AS strand FROM m WHERE flag & 4=0", "sam")),
    "sam_to_bed12": Query(q_sam_bed12, sql(SAM + "SELECT r_name AS chrom, pos-1 AS start, pos-1+rl AS \"end\", q_name AS name, CASE WHEN flag & 16<>0 THEN '-' ELSE '+' END AS strand, CAST(CASE WHEN rl=27 THEN 2 ELSE 1 END AS BIGINT) AS block_count, CASE WHEN rl=27 THEN '3,4' ELSE '8' END AS block_sizes, CASE WHEN rl=27 THEN '0,23' ELSE '0' END AS block_starts FROM m WHERE flag & 4=0", "sam")),
}
