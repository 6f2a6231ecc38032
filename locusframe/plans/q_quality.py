"""Queries of the data-quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.operators import quality as Q
from locusframe.plans.q_align import PSL
from locusframe.plans.q_convert import MAF
from locusframe.plans.registry import Query, longs
from locusframe.plans.views import VIEWS, sql, view

VIEWS["vcf_bad"] = """
SELECT * FROM {vcf_meta} UNION ALL
SELECT path, ord, CASE CAST(ord%41 AS INT) WHEN 0 THEN 'short'||chr(9)||'line' WHEN 1 THEN replace(value, chr(9)||'A'||chr(9), chr(9)||'Z'||chr(9)) WHEN 2 THEN replace(value, 'GT:AD:PL', 'AD:GT') WHEN 3 THEN value||chr(9)||'extra' ELSE value END AS value FROM {vcf}"""
VIEWS["fasta_lines"] = """
SELECT 'q.fa' AS path, p_partkey AS ord, CASE WHEN p_size%7=0 THEN '>s'||CAST(p_partkey%900 AS STRING) WHEN p_size%31=0 THEN '>' WHEN p_size%11=0 THEN 'ACGTNZ1' ELSE 'acgtRYK' END AS value FROM {part}"""
VIEWS["sam_bad"] = """
SELECT path, ord, CASE CAST(ord%37 AS INT) WHEN 0 THEN replace(value, chr(9)||'8M'||chr(9), chr(9)||'9M'||chr(9)) WHEN 1 THEN replace(value, 'IIIIIIII', 'III') WHEN 2 THEN replace(value, 'ACGTACGT', 'AC1TACGT') WHEN 3 THEN 'r'||chr(9)||'0'
  WHEN 4 THEN replace(value, 'NM:i:0', 'NM') WHEN 5 THEN 'r'||chr(9)||'0'||chr(9)||'chr1'||chr(9)||'5'||chr(9)||'-1'||chr(9)||'*'||chr(9)||'*'||chr(9)||'0'||chr(9)||'0'||chr(9)||'*'||chr(9)||'*' ELSE value END AS value FROM {sam} WHERE ord>=0"""
VIEWS["reports"] = """
SELECT 'step'||CAST(k%300 AS STRING) AS step, CASE CAST(n AS INT) WHEN 1 THEN 'records' WHEN 2 THEN 'error_count' WHEN 3 THEN 'Warning_count' WHEN 4 THEN 'parsed_records' ELSE 'other' END AS metric,
       max(CASE WHEN n=2 THEN CASE WHEN k%7=0 THEN '3' ELSE '0' END WHEN n=3 THEN CASE WHEN k%5=0 THEN '2' ELSE '' END ELSE CAST(k%300 AS STRING) END) AS value FROM {li} GROUP BY 1, 2"""

# one broken field per row, chosen by a key (fault 0 or an unused number: none)
VIEWS["wig_bad"] = """
SELECT 'w.wig' AS path, CAST(-1 AS BIGINT) AS ord, '5' AS value UNION ALL
SELECT path, ord, CASE WHEN ord%16=0 THEN CASE CAST((ord/16)%23 AS INT) WHEN 1 THEN replace(value, 'chrom=', 'name=') WHEN 2 THEN replace(value, ' step=10', '') WHEN 4 THEN replace(value, ' start=', ' start=-') WHEN 6 THEN replace(value, 'step=10', 'step=x') ELSE value END
  WHEN ord%19=3 THEN 'odd line '||value WHEN ord%19=5 THEN '-'||value ELSE value END AS value FROM {wig}"""
VIEWS["genepred_bad"] = """
SELECT path, ord, CASE WHEN f=1 THEN 'tx'||chr(9)||'chr1'||chr(9)||'?' WHEN f=2 THEN 'tx'||chr(9)||'chr1'||chr(9)||'+'||chr(9)||'5' ELSE concat_ws(chr(9), name, 'chr1', CASE WHEN f=3 THEN '.' ELSE '-' END, CASE f WHEN 4 THEN 'x' WHEN 6 THEN '-5' ELSE CAST(a AS STRING) END,
  CAST(a+CASE WHEN f=7 THEN 0 ELSE 300 END AS STRING), CAST(a+CASE WHEN f=8 THEN -10 ELSE 50 END AS STRING), CAST(a+CASE WHEN f=9 THEN 20 ELSE 250 END AS STRING), CASE f WHEN 5 THEN 'two' WHEN 10 THEN '0' WHEN 11 THEN '3' ELSE '2' END,
  CASE f WHEN 12 THEN CAST(a AS STRING) WHEN 15 THEN CAST(a+200 AS STRING)||','||CAST(a AS STRING) WHEN 16 THEN CAST(a+10 AS STRING)||','||CAST(a+200 AS STRING) ELSE CAST(a AS STRING)||','||CAST(a+200 AS STRING) END||',',
  CASE f WHEN 13 THEN CAST(a+100 AS STRING)||','||CAST(a+200 AS STRING) WHEN 14 THEN CAST(a+100 AS STRING)||','||CAST(a+400 AS STRING) WHEN 15 THEN CAST(a+300 AS STRING)||','||CAST(a+100 AS STRING) WHEN 17 THEN CAST(a+300 AS STRING) ELSE CAST(a+100 AS STRING)||','||CAST(a+300 AS STRING) END||',') END AS value
FROM (SELECT 'g.gp' AS path, k*8+n AS ord, CASE WHEN n%2=0 THEN 'gene'||chr(9) ELSE '' END||'tx'||CAST(k*8+n AS STRING) AS name, k*37 AS a, CAST((k*8+n)%29 AS INT) AS f FROM {li}) x"""
VIEWS["chain_bad"] = """
SELECT 'c.chain' AS path, CAST(-1 AS BIGINT) AS ord, '7' AS value UNION ALL
SELECT 'c.chain', k*4, 'chain '||CASE WHEN f=3 THEN 'x' ELSE '9' END||' chr1 '||CASE f WHEN 5 THEN '0' WHEN 8 THEN '10' ELSE '900000000' END||' + '||CAST(k*37 AS STRING)||' '||CAST(k*37+CASE WHEN f=6 THEN 0 ELSE 163 END AS STRING)||' new '||CASE f WHEN 9 THEN '10' ELSE '800000000' END||' '||
  CASE WHEN f=4 THEN '?' ELSE '-' END||' '||CAST(k*11 AS STRING)||CASE WHEN f=1 THEN '' ELSE ' '||CAST(k*11+CASE WHEN f=7 THEN 0 ELSE 162 END AS STRING)||CASE WHEN f=2 THEN '' ELSE ' '||CAST(k AS STRING) END END FROM (SELECT o_orderkey AS k, CAST(o_orderkey%37 AS INT) AS f FROM {orders}) x
UNION ALL SELECT 'c.chain', o_orderkey*4+1, CASE CAST(o_orderkey%37 AS INT) WHEN 10 THEN '100 x 2' WHEN 13 THEN '100 3' WHEN 14 THEN '101 3 2' ELSE '100 3 2' END FROM {orders}
UNION ALL SELECT 'c.chain', o_orderkey*4+2, CASE WHEN o_orderkey%37=11 THEN '60 0 0' ELSE '60' END FROM {orders}
UNION ALL SELECT 'c.chain', o_orderkey*4+3, CASE WHEN o_orderkey%37=12 THEN '5 1 1' ELSE '' END FROM {orders}"""
VIEWS["psl_bad"] = """
SELECT 'a.psl' AS path, ord, concat_ws(chr(9), CASE WHEN f=1 THEN 'x' ELSE CAST(90+p-m+CASE WHEN f IN (8, 9) THEN 1 ELSE 0 END AS STRING) END, CAST(m AS STRING), '0', '1', CAST(CASE WHEN f IN (19, 21) THEN 5 ELSE e END AS STRING), CAST(7*e+CASE WHEN f=23 THEN 1 ELSE 0 END AS STRING),
  CASE WHEN f IN (20, 22) THEN '5' ELSE '1' END, CASE WHEN f=24 THEN '21' ELSE '20' END, CASE WHEN f=4 THEN '*' WHEN f IN (9, 21, 22) THEN '++' ELSE '+' END, 'q', CASE f WHEN 3 THEN 'x' WHEN 10 THEN '0' WHEN 14 THEN '50' ELSE '500' END, CASE WHEN f=6 THEN '9' ELSE '10' END,
  CAST(CASE f WHEN 12 THEN 5 WHEN 7 THEN 102+p+7*e ELSE 101+p+7*e END AS STRING), 'chr1', CAST(CASE f WHEN 11 THEN 0 WHEN 15 THEN a+50 ELSE 900000000 END AS STRING), CAST(a AS STRING), CAST(CASE WHEN f=13 THEN a-1 ELSE a+111+p END AS STRING), CASE WHEN f=5 THEN '3' ELSE '2' END,
  '40,'||CAST(51+p AS STRING)||',', CASE WHEN f=16 THEN CAST(50+7*e AS STRING)||',10,' ELSE '10,'||CAST(50+7*e AS STRING)||',' END)||
  CASE WHEN f=2 THEN '' WHEN f=17 THEN chr(9)||CAST(a+60 AS STRING)||','||CAST(a AS STRING)||',' ELSE chr(9)||CAST(a AS STRING)||','||CAST(a+60 AS STRING)||',' END AS value
FROM (SELECT k*8+n AS ord, CAST((k*8+n)%41 AS INT) AS f, pk%9 AS p, sk%4 AS m, CASE WHEN pk%2=0 THEN 1 ELSE 0 END AS e, k*37 AS a FROM {li}) x"""


def counts(check):
    return check.rule_counts()


def report(check):
    return check.report()


def _q(make, *names, out=counts):
    return lambda s, d: out(make(*[view(s, d, n) for n in names]))


def q_messages(s, d):
    lines = view(s, d, "bed")
    return longs(Q.check_bed(lines).messages(lines, 100))


def q_issue_lines(s, d):
    lines = view(s, d, "bed")
    return Q.check_bed(lines).issue_lines(lines).where("level = 'error'")


def q_undeclared(s, d):
    lines = view(s, d, "vcf_meta").unionByName(view(s, d, "vcf"))
    return Q.undeclared_names(lines).select("ord", "kind", "name")


def q_status(s, d):
    return longs(Q.step_status(view(s, d, "reports")))


def q_clean_smprot(s, d):
    return Q.clean_smprot(view(s, d, "smprot"))


def q_line_numbers(s, d):
    from locusframe.sources.lines import with_line_numbers

    return with_line_numbers(view(s, d, "bed")).select("ord", "line_no")


def q_contig_order(s, d):
    from locusframe.functions.values import contig_order
    from locusframe.sources.tables import parse_chrom_sizes

    k = parse_chrom_sizes(view(s, d, "size_lines")).select("chrom", contig_order(F.col("chrom")).alias("k")).distinct()
    return k.select("chrom", F.col("k.g").cast("bigint").alias("g"), F.col("k.n").alias("n"))


def _count_sql(steps, rules, *names):
    """SQL counting broken rules: (level, rule, condition) over a table ``x``."""
    parts = " UNION ALL ".join(f"SELECT '{lv}' AS level, '{rule}' AS rule, count(*) AS n FROM x WHERE {cond} HAVING count(*)>0" for lv, rule, cond in rules)
    return sql(steps + parts, *names)


E, W = "error", "warning"

def _unsorted(table, chrom, pos):
    """SQL steps marking rows out of order: ``un``."""
    return f"""
, fs AS (SELECT *, min(ord) OVER (PARTITION BY {chrom}) AS fo, lag({chrom}) OVER (ORDER BY ord) AS pc, lag({pos}) OVER (ORDER BY ord) AS pp FROM {table} WHERE {pos} IS NOT NULL),
fm AS (SELECT *, max(fo) OVER (ORDER BY ord ROWS UNBOUNDED PRECEDING) AS nw FROM fs), un AS (SELECT count(*) AS n FROM fm WHERE pc IS NOT NULL AND ((pc={chrom} AND {pos}<pp) OR (pc<>{chrom} AND fo<nw)))
"""


BED_X = ", x AS (SELECT *, len(c) AS n, TRY_CAST(c[2] AS BIGINT) AS s, TRY_CAST(c[3] AS BIGINT) AS e FROM (SELECT ord, string_split(value, chr(9)) AS c FROM bed WHERE value NOT LIKE '#%'))\n"
GTF_X = """, x AS (SELECT *, len(c)=9 AS ok, TRY_CAST(c[4] AS BIGINT) AS s, TRY_CAST(c[5] AS BIGINT) AS e FROM (SELECT string_split(value, chr(9)) AS c FROM gtf WHERE value NOT LIKE '#%'))
"""
VCF_X = """, x AS (SELECT *, len(c)>=8 AS w FROM (SELECT ord, value, string_split(value, chr(9)) AS c FROM vcf_bad WHERE value NOT LIKE '#%'))
"""
BDG_X = """, x0 AS (SELECT ord, string_split(value, chr(9)) AS c FROM bedgraph WHERE value NOT LIKE 'track %'),
x AS (SELECT *, len(c)=4 AS f, CASE WHEN len(c)=4 THEN TRY_CAST(c[2] AS BIGINT) END AS s, CASE WHEN len(c)=4 THEN TRY_CAST(c[3] AS BIGINT) END AS e, CASE WHEN len(c)=4 AND c[3]<>'x' THEN c[1] END AS ch, CASE WHEN len(c)=4 AND c[3]<>'x' THEN TRY_CAST(c[2] AS BIGINT) END AS po FROM x0)
"""
MAF_X = """, x AS (SELECT *, len(c)=10 AS u, TRY_CAST(c[3] AS BIGINT) AS s, TRY_CAST(c[4] AS BIGINT) AS e, CASE WHEN len(c)=10 THEN row_number() OVER (PARTITION BY len(c), c[2], c[3], c[4], c[10], c[7], c[9] ORDER BY ord) END AS k FROM (SELECT ord, string_split(value, chr(9)) AS c FROM maf))
"""
MAP_X = """, x AS (SELECT *, TRY_CAST(c[len(c)] AS BIGINT) AS bp, row_number() OVER (PARTITION BY c[2] ORDER BY ord) AS k FROM (SELECT ord, string_split(value, ' ') AS c FROM plink_map))
"""
PED_X = """, x AS (SELECT ord, c, len(c)=6+2*(SELECT count(*) FROM plink_map) AS u FROM (SELECT ord, string_split(value, ' ') AS c FROM plink_ped))
"""
SAM_X = """, x AS (SELECT *, len(c)>=11 AS w FROM (SELECT string_split(value, chr(9)) AS c FROM sam_bad))
"""
BM_X = """, x AS (SELECT *, CAST(c[10] AS BIGINT) AS cov FROM (SELECT string_split(value, chr(9)) AS c FROM bedmethyl))
"""
SIZE_X = r""", x0 AS (SELECT ord, value, string_split(value, chr(9)) AS t, string_split(replace(value, chr(9), ' '), ' ') AS w FROM size_lines WHERE value NOT LIKE '#%'), x1 AS (SELECT *, len(t)=2 OR len(w)=2 AS ok FROM x0),
x AS (SELECT *, CASE WHEN ok THEN w[1] END AS name, CASE WHEN ok THEN TRY_CAST(w[2] AS BIGINT) END AS size, CASE WHEN ok THEN row_number() OVER (PARTITION BY ok, w[1] ORDER BY ord) END AS k FROM x1)
"""
FA_X = """, x AS (SELECT *, value LIKE '>%' AS h, max(CASE WHEN value LIKE '>%' THEN ord END) OVER (ORDER BY ord ROWS UNBOUNDED PRECEDING) AS ho, row_number() OVER (PARTITION BY value ORDER BY ord) AS k FROM fasta_lines)
"""
def _not_positive(name):
    """SQL: a setting of a declaration that is no whole number from 1 on."""
    found = f"regexp_extract(t, ' {name}=([^ ]+)', 1)"
    return f"({found}<>'' AND coalesce(TRY_CAST({found} AS BIGINT), 0)<1)"


WIG_X = """, d AS (SELECT ord, value AS t, value LIKE 'fixedStep%' OR value LIKE 'variableStep%' AS decl FROM wig_bad), e AS (SELECT *, max(CASE WHEN decl THEN ord END) OVER (ORDER BY ord ROWS UNBOUNDED PRECEDING) AS at_, string_split(t, ' ') AS w FROM d),
y AS (SELECT e.*, h.t LIKE 'fixed%' AS fixed FROM e LEFT JOIN d h ON h.decl AND h.ord=e.at_), x AS (SELECT *, NOT decl AND at_ IS NOT NULL AND CASE WHEN fixed THEN TRY_CAST(t AS DOUBLE) IS NOT NULL ELSE len(w)=2 AND TRY_CAST(w[1] AS BIGINT) IS NOT NULL AND TRY_CAST(w[2] AS DOUBLE) IS NOT NULL END AS good FROM y)
"""
GP_X = """, r AS (SELECT string_split(value, chr(9)) AS c FROM genepred_bad), y AS (SELECT c, CASE WHEN c[3] IN ('+', '-', '.') THEN 0 WHEN c[4] IN ('+', '-', '.') THEN 1 END AS o FROM r),
z AS (SELECT o, coalesce(len(c)>=9+o, false) AS w, c[o+3] AS st, TRY_CAST(c[o+4] AS BIGINT) AS ts, TRY_CAST(c[o+5] AS BIGINT) AS te, TRY_CAST(c[o+6] AS BIGINT) AS cs, TRY_CAST(c[o+7] AS BIGINT) AS ce, TRY_CAST(c[o+8] AS BIGINT) AS n,
  [CAST(i AS BIGINT) for i in string_split(rtrim(coalesce(c[o+9], '0'), ','), ',')] AS xs, [CAST(i AS BIGINT) for i in string_split(rtrim(coalesce(c[o+10], '0'), ','), ',')] AS xe FROM y),
x AS (SELECT *, w AND ts IS NOT NULL AND te IS NOT NULL AND cs IS NOT NULL AND ce IS NOT NULL AS ints, w AND ts IS NOT NULL AND te IS NOT NULL AND cs IS NOT NULL AND ce IS NOT NULL AND n IS NOT NULL AS fu FROM z)
"""
CH_X = """, r AS (SELECT ord, string_split(value, ' ') AS c, max(CASE WHEN value LIKE 'chain %' THEN ord END) OVER (ORDER BY ord ROWS UNBOUNDED PRECEDING) AS h FROM chain_bad WHERE value<>''),
b AS (SELECT *, len(c) NOT IN (1, 3) OR len([1 for i in c if TRY_CAST(i AS BIGINT) IS NULL])>0 AS bad, TRY_CAST(c[1] AS BIGINT) AS size, coalesce(TRY_CAST(c[2] AS BIGINT), 0) AS dt, coalesce(TRY_CAST(c[3] AS BIGINT), 0) AS dq FROM r WHERE c[1]<>'chain' AND h IS NOT NULL),
p AS (SELECT h, count(*) FILTER (WHERE bad) AS bad, sum(size+dt) AS tu, sum(size+dq) AS qu, max(ord) AS last_at, min(CASE WHEN len(c)=1 AND NOT bad THEN ord END) AS end_at FROM b GROUP BY 1),
y AS (SELECT ord, false AS orphan, len(c) AS n, TRY_CAST(c[2] AS BIGINT) AS score, TRY_CAST(c[4] AS BIGINT) AS ts, TRY_CAST(c[6] AS BIGINT) AS t0, TRY_CAST(c[7] AS BIGINT) AS t1, c[5] AS a, c[10] AS z, TRY_CAST(c[9] AS BIGINT) AS qs, TRY_CAST(c[11] AS BIGINT) AS q0, TRY_CAST(c[12] AS BIGINT) AS q1 FROM r WHERE c[1]='chain'
  UNION ALL SELECT ord, true, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM r WHERE h IS NULL),
x AS (SELECT y.*, p.*, coalesce(n IN (12, 13), false) AS ok, coalesce(n IN (12, 13), false) AND score+ts+t0+t1+qs+q0+q1 IS NOT NULL AS ints, coalesce(n IN (12, 13), false) AND score+ts+t0+t1+qs+q0+q1 IS NOT NULL AND end_at IS NOT NULL AS cl FROM y LEFT JOIN p ON p.h=y.ord)
"""
PSL_X = """, r AS (SELECT string_split(value, chr(9)) AS c FROM psl_bad), y AS (SELECT c, regexp_matches(c[1], '^[0-9]+$') AS num, len(c)=21 AS fl, [TRY_CAST(i AS BIGINT) for i in c] AS v, [CAST(i AS BIGINT) for i in string_split(rtrim(c[19], ','), ',')] AS b,
  [CAST(i AS BIGINT) for i in string_split(rtrim(c[20], ','), ',')] AS q, [CAST(i AS BIGINT) for i in string_split(rtrim(coalesce(c[21], '0'), ','), ',')] AS t FROM r),
z AS (SELECT *, num AND fl AS us, num AND fl AND v[11] IS NOT NULL AS ints, num AND fl AND v[11] IS NOT NULL AND len(b)=v[18] AND len(q)=v[18] AND len(t)=v[18] AS sh, length(c[9])=1 AS pl FROM y),
x AS (SELECT *, [q[1]-v[12], q[2]-q[1]-b[1], v[13]-q[2]-b[2]] AS qg, [t[1]-v[16], t[2]-t[1]-b[1], v[17]-t[2]-b[2]] AS tg FROM z)
"""


def _psl_side(side, size, start, end, number, bases):
    """SQL rules of one side of alignments with two blocks; the numbers are places of columns."""
    gap = f"len([1 for g in {side}g if g<>0])<>v[{number}]"
    return [(E, f"{side} size below 1", f"sh AND v[{size}]<1"), (E, f"{side} end before start", f"sh AND v[{end}]<v[{start}]"), (E, f"{side} end beyond its size", f"sh AND v[{end}]>v[{size}]"), (E, f"{side} blocks not sorted", f"sh AND {side}[1]>{side}[2]"),
            (E, f"{side} block out of bounds", f"sh AND (least({side}[1], {side}[2])<v[{start}] OR greatest({side}[1]+b[1], {side}[2]+b[2])>v[{size}])"), (E, f"{side} gap bases differ from the blocks", f"sh AND list_sum({side}g)<>v[{bases}]"),
            (E, f"{side} gap count differs from the blocks", f"sh AND pl AND {gap}"), (W, f"{side} gap count differs from the blocks", f"sh AND NOT pl AND {gap}")]


RMSK_X = r""", r AS (SELECT ord, string_split(trim(value), ' ') AS c FROM rmsk WHERE trim(value) NOT LIKE 'SW%'), w AS (SELECT *, len(c)=15 AS m, c[5] AS qn, c[10] AS rn, TRY_CAST(c[6] AS BIGINT) AS b, TRY_CAST(c[7] AS BIGINT) AS e, TRY_CAST(nullif(regexp_extract(c[8], '^\((-?\d+)\)$', 1), '') AS BIGINT) AS l,
  TRY_CAST(c[12] AS BIGINT) AS rb, TRY_CAST(c[13] AS BIGINT) AS re, TRY_CAST(nullif(regexp_extract(c[14], '^\((-?\d+)\)$', 1), '') AS BIGINT) AS rl, TRY_CAST(c[15] AS BIGINT) AS id FROM r),
f AS (SELECT *, lag(b) OVER q AS pb, lag(e) OVER q AS pe, lag(id) OVER (ORDER BY ord) AS pid, first_value(e+l) OVER q AS ql, min_by(re+rl, ord) OVER (PARTITION BY rn) AS rlen FROM w WHERE m WINDOW q AS (PARTITION BY qn ORDER BY ord)),
t AS (SELECT count(*) FILTER (WHERE b<pb) AS late, count(*) FILTER (WHERE b<=pe) AS over_, count(*) FILTER (WHERE id<=pid) AS ids, count(*) FILTER (WHERE re+rl<>rlen AND rl>=0) AS cons, count(DISTINCT qn) AS qs, count(DISTINCT rn) AS rs,
  sum(CAST(coalesce(TRY_CAST(c[2] AS DOUBLE) NOT BETWEEN 0 AND 100 OR TRY_CAST(c[3] AS DOUBLE) NOT BETWEEN 0 AND 100 OR TRY_CAST(c[4] AS DOUBLE) NOT BETWEEN 0 AND 100, true) AS INT)+CAST(b IS NULL OR e IS NULL OR l IS NULL OR b<1 AS INT)+CAST(coalesce(e<b, false) AS INT)+CAST(c[9] NOT IN ('+', '-', 'C', 'c') AS INT)
    +CAST(rb IS NULL OR re IS NULL OR rl IS NULL AS INT)+CAST(coalesce(re<rb, false) AS INT)+CAST(id IS NULL OR id<1 AS INT)+CAST(coalesce(e+l<>ql, false) AS INT)) AS errors FROM f)
SELECT 'records' AS metric, CAST(count(*) AS VARCHAR) AS value FROM w UNION ALL SELECT 'query_count', CAST(qs AS VARCHAR) FROM t UNION ALL SELECT 'repeat_count', CAST(rs AS VARCHAR) FROM t UNION ALL SELECT 'order_breaks', CAST(late AS VARCHAR) FROM t UNION ALL SELECT 'overlaps', CAST(over_ AS VARCHAR) FROM t
UNION ALL SELECT 'id_breaks', CAST(ids AS VARCHAR) FROM t UNION ALL SELECT 'consensus_differs', CAST(cons AS VARCHAR) FROM t UNION ALL SELECT 'error_count', CAST(errors+(SELECT count(*) FROM w WHERE NOT m) AS VARCHAR) FROM t
UNION ALL SELECT 'warning_count', CAST(CAST(late>0 AS INT)+CAST(over_>0 AS INT)+CAST(ids>0 AS INT)+CAST(cons>0 AS INT) AS VARCHAR) FROM t"""
CH_HEAD = "SELECT 'chains' AS metric, CAST(count(*) AS VARCHAR) AS value FROM orders UNION ALL SELECT 'blocks', CAST(2*count(*) AS VARCHAR) FROM orders UNION ALL SELECT 'error_count', '0' UNION ALL SELECT 'warning_count', '0'"

QUERIES = {
    "check_annotation": Query(_q(Q.check_annotation, "gtf"), _count_sql(GTF_X, [(E, "needs 9 columns", "NOT ok"), (E, "coordinates are not whole numbers", "ok AND (s IS NULL OR e IS NULL)"),
        (E, "record without gene", "ok AND c[9]='a' AND c[3]='exon'"), (E, "record without transcript", "ok AND c[9]='a' AND c[3]='exon'"), (E, "start after end", "ok AND s>e")], "gtf")),
    "annotation_feature_counts": Query(lambda s, d: Q.annotation_feature_counts(view(s, d, "gtf")), sql(GTF_X + "SELECT c[3] AS feature, count(*) AS n FROM x WHERE ok GROUP BY 1", "gtf")),
    "check_gff3_structure": Query(_q(Q.check_gff3_structure, "gff3", out=report), sql("SELECT 'parsed_records' AS metric, CAST(count(*) AS VARCHAR) AS value FROM gff3 UNION ALL SELECT 'error_count', CAST(count(*) AS VARCHAR) FROM gff3 WHERE value LIKE '%Parent=gene%' UNION ALL SELECT 'warning_count', '0'", "gff3")),
    "check_bed": Query(_q(Q.check_bed, "bed"), _count_sql(BED_X, [(E, "too few columns", "n<3"), (E, "coordinates are not whole numbers", "n>=3 AND (s IS NULL OR e IS NULL)"), (E, "end not after start", "n>=3 AND e<=s"),
        (W, "extra columns short of BED6", "n>3 AND n<6 AND s IS NOT NULL AND e IS NOT NULL")], "bed")),
    "bed_error_messages": Query(q_messages, sql("""
, l AS (SELECT *, row_number() OVER (ORDER BY ord) AS ln, string_split(value, chr(9)) AS c FROM bed), m AS (SELECT ln, CASE WHEN len(c)<3 THEN 'too few columns' WHEN TRY_CAST(c[2] AS BIGINT) IS NULL THEN 'coordinates are not whole numbers' WHEN CAST(c[3] AS BIGINT)<=CAST(c[2] AS BIGINT) THEN 'end not after start' END AS t FROM l WHERE value NOT LIKE '#%'),
f AS (SELECT * FROM m WHERE t IS NOT NULL ORDER BY ln LIMIT 100) SELECT 'x.bed' AS path, string_agg('line '||CAST(ln AS VARCHAR)||': '||t, ' | ' ORDER BY ln) AS errors, (SELECT count(*)-100 FROM m WHERE t IS NOT NULL) AS left_out FROM f""", "bed")),
    "bed_issue_lines": Query(q_issue_lines, sql("""
, l AS (SELECT *, row_number() OVER (ORDER BY ord) AS ln, string_split(value, chr(9)) AS c FROM bed), m AS (SELECT ln, CASE WHEN len(c)<3 THEN 'too few columns' WHEN TRY_CAST(c[2] AS BIGINT) IS NULL THEN 'coordinates are not whole numbers' WHEN CAST(c[3] AS BIGINT)<=CAST(c[2] AS BIGINT) THEN 'end not after start' END AS t FROM l WHERE value NOT LIKE '#%')
SELECT 'x.bed' AS path, ln AS line_no, 'error' AS level, t AS rule FROM m WHERE t IS NOT NULL""", "bed")),
    "line_numbers": Query(q_line_numbers, sql("SELECT ord, row_number() OVER (ORDER BY ord) AS line_no FROM bed", "bed")),
    "check_bedgraph": Query(_q(Q.check_bedgraph, "bedgraph"), _count_sql(BDG_X, [(E, "needs 4 columns", "NOT f"), (E, "coordinates are not whole numbers", "f AND (s IS NULL OR e IS NULL)"), (E, "start below 0", "f AND e IS NOT NULL AND s<0"), (E, "end not after start", "f AND e<=s"),
        (E, "value is not finite", "f AND s IS NOT NULL AND e IS NOT NULL AND c[4] IN ('nan', 'inf')"), (E, "value is not numeric", "f AND s IS NOT NULL AND e IS NOT NULL AND c[4]='bad'")], "bedgraph")),
    "check_bedgraph_order": Query(lambda s, d: longs(Q.check_bedgraph(view(s, d, "bedgraph")).summary().select("records", "unsorted_records")),
        sql(BDG_X + _unsorted("x", "ch", "po") + "SELECT (SELECT count(*) FROM x) AS records, n AS unsorted_records FROM un", "bedgraph")),
    "check_vcf": Query(_q(Q.check_vcf, "vcf_bad"), _count_sql(VCF_X, [(E, "fewer than 8 columns", "NOT w"), (E, "column count differs from the header", "w AND len(c)<>11"), (E, "REF is not made of bases", "w AND c[4]='Z'"), (E, "ALT allele not understood", "w AND c[5]='Z'"),
        (W, "no ALT allele", "w AND c[5]='.'"), (W, "GT is not the first FORMAT field", "w AND c[9]='AD:GT'")], "vcf_bad")),
    "check_vcf_report": Query(_q(Q.check_vcf, "vcf_bad", out=lambda c: longs(c.summary().select("records", "file_format_lines", "column_headers"))), sql(VCF_X + "SELECT count(*) AS records, CAST(1 AS BIGINT) AS file_format_lines, CAST(1 AS BIGINT) AS column_headers FROM x", "vcf_bad")),
    "vcf_undeclared_names": Query(q_undeclared, sql("""
, r AS (SELECT ord, string_split(value, chr(9)) AS c FROM vcf), u AS (SELECT ord, 'contig' AS kind, c[1] AS name FROM r UNION ALL SELECT ord, 'FILTER', c[7] FROM r UNION ALL SELECT ord, 'ALT', 'DEL' FROM r WHERE c[5]='<DEL>' UNION ALL SELECT ord, 'FORMAT', unnest(string_split(c[9], ':')) FROM r
 UNION ALL SELECT ord, 'INFO', split_part(t, '=', 1) FROM (SELECT ord, unnest(string_split(c[8], ';')) AS t FROM r)), k AS (SELECT min(ord) AS ord, kind, name FROM u GROUP BY 2,3)
SELECT ord, kind, name FROM k WHERE name NOT IN ('PASS', '.') AND (kind, name) NOT IN (('INFO', 'AC'), ('INFO', 'CLNSIG'), ('FORMAT', 'AD'), ('FORMAT', 'PL'), ('contig', 'X'), ('contig', 'chr9'), ('FILTER', 'q10'))""", "vcf")),
    "check_clinvar_vcf": Query(_q(Q.check_clinvar_vcf, "vcf_bad", out=report), sql(VCF_X + """SELECT 'records' AS metric, CAST(count(*) FILTER (WHERE w) AS VARCHAR) AS value FROM x UNION ALL SELECT 'file_format_lines', '1' UNION ALL SELECT 'column_headers', '1' UNION ALL SELECT 'clnsig_headers', '1'
UNION ALL SELECT 'error_count', CAST(count(*) FILTER (WHERE NOT w) AS VARCHAR) FROM x UNION ALL SELECT 'warning_count', CAST(count(*) FILTER (WHERE w AND c[5]='.') AS VARCHAR) FROM x""", "vcf_bad")),
    "check_cosmic": Query(_q(Q.check_cosmic, "cosmic", out=report), sql("SELECT 'records' AS metric, CAST(count(*) AS VARCHAR) AS value FROM cosmic UNION ALL SELECT 'error_count', CAST(count(*) AS VARCHAR) FROM cosmic WHERE fathmm_mkl_score IN ('bad', '1d') UNION ALL SELECT 'warning_count', '0'", "cosmic")),
    "check_gwas": Query(_q(Q.check_gwas, "gwas"), sql("SELECT 'warning' AS level, 'position is not a whole number' AS rule, count(*) AS n FROM gwas WHERE pos IN ('', '12;15') UNION ALL SELECT 'warning', 'p-value is not numeric', count(*) FROM gwas WHERE p_value='x'", "gwas")),
    "check_smprot": Query(_q(Q.check_smprot, "smprot", out=report), sql("""SELECT 'records' AS metric, CAST(count(*) AS VARCHAR) AS value FROM smprot UNION ALL SELECT 'kept_records', CAST(count(*) AS VARCHAR) FROM smprot WHERE start<>'x' AND CAST(end_ AS BIGINT)>TRY_CAST(start AS BIGINT) AND chrom<>'' AND protein_id<>''
UNION ALL SELECT 'error_count', CAST(count(*) AS VARCHAR) FROM smprot WHERE start='x' OR CAST(end_ AS BIGINT)<=TRY_CAST(start AS BIGINT) UNION ALL SELECT 'warning_count', CAST(count(*) AS VARCHAR) FROM smprot WHERE start<>'x' AND CAST(end_ AS BIGINT)>TRY_CAST(start AS BIGINT) AND (chrom='' OR protein_id='')""", "smprot")),
    "clean_smprot": Query(q_clean_smprot, sql("SELECT 'chr'||chrom AS chrom, start, end_ AS \"end\", protein_id, evidence FROM smprot WHERE start<>'x' AND CAST(end_ AS BIGINT)>TRY_CAST(start AS BIGINT) AND chrom<>'' AND protein_id<>''", "smprot")),
    "check_wig": Query(_q(Q.check_wig, "wig", out=report), sql("""SELECT 'declarations' AS metric, CAST(count(DISTINCT k) AS VARCHAR) AS value FROM li UNION ALL SELECT 'records', CAST(count(*) AS VARCHAR) FROM li UNION ALL SELECT 'chrom_count', CAST(count(DISTINCT k%5) AS VARCHAR) FROM li
UNION ALL SELECT 'unsorted_records', '0' UNION ALL SELECT 'error_count', '0' UNION ALL SELECT 'warning_count', '0'""", "li")),
    "check_genepred": Query(_q(Q.check_genepred, "genepred", out=report), sql("""SELECT 'records' AS metric, CAST(count(*) AS VARCHAR) AS value FROM genepred UNION ALL SELECT 'layouts', '2' UNION ALL SELECT 'chrom_count', '5' UNION ALL SELECT 'error_count', '0' UNION ALL SELECT 'warning_count', '1'""", "genepred")),
    "check_wig_rules": Query(_q(Q.check_wig, "wig_bad"), _count_sql(WIG_X, [(E, "declaration without chrom", "decl AND t NOT LIKE '% chrom=%'"), (E, "fixedStep without start or step", "t LIKE 'fixedStep%' AND (t NOT LIKE '% start=%' OR t NOT LIKE '% step=%')"),
        (E, "declaration value is not a positive number", "decl AND (" + " OR ".join(_not_positive(n) for n in ("start", "step", "span")) + ")"), (E, "data before a declaration", "NOT decl AND at_ IS NULL"), (E, "data line not understood", "NOT decl AND at_ IS NOT NULL AND NOT good"),
        (E, "position below 1", "good AND NOT fixed AND CAST(w[1] AS BIGINT)<1")], "wig_bad")),
    "check_genepred_rules": Query(_q(Q.check_genepred, "genepred_bad"), _count_sql(GP_X, [(E, "layout not recognised", "o IS NULL"), (E, "too few columns", "o IS NOT NULL AND NOT w"), (W, "strand unknown", "w AND st='.'"), (E, "coordinates are not whole numbers", "w AND NOT ints"),
        (E, "exon count is not a whole number", "ints AND n IS NULL"), (E, "transcript start below 0", "fu AND ts<0"), (E, "transcript end not after start", "fu AND te<=ts"), (E, "coding span outside the transcript", "fu AND (cs<ts OR ce>te)"), (E, "coding end before start", "fu AND ce<cs"), (E, "no exons", "fu AND n<1"),
        (E, "exon starts differ from the count", "fu AND len(xs)<>n"), (E, "exon ends differ from the count", "fu AND len(xe)<>n"), (E, "exon end not after start", "fu AND len(xs)=len(xe) AND (xe[1]<=xs[1] OR xe[2]<=xs[2])"), (E, "exon outside the transcript", "fu AND len(xs)=len(xe) AND (list_min(xs)<ts OR list_max(xe)>te)"),
        (W, "exons not sorted", "fu AND len(xs)=len(xe) AND xs[2]<xs[1]"), (W, "transcript and outer exons differ", "fu AND n>=1 AND (xs[1]<>ts OR xe[len(xe)]<>te)")], "genepred_bad")),
    "check_chain_rules": Query(_q(Q.check_chain, "chain_bad"), _count_sql(CH_X, [(E, "block before a chain", "orphan"), (E, "header needs 12 or 13 fields", "NOT orphan AND NOT ok"), (W, "header without id", "n=12"), (E, "header numbers are not whole", "ok AND NOT ints"),
        (E, "unknown strand", "ints AND (a NOT IN ('+', '-') OR z NOT IN ('+', '-'))"), (E, "sizes below 1", "ints AND (ts<1 OR qs<1)"), (E, "target end not after start", "ints AND t1<=t0"), (E, "query end not after start", "ints AND q1<=q0"), (E, "target end beyond its size", "ints AND t1>ts"),
        (E, "query end beyond its size", "ints AND q1>qs"), (E, "block line not understood", "bad>0"), (E, "chain is not terminated", "ints AND NOT cl"), (E, "block after the end of a chain", "cl AND last_at>end_at"), (E, "target blocks differ from the span", "cl AND tu<>t1-t0"),
        (E, "query blocks differ from the span", "cl AND qu<>q1-q0")], "chain_bad")),
    "check_psl_rules": Query(_q(Q.check_psl, "psl_bad"), _count_sql(PSL_X, [(E, "record does not start with a number", "NOT num"), (E, "needs 21 or 23 fields", "num AND NOT fl"), (E, "numbers are not whole", "us AND NOT ints"), (E, "unknown strand", "us AND c[9]='*'"), (E, "lists differ from the block count", "ints AND NOT sh"),
        (W, "first block differs from qStart", "sh AND q[1]<>v[12]"), (W, "last block differs from qEnd", "sh AND q[2]+b[2]<>v[13]"), (E, "counts differ from the aligned size", "sh AND pl AND v[1]+v[2]+v[3]+v[4]<>b[1]+b[2]"), (W, "counts differ from the aligned size", "sh AND NOT pl AND v[1]+v[2]+v[3]+v[4]<>b[1]+b[2]"),
        *_psl_side("q", 11, 12, 13, 5, 6), *_psl_side("t", 15, 16, 17, 7, 8)], "psl_bad")),
    "check_sam": Query(_q(Q.check_sam, "sam_bad"), _count_sql(SAM_X, [(E, "SEQ and CIGAR lengths differ", "w AND c[6]='9M'"), (E, "QUAL and SEQ lengths differ", "w AND c[11]='III'"), (E, "SEQ has other characters", "w AND c[10]='AC1TACGT'"),
        (E, "fewer than 11 fields", "NOT w"), (E, "MAPQ out of range", "w AND c[5]='-1'"), (E, "tag not understood", "w AND c[12]='NM'")], "sam_bad")),
    "check_sam_report": Query(_q(Q.check_sam, "sam", out=report), sql("SELECT 'header_lines' AS metric, '1' AS value UNION ALL SELECT 'records', CAST(count(*) AS VARCHAR) FROM li UNION ALL SELECT 'unmapped', CAST(count(*) AS VARCHAR) FROM li WHERE pk%6=0 UNION ALL SELECT 'error_count', '0' UNION ALL SELECT 'warning_count', '0'", "li")),
    "check_chain": Query(_q(Q.check_chain, "chain", out=report), sql("\n" + CH_HEAD, "li")),
    "check_fasta": Query(_q(Q.check_fasta, "fasta_lines"), _count_sql(FA_X, [(E, "empty header", "value='>'"), (E, "sequence before a header", "NOT h AND ho IS NULL"), (W, "repeated header", "h AND value<>'>' AND k>1"), (W, "characters outside the alphabet", "value='ACGTNZ1'")], "fasta_lines")),
    "fasta_lengths": Query(lambda s, d: Q.fasta_lengths(view(s, d, "fasta_lines")), sql(FA_X + """, p AS (SELECT ho, CAST(sum(CASE WHEN h THEN 0 ELSE length(value) END) AS BIGINT) AS n FROM x WHERE ho IS NOT NULL GROUP BY 1)
SELECT count(*) AS sequences, count(*) FILTER (WHERE n=0) AS empty_sequences, min(n) FILTER (WHERE n>0) AS min_length, max(n) AS max_length FROM p""", "fasta_lines").replace("min(n) FILTER", "min(n) FILTER")),
    "fasta_odd_characters": Query(lambda s, d: Q.fasta_odd_characters(view(s, d, "fasta_lines")), sql("SELECT ch AS character, count(*) AS n FROM fasta_lines, (VALUES ('Z'), ('1')) t(ch) WHERE value='ACGTNZ1' GROUP BY 1", "fasta_lines")),
    "check_psl": Query(_q(Q.check_psl, "psl", out=lambda c: longs(c.summary().select("records", "queries", "targets", "duplicates", "error_count"))), sql(PSL + """
SELECT count(*) AS records, count(DISTINCT q_name) AS queries, count(DISTINCT t_name) AS targets, count(*)-count(DISTINCT (q_name, t_name, q_start, t_start, bs)) AS duplicates, CAST(0 AS BIGINT) AS error_count FROM p""", "psl")),
    "check_rmsk": Query(_q(Q.check_rmsk, "rmsk", out=report), sql(RMSK_X, "rmsk")),
    "check_chrom_sizes": Query(_q(Q.check_chrom_sizes, "size_lines"), _count_sql(SIZE_X, [(E, "looks like a fasta index", "len(w)=5"), (E, "needs 2 columns", "len(w) NOT IN (2, 5)"), (E, "repeated name", "ok AND k>1"), (E, "size is not a whole number", "ok AND size IS NULL"), (E, "size below 1", "ok AND size<1")], "size_lines")),
    "check_chrom_sizes_totals": Query(_q(Q.check_chrom_sizes, "size_lines", out=lambda c: longs(c.summary().select("chromosomes", "total_bases", "min_size", "max_size", "duplicate_names", "space_separated"))), sql(SIZE_X + """
SELECT count(*) FILTER (WHERE ok) AS chromosomes, CAST(sum(size) FILTER (WHERE size>0) AS BIGINT) AS total_bases, min(size) FILTER (WHERE size>0) AS min_size, max(size) FILTER (WHERE size>0) AS max_size, count(*) FILTER (WHERE k>1) AS duplicate_names, count(*) FILTER (WHERE ok AND len(t)<>2) AS space_separated FROM x""", "size_lines")),
    "contig_order_keys": Query(q_contig_order, sql(r"""
, r AS (SELECT string_split(replace(trim(value), chr(9), ' '), ' ') AS c FROM size_lines WHERE value NOT LIKE '#%'), n AS (SELECT DISTINCT c[1] AS chrom FROM r WHERE len(c)>=2 AND TRY_CAST(c[2] AS BIGINT) IS NOT NULL), st AS (SELECT chrom, regexp_replace(chrom, '^chr', '') AS b FROM n)
SELECT chrom, CAST(CASE WHEN b='X' OR regexp_matches(b, '^[0-9]+$') THEN 1 WHEN regexp_matches(b, '[0-9]') THEN 2 ELSE 3 END AS BIGINT) AS g, CASE WHEN b='X' THEN 23 ELSE coalesce(TRY_CAST(regexp_extract(b, '([0-9]+)', 1) AS BIGINT), 0) END AS n FROM st""", "size_lines")),
    "check_bedmethyl": Query(_q(Q.check_bedmethyl, "bedmethyl"), _count_sql(BM_X, [(E, "modification code not understood", "c[4]='m?'"), (E, "colour not understood", "c[9]='300,0,0'"), (W, "thick positions differ", "c[3]<>c[8]"),
        (E, "percent differs from the counts", "cov>0 AND abs(CAST(c[11] AS DOUBLE)-CAST(c[12] AS DOUBLE)/cov*100)>0.01")], "bedmethyl")),
    "check_maf": Query(_q(lambda lines: Q.check_maf(lines, MAF), "maf"), _count_sql(MAF_X, [(E, "column count differs from the header", "NOT u"), (E, "start is not a positive number", "u AND s<1"), (E, "end is not a positive number", "u AND e<1"), (E, "start after end", "u AND s>=1 AND e>=1 AND s>e"),
        (E, "empty variant type", "u AND c[6]=''"), (W, "allele lengths do not fit the type", "u AND ((c[6]='SNP' AND length(c[7])<>1) OR (c[6]='DNP') OR (c[6]='INS') OR (c[6]='DEL' AND length(c[7])<=1))"), (W, "allele equals the reference", "u AND c[7]=c[9]"),
        (W, "unknown classification", "u AND c[5]='Odd'"), (W, "repeated variant", "u AND k>1")], "maf")),
    "check_plink_map": Query(_q(Q.check_plink_map, "plink_map"), _count_sql(MAP_X, [(W, "unusual contig code", "c[1]='scaffold'"), (W, "repeated variant id", "k>1"), (E, "position is not a whole number", "bp IS NULL"), (W, "position is 0", "bp=0")], "plink_map")),
    "check_plink_map_order": Query(_q(Q.check_plink_map, "plink_map", out=lambda c: longs(c.summary().select("variants", "duplicate_ids", "unsorted_records"))), sql(MAP_X + ", y AS (SELECT ord, CASE WHEN bp>0 THEN bp END AS po, c[1] AS ch FROM x)" + _unsorted("y", "ch", "po") + "SELECT (SELECT count(*) FROM x) AS variants, (SELECT count(*) FROM x WHERE k>1) AS duplicate_ids, n AS unsorted_records FROM un", "plink_map")),
    "check_plink_ped": Query(_q(Q.check_plink_ped, "plink_ped", "plink_map"), _count_sql(PED_X, [(E, "token count differs from the map", "NOT u")], "plink_ped", "plink_map")),
    "step_status": Query(q_status, sql("""
, a AS (SELECT step, max(CASE WHEN lower(metric) LIKE 'error%' AND value NOT IN ('', '0') THEN 2 WHEN lower(metric) LIKE 'warning%' AND value NOT IN ('', '0') THEN 1 ELSE 0 END) AS lv, coalesce(max(value) FILTER (WHERE metric='records'), max(value) FILTER (WHERE metric='parsed_records'), '-') AS records FROM reports GROUP BY 1)
SELECT step, CASE lv WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'OK' END AS status, records, CAST(2-lv AS BIGINT) AS status_rank FROM a""", "reports")),
}
