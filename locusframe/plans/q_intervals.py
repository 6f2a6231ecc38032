"""Queries of the interval operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.operators import intervals as I
from locusframe.operators.ordered import with_rank
from locusframe.plans.registry import Query, longs
from locusframe.plans.views import VIEWS, sql, view

VIEWS["sizes"] = "SELECT chrom, max(end_)-CAST(5000 AS BIGINT) AS size FROM {feat} GROUP BY chrom"
# three bedGraph tracks without overlaps inside a track
VIEWS["tracks"] = """
SELECT 'track'||CAST(n%3+1 AS STRING) AS track, 'chr'||CAST(k%5+1 AS STRING) AS chrom, k*37+CAST(floor(n/3) AS BIGINT)*10 AS start,
       k*37+CAST(floor(n/3) AS BIGINT)*10+1+pk%10 AS end_, CAST(1+qty%7 AS DOUBLE) AS value
FROM {li}"""

DEPTH_SQL = """
, ev AS (SELECT chrom, pos, sum(d) AS d FROM (SELECT chrom, start AS pos, 1 AS d FROM feat UNION ALL SELECT chrom, end_, -1 FROM feat) GROUP BY 1,2),
run AS (SELECT chrom, pos, lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS nxt, sum(d) OVER (PARTITION BY chrom ORDER BY pos) AS depth FROM ev WHERE d<>0)
"""


def _f(s, d):
    return view(s, d, "feat")


def overlap_join(s, d):
    hits = I.interval_join(_f(s, d), view(s, d, "var").select("chrom", "start", "end", "variant_id", "part"), short_side="right")
    return hits.select("chrom", "feature_id", F.col("start").alias("f_start"), F.col("end").alias("f_end"), "variant_id",
                       F.col("start_b").alias("v_start"), F.col("end_b").alias("v_end"), "part")


def overlap_join_long(s, d):
    """Long intervals on both sides: whole-order spans against features."""
    x = _f(s, d).select("chrom", F.col("start"), (F.col("end") + F.when(F.col("start") % 1000 == 0, 3_000_000).otherwise(0)).alias("end"), "feature_id")
    y = view(s, d, "feat").where("feature_type = 'gene'").select("chrom", "start", (F.col("end") + F.when(F.col("start") % 1200 == 0, 2_000_000).otherwise(0)).alias("end"), F.col("feature_id").alias("other"))
    j = I.interval_join(x, y)
    return j.groupBy("feature_id").agg(F.count("*").alias("n"), F.sum(F.col("start_b")).alias("starts"))


def sort_bed(s, d):
    return longs(with_rank(I.sort_intervals(_f(s, d).select("chrom", "start", "end", "feature_id"), "feature_id", order=["chr3", "chr1"])))


def q_depth(s, d):
    return longs(I.coverage_depth(_f(s, d)))


def q_base_depth(s, d):
    # regions as the third filter: bases inside exons only
    reg = _f(s, d).where("feature_type = 'exon'")
    return longs(I.base_depth(view(s, d, "feat").where("feature_type = 'CDS'"), reg))


def q_union(s, d):
    return I.union_length(_f(s, d), ["chrom", "gene_id"])


def q_merge(s, d):
    return I.merge_intervals(_f(s, d), ["chrom", "strand"])


def q_pair_fraction(s, d):
    """Overlap of each gene's features with its exons, as a share of the shorter union."""
    f = _f(s, d)
    a, b = f.where("feature_type = 'exon'"), f.where("feature_type = 'CDS'")
    j = I.interval_join(a.select("chrom", "start", "end"), b.select("chrom", "start", "end"))
    inter = j.groupBy("chrom").agg(F.sum(I.overlap_length(F.col("start"), F.col("end"), F.col("start_b"), F.col("end_b"))).alias("shared"))
    ua, ub = I.union_length(a, ["chrom"], "ua"), I.union_length(b, ["chrom"], "ub")
    return inter.join(ua, "chrom").join(ub, "chrom").select("chrom", "shared", F.round(F.col("shared") / F.least("ua", "ub"), 9).alias("fraction"))


def q_tracks(s, d):
    return I.union_tracks(view(s, d, "tracks"), ["track1", "track2", "track3"])


def q_compare(s, d):
    return I.compare_tracks(view(s, d, "tracks"), "track1", "track2", "subtract")


def q_binned(s, d):
    return longs(I.binned_coverage(_f(s, d), 500, 0.5))


def q_matrix(s, d):
    m = I.tracks_matrix(view(s, d, "tracks"), 100, ["track1", "track2", "track3"])
    return longs(m.select("chrom", "start", "end", *[F.round(c, 9).alias(c) for c in ("track1", "track2", "track3")]))


def q_clip(s, d):
    return I.clip_to_sizes(_f(s, d).select("chrom", "start", "end", "feature_id"), view(s, d, "sizes"), truncate=True)


def q_bedcov(s, d):
    reg = _f(s, d).where("feature_type = 'exon'").select("chrom", "start", "end", "feature_id")
    return I.region_coverage(reg, view(s, d, "var"))


QUERIES = {
    "interval_overlap_join": Query(overlap_join, sql("""
SELECT f.chrom, feature_id, f.start AS f_start, f.end_ AS f_end, variant_id, v.start AS v_start, v.end_ AS v_end, part
FROM feat f JOIN var v ON f.chrom=v.chrom AND f.start<v.end_ AND v.start<f.end_""", "feat", "var")),
    "interval_overlap_long": Query(overlap_join_long, sql("""
, x AS (SELECT chrom, start, end_+CASE WHEN start%1000=0 THEN 3000000 ELSE 0 END AS e, feature_id FROM feat),
y AS (SELECT chrom, start, end_+CASE WHEN start%1200=0 THEN 2000000 ELSE 0 END AS e FROM feat WHERE feature_type='gene')
SELECT feature_id, count(*) AS n, CAST(sum(y.start) AS BIGINT) AS starts FROM x JOIN y ON x.chrom=y.chrom AND x.start<y.e AND y.start<x.e GROUP BY 1""", "feat")),
    "interval_sort": Query(sort_bed, sql("""SELECT chrom, start, end_ AS "end", feature_id,
 row_number() OVER (ORDER BY CASE chrom WHEN 'chr3' THEN 0 WHEN 'chr1' THEN 1 ELSE 2 END, chrom, start, end_, feature_id) AS rank FROM feat""", "feat")),
    "coverage_depth": Query(q_depth, sql(DEPTH_SQL + """
SELECT chrom, pos AS start, nxt AS "end", CAST(depth AS BIGINT) AS depth FROM run WHERE depth>0""", "feat")),
    "base_depth_in_regions": Query(q_base_depth, sql("""
, b AS (SELECT chrom, unnest(range(start+1, end_+1)) AS pos FROM feat WHERE feature_type='CDS'),
r AS (SELECT DISTINCT chrom, unnest(range(start+1, end_+1)) AS pos FROM feat WHERE feature_type='exon')
SELECT b.chrom, b.pos, count(*) AS depth FROM b JOIN r ON b.chrom=r.chrom AND b.pos=r.pos GROUP BY 1,2""", "feat")),
    "union_length": Query(q_union, sql("""
, o AS (SELECT chrom, gene_id, start, end_, max(end_) OVER (PARTITION BY chrom, gene_id ORDER BY start, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM feat)
SELECT chrom, gene_id, CAST(sum(greatest(0, end_-greatest(start, coalesce(m, start)))) AS BIGINT) AS union_length FROM o GROUP BY 1,2""", "feat")),
    "merge_intervals": Query(q_merge, sql("""
, o AS (SELECT *, max(end_) OVER (PARTITION BY chrom, strand ORDER BY start, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM feat),
g AS (SELECT *, sum(CASE WHEN m IS NULL OR start>m THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, strand ORDER BY start, end_ ROWS UNBOUNDED PRECEDING) AS isl FROM o)
SELECT chrom, strand, min(start) AS start, max(end_) AS "end" FROM g GROUP BY chrom, strand, isl""", "feat")),
    "pairwise_overlap_fraction": Query(q_pair_fraction, sql("""
, a AS (SELECT * FROM feat WHERE feature_type='exon'), b AS (SELECT * FROM feat WHERE feature_type='CDS'),
ua AS (SELECT chrom, count(*) AS u FROM (SELECT DISTINCT chrom, unnest(range(start, end_)) FROM a) GROUP BY 1), ub AS (SELECT chrom, count(*) AS u FROM (SELECT DISTINCT chrom, unnest(range(start, end_)) FROM b) GROUP BY 1),
i AS (SELECT a.chrom, CAST(sum(least(a.end_, b.end_)-greatest(a.start, b.start)) AS BIGINT) AS shared FROM a JOIN b ON a.chrom=b.chrom AND a.start<b.end_ AND b.start<a.end_ GROUP BY 1)
SELECT i.chrom, shared, round(shared/CAST(least(ua.u, ub.u) AS DOUBLE), 9) AS fraction FROM i JOIN ua ON ua.chrom=i.chrom JOIN ub ON ub.chrom=i.chrom""", "feat")),
    "union_tracks": Query(q_tracks, sql("""
, p AS (SELECT DISTINCT chrom, unnest([start, end_]) AS pos FROM tracks), g AS (SELECT chrom, pos AS s, lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS e FROM p)
SELECT g.chrom, s AS start, e AS "end", coalesce(max(value) FILTER (WHERE track='track1'), 0) AS track1, coalesce(max(value) FILTER (WHERE track='track2'), 0) AS track2, coalesce(max(value) FILTER (WHERE track='track3'), 0) AS track3
FROM g JOIN tracks t ON t.chrom=g.chrom AND t.start<g.e AND g.s<t.end_ GROUP BY 1,2,3""", "tracks")),
    "compare_tracks": Query(q_compare, sql("""
, tt AS (SELECT * FROM tracks WHERE track<>'track3'), p AS (SELECT DISTINCT chrom, unnest([start, end_]) AS pos FROM tt), g AS (SELECT chrom, pos AS s, lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS e FROM p)
SELECT g.chrom, s AS start, e AS "end", coalesce(max(value) FILTER (WHERE track='track1'), 0)-coalesce(max(value) FILTER (WHERE track='track2'), 0) AS value
FROM g JOIN tt t ON t.chrom=g.chrom AND t.start<g.e AND g.s<t.end_ GROUP BY 1,2,3""", "tracks")),
    "binned_coverage": Query(q_binned, sql("""
, b AS (SELECT chrom, unnest(range(start//500, (end_-1)//500+1)) AS bin FROM feat)
SELECT chrom, bin*500 AS start, (bin+1)*500 AS "end", CAST(count(*)*0.5 AS DOUBLE) AS value FROM b GROUP BY 1,2,3""", "feat")),
    "binned_track_matrix": Query(q_matrix, sql("""
, b AS (SELECT track, chrom, start, end_, value, unnest(range(start//100, (end_-1)//100+1)) AS bin FROM tracks),
m AS (SELECT track, chrom, bin, sum((least(end_, (bin+1)*100)-greatest(start, bin*100))*value)/sum(least(end_, (bin+1)*100)-greatest(start, bin*100)) AS v FROM b GROUP BY 1,2,3)
SELECT chrom, bin*100 AS start, (bin+1)*100 AS "end", round(max(v) FILTER (WHERE track='track1'), 9) AS track1, round(max(v) FILTER (WHERE track='track2'), 9) AS track2, round(max(v) FILTER (WHERE track='track3'), 9) AS track3 FROM m GROUP BY 1,2,3""", "tracks")),
    "clip_to_chrom_sizes": Query(q_clip, sql("""
SELECT f.chrom, start, least(end_, size) AS "end", feature_id FROM feat f JOIN sizes s ON s.chrom=f.chrom WHERE start<least(end_, size)""", "feat", "sizes")),
    "region_read_coverage": Query(q_bedcov, sql("""
SELECT f.chrom, f.start, f.end_ AS "end", feature_id, count(v.chrom) AS n_reads, CAST(coalesce(sum(least(f.end_, v.end_)-greatest(f.start, v.start)) FILTER (WHERE v.chrom IS NOT NULL), 0) AS BIGINT) AS n_bases
FROM feat f LEFT JOIN var v ON f.chrom=v.chrom AND f.start<v.end_ AND v.start<f.end_ WHERE feature_type='exon' GROUP BY 1,2,3,4""", "feat", "var")),
}
