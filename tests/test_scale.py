"""Work that is done once, and rows of one file or a frequent key that do not meet in one task."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from locusframe.functions import variant as V
from locusframe.functions.values import int_list, to_int_lenient
from locusframe.operators import conservation, variants
from locusframe.operators import quality as Q
from locusframe.operators.intervals import interval_join
from locusframe.operators.ordered import left_lookup
from locusframe.operators.variants import ANNOTATION_BINS
from locusframe.plans import q_conservation
from locusframe.plans.views import view
from locusframe.sources.annotation import parse_annotation, parse_bed
from locusframe.sources.vcf import parse_vcf


@contextmanager
def setting(spark, key, value):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def lineitem(spark, tmp_path):
    rows = [(k, 10 + k, k % 5, n, 4.0, 0.05, "R", "O") for k in range(1, 40) for n in range(1, 4)]
    spark.createDataFrame(rows, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_discount double, l_returnflag string, l_linestatus string").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_derived_text_is_built_once(spark, lineitem):
    """No condition on the cells moves below the file boundary, where it would build the text again."""
    for df in (parse_vcf(view(spark, lineitem, "vcf")), parse_annotation(view(spark, lineitem, "gtf")).where("feature = 'exon'")):
        below = optimized(df).split("RepartitionByExpression", 1)[1]
        assert "split(" not in below and "RLIKE" not in below
        assert df.count() > 0


@pytest.mark.parametrize("parse,text", [(parse_vcf, "1\t5\trs\tA\tG\t.\tPASS\tX=1"), (parse_annotation, 'c\ts\texon\t1\t9\t.\t+\t.\tgene_id "g";'), (parse_bed, "c\t1\t9")])
def test_a_line_is_split_once(lines, parse, text):
    df = parse(lines(text + "\n# no record\nshort"))
    assert len(re.findall(r"split\(value#\d+, \t", optimized(df))) == 1
    assert df.count() == 1


def test_last_value_of_an_info_key(spark):
    texts = ["A=1;B=2;A=3", "A", "A;A=x", "A=x;A", "AB=1", "XA=1", "A=", "A=;A", "", ".", None, "A=b=c;D", "b;A=é;z", "A=1;;A=2;"]
    expected = ["3", "True", "x", "True", None, None, "", "True", None, None, None, "b=c", "é", "2"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r.v for r in df.select("i", V.info_last(F.col("t"), "A").alias("v")).orderBy("i").collect()] == expected


def test_labels_in_their_order_without_repeats(spark):
    texts = ["Affectes,affects", "Risk_factor|Pathogenic", "none", "", None, "Benign/Likely_benign,drug_response"]
    expected = [["Affects"], ["Pathogenic", "Risk factor"], [], [], [], ["Benign", "Drug response"]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r.v for r in df.select("i", V.clinical_labels(F.col("t")).alias("v")).orderBy("i").collect()] == expected


def test_whole_numbers_of_a_list(spark):
    df = spark.createDataFrame([("1,2.7,x,-3,123456789012345,9007199254740993,,",), ("",), (None,)], "t string")
    items = F.filter(F.split(F.coalesce("t", F.lit("")), ","), lambda x: x != "")
    for r in df.select(int_list(F.col("t")).alias("a"), F.transform(items, lambda x: to_int_lenient(x)).alias("b")).collect():
        assert r.a == r.b


def test_rows_without_a_key_stay_spread_where_a_key_is_constant(spark):
    """A constant mark would leave the keys of the join and put all rows without a key into one task."""
    rows = spark.range(4000).select(F.lit("f").alias("path"), F.when(F.col("id") < 10, F.col("id").cast("string")).alias("k"), "id")
    table = rows.where("k is not null").groupBy("path", "k").agg(F.max("id").alias("m"))
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), setting(spark, "spark.sql.adaptive.enabled", "false"):
        out = left_lookup(rows, table, ["path", "k"], ["id"])
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 4000 and max(sizes) < 2000
        assert out.where("m is not null").count() == 10


def test_rows_of_a_frequent_contig_stay_spread(spark):
    """The place of the first row of a contig reaches its rows in many tasks."""
    rows = spark.range(4000).select(F.lit("f").alias("path"), F.shiftleft("id", 18).alias("ord"), F.when(F.col("id") != 7, F.lit("chr1")).alias("chrom"))
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), setting(spark, "spark.sql.adaptive.enabled", "false"):
        out = Q.with_first_seen(rows.where("ord > 0"), ["chrom"])
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 3999 and max(sizes) < 2000
        assert {(r.chrom, r.first_ord) for r in out.select("chrom", "first_ord").distinct().collect()} == {("chr1", 1 << 18), (None, None)}


def test_lines_of_a_sam_file_are_not_joined_by_path(spark, lines):
    text = "@HD\tVN:1.6\n@SQ\tSN:c\tLN:9\nr\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n@SQ\tSN:d\tLN:9"
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        check = Q.check_sam(lines(text))
        assert "SortMergeJoin" not in physical(check.issues())
        assert [(r.ord, r.rule) for r in check.issues().collect()] == [(3, "header after records")]


def test_annotation_bins_find_all_overlaps(spark):
    import random

    r = random.Random(5)
    a = [(i, r.choice("xy"), s, s + r.choice([1, 300, 2047, 2048, 40000, 131072, 140000, 3000000])) for i, s in enumerate(r.randrange(0, 4000000) for _ in range(150))]
    b = [(i, r.choice("xy"), s, s + r.choice([1, 3, 5000])) for i, s in enumerate(r.randrange(0, 4000000) for _ in range(300))]
    left = spark.createDataFrame(a, "i int, chrom string, start bigint, end bigint")
    right = spark.createDataFrame(b, "j int, chrom string, start bigint, end bigint")
    got = sorted((x.i, x.j) for x in interval_join(left, right, short_side="right", classes=ANNOTATION_BINS).collect())
    assert got == sorted((i, j) for i, c, s, e in a for j, d, t, u in b if c == d and s < u and t < e)


def test_significance_text_is_cut_out_once(lines):
    head = ("chr7", "5", ".", "C", "T", "40", ".")
    infos = ["CLNSIG=Likely_benign,Risk_Factor;RS=9", "CLNSIG=Affects", "CLNSIG=not_provided", "DP=3", ".", "CLNSIG=Benign;CLNSIG=Drug_response", "CLNSIG"]
    kept = variants.clinvar_filter(parse_vcf(lines("\n".join("\t".join([*head, i]) for i in infos))))
    assert sorted((r.clinical_labels, r.dbsnp_id) for r in kept.collect()) == [("Affects", "NA"), ("Benign|Risk factor", "rs9"), ("Drug response", "NA")]
    plan = optimized(kept)
    assert plan.count("replace(lower(") == 1, plan


def test_genotype_text_is_split_once(lines):
    row = ("chr7", "5", "v", "C", "T,G", ".", ".", ".", "DP:GT")
    table = variants.genotype_table(parse_vcf(lines("\t".join([*row, "3:0/2", "4:1|0", "5:./1", "6", "7:0/1|2"]))), list("abcde"))
    assert {r.sample: (r.a1, r.a2) for r in table.collect()} == {"a": ("C", "G"), "b": ("T", "C"), "c": ("0", "T"), "d": ("0", "0"), "e": ("C", "T")}
    plan = optimized(table)
    assert plan.count("_v#") and "[/|]" not in plan, plan


def test_duplicate_segments_are_judged_once(spark, tmp_path, monkeypatch):
    rows = [(k, n, 10 * k + n % 2, 7 * n + k, 5.0, 0.05, "A", "F") for k in range(12) for n in range(1, 5)]
    spark.createDataFrame(rows, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_discount double, l_returnflag string, l_linestatus string").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    gone = {(r.species, r.segment_id) for r in q_conservation.drops(spark, str(tmp_path)).collect()}
    groups = {(r.species, r.grouped_id) for r in q_conservation.grouped(spark, str(tmp_path)).collect()}
    calls, real = [], conservation.duplicate_segments
    monkeypatch.setattr(conservation, "duplicate_segments", lambda *a: calls.append(1) or real(*a))
    got = {r.species: r[2:] for r in q_conservation.q_qc(spark, str(tmp_path)).collect()}
    assert len(calls) == 1
    for species in ("mouse", "rat"):
        n = sum(s == species for s, _ in gone)
        assert n and got[species] == (24, n, 24 - n, sum(s == species for s, _ in groups))
