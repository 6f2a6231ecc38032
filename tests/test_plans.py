"""Executed plans and helpers that keep work spread out."""

import os
import re

import pytest

from locusframe.operators.ordered import evaluated_once, left_lookup, with_rank
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name,scans", [("coverage_depth", 2), ("union_length", 1), ("line_numbers", 1)])
def test_inputs_run_once(spark, name, scans):
    from locusframe.plans.registry import all_queries

    df = all_queries()[name](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet", plan)) == scans
    assert len(re.findall(r"ReusedExchange", plan)) >= 1


def test_ranks_follow_the_sort(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x")).repartition(7)
    got = with_rank(df.orderBy("x")).collect()
    assert sorted((r.x, r["rank"]) for r in got) == [(i, i + 1) for i in range(5000)]


def test_lookup_spreads_rows_without_a_key(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), ("", 3), ("b", 4)] + [(None, i) for i in range(10, 60)], "k string, n int")
    table = spark.createDataFrame([("a", "x"), ("", "never"), ("c", "z")], "k string, v string")
    got = {(r.k, r.n): r.v for r in left_lookup(rows, table.where("k <> ''"), ["k"], ["n"], blanks=True).collect()}
    assert got == {("a", 1): "x", ("", 3): None, ("b", 4): None, (None, 2): None, **{(None, i): None for i in range(10, 60)}}
    shared = evaluated_once(rows, "n")
    assert shared.unionByName(shared).count() == 2 * rows.count()


def test_texts_of_numbers(spark):
    from locusframe.functions.values import shortest_number

    values = [5e-8, 1e-4, 0.0005, 123.25, 1e7, 1.5e15, 1e16, -2.5e-10, 0.0, 9.999e22, -1e-3]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(shortest_number(F.col("v")).alias("t")).collect()
    assert [r.t for r in got] == [repr(v) for v in values]


def test_numbers_with_six_digits(spark):
    import random

    from locusframe.functions.values import general_number

    r = random.Random(3)
    values = [0.0, -0.0, 1.0, 10.0, 1e-4, 9.9999949e-5, 9.99999500001e-5, 0.1234565, 1.0000005, 1.0000015, 2097152.5, 999999.5, 999998.5, 1e15, 1e-16, 1e22, 3e-200, 1e-30, 0.5, 123456.5, 123457.5,
              float("inf"), float("-inf"), float("nan"), 1000.0, 1e6, 0.001, 1234565.0, 1234575.0, 12345650000.0, 100000.0, 99999.95]
    values += [r.choice((-1, 1)) * r.random() * 10.0 ** r.randrange(-15, 15) for _ in range(3000)]
    values += [r.randrange(10**6, 10**7) * 10.0 ** r.randrange(-14, 6) for _ in range(3000)]
    values += [(r.randrange(10**5, 10**6) + 0.5) / 2.0 ** r.randrange(0, 30) for _ in range(1000)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", general_number(F.col("v")).alias("t")).collect()
    assert [(row.v, row.t) for row in got if row.t != f"{row.v:.6g}"] == []
    assert spark.sql("SELECT CAST(null AS double) AS v").select(general_number(F.col("v")).alias("t")).first().t is None


def test_error_function(spark):
    import math

    from locusframe.functions.values import error_function

    values = [i / 64 for i in range(-450, 451)] + [0.46875, 4.0, 5.9999, 30.0, float("inf")]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", error_function(F.col("v")).alias("e")).collect()
    assert max(abs(r.e - math.erf(r.v)) for r in got) < 5e-16


def test_long_runs_are_cut():
    """An interval of 300 million positions under a driver of 1 GB: no row holds more than one block of positions."""
    import subprocess
    import sys

    code = """
from locusframe.session import get_session
from locusframe.operators import intervals as I
from pyspark.sql import functions as F
s = get_session("runs", "local[2]", **{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.driver.memory": "1g"})
one = s.createDataFrame([("c", 5, 300_000_005), ("c", 7, 7)], "chrom string, start bigint, end bigint")
print(*I.base_depth(one.where("start < end")).agg(F.count("*"), F.min("pos"), F.max("pos"), F.max("depth")).first())
print(*I.binned_coverage(one.where("start < end"), 10).agg(F.count("*"), F.min("start"), F.max("end")).first())
t = one.select(F.lit("t").alias("track"), "chrom", "start", "end", F.lit(2.0).alias("value"))
print(*I.binned_mean(t, 1000).agg(F.count("*"), F.min("value"), F.max("value")).first())
print(I.places(one, "at").groupBy(F.expr("at div 65536")).count().agg(F.max("count")).first()[0], I.cut_runs(one).agg(F.max(F.col("end") - F.col("start"))).first()[0])
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, timeout=600)
    assert out.stdout.split("\n")[:4] == ["300000000 6 300000005 1", "30000001 0 300000010", "300001 2.0 2.0", "65536 65536"], out.stderr[-2000:]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("check,table", [("check_wig", "wig_bad"), ("check_genepred", "genepred_bad"), ("check_chain", "chain_bad"), ("check_psl", "psl_bad")])
def test_every_rule_fires(spark, check, table):
    from locusframe.operators import quality
    from locusframe.plans import q_quality  # noqa: F401
    from locusframe.plans.views import view

    found = getattr(quality, check)(view(spark, SF, table))
    assert {(r.level, r.rule) for r in found.rule_counts().collect()} == {(r.level, r.name) for r in found.rules}
