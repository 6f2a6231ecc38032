"""Operators against literal loops on random small inputs."""

import random

import pytest
from pyspark.sql import functions as F

from locusframe.operators import cerna, conservation, intervals, methylation
from locusframe.operators.ordered import position_block, running

SPAN = "chrom string, start bigint, end bigint, id bigint"


def spans(spark, n, seed, longest):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        s = r.randrange(5_000_000)
        rows.append((r.choice("ab"), s, s + 1 + int(r.random() ** 4 * longest), i))
    return rows, spark.createDataFrame(rows, SPAN)


@pytest.mark.parametrize("short", [None, "right"])
def test_interval_join(spark, short):
    ra, a = spans(spark, 300, 1, 4_000_000)
    rb, b = spans(spark, 300, 2, 4_000_000 if short is None else 50)
    want = sorted((x[3], y[3]) for x in ra for y in rb if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    assert sorted((r.id, r.id_b) for r in intervals.interval_join(a, b, short_side=short).collect()) == want


def test_union_and_depth(spark):
    rows, df = spans(spark, 200, 3, 3000)
    rows = [(c, s % 4000, s % 4000 + e - s, i) for c, s, e, i in rows]
    df = spark.createDataFrame(rows, SPAN)
    want = {c: len({p for x in rows if x[0] == c for p in range(x[1], x[2])}) for c in "ab"}
    assert {r.chrom: r.union_length for r in intervals.union_length(df).collect()} == want
    total = sum(x[2] - x[1] for x in rows)
    assert intervals.coverage_depth(df).select(F.sum((F.col("end") - F.col("start")) * F.col("depth"))).first()[0] == total


def test_running_over_blocks(spark):
    r = random.Random(4)
    rows = [(1 if r.random() < 0.7 else 2, p, r.choice([None, r.randrange(9)])) for p in r.sample(range(4000), 400)]
    df = spark.createDataFrame(rows, "k int, pos bigint, v bigint")
    got = running(df, ["k"], ["pos"], position_block("pos", 6), {"s": ("sum", F.col("v")), "l": ("last", F.col("v")), "m": ("max", F.col("v"))}, exclusive=True)
    for row in got.collect():
        before = [v for k, p, v in sorted(rows, key=lambda x: x[1]) if k == row.k and p < row.pos and v is not None]
        assert (row.s, row.l, row.m) == (sum(before), before[-1] if before else None, max(before, default=None))


def segments(seed, n):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        s = r.randrange(400)
        rows.append(("m", "lnc", f"tx{i % 3}_{i}", f"tx{i % 3}", s, s + r.randrange(20, 90), r.choice("+-"), r.randrange(12)))
    return rows


def overlap_share(a, b):
    return max(0, min(a[5], b[5]) - max(a[4], b[4])) / min(a[5] - a[4], b[5] - b[4])


def touching(rows, near):
    """All pairs of a base id that ``near`` accepts, in the order of their ids."""
    return sorted((a[2], b[2], a, b) for a in rows for b in rows if a[3] == b[3] and a[2] < b[2] and near(a, b))


def judged(pairs):
    """Who is gone after the pairs (i, j, loser) are judged one after the other."""
    gone = set()
    for i, j, loser in pairs:
        if gone.isdisjoint((i, j)):
            gone.add(loser)
    return gone


def test_duplicate_pass(spark):
    rows = segments(5, 40)
    close = touching(rows, lambda a, b: a[5] >= b[4] and b[5] >= a[4] and overlap_share(a, b) >= 0.5)
    gone = judged([(i, j, j if a[7] >= b[7] else i) for i, j, a, b in close])
    sc = spark.createDataFrame([(x[0], x[1], x[2], x[3], x[7]) for x in rows], "species string, mode string, segment_id string, base_id string, matched_length bigint")
    b = spark.createDataFrame([(x[0], x[1], x[2], x[4], x[5], x[6], [], []) for x in rows],
                              "species string, mode string, ids string, start bigint, end bigint, strand string, sizes array<bigint>, starts array<bigint>")
    assert {r.segment_id for r in conservation.duplicate_segments(sc, b, 0.5).collect()} == gone


def beaten(spark, pairs):
    trace = []
    table = spark.createDataFrame([("m", "lnc", i, j, loser == j) for i, j, loser in pairs], "species string, mode string, i long, j long, keeps_i boolean")
    got = [r.segment_id for r in conservation._beaten(table, ["species", "mode"], trace).collect()]
    assert len(got) == len(set(got)) and set(got) == judged(sorted(pairs))
    return len(trace) + sum(trace)


def test_chains_of_ties_and_falling_scores_take_logarithmic_rounds(spark):
    n = 32_768
    assert beaten(spark, [(i, i + 1, i + 1) for i in range(n - 1)]) <= 20
    falling = [(i, i + 1, i + 1 if i % 1000 < 990 else i) for i in range(n - 1)]
    assert beaten(spark, falling) <= 20


def test_pairs_that_wait_for_several_others(spark):
    r = random.Random(11)
    pairs = {(i, j) for i in range(60) for j in r.sample(range(60), 4) if i < j}
    beaten(spark, [(i, j, r.choice((i, j))) for i, j in pairs])


def test_duplicate_pass_over_one_long_island(spark):
    n = 50_000
    r = random.Random(9)
    score = [r.randrange(100) for _ in range(n)]
    gone = judged((i, i + 1, i + 1 if score[i] >= score[i + 1] else i) for i in range(n - 1))  # each segment of 10 overlaps the next one by 6
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(score)], "i long, matched_length long").selectExpr(
        "'m' AS species", "'lnc' AS mode", "concat('tx_', lpad(cast(i AS string), 6, '0')) AS segment_id", "'tx' AS base_id", "matched_length", "i")
    spans = rows.selectExpr("species", "mode", "segment_id AS ids", "i * 4 AS start", "i * 4 + 10 AS end", "'+' AS strand", "array(10L) AS sizes", "array(0L) AS starts")
    got = {int(x.segment_id[3:]) for x in conservation.duplicate_segments(rows.drop("i"), spans).collect()}
    assert got == gone


def test_nearby_labels(spark):
    rows = segments(6, 45)
    label = {x[2]: x[2] for x in rows}
    for i, j, _, _ in touching(rows, lambda a, b: a[6] == b[6] and max(b[4] - a[5], a[4] - b[5]) <= 15):
        label[i] = label[j] = min(label[i], label[j])
    numbers = {base: sorted({label[x[2]] for x in rows if x[3] == base}) for base in {x[3] for x in rows}}
    want = {x[2]: f"{x[3]}_{numbers[x[3]].index(label[x[2]]) + 1}" for x in rows}
    kept = spark.createDataFrame([(x[0], x[1], x[3], x[2]) for x in rows], "species string, mode string, base_id string, segment_id string")
    sp = spark.createDataFrame([(x[0], x[1], x[2], x[4], x[5], x[6]) for x in rows], "species string, mode string, ids string, start bigint, end bigint, strand string")
    assert {r.segment_id: r.grouped_id for r in conservation.nearby_groups(kept, sp, 15).collect()} == want


def test_long_chain_of_nearby_segments(spark):
    """20,000 members in a row, near only to the next one: the label passes along as the ids rise."""
    n = 20_000
    rows = spark.range(n).selectExpr("'m' AS species", "'lnc' AS mode", "'tx' AS base_id", "concat('tx_', lpad(cast(id AS string), 6, '0')) AS segment_id", "id * 100 AS start", "id * 100 + 95 AS end")
    got = conservation.nearby_groups(rows, rows.selectExpr("species", "mode", "segment_id AS ids", "start", "end", "'+' AS strand"), 10)
    assert [(r.grouped_id, r.n) for r in got.groupBy("grouped_id").agg(F.count("*").alias("n")).collect()] == [("tx_1", n)]


@pytest.mark.parametrize("order, distance", [("id", 210), ("(id * 7919) % 20011", 210)])
def test_labels_pass_along_chains_in_few_rounds(spark, order, distance):
    n = 20_011
    rows = spark.range(n).selectExpr(
        "'m' AS species", "'lnc' AS mode", "'tx' AS base_id", "'+' AS strand", "0L AS island", f"concat('tx_', lpad(cast({order} AS string), 6, '0')) AS segment_id",
        "id * 100 AS start", "id * 100 + 95 AS end")
    at = {int(r.segment_id[3:]): r.start // 100 for r in rows.collect()}
    member = {place: no for no, place in at.items()}
    label = {no: no for no in at}
    steps = range(1, (distance - 5) // 100 + 2)
    for no in sorted(at):
        for other in sorted(o for k in steps for o in (member.get(at[no] - k), member.get(at[no] + k)) if o is not None and o > no):
            label[no] = label[other] = min(label[no], label[other])
    rounds = []
    got = conservation._passed_labels(rows, distance, rounds)
    assert {int(r.segment_id[3:]): int(r.label_id[3:]) for r in got.collect()} == label
    assert rounds[0] <= 20


def test_sites_and_windows(spark):
    r = random.Random(7)
    def sites(n):
        return [("m", r.choice("xy"), "-", "-", s, s + r.randrange(3, 30)) for s in (r.randrange(1, 200) for _ in range(n))]
    schema = "mirna string, target string, score string, energy string, start bigint, end bigint"
    m, t = sites(60), sites(40)
    dm, dt = spark.createDataFrame(m, schema), spark.createDataFrame(t, schema)
    want = sorted(x for x in m if any(y[1] == x[1] and y[4] >= x[4] and y[5] <= x[5] for y in t))
    assert sorted(tuple(x) for x in cerna.containing_sites(dm, dt).collect()) == want
    hit = sorted({x for x in m for y in t if x[1] == y[1] and any(k + 1 >= y[4] and k + 6 <= y[5] for k in range(x[4] - 1, x[5] - 8))})
    assert sorted(tuple(x) for x in cerna.sites_sharing_window(dm, dt).collect()) == hit
    assert sorted({tuple(x) for x in cerna.shared_windows(dm, dt).collect()}) == hit


def test_rank_test_p_value(spark):
    vals = [("d", "body", "g1", f"s{i}", "case" if i < 4 else "control", float(v)) for i, v in enumerate([9, 8, 7, 7, 1, 2, 7, 3])]
    v = spark.createDataFrame(vals, "dataset string, region string, gene_id string, sample string, class string, value double")
    sizes = methylation.class_sizes(v.select("dataset", "sample", "class").distinct())
    grid = spark.createDataFrame([("d", "body", "g1"), ("d", "body", "g2")], "dataset string, region string, gene_id string")
    out = {r.gene_id: r for r in methylation.wilcox_calls(methylation.rank_statistics(v, sizes, grid)).collect()}
    # ranks of the cases: 8, 7, 5, 5 -> U = 16 - (25 - 10) = 1, one tie of three
    assert (out["g1"].u, out["g1"].tie_sum) == (1.0, 24.0)
    assert abs(out["g1"].p - 0.0384) < 5e-4 and out["g2"].p == 1.0 and out["g1"].direction == "High"
