"""Work that must not be shuffled, and small and large groups that must agree."""

import pytest

from locusframe.operators import cerna, conservation, quality
from locusframe.operators.align import liftover


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _segments(spark, n=12):
    seq = "ACGTACGTACGTACGTACGT"
    ids = [(f"t{b}_{i}", b, i) for b in range(3) for i in range(n)]
    q = spark.createDataFrame([("m", "l", s, seq) for s, _, _ in ids], "species string, mode string, segment_id string, seq string")
    t = spark.createDataFrame([("m", "l", s, seq[: 8 + i % 5] + "N" * (12 - i % 5)) for s, _, i in ids], q.schema)
    rows = [("m", "l", s, 100 * b + 7 * i, 100 * b + 7 * i + 40, "+-"[i % 3 == 0], [10, 15][: 1 + i % 2], [0, 25][: 1 + i % 2]) for s, b, i in ids]
    spans = spark.createDataFrame(rows, "species string, mode string, ids string, start bigint, end bigint, strand string, sizes array<bigint>, starts array<bigint>")
    exons = spark.createDataFrame([("m", "l", f"t{b}", 0, 600, [40, 50, 60], [0, 100, 200]) for b in range(3)], "species string, mode string, ids string, start bigint, end bigint, sizes array<bigint>, starts array<bigint>")
    return conservation.segment_scores(q, t), spans, exons


@pytest.mark.parametrize("distance", [5, 100_000])
def test_small_and_large_base_ids_agree(spark, monkeypatch, distance):
    sc, spans, exons = _segments(spark)
    found = []
    for small in (64, 2):
        monkeypatch.setattr(conservation, "SMALL", small)
        gone = conservation.duplicate_segments(sc, spans, 0.3)
        kept = sc.join(gone, [*conservation.RUN, "segment_id"], "left_anti")
        groups = conservation.nearby_groups(kept, spans, distance)
        table = conservation.aggregate_groups(kept, groups, spans, exons)
        found.append([sorted(map(str, x.select(*sorted(x.columns)).collect())) for x in (gone, groups, table)])
    assert found[0] == found[1] and all(found[0])


def test_repeated_segment_ids_take_the_general_path(spark, monkeypatch):
    sc, spans, _ = _segments(spark, 3)
    called, real = [], conservation._beaten
    monkeypatch.setattr(conservation, "_beaten", lambda pairs, keys: called.append(pairs.count()) or real(pairs, keys))
    conservation.duplicate_segments(sc, spans, 0.3)
    conservation.duplicate_segments(sc.unionByName(sc), spans, 0.3)
    assert called[0] == 0 and called[1] > 0


def test_words_without_a_seed_are_not_shuffled(spark):
    targets = spark.createDataFrame([("a", "ACGTACGTTTACGGA" * 20), ("b", "ACG")], "target string, seq string")
    seeds = spark.createDataFrame([("m1", "ACGTACG"), ("m2", "ACGTACG"), ("m3", "ACG")], "mirna string, seed string")
    sites = cerna.seed_sites(targets, seeds)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(cerna.seed_sites(targets, seeds))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan
    seq = "ACGTACGTTTACGGA" * 20
    want = sum(seq[i:i + 7] == "CGTACGT" for i in range(len(seq)))
    assert want and sites.count() == 2 * want


def test_a_lifted_span_is_exchanged_once(spark):
    spans = spark.createDataFrame([("c", 5, 15), ("c", 5, 15), ("c", 95, 130)], "chrom string, start bigint, end bigint")
    blocks = spark.createDataFrame([("c", 0, 100, "x", "n", 500, "+", 50)], "t_name string, t_from bigint, size bigint, chain_id string, q_name string, q_size bigint, q_strand string, q_from bigint")
    lifted = liftover(spans, blocks, 0.5)
    assert sorted(map(tuple, lifted.select("start", "fate", "new_start").collect())) == [(5, "mapped", 55), (5, "mapped", 55), (95, "partial", None)]
    assert _plan(lifted).count("REPARTITION_BY_COL") == 1 and "hashpartitioning(chrom#" in _plan(lifted)


@pytest.mark.parametrize("name", ["check_rmsk", "check_bedmethyl"])
def test_checks_do_not_shuffle_cells(lines, name):
    check = getattr(quality, name)(lines("chr1\t5\t6\tm\t3\t+\t5\t6\t0,0,0\t3\t50"))
    assert "c" not in check.rows.columns and "_broken" in check.rows.columns
