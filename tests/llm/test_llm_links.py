"""Jaccard and vector links against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusframe.llm import graph_dedup, ngram_join
from locusframe.llm.components import connected_components


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, n, num, den):
    sets = {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        k = min(n, len(words))
        sets[doc] = frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()
    docs = sorted(sets)
    links = [(a, b) for i, b in enumerate(docs) for a in docs[:i] if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    return sets, links


def near_copies(rng, families, copies):
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(families):
        base = rng.choices(words, k=rng.choice([1, 3, 4, 7, 8, 9, 10, 12, 15, 20, 40, 90, 300]))
        texts.append(" ".join(base))
        for _ in range(copies):
            other = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                at = rng.randrange(len(other))
                other[at : at + rng.choice([0, 1])] = rng.choice([[], [rng.choice(words)]]) or other[at : at + 1]
            texts.append(" ".join(other))
    return texts


@pytest.mark.parametrize("n,num,den", [(4, 85, 100), (5, 80, 100), (3, 50, 100)])
def test_marks_and_groups_lose_no_link(n, num, den):
    rng = random.Random(n)
    rows = list(enumerate(near_copies(rng, 40, 6)))
    sets, links = brute(rows, n, num, den)
    own = [ngram_join.ngram_set(t, n) for _, t in rows]
    assert [len(s) for s in own] == [len(sets[i]) for i, _ in rows]
    marks = [set(ngram_join.segment_marks(s, num, den).tolist()) for s in own]
    assert all(marks[a] & marks[b] for a, b in links if sets[a] != sets[b])
    found = {(min(q, o), max(q, o)) for q, others in ngram_join.group_links(own, np.zeros(len(own), np.int8), num, den, group=5) for o in others.tolist()}
    assert found == set(links)


def test_packed_marks_round_trip():
    rng = np.random.default_rng(1)
    marks, ids = rng.integers(0, 2**63, 500).astype(np.uint64), rng.integers(-(2**40), 2**40, 500)
    back = [(int(i), int(m)) for _, a, b in ngram_join.packed_marks(marks, ids, 7) for m, i in zip(*ngram_join.unpacked_marks(a, b))]
    assert sorted(back) == sorted((int(i), int(m & np.uint64((1 << 40) - 1))) for m, i in zip(marks, ids))


@pytest.mark.parametrize("block_bytes", [8 << 20, 3000])
def test_jaccard_components_equal_brute_force(spark, block_bytes):
    rng = random.Random(5)
    texts = near_copies(rng, 25, 5)
    texts += [texts[0]] * 3 + [texts[-1].upper(), None, "", " \t\n", "one", "ONE", "x " * 30_000]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"size": F.lit("clash"), "block": F.lit(1)})
    got = ngram_join.jaccard_components(docs, block_bytes=block_bytes).collect()
    sets, links = brute(rows, 4, 85, 100)
    want = components(sets, links)
    degree = {d: sum(d in pair for pair in links) for d in sets}
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got) == [(d, len(sets[d]), want[d], degree[d]) for d in sorted(sets)]


def test_jaccard_of_odd_tables(spark):
    frame = spark.createDataFrame([(None, "a b c d e"), (None, None), (3, "a b c d e"), (3, "a b c d e"), (4, "other words are in here")], "doc_id long, text string")
    got = sorted(ngram_join.jaccard_components(frame).collect(), key=str)
    assert len(got) == 5
    assert [(r.component_id, r.n_shingles) for r in got if r.doc_id == 3] == [(3, 2)] * 2
    assert sorted(r.n_shingles for r in got if r.doc_id is None) == [0, 2]
    assert ngram_join.jaccard_components(frame.limit(0)).collect() == []


def test_connected_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200, 260)] + [(5, i) for i in range(6, 40)] + [(1, 1), (None, 3), (300, 9)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = components({n for e in edges[:-3] for n in e} | {300, 9}, [e for e in edges if None not in e and e != (1, 1)])
    assert got == want


def vectors(rng, groups, size, dim=16):
    rows = []
    for g in range(groups):
        base = rng.normal(size=dim)
        rows += [(base + rng.normal(size=dim) * 0.05 * rng.random(), g % 3) for _ in range(size)]
    rows += [(rng.normal(size=dim), int(rng.integers(0, 3))) for _ in range(300)]
    return rows


@pytest.mark.parametrize("shard_rows,block_rows", [(1000, 6000), (60, 6000), (1000, 90)])
def test_vector_links_reach_the_recall(spark, shard_rows, block_rows):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(v)) for v in x], label) for i, (x, label) in enumerate(vectors(rng, 25, 12))]
    rows += [(2000, rows[0][1], rows[0][2]), (2001, rows[0][1], rows[0][2]), (2002, rows[0][1], (rows[0][2] + 1) % 3)]
    bad = [(3000, None, 0), (3001, [0.0] * 16, 0), (3002, [None, 1.0], 0), (3003, [float("nan"), 1.0], 1), (3004, [float("inf")] * 16, 1), (3005, rows[0][1], None),
           (3006, [], 0), (3007, [1.0], 0), (None, rows[0][1], rows[0][2])]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int").withColumn("unit", F.lit("clash"))
    got = {r.vec_id: r for r in graph_dedup.near_duplicates(frame, shard_rows=shard_rows, block_rows=block_rows).collect()}
    assert len(got) == len(rows) + len(bad)
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    ids = [r[0] for r in rows]
    found = np.array([got[i].n_links for i in ids])
    assert (found <= near.sum(axis=1)).all() and found.sum() >= 0.97 * near.sum()
    want = components(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(near)))])
    assert sum(got[i].component_id == want[i] for i in ids) >= 0.97 * len(ids)
    assert all(got[r[0]].n_links == 0 and got[r[0]].kept and got[r[0]].component_id == r[0] for r in bad)
    assert all(got[i].kept == (got[i].component_id == i) for i in ids)


def test_vector_links_of_empty_table(spark):
    assert graph_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_one_wide_group_loses_no_vector_links(spark):
    rng = np.random.default_rng(9)
    middle = rng.normal(size=64)
    x = middle / np.linalg.norm(middle) + rng.normal(size=(900, 64)) * 0.0285
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x.astype(np.float32))] + [(900 + i, x[i].astype(np.float32).tolist(), 1) for i in range(5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in graph_dedup.near_duplicates(frame, shard_rows=15, probes=1, max_probes=2).collect()}
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.93
    np.fill_diagonal(near, False)
    assert near.sum() > 400 * 900
    assert [got[i].n_links for i in range(len(rows))] == near.sum(axis=1).tolist()
    want = components(range(len(rows)), list(zip(*np.nonzero(np.triu(near)))))
    assert all(got[i].component_id == want[i] for i in range(len(rows)))


def test_clusters_beyond_the_bound_are_split_on_spark(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(v)) for v in x], label) for i, (x, label) in enumerate(vectors(rng, 60, 12))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    units = graph_dedup.unit_vectors(frame).select("vec_id", "label", "dim", "unit", F.lit(1).cast("long").alias("copies"))
    clusters = graph_dedup.fit_clusters(units, 20, most=6)
    assert clusters.split and 2 <= sum(map(len, clusters.centers.values())) <= 6
    placed = graph_dedup.assign(units, clusters, 2).toPandas()
    assert sorted(placed.vec_id) == list(range(len(rows))) and set(map(len, placed.shards)) == {2}
    counts = placed.explode("shards").groupby(["label", "shards"]).size()
    assert len(counts) > 3 * 6 and counts.median() < 100
    got = {r.vec_id: r.n_links for r in graph_dedup.near_duplicates(frame, shard_rows=20, most_centers=6).collect()}
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    found = np.array([got[i] for i in range(len(rows))])
    assert (found <= near.sum(axis=1)).all() and found.sum() >= 0.97 * near.sum()
