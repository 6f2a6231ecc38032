"""Near-duplicate vectors by a robust-pruned flat graph, built shard by shard.

Vectors of a label go to their nearest clusters (several each, so that shards overlap). Every shard builds a graph:
candidates are near neighbours and a few far ones, thinned by robust pruning, with reverse edges. A
vector's neighbours in all its shards are united. Each shard then searches for all its vectors at
once: greedily from the medoid, and from every vector found in range on to its neighbours in range.
Pairs are verified in double precision; after every round a brute-force audit of drawn vectors measures the
recall of all links, and of each label by the size of a vector's group. Labels that fall short are searched
again with more clusters per vector, and at last compared exactly, block by block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import stored
from locusframe.llm.components import connected_components
from locusframe.llm.ngram_join import Forest

VECTORS = "vec_id bigint, label bigint, dim int, unit binary, hash bigint"
LINKS = "label bigint, dim int, vec_id bigint, root bigint, links bigint"


def unit_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, label, dim, unit, hash) of comparable rows: double-precision unit vectors as bytes, and a hash of the given values."""

    def run(batches):
        for pdf in batches:
            out = []
            for vec, label, x in zip(pdf["vec_id"], pdf["label"], pdf["embedding"]):
                if x is None or len(x) == 0 or any(v is None for v in x):
                    continue
                a = np.asarray(x, np.float64)
                peak = np.abs(a).max()
                if not np.isfinite(a).all() or peak == 0:
                    continue
                a = a / peak
                a = a / np.sqrt((a * a).sum())
                out.append((int(vec), int(label), len(a), a.tobytes(), xxhash.xxh3_64_intdigest(a.tobytes()) - (1 << 63)))
            yield pd.DataFrame(out, columns=["vec_id", "label", "dim", "unit", "hash"])

    return rows.where("vec_id is not null and label is not null").mapInPandas(run, VECTORS)


def matrix(units: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)


def k_means(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centers = x[rng.permutation(len(x))[:k]]
    for _ in range(rounds):
        nearest = (x @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, x)
        size = np.sqrt((sums * sums).sum(axis=1))
        centers = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-12)[:, None], centers)
    return centers


@dataclass
class Clusters:
    """Coarse centres by (label, dim), and whether clusters are split further on Spark into shards of ``shard_rows``."""

    centers: dict[tuple[int, int], np.ndarray]
    split: bool
    shard_rows: int
    most: int
    per_cluster: int
    rounds: int
    seed: int


def _drawn(seed: int, share: Column) -> Column:
    scale = 1_000_000_000
    return F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(scale)) < F.least(F.lit(1.0), share) * scale


def fit_clusters(vectors: DataFrame, shard_rows: int, per_cluster: int = 24, rounds: int = 6, most: int = 400, seed: int = 7) -> Clusters:
    """Clusters of the labels with more than ``shard_rows`` vectors, one per ``shard_rows`` while that makes up to ``most`` in all.

    Larger tables get at most ``most`` coarse centres, shared among the labels by their sizes, and ``split_clusters`` cuts
    what they hold. Centres are fitted on about ``per_cluster`` vectors each, drawn by a seeded hash of the
    id, so the driver holds at most about ``most * per_cluster`` vectors.
    """
    sizes = vectors.groupBy("label", "dim").count().where(F.col("count") > shard_rows).withColumn("wanted", F.ceil(F.col("count") / shard_rows))
    sizes = stored(sizes)
    total = sizes.agg(F.sum("wanted")).first()[0] or 0
    split = total > most
    share = min(1.0, most / max(total, 1))
    sizes = sizes.select("label", "dim", "count", F.floor(F.col("wanted") * share + 1e-9).cast("int").alias("k")).where("k > 1")
    keys = {(r["label"], r["dim"]): r["k"] for r in sizes.collect()}
    out = {}
    if keys:
        drawn = vectors.select("label", "dim", "vec_id", "unit").join(F.broadcast(sizes), ["label", "dim"]).where(_drawn(seed, per_cluster * F.col("k") / F.col("count")))
        drawn = drawn.select("label", "dim", "vec_id", "unit").toPandas().sort_values("vec_id")
        rng = np.random.default_rng(seed)
        for key, part in drawn.groupby(["label", "dim"]):
            key = int(key[0]), int(key[1])
            out[key] = k_means(matrix(part["unit"]), keys[key], rounds, rng)
    return Clusters(out, split, shard_rows, most, per_cluster, rounds, seed)


def split_clusters(rows: DataFrame, clusters: Clusters, probes: int) -> DataFrame:
    """``shards`` anew: the ``probes`` nearest of the finer clusters inside a vector's coarse ones.

    The finer centres of a coarse cluster, at most ``most``, are fitted in one task on a bounded sample; its vectors meet
    them in groups of about 5,000.
    """
    key, columns = ["label", "dim", "coarse"], [c for c in rows.columns if c != "shards"]
    own = "label bigint, dim int, coarse int"
    sizes = rows.select("label", "dim", (1 / F.size("shards")).alias("part"), F.explode("shards").alias("coarse")).groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.sum("part").alias("whole"))
    sizes = stored(sizes.select(*key, "n", F.least(F.lit(clusters.most), F.ceil(F.col("whole") / clusters.shard_rows)).cast("int").alias("k"), F.ceil(F.col("n") / 5000).cast("int").alias("parts")))
    at = stored(rows.withColumn("coarse", F.explode("shards")).drop("shards").join(sizes, key).withColumn("part", F.pmod(F.xxhash64(F.lit(clusters.seed), "vec_id"), F.col("parts")).cast("int")))
    per_cluster, rounds, seed, most = clusters.per_cluster, clusters.rounds, clusters.seed, clusters.most

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        found = k_means(matrix(pdf["unit"]), int(pdf["k"].iat[0]), rounds, np.random.default_rng(seed))
        return pdf[[*key, "parts"]].head(1).assign(centers=[found.tobytes()])

    sample = at.where(_drawn(seed + 1, (per_cluster * F.col("k") + 8) / F.col("n"))).select(*key, "parts", "k", "vec_id", "unit")
    fits = stored(sample.groupBy(*key).applyInPandas(fit, own + ", parts int, centers binary"))
    fits = fits.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def place(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame(columns=[*columns, "shard", "sim"])
        x = matrix(left["unit"])
        c = np.frombuffer(right["centers"].iat[0], np.float64).reshape(-1, x.shape[1]) if len(right) else np.zeros((1, x.shape[1]))
        sims = x @ c.T
        near = np.argsort(-sims, axis=1)[:, :probes]
        row = np.arange(len(x)).repeat(near.shape[1])
        near = near.ravel()
        return left.iloc[row][columns].assign(shard=left["coarse"].to_numpy()[row] * most + near, sim=sims[row, near])

    kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes if n != "shards")
    placed = at.groupBy(*key, "part").cogroup(fits.groupBy(*key, "part")).applyInPandas(place, kinds + ", shard int, sim double")
    best = F.slice(F.sort_array(F.collect_list(F.struct("sim", "shard")), False), 1, probes)
    return placed.groupBy(*columns).agg(F.array_sort(F.transform(best, lambda s: s["shard"])).alias("shards"))


def assign(vectors: DataFrame, clusters: Clusters, probes: int) -> DataFrame:
    """Add ``shards``: the ``probes`` nearest clusters of each vector, in ascending order."""
    shared = vectors.sparkSession.sparkContext.broadcast(clusters.centers)
    columns = vectors.columns

    def run(batches):
        for pdf in batches:
            shards = np.empty(len(pdf), object)
            for (label, dim), at in pdf.groupby(["label", "dim"]).indices.items():
                c = shared.value.get((int(label), int(dim)))
                if c is None or len(c) == 1:
                    for i in at:
                        shards[i] = np.zeros(1, np.int32)
                    continue
                near = np.sort(np.argsort(-(matrix(pdf["unit"].iloc[at]) @ c.T), axis=1)[:, :probes], axis=1).astype(np.int32)
                for i, row in zip(at, near):
                    shards[i] = row
            yield pdf.assign(shards=shards)[[*columns, "shards"]]

    rows = vectors.mapInPandas(run, ", ".join(f"{n} {t}" for n, t in vectors.dtypes) + ", shards array<int>")
    return split_clusters(stored(rows), clusters, probes) if clusters.split else rows


def build_graph(x: np.ndarray, degree: int, alpha: float, near: int = 48, far: int = 24, seed: int = 1) -> list[np.ndarray]:
    """Neighbour lists by robust pruning: a candidate goes when a kept one is ``alpha`` times nearer to it than the vector is."""
    n = len(x)
    rng = np.random.default_rng(seed)
    near = min(near, n - 1)
    if near <= 0:
        return [np.empty(0, np.int64) for _ in range(n)]
    out: list[list[int]] = [[] for _ in range(n)]
    for a in range(0, n, 256):
        rows = np.arange(a, min(a + 256, n))
        sims = x[rows] @ x.T
        sims[np.arange(len(rows)), rows] = -2
        cand = np.argpartition(-sims, near - 1, axis=1)[:, :near]
        cand = np.hstack([cand, rng.integers(0, n, (len(rows), far))])
        s = np.take_along_axis(sims, cand, axis=1)
        order = np.argsort(-s, axis=1, kind="stable")
        cand, s = np.take_along_axis(cand, order, axis=1), np.take_along_axis(s, order, axis=1)
        dist = np.maximum(2 - 2 * s, 0)
        points = x[cand]
        between = np.maximum(2 - 2 * np.einsum("rcd,red->rce", points, points), 0)
        alive = (s > -1.5) & np.concatenate([np.ones((len(rows), 1), bool), cand[:, 1:] != cand[:, :-1]], axis=1)
        kept = np.zeros_like(alive)
        for c in range(cand.shape[1]):
            take = alive[:, c] & (kept.sum(axis=1) < degree)
            kept[take, c] = True
            alive &= ~(take[:, None] & (alpha * alpha * between[:, c, :] <= dist))
        for i, row in enumerate(rows):
            out[row] += cand[i, kept[i]].tolist()
    back: list[list[int]] = [[] for _ in range(n)]
    for i, ns in enumerate(out):
        for j in ns:
            if len(back[j]) < 2 * degree:
                back[j].append(i)
    return [np.unique(np.array(a + b, np.int64)) for a, b in zip(out, back)]


def range_search(x: np.ndarray, neighbours: np.ndarray, threshold: float, beam: int = 24, step: int = 512):
    """Pairs (query, found) with cosine of at least ``threshold`` by greedy search from the medoid, then expansion in range.

    ``neighbours`` is a padded table of neighbour indexes (-1: none). All vectors are queries, in steps.
    """
    n, width = neighbours.shape
    middle = x.mean(axis=0)
    medoid = int((x @ middle).argmax())
    beam = min(beam, n)
    for a in range(0, n, step):
        q = np.arange(a, min(a + step, n))
        m = len(q)
        seen = np.zeros((m, n), bool)
        ids = np.full((m, beam), -1)
        sims = np.full((m, beam), -2.0)
        open_ = np.zeros((m, beam), bool)
        ids[:, 0], sims[:, 0], open_[:, 0] = medoid, x[q] @ x[medoid], True
        seen[:, medoid] = True
        found_q, found_p = [np.arange(m), np.flatnonzero(sims[:, 0] >= threshold)], [q, np.full(int((sims[:, 0] >= threshold).sum()), medoid)]
        for _ in range(3 * beam):
            best = np.where(open_, sims, -3).argmax(axis=1)
            act = np.flatnonzero(open_[np.arange(m), best])
            if len(act) == 0:
                break
            open_[act, best[act]] = False
            nb = neighbours[ids[act, best[act]]]
            fresh = (nb >= 0) & ~seen[act[:, None], nb]
            seen[act[:, None].repeat(width, 1)[fresh], nb[fresh]] = True
            s = np.where(fresh, np.einsum("ad,awd->aw", x[q[act]], x[nb]), -2.0)
            r, c = np.nonzero(s >= threshold)
            found_q.append(act[r])
            found_p.append(nb[r, c])
            all_s, all_i = np.hstack([sims[act], s]), np.hstack([ids[act], nb])
            all_o = np.hstack([open_[act], fresh])
            top = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
            sims[act], ids[act], open_[act] = (np.take_along_axis(z, top, axis=1) for z in (all_s, all_i, all_o))
            open_[act] &= sims[act] > -2
        inside = np.zeros((m, n), bool)
        fq, fp = np.concatenate(found_q), np.concatenate(found_p)
        inside[fq, fp] = True
        fq, fp = np.nonzero(inside)
        tried = inside.copy()
        while len(fq):
            new_q, new_p = [], []
            for b in range(0, len(fq), 20_000):
                rq, nb = fq[b : b + 20_000], neighbours[fp[b : b + 20_000]]
                i, j = np.nonzero((nb >= 0) & ~tried[rq[:, None], nb])
                key = np.unique(rq[i] * n + nb[i, j])
                kq, kp = key // n, key % n
                tried[kq, kp] = True
                good = np.einsum("ad,ad->a", x[q[kq]], x[kp]) >= threshold
                new_q.append(kq[good])
                new_p.append(kp[good])
            fq, fp = np.concatenate(new_q), np.concatenate(new_p)
            inside[fq, fp] = True
        r, p = np.nonzero(inside)
        other = q[r] != p
        yield q[r[other]], p[other]


def _padded(lists: list[np.ndarray]) -> np.ndarray:
    out = np.full((len(lists), max([1, *map(len, lists)])), -1, np.int64)
    for i, row in enumerate(lists):
        out[i, : len(row)] = row
    return out


def _build(degree: int, alpha: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        graph, ids = build_graph(matrix(pdf["unit"]), degree, alpha), pdf["vec_id"].to_numpy(np.int64)
        return pd.DataFrame({"vec_id": ids, "neighbours": [ids[g] for g in graph]})

    return run


def _search(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        x, ids, copies = matrix(pdf["unit"]), pdf["vec_id"].to_numpy(np.int64), pdf["copies"].to_numpy(np.int64)
        place = {v: i for i, v in enumerate(ids.tolist())}
        graph = _padded([np.array([place[v] for v in row.tolist() if v in place], np.int64) for row in pdf["neighbours"]])
        here, apart = int(pdf["shard"].iat[0]), bool(pdf["apart"].iat[0])
        shards, block = _padded([np.asarray(s, np.int64) for s in pdf["shards"]]), pdf["block"].to_numpy()
        pairs = []
        for q, p in range_search(x, graph, threshold):
            ok = block[q] != block[p] if apart else np.ones(len(q), bool)
            for k in range(shards.shape[1]):  # a pair counts in the lowest shard that both are in
                first = shards[q, k]
                ok &= ~((first >= 0) & (first < here) & (shards[p] == first[:, None]).any(axis=1))
            q, p = q[ok], p[ok]
            pairs.append(np.minimum(q, p) * len(ids) + np.maximum(q, p))
        pairs = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
        a, b = pairs // max(len(ids), 1), pairs % max(len(ids), 1)
        true = np.einsum("ad,ad->a", x[a], x[b]) >= threshold  # verified, once per pair
        a, b = a[true], b[true]
        links, forest = np.zeros(len(ids), np.int64), Forest(len(ids))
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        for i, j in zip(a.tolist(), b.tolist()):
            i, j = forest.find(i), forest.find(j)
            if i != j:
                forest.parent[max(i, j)] = min(i, j)
        hit = np.flatnonzero(links)
        roots = np.array([forest.find(i) for i in hit.tolist()], np.int64)
        out = pd.DataFrame({"vec_id": ids[hit], "root": ids[roots] if len(hit) else ids[:0], "links": links[hit]})
        return out.assign(label=pdf["label"].iat[0], dim=pdf["dim"].iat[0])[["label", "dim", "vec_id", "root", "links"]]

    return run


def _in_blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """One row per vector, shard and pair of blocks; shards of up to ``block_rows`` vectors are one block."""
    rows = rows.withColumn("shard", F.explode("shards"))
    sizes = rows.groupBy("label", "dim", "shard").count().select("label", "dim", "shard", F.ceil(F.col("count") / block_rows).cast("int").alias("blocks"))
    rows = rows.join(sizes, ["label", "dim", "shard"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    return rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("apart", F.col("other") != F.col("block"))


def search_links(vectors: DataFrame, clusters: Clusters, threshold: float, probes: int, degree: int, alpha: float, block_rows: int) -> DataFrame:
    """(label, dim, vec_id, root, links) by shard for vectors (vec_id, label, dim, unit, copies)."""
    rows = stored(_in_blocks(assign(vectors, clusters, probes), block_rows))
    key = ["label", "dim", "shard", F.least("block", "other"), F.greatest("block", "other")]
    lists = rows.select("label", "dim", "shard", "block", "other", "vec_id", "unit").groupBy(*key).applyInPandas(_build(degree, alpha), "vec_id bigint, neighbours array<bigint>")
    united = stored(lists.select("vec_id", F.explode_outer("neighbours").alias("n")).distinct().groupBy("vec_id").agg(F.collect_list("n").alias("neighbours")))
    return stored(rows.join(united, "vec_id").groupBy(*key).applyInPandas(_search(threshold), LINKS))


def short_labels(vectors: DataFrame, found: DataFrame, threshold: float, recall: float, least: float, queries: int = 512, seed: int = 31) -> Column | None:
    """Condition for the vectors whose links must be searched again, None when enough were found.

    Brute force over all vectors in batches gives the true links of drawn vectors. All labels fall short when the mean recall of the
    drawn vectors is below ``recall``, else those where it is below ``least`` among vectors with about the same number of true links.
    """
    total = vectors.count()
    scale = 1_000_000_000
    drawn = vectors.where(F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(scale)) < int(scale * min(1.0, queries / max(total, 1)))).select("vec_id", "label", "dim", "unit").toPandas()
    if not len(drawn):
        return None
    shared = vectors.sparkSession.sparkContext.broadcast(drawn)

    def run(batches):
        asked = shared.value
        for pdf in batches:
            for key, at in pdf.groupby(["label", "dim"]).indices.items():
                own = asked[(asked["label"] == key[0]) & (asked["dim"] == key[1])]
                if not len(own):
                    continue
                part = pdf.iloc[at]
                near = (matrix(own["unit"]) @ matrix(part["unit"]).T) >= threshold
                near &= own["vec_id"].to_numpy()[:, None] != part["vec_id"].to_numpy()[None, :]
                yield pd.DataFrame({"label": key[0], "dim": key[1], "vec_id": own["vec_id"].to_numpy(), "true": near @ part["copies"].to_numpy(np.int64)})

    key = ["label", "dim", "vec_id"]
    true = vectors.mapInPandas(run, "label bigint, dim int, vec_id bigint, true bigint").groupBy(*key).agg(F.sum("true").alias("true")).where(F.col("true") > 0)
    got = found.groupBy(*key).agg(F.sum("links").alias("got"))
    judged = true.join(got, key, "left").select("label", "dim", F.floor(F.log2("true")).alias("size"), F.least(F.lit(1.0), F.coalesce("got", F.lit(0)) / F.col("true")).alias("share")).toPandas()
    if not len(judged):
        return None
    if judged["share"].mean() < recall:
        return F.lit(True)
    groups = judged.groupby(["label", "dim", "size"])["share"].mean()
    short = sorted({f"{label}:{dim}" for label, dim, _ in groups[groups < least].index})
    return F.concat_ws(":", "label", "dim").isin(short) if short else None


def _compare(shared, threshold: float, cells: int = 2_000_000):
    def run(batches):
        asked = shared.value
        forests = {key: Forest(len(ids)) for key, (ids, _, _) in asked.items()}
        names = {key: np.arange(len(ids)) for key, (ids, _, _) in asked.items()}
        for pdf in batches:
            vec = pdf["vec_id"].to_numpy(np.int64)
            for key, at in pdf.groupby(["label", "dim"]).indices.items():
                key = int(key[0]), int(key[1])
                if key not in asked:
                    continue
                ids, x, copies = asked[key]
                y, forest, step = matrix(pdf["unit"].iloc[at]), forests[key], max(1, cells // len(ids))
                for a in range(0, len(at), step):
                    own = vec[at[a : a + step]]
                    hit = ((y[a : a + step] @ x.T) >= threshold) & (own[:, None] != ids[None, :])
                    rows = np.flatnonzero(hit.any(axis=1))
                    if not len(rows):
                        continue
                    hit = hit[rows]
                    low, high = np.where(hit, names[key], len(ids)).min(axis=1), np.where(hit, names[key], -1).max(axis=1)
                    for i in np.flatnonzero(low != high):  # the asked vectors this one joins are one group
                        group = sorted({forest.find(k) for k in np.unique(names[key][hit[i]]).tolist()})
                        for k in group[1:]:
                            forest.parent[k] = group[0]
                    parent = np.asarray(forest.parent)
                    while (parent[parent] != parent).any():
                        parent = parent[parent]
                    names[key] = parent
                    links = (hit.astype(np.float64) @ copies).astype(np.int64)
                    yield pd.DataFrame({"label": key[0], "dim": key[1], "vec_id": own[rows], "root": ids[hit.argmax(axis=1)], "links": links})
        for key, (ids, _, _) in asked.items():
            moved = np.flatnonzero(names[key] != np.arange(len(ids)))
            if len(moved):
                yield pd.DataFrame({"label": key[0], "dim": key[1], "vec_id": ids[moved], "root": ids[names[key][moved]], "links": 0})

    return run


def exact_links(vectors: DataFrame, threshold: float, block_bytes: int = 32 << 20) -> DataFrame:
    """(label, dim, vec_id, root, links) by comparing all vectors of a label, without a shuffle.

    Blocks of about ``block_bytes`` of vectors are broadcast in turn and all vectors pass each block once.
    """
    spark = vectors.sparkSession
    blocks = max(1, -(-(vectors.agg(F.sum(F.octet_length("unit"))).first()[0] or 0) // block_bytes))
    out = None
    for block in range(blocks):
        pdf = vectors.where(F.pmod(F.xxhash64(F.lit(53), "label", "vec_id"), F.lit(blocks)) == block).select("label", "dim", "vec_id", "unit", "copies").toPandas()
        shared = spark.sparkContext.broadcast({(int(k[0]), int(k[1])): (p["vec_id"].to_numpy(np.int64), matrix(p["unit"]), p["copies"].to_numpy(np.float64)) for k, p in pdf.groupby(["label", "dim"])})
        found = stored(vectors.mapInPandas(_compare(shared, threshold), LINKS))
        out = found if out is None else out.unionByName(found)
        shared.unpersist()
    return out


def near_duplicates(rows: DataFrame, threshold: float = 0.93, shard_rows: int = 1000, probes: int = 2, degree: int = 24, alpha: float = 1.2,
                    block_rows: int = 6000, recall: float = 0.98, max_probes: int = 8, least: float = 0.9, most_centers: int = 400) -> DataFrame:
    """One row per input row (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Rows link when their labels are equal and the cosine is at least ``threshold``. Null labels, null, empty or zero
    vectors and vectors with null or non-finite components link with nothing, and so do vectors of
    different lengths. ``n_links`` counts other rows linked directly, ``component_id`` is the smallest id reachable, ``kept``
    marks ids that are their component's. A null id links with nothing, has a null component and is
    kept. Equal vectors are searched once. Labels whose audited recall stays below ``recall`` over all drawn vectors, or below
    ``least`` in a size of group, are compared exactly after the round of ``max_probes``. Empty tables give no rows. Other columns of the
    input, whatever their names, are neither read nor returned.
    """
    base = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    units = stored(unit_vectors(base))
    sets = units.groupBy("label", "dim", "hash").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("unit").alias("unit"))
    sets = stored(sets)
    vectors = sets.select(F.col("rep").alias("vec_id"), "label", "dim", "unit", "copies")
    clusters = fit_clusters(vectors, shard_rows, most=most_centers)
    found, rest = None, vectors
    while True:
        links = search_links(rest, clusters, threshold, probes, degree, alpha, block_rows)
        short = short_labels(rest, links, threshold, recall, least)
        enough = links if short is None else links.where(~short)
        found = enough if found is None else found.unionByName(enough)
        if short is None:
            break
        rest = stored(rest.where(short))
        if probes >= max_probes:
            found = found.unionByName(exact_links(rest, threshold))
            break
        probes *= 2
    copies = units.join(sets.drop("unit"), ["label", "dim", "hash"]).select("vec_id", "rep", "copies")
    ties = copies.where("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    component = connected_components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")).unionByName(ties))
    links = found.groupBy(F.col("vec_id").alias("rep")).agg(F.sum("links").alias("links"))
    linked = copies.join(links, "rep", "left").groupBy("vec_id").agg(F.max(F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = base.select("vec_id").join(linked, "vec_id", "left").join(component, F.col("vec_id") == F.col("node"), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
