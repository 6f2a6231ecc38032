"""Exact Jaccard self-join of word-n-gram sets by token-group matrices.

1. Every text becomes its set of n-gram hashes; equal sets meet under one representative.
2. Partition into groups of similar documents. The hash space is cut into k segments, with k larger
   than the most tokens by which two linked sets of a size class can differ; so two linked sets
   agree in whole segments. Sets that agree in a segment fall into one family; families are
   connected components of these agreements and no link crosses them. A family too large for one task is
   not gathered: its sets meet in smaller groups, one for each first document they agree with.
3. Inside a family, groups of similar sets keep the union of their tokens (the token-group matrix).
   For a query set its overlap with a group's union bounds its overlap with each member; only groups
   that reach the bound are opened and their members verified by exact set overlap.

A group that is still beyond ``block_bytes`` is cut into blocks, and each pair of blocks is a task of its own.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import bounded_broadcast, mix, shuffle_partitions, stored, windows, word_hashes
from locusframe.llm.components import connected_components

SEEDS = 2


def ngram_set(text: str | None, n: int) -> np.ndarray:
    """Sorted hashes of the distinct n-word runs; the whole sequence as one run where it is shorter."""
    words = word_hashes(text)
    if len(words) == 0:
        return words
    return np.unique(windows(words, min(n, len(words))))


def set_hash(tokens: np.ndarray) -> int:
    """A signed 64-bit hash of a set, the same for any order of its tokens."""
    return int(mix(tokens + np.uint64(77)).sum(dtype=np.uint64).view(np.int64)) ^ len(tokens)


def needed(a, b, num: int, den: int):
    """Least overlap with which sets of a and b tokens link: overlap * (num + den) >= num * (a + b)."""
    return -(-num * (a + b) // (num + den))


@lru_cache(maxsize=None)
def size_class(c: int, num: int, den: int) -> tuple[int, int, int, int, int]:
    """(lowest size, size bound, segments, short segments allowed, tokens of a segment that is not short) of class c.

    No segments where only equal sets link. A segment is short below two tokens, or, where a low similarity leaves
    too many of these, if empty.
    """
    low = 1
    for _ in range(c):
        low = max(low + 1, math.ceil(low * (den / num) ** 2))
    high = max(low + 1, math.ceil(low * (den / num) ** 2))
    differ = 2 * (high - 1) * (den - num) // (num + den)
    if differ == 0:
        return low, high, 0, 0, 0
    for full in (2, 1):
        for short in range(differ + 4):
            k = differ + 1 + short
            rate = low * num / den / k  # of the smallest set that a class links
            if _above(k, short, math.exp(-rate) * (1 + rate * (full - 1))) <= 0.3:
                return low, high, k, short, full
    return low, high, differ + 1, 0, 1


def _above(n: int, most: int, p: float) -> float:
    """Chance that more than ``most`` of ``n`` independent cases of chance ``p`` occur."""
    if n > 200:
        return 0.5 * math.erfc((most + 0.5 - n * p) / math.sqrt(2 * n * p * (1 - p)))
    return 1 - sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(most + 1))


@lru_cache(maxsize=65_536)
def classes_of(size: int, num: int, den: int) -> tuple[int, ...]:
    """Classes in which a set can be the larger or the smaller part of a linked pair."""
    c = 0
    while size_class(c, num, den)[1] <= size:
        c += 1
    out, largest = [c], size * den // num
    while size_class(out[-1], num, den)[1] <= largest:
        out.append(out[-1] + 1)
    return tuple(out)


def class_of(size: int, num: int, den: int) -> int:
    return classes_of(size, num, den)[0]


def common_tokens(docs: DataFrame, n: int, num: int, den: int, least: int = 4, most: int = 1_000_000, step: int = 1024) -> np.ndarray:
    """Sorted tokens of passages that texts of very different lengths share.

    Left out of the segments, they keep texts that only share a passage out of one family. Leaving the same tokens out of all
    sets adds no difference to any pair, so every choice of them gives the same links; this one counts over all
    texts. A token counts once for each ``step`` texts in which sets at least three size classes apart hold
    it, and needs ``least`` counts; of more than ``most`` such tokens the most frequent are taken.
    """

    def run(batches):
        for batch in batches:
            text = batch.column("text")
            out = []
            for at in range(0, len(text), step):
                sets = [s for s in (ngram_set(t.as_py(), n) for t in text.slice(at, step)) if len(s)]
                if len(sets) < 2:
                    continue
                tokens = np.concatenate(sets)
                size_classes = np.repeat([class_of(len(s), num, den) for s in sets], [len(s) for s in sets])
                order = np.argsort(tokens, kind="stable")
                tokens, size_classes = tokens[order], size_classes[order]
                starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
                far = np.maximum.reduceat(size_classes, starts) - np.minimum.reduceat(size_classes, starts) >= 3
                out.append(tokens[starts[far]].view(np.int64))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out))], names=["token"])

    found = docs.select("text").mapInArrow(run, "token bigint").groupBy("token").count().where(F.col("count") >= least).orderBy(F.desc("count"), "token").limit(most)
    return np.sort(np.array([r["token"] for r in found.select("token").collect()], np.int64).view(np.uint64))


def _without(tokens: np.ndarray, common: np.ndarray | None) -> np.ndarray:
    if common is None or len(common) == 0:
        return tokens
    at = np.searchsorted(common, tokens)
    at[at == len(common)] = 0
    return tokens[common[at] != tokens]


def segment_marks(tokens: np.ndarray, num: int, den: int, common: np.ndarray | None = None) -> np.ndarray:
    """Signatures of the segments of a set without its ``common`` tokens, for each of its classes.

    Short segments are left out while a set has no more of them than its class
    allows; a set with more adds another seed, and after the last seed single tokens: the first of its tokens
    in a common order, common ones last, as many as a linked set can lack and one more. Two linked sets
    agree in more segments than the allowance, so they share a signature at the first seed at which one of
    them keeps it, and if neither does at any, one of those tokens.
    """
    out = []
    size, whole = len(tokens), tokens
    tokens = _without(tokens, common)
    for c in classes_of(size, num, den):
        _, _, k, allowed, full = size_class(c, num, den)
        if k == 0:
            continue
        for seed in range(SEEDS + 1):
            if seed == SEEDS:
                lacking = size + num * size // -den + 1
                first = tokens[:lacking]
                if len(first) < lacking:
                    first = np.concatenate((first, np.setdiff1d(whole, tokens, assume_unique=True)[: lacking - len(first)]))
                out.append(mix(first + (np.uint64(0x5BD1E995) ^ (np.uint64(c) << np.uint64(40)))))
                break
            hashed = tokens if seed == 0 else np.sort(mix(tokens + np.uint64(seed * 0x51ED270B)))
            edges = np.searchsorted(hashed, (np.arange(1, k, dtype=np.float64) * (2.0**64 / k)).astype(np.uint64))
            edges = np.concatenate(([0], edges, [len(hashed)]))
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashed ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)))
            counts = np.diff(edges)
            marks = mix(sums[edges[1:]] - sums[edges[:-1]] + mix(np.arange(k, dtype=np.uint64) + np.uint64((c * SEEDS + seed) << 32)))
            out.append(marks[counts >= full])
            if int((counts < full).sum()) <= allowed:
                break
    return np.concatenate(out) if out else np.empty(0, np.uint64)


MARKS_SCHEMA = "bucket int, docs array<bigint>, sizes array<bigint>, hashes array<bigint>, ids binary, marks binary"


def packed_marks(marks: np.ndarray, ids: np.ndarray, buckets: int) -> list[tuple[int, bytes, bytes]]:
    """(bucket, ids, marks) with the low five bytes of each mark, and ids in order as first value and small differences.

    A bucket holds far fewer marks than five bytes can tell apart; two that still look alike only widen a family.
    """
    where = (marks >> np.uint64(40)) % np.uint64(buckets)
    order = np.lexsort((ids, where))
    marks, ids, where = marks[order], ids[order], where[order]
    starts = np.concatenate(([0], np.flatnonzero(np.diff(where)) + 1, [len(marks)])) if len(marks) else np.zeros(1, int)
    out = []
    for a, b in zip(starts[:-1], starts[1:]):
        steps = np.diff(ids[a:b]).astype(np.uint64)
        kind = next(t for t in ("<u2", "<u4", "<u8") if len(steps) == 0 or int(steps.max()) <= np.iinfo(t).max)
        head = np.array([ids[a], int(kind[2])], "<i8").tobytes()
        low = marks[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
        out.append((int(where[a]), head + steps.astype(kind).tobytes(), low.tobytes()))
    return out


def unpacked_marks(ids: bytes, marks: bytes) -> tuple[np.ndarray, np.ndarray]:
    first, width = np.frombuffer(ids[:16], "<i8")
    steps = np.frombuffer(ids[16:], f"<u{width}").astype(np.int64)
    wide = np.zeros((len(marks) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(marks, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel().astype(np.uint64), first + np.concatenate(([0], np.cumsum(steps)))


def _mark_batches(n: int, num: int, den: int, buckets: int, common, step: int = 1024):
    """Per ``step`` documents (doc, text): one row (bucket -1) with the facts of all, and one row per bucket of packed signatures.

    Of equal sets among them only the first gives signatures.
    """

    def rows_of(ids: np.ndarray, texts: list) -> list[tuple]:
        sizes, hashes, marks, owner, seen = [], [], [], [], set()
        for doc, text in zip(ids.tolist(), texts):
            tokens = ngram_set(text.as_py(), n)
            mark = set_hash(tokens) if len(tokens) else 0
            sizes.append(len(tokens))
            hashes.append(mark)
            if len(tokens) and (mark, len(tokens)) not in seen:
                seen.add((mark, len(tokens)))
                marks.append(segment_marks(tokens, num, den, common.value))
                owner.append(np.full(len(marks[-1]), doc))
        rows = [(-1, ids, np.array(sizes, np.int64), np.array(hashes, np.int64), None, None)]
        if marks:
            rows += [(bucket, None, None, None, i, x) for bucket, i, x in packed_marks(np.concatenate(marks), np.concatenate(owner), buckets)]
        return rows

    def run(batches):
        kinds = pa.schema([("bucket", pa.int32()), *[(c, pa.list_(pa.int64())) for c in ("docs", "sizes", "hashes")], ("ids", pa.binary()), ("marks", pa.binary())])
        for batch in batches:
            ids = batch.column("doc").to_numpy(zero_copy_only=False)
            for at in range(0, len(ids), step):
                order = at + np.argsort(ids[at : at + step], kind="stable")
                text = batch.column("text")
                rows = rows_of(ids[order].astype(np.int64), [text[int(i)] for i in order])
                yield pa.RecordBatch.from_arrays([pa.array(column, kind.type) for column, kind in zip(zip(*rows), kinds)], schema=kinds)

    return run


def _meet(pdf: pd.DataFrame) -> pd.DataFrame:
    """Distinct pairs of a document and the first document with the same signature, over the signatures of a bucket."""
    parts = [unpacked_marks(i, m) for i, m in zip(pdf["ids"], pdf["marks"])]
    marks, ids = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.lexsort((ids, marks))
    ids, marks = ids[order], marks[order]
    first = np.concatenate(([True], marks[1:] != marks[:-1]))
    root = ids[np.flatnonzero(first)][np.cumsum(first) - 1]
    far = ids != root
    pairs = np.unique(np.stack((ids[far], root[far]), axis=1), axis=0) if far.any() else np.empty((0, 2), np.int64)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


class Sets:
    """Token sets of documents side by side: ``tok[ptr[i]:ptr[i + 1]]`` are the tokens of document i."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        self.ptr = np.concatenate(([0], np.cumsum(self.size)))
        raw = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        self.vocabulary, self.tok = np.unique(raw, return_inverse=True)

    def of(self, i: int) -> np.ndarray:
        return self.tok[self.ptr[i] : self.ptr[i + 1]]


def group_links(sets: list[np.ndarray], side: np.ndarray, num: int, den: int, group: int = 24, met: np.ndarray | None = None):
    """Links (query index, array of linked indexes) of a family, each pair once.

    ``side`` is 0 or 1; with both present only pairs across the sides are looked for. ``met`` marks, per set, the
    tasks that come before this one: sets with a mark in common are compared there. Sets are put in
    the order of their lowest tokens, so that similar ones are neighbours, and cut into groups; a
    group's union is its row of the token-group matrix.
    """
    order = np.array(sorted(range(len(sets)), key=lambda i: (int(side[i]), int(sets[i][0]), int(sets[i][-1]))), np.int64)
    s = Sets([sets[i] for i in order])
    side, met = side[order], met[order] if met is not None and met.shape[1] else None
    n = len(order)
    both = bool(side.any()) and not bool(side.all())
    starts = np.arange(0, n, group)
    ends = np.minimum(starts + group, n)
    n_groups, n_tokens = len(starts), len(s.vocabulary)
    # the token-group matrix by token: groups whose union holds it
    pairs = np.unique(s.tok.astype(np.int64) * n_groups + np.repeat(np.arange(n) // group, s.size))
    by_token, groups = np.divmod(pairs, n_groups)
    token_ptr = np.searchsorted(by_token, np.arange(n_tokens + 1))
    low = np.minimum.reduceat(s.size, starts)
    high = np.maximum.reduceat(s.size, starts)
    marked = np.zeros(n_tokens, bool)
    for q in range(n):
        if both and side[q]:
            break
        tokens, size = s.of(q), int(s.size[q])
        a, b = token_ptr[tokens], token_ptr[tokens + 1]
        spans = b - a
        at = np.repeat(a - np.concatenate(([0], np.cumsum(spans)[:-1])), spans) + np.arange(int(spans.sum()))
        overlap = np.bincount(groups[at], minlength=n_groups)
        least = -(-num * size // den)  # a linked set shares at least this much with the query
        opened = np.flatnonzero((overlap >= least) & (low * num <= size * den) & (size * num <= high * den) & (ends > q + 1))
        if len(opened) == 0:
            continue
        members = np.concatenate([np.arange(max(starts[g], q + 1), ends[g]) for g in opened])
        if both:
            members = members[side[members] == 1]
        members = members[(s.size[members] * num <= size * den) & (size * num <= s.size[members] * den)]
        if met is not None:
            before = np.flatnonzero(met[q])
            members = members[~met[np.ix_(members, before)].any(axis=1)] if len(before) else members
        if len(members) == 0:
            continue
        marked[tokens] = True
        lengths = s.size[members]
        offset = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        index = np.repeat(s.ptr[members] - offset, lengths) + np.arange(int(lengths.sum()))
        common = np.add.reduceat(marked[s.tok[index]].astype(np.int64), offset)
        marked[tokens] = False
        linked = members[common >= needed(size, lengths, num, den)]
        if len(linked):
            yield int(order[q]), order[linked]


class Forest:
    """Union of indexes; the smallest one is the root."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = int(p[i])
        return i

    def union(self, i: int, others: np.ndarray) -> None:
        roots = {self.find(i), *map(self.find, map(int, others))}
        low = min(roots)
        for r in roots:
            self.parent[r] = low


def _earlier(family: pd.DataFrame) -> np.ndarray:
    """Which smaller roots each row of a root's task also meets others at."""
    own = [[r for r in roots if r < family["family"].iat[0]] if roots is not None else [] for roots in family["roots"]]
    names = {r: k for k, r in enumerate(sorted({r for row in own for r in row}))}
    out = np.zeros((len(own), len(names)), bool)
    for i, row in enumerate(own):
        out[i, [names[r] for r in row]] = True
    return out


def _verify(n: int, num: int, den: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, family in pdf.groupby("family", sort=False):
            family = family.drop_duplicates(["doc", "text", "block"]).sort_values("doc", kind="stable")
            sets = [ngram_set(t, n) for t in family["text"]]
            keep = [i for i, s in enumerate(sets) if len(s) and set_hash(s) == family["hash"].iat[i]]
            family, sets = family.iloc[keep], [sets[i] for i in keep]
            if len(sets) < 2:
                continue
            docs, copies = family["doc"].to_numpy(np.int64), family["copies"].to_numpy(np.int64)
            side = (family["block"] != family["block"].min()).to_numpy(np.int8)
            if family["apart"].iat[0] and not side.any():
                continue
            links, forest = np.zeros(len(sets), np.int64), Forest(len(sets))
            for q, others in group_links(sets, side, num, den, met=_earlier(family)):
                links[q] += copies[others].sum()
                links[others] += copies[q]
                forest.union(q, others)
            roots = [forest.find(i) for i in range(len(sets))]
            hit = links > 0
            out.append(pd.DataFrame({"doc": docs[hit], "root": docs[roots][hit], "links": links[hit]}))
        return pd.concat(out) if out else pd.DataFrame({"doc": [], "root": [], "links": []}, dtype=np.int64)

    return run


def jaccard_components(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """One row per document: (id, n_shingles, component_id, n_links, representative).

    Documents link when ``den * |A & B| >= num * |A | B|`` of their sets of n-word runs. ``component_id`` is the
    smallest id reachable by links, the document included; ``n_links`` counts the other rows linked
    directly; ``representative`` is the smallest id with the same set. Null and wordless texts have an empty
    set, link with nothing and represent themselves. Rows that repeat an id are one document in
    components; a null id keeps its row, with null component. Empty tables give no rows. Texts are read whole, however
    long. Other columns of the input, whatever their names, are neither read nor returned.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    buckets = 4 * shuffle_partitions(spark)
    named = docs.where("doc is not null")
    common = spark.sparkContext.broadcast(common_tokens(named, n, num, den))
    marks = stored(named.mapInArrow(_mark_batches(n, num, den, buckets, common), MARKS_SCHEMA))
    info = marks.where("bucket = -1").select(F.explode(F.arrays_zip("docs", "sizes", "hashes")).alias("x")).select(
        F.col("x.docs").alias("doc"), F.col("x.sizes").alias("size"), F.col("x.hashes").alias("hash"))
    sets = stored(info.where("size > 0").groupBy("hash", "size").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("copies")))
    edges = stored(marks.where("bucket >= 0").select("bucket", "ids", "marks").groupBy("bucket").applyInPandas(_meet, "a bigint, b bigint").distinct())
    families = connected_components(edges).select(F.col("node").alias("rep"), F.col("component").alias("family"))
    members = families.join(sets, "rep")
    weight = members.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("tokens")).where("n > 1")
    members = stored(members.join(weight, "family").select(
        F.col("rep").alias("doc"), "family", "hash", "copies", "size", (F.col("tokens") * 8 <= block_bytes).alias("small")))
    placed = members.where("small").select("doc", "family", "hash", "copies", F.lit(1).alias("blocks"), F.lit(None).cast("array<bigint>").alias("roots"))
    # a large family is not gathered: its documents meet at the first documents they share a signature with
    wide = members.where("not small")
    meets = edges.unionByName(edges.select(F.col("b").alias("a"), "b")).distinct().join(wide, F.col("a") == F.col("doc")).select("doc", F.col("b").alias("root"), "size")
    meets = stored(meets)
    crowd = meets.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.sum("size") * 8 / block_bytes).cast("int").alias("blocks")).where("n > 1")
    roots = meets.groupBy("doc").agg(F.sort_array(F.collect_list("root")).alias("roots"))
    wide = wide.drop("family", "small", "size").join(roots, "doc").join(meets.select("doc", "root").join(crowd, "root"), "doc").select(
        "doc", F.col("root").alias("family"), "hash", "copies", "blocks", "roots")
    members = stored(placed.unionByName(wide))
    texts = docs.join(bounded_broadcast(members), "doc")
    block = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tasks = texts.withColumn("block", block).select("*", other).select(
        "doc", "text", "hash", "copies", "block", "family", "roots", (F.col("other") != F.col("block")).alias("apart"),
        F.when(F.col("roots").isNull(), F.pmod(F.xxhash64("family"), F.lit(buckets))).otherwise(
            F.xxhash64("family", F.least("block", "other"), F.greatest("block", "other"))).alias("task"))
    found = stored(tasks.groupBy("task").applyInPandas(_verify(n, num, den), "doc bigint, root bigint, links bigint"))
    copies = info.where("size > 0").join(sets, ["hash", "size"]).select("doc", "size", "rep", "copies")
    ties = copies.where("doc <> rep").select(F.col("doc").alias("a"), F.col("rep").alias("b"))
    component = connected_components(found.select(F.col("doc").alias("a"), F.col("root").alias("b")).unionByName(ties))
    links = found.groupBy(F.col("doc").alias("rep")).agg(F.sum("links").alias("links"))
    rows = copies.join(links, "rep", "left").select("doc", "size", "rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    rows = rows.unionByName(info.where("size = 0").select("doc", "size", F.col("doc").alias("rep"), F.lit(0).cast("long").alias("n_links")))
    rows = rows.join(component, rows["doc"] == component["node"], "left").select(
        F.col("doc").alias(id_col), F.col("size").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"), "n_links", F.col("rep").alias("representative"))
    return rows.unionByName(_without_id(docs, n, id_col))


def _without_id(docs: DataFrame, n: int, id_col: str) -> DataFrame:
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"n": [len(ngram_set(t, n)) for t in pdf["text"]]})

    size = docs.where("doc is null").select("text").mapInPandas(run, "n bigint")
    none = F.lit(None).cast("long")
    return size.select(none.alias(id_col), F.col("n").alias("n_shingles"), none.alias("component_id"), F.lit(0).cast("long").alias("n_links"), none.alias("representative"))
