"""Benchmark passages in documents by greedy string tiling.

Documents and benchmark items meet in shared seeds, the Karp-Rabin hashes of runs of words. For each pair that
shares a seed the longest common run of unmarked words becomes a tile, is marked on both sides, and
the search goes on until no run of the least length is left; so passages in another order still
count. A pair is contaminated when tiles cover enough of the item.
"""

from __future__ import annotations

import heapq
import string
import uuid
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import _hashes, windows

_TABLE = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
FILTER_BITS = 22


def words(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased words, ASCII punctuation and white space apart."""
    if not text:
        return np.empty(0, np.uint64)
    parts = text.lower().encode("utf-8").translate(_TABLE).split()
    return np.fromiter(map(_hashes.__getitem__, parts), np.uint64, len(parts))


class Seeds:
    """Benchmark items by the hashes of their runs of ``length`` words; shorter items have no seed."""

    def __init__(self, items: list[tuple[int, str]], length: int):
        self.length = length
        self.items = {i: words(t) for i, t in items}
        self.places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for item, hashed in self.items.items():
            for at, h in enumerate(windows(hashed, length).tolist()):
                self.places[h].append((item, at))
        self.known = np.array(sorted(self.places), np.uint64)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.known >> np.uint64(64 - FILTER_BITS)] = True

    def hits(self, document: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """Places (in the item, in the document) of shared seeds, by item."""
        hashed = windows(document, self.length)
        out: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for at in np.flatnonzero(self.filter[hashed >> np.uint64(64 - FILTER_BITS)]).tolist():
            for item, place in self.places.get(int(hashed[at]), ()):
                out[item].append((place, at))
        return out


def tile(seeds: list[tuple[int, int]], length: int, item_words: int) -> list[tuple[int, int, int]]:
    """Tiles (start in the item, start in the document, words), longest first, ties by place.

    ``seeds`` are all pairs of places with equal runs of ``length`` words; neighbours on a diagonal make a longer run.
    """
    runs, diagonals = [], defaultdict(list)
    for i, j in seeds:
        diagonals[j - i].append(i)
    for shift, places in diagonals.items():
        places.sort()
        start = last = places[0]
        for i in [*places[1:], None]:
            if i is None or i != last + 1:
                runs.append((start - last - length, start, start + shift))
                start = i
            last = i
    heapq.heapify(runs)
    in_item, in_document, out = set(), set(), []
    while runs and len(in_item) + length <= item_words:
        negative, i, j = heapq.heappop(runs)
        n = -negative
        free = [k for k in range(n) if i + k not in in_item and j + k not in in_document]
        if len(free) == n:
            out.append((i, j, n))
            in_item.update(range(i, i + n))
            in_document.update(range(j, j + n))
            continue
        start = last = None
        for k in [*free, None]:
            if start is not None and (k is None or k != last + 1):
                if last - start + 1 >= length:
                    heapq.heappush(runs, (start - last - 1, i + start, j + start))
                start = None
            if start is None:
                start = k
            last = k
    return out


FOUND = "doc_id bigint, item_id bigint, item_words bigint, tiled_words bigint, tiles bigint, longest_tile bigint, doc_words bigint"


def tilings(docs: DataFrame, benchmark: DataFrame, seed_words: int = 5, block_bytes: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item (item_id, text) that share a seed, with what the tiles cover.

    The benchmark is read in blocks of about ``block_bytes`` of text, one pass over the documents each, so its size is no
    limit. Null and empty texts, and items of fewer than ``seed_words`` words, share no seed. Rows that
    repeat a document or an item each count; null ids are kept as null.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    blocks = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        index = spark.sparkContext.broadcast([((k, r["item_id"]), r["text"]) for k, r in enumerate(own)])
        found = docs.mapInArrow(_tile_batches(index, seed_words), FOUND)
        out = found if out is None else out.unionByName(found)
    return out


_loaded: dict = {}


def _tile_batches(index, seed_words: int):
    name = uuid.uuid4().hex  # the index is built once per worker process

    def run(batches):
        import pyarrow as pa

        if name not in _loaded:
            _loaded.clear()
            _loaded[name] = Seeds(index.value, seed_words)
        seeds = _loaded[name]
        names = [c.split()[0] for c in FOUND.split(", ")]
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                document = words(text.as_py())
                for item, places in seeds.hits(document).items():
                    size = len(seeds.items[item])
                    tiles = tile(places, seed_words, size)
                    rows.append((doc.as_py(), item[1], size, sum(t[2] for t in tiles), len(tiles), max(t[2] for t in tiles), len(document)))
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=names)

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = 0.5, **options) -> DataFrame:
    """Pairs of a document and a benchmark item of whose words tiles cover at least ``coverage``; see ``tilings``.

    Texts are read whole, however long. Other columns of both tables, whatever their names, are neither read nor returned.
    """
    share = F.col("tiled_words") / F.col("item_words")
    return tilings(docs, benchmark, **options).withColumn("coverage", share).where(F.col("coverage") >= coverage)
