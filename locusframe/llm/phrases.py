"""Phrase collocations by Toivonen's sampling method.

A sample of the documents is mined level by level with a lowered threshold. The phrases it proposes and their
negative border (phrases that are not among them, but whose parts are) are the candidates of a full pass over
all documents. Where a border phrase proves frequent the sample has missed something: the frequent set grows by what was
found, and one more pass counts the new border and all that grows from it, which closes the set. Counts are exact whatever the sample
holds.

The border of a large corpus is mostly phrases seen once or twice. A pass therefore reads the documents twice: first
candidates are added up in hashed buckets, and a bucket below the threshold proves that none of its phrases is
frequent; then the phrases of full buckets are counted one by one. What tasks need to know of a phrase set is an
array of flags of bounded size, so no phrase set is collected or broadcast; phrases that share a bucket only cause more to
be counted.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe.llm.common import bounded_broadcast, mix, shuffle_partitions, stored

# The signs that end a piece, turned into a byte that UTF-8 text never holds.
PIECE_ENDS = b".,;:!?\n\v\f\r"
_to_marks = bytes.maketrans(PIECE_ENDS, b"\xff" * len(PIECE_ENDS))
GRAMS = "lang string, len int, phrase string, hash bigint, n bigint"
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 1 << 16
HASHED_AT_ONCE = 1 << 20

_values = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_of(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        base = int(GOLDEN)
        for i, factor in enumerate((base, pow(base, -1, 1 << 64))):
            steps = np.full(n, factor, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def _hashed(raw: bytes) -> np.ndarray:
    """Hashes of the words of lower-cased, marked bytes in order; 0 for every mark."""
    a = np.frombuffer(raw, np.uint8)
    mark = a == 255
    gap = mark | (a == 32) | (a == 9)
    edge = np.diff(np.concatenate(([True], gap, [True])).view(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _powers_of(len(a) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_values[a] * up[: len(a)])))
    hashes = mix((sums[end] - sums[start]) * down[start])
    hashes[hashes == 0] = 1
    at = np.concatenate((start, np.flatnonzero(mark)))
    return np.concatenate((hashes, np.zeros(len(at) - len(start), np.uint64)))[np.argsort(at, kind="stable")]


def hashed(raw: bytes) -> np.ndarray:
    """``_hashed`` part by part, cut between words."""
    out, a = [np.empty(0, np.uint64)], 0
    while a < len(raw):
        b = a + HASHED_AT_ONCE
        if b < len(raw):
            cuts = [raw.find(c, b) for c in (b" ", b"\t", b"\xff")]
            b = min((c for c in cuts if c >= 0), default=len(raw))
        out.append(_hashed(raw[a:b]))
        a = b
    return np.concatenate(out)


def marked(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower().translate(_to_marks)


@dataclass
class Flags:
    """A set of 64-bit hashes as one flag per bucket: never a false no, and few a false yes while most buckets are empty."""

    bits: np.ndarray

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = bucket_of(hashes, len(self.bits) * 8)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1) == 1


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes & np.uint64(buckets - 1)).astype(np.int64)


class Words(dict):
    """Numbers of words from 1 in order of first sight; 0 marks the end of a piece."""

    def __init__(self):
        super().__init__({b"\xff": 0})
        self.words = [b""]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number


def numbered(texts: list[str], words: Words) -> np.ndarray:
    """The words of all texts as numbers, a 0 behind every piece."""
    parts = []
    for text in texts:
        tokens = marked(text).replace(b"\xff", b" \xff ").split()
        tokens.append(b"\xff")
        parts.append(np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens)))
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


def counted_apart(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words as numbers, their hashes, and the words themselves, which are told apart by their bytes."""
    words = Words()
    x = numbered(texts, words)
    return x, np.concatenate((np.zeros(1, np.uint64), hashed(b" ".join(words.words[1:])))), words.words


def counted_by_hash(texts: list[str]) -> tuple[np.ndarray, np.ndarray, None]:
    """Words as numbers and their hashes, without a look at single words: for bounds, where words of one hash may count as one."""
    x, hashes = pd.factorize(np.concatenate((np.zeros(1, np.uint64), hashed(b"\xff".join(map(marked, texts))))))
    return x[1:].astype(np.int32), hashes, None


def chosen_grams(x: np.ndarray, word_hash: np.ndarray, lang: str, now: list[Flags], before: list[Flags] | None, most: int, full: Flags | None = None):
    """Yield (length, first places, hashes, counts) of the different candidates in ``x``, level by level up to ``most`` words.

    Every word is a candidate. ``now[k-1]`` holds the accepted phrases of k words; a longer phrase is a candidate when
    both its first and its last words but one are accepted. With ``before``, the accepted phrases of the pass before, what was a
    candidate then is left out, and new candidates (those of ``full`` buckets where these are known) are accepted as parts too: so
    everything that grows from what had failed is met in one pass. Phrases are told apart by the numbers of their words.
    """
    n_words = len(word_hash)
    hashes = mix(word_hash ^ hashed(lang.encode("utf-8", "surrogatepass").hex().encode() + b"-")[0])
    if before is None:
        first = np.zeros(n_words, np.int64)
        first[x[::-1]] = np.arange(len(x))[::-1]
        counts = np.bincount(x, minlength=n_words)
        seen = np.flatnonzero(counts[1:]) + 1
        yield 1, first[seen], hashes[seen], counts[seen]

    def spread(filters: list[Flags], level: int, at, of, allowed) -> np.ndarray:
        out = np.zeros(len(x), bool)
        if level <= len(filters):
            out[at] = filters[level - 1].has(hashes)[of] & allowed
        return out

    code, whole = x.astype(np.int64), np.arange(len(x))
    member = spread(now, 1, whole, x, x > 0)
    old = spread(before or [], 1, whole, x, x > 0)
    for k in range(2, most + 1):
        at = np.flatnonzero(member[:-1] & member[1:])
        if not len(at):
            return
        of, keys = pd.factorize(code[at] * np.int64(n_words) + x[at + k - 1])
        first = np.empty(len(keys), np.int64)
        first[of[::-1]] = at[::-1]
        hashes = mix(hashes[code[first]] * GOLDEN + word_hash[x[first + k - 1]])
        known = old[:-1] & old[1:]
        fresh = ~known[first]
        new = np.flatnonzero(fresh)
        yield k, first[new], hashes[new], np.bincount(of, minlength=len(keys))[new]
        member = spread(now, k, at, of, True)
        if before is not None:
            member[at] |= (fresh if full is None else fresh & full.has(hashes))[of]
        old = spread(before or [], k, at, of, known[at])
        code = np.zeros(len(x), np.int64)
        code[at] = of


def _chunks(batches, chunk_bytes: int):
    """(lang, texts) of about ``chunk_bytes`` of text of one language, from batches of (lang, text)."""
    held: dict[str, list[str]] = {}
    sizes: dict[str, int] = {}

    def taken(lang: str):
        sizes.pop(lang)
        return lang, held.pop(lang)

    for got in batches:
        for lang, text in zip(got.column(0).to_pylist(), got.column(1).to_pylist()):
            held.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text) + 1
            if sum(sizes.values()) > chunk_bytes:
                yield taken(max(sizes, key=sizes.get))
    for lang in list(held):
        yield taken(lang)


@dataclass(frozen=True)
class Sizes:
    """Bytes of text counted at once in a task, buckets (a power of two, a block at least) per flag array, and phrases a task adds up before it sends them."""

    chunk_bytes: int = 16 << 20
    buckets: int = 1 << 24
    held: int = 400_000

    def __post_init__(self):
        if self.buckets < BLOCK or self.buckets & (self.buckets - 1):
            raise ValueError(f"buckets must be a power of two from {BLOCK} on")


class Tally:
    """Counts of a language's phrases, added up over chunks of text."""

    def __init__(self):
        self.numbers = Words()
        self.lengths, self.hashes, self.counts = np.zeros(1, np.int32), np.zeros(1, np.uint64), np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.counts) - 1

    def add(self, length: int, phrases: list[bytes], hashes: np.ndarray, counts: np.ndarray) -> None:
        """Add the counts of different phrases of ``length`` words."""
        at = np.fromiter(map(self.numbers.__getitem__, phrases), np.int64, len(phrases))
        more = (0, len(self.numbers.words) - len(self.counts))
        self.lengths, self.hashes, self.counts = np.pad(self.lengths, more), np.pad(self.hashes, more), np.pad(self.counts, more)
        self.lengths[at], self.hashes[at] = length, hashes
        self.counts[at] += counts

    def rows(self, lang: str):
        for a in range(1, len(self.counts), 50_000):
            part = slice(a, a + 50_000)
            phrases = self.numbers.words[part]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(phrases), pa.string()), pa.array(self.lengths[part]), pa.array(phrases, pa.binary()).cast(pa.string()),
                pa.array(self.hashes[part].view(np.int64)), pa.array(self.counts[part])], names=["lang", "len", "phrase", "hash", "n"])


def gathered(docs: DataFrame) -> DataFrame:
    """At most two partitions for each core of the cluster.

    A task sends every frequent phrase it meets once, so what is sent grows with phrases times tasks. The number of tasks is tied
    to the cluster, not to the input; a table of fewer partitions is left as it is.
    """
    return docs.coalesce(2 * docs.sparkSession.sparkContext.defaultParallelism)


def full_buckets(docs: DataFrame, now: list[Flags], before: list[Flags] | None, levels: range, least: int, sizes: Sizes) -> Flags:
    """Flags of the buckets in which the candidates of ``levels`` words occur ``least`` times or more in all.

    Counts stop at ``least``; tasks send the blocks of their bucket array, thinly filled ones as places and counts,
    which are added after a shuffle. The driver gets one bit per bucket.
    """
    shared = docs.sparkSession.sparkContext.broadcast((now, before))
    kind = np.min_scalar_type(least)

    def add_up(batches):
        filters, earlier = shared.value
        own = np.zeros(sizes.buckets, kind)
        for lang, texts in _chunks(batches, sizes.chunk_bytes):
            x, word_hash, _ = counted_by_hash(texts)
            for k, _, hashes, counts in chosen_grams(x, word_hash, lang, filters, earlier, levels.stop - 1):
                if k in levels:
                    at, of = np.unique(bucket_of(hashes, sizes.buckets), return_inverse=True)
                    own[at] = np.minimum(own[at].astype(np.int64) + np.bincount(of, counts, len(at)).astype(np.int64), least)
        yield from _blocks(own, kind)

    def unite(batches):
        total: dict[int, np.ndarray] = {}
        for got in batches:
            for block, places, counts in zip(*(got.column(i).to_pylist() for i in range(3))):
                sums = total.setdefault(block, np.zeros(BLOCK, np.int64))
                at = slice(None) if places is None else np.frombuffer(places, np.uint16).astype(np.int64)
                sums[at] = np.minimum(sums[at] + np.frombuffer(counts, kind), least)
        rows = [(b, np.packbits(sums >= least, bitorder="little").tobytes()) for b, sums in total.items() if (sums >= least).any()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["block", "bits"])

    sums = docs.mapInArrow(add_up, BLOCKS).repartition(shuffle_partitions(docs.sparkSession), "block")
    return _flags(sums.mapInArrow(unite, "block bigint, bits binary"), sizes.buckets)


BLOCKS = "block bigint, places binary, counts binary"


def _blocks(own: np.ndarray, kind):
    for b in range(len(own) // BLOCK):
        part = own[b * BLOCK : (b + 1) * BLOCK]
        at = np.flatnonzero(part)
        if len(at):
            thin = len(at) * (2 + part.itemsize) < part.nbytes
            yield pa.RecordBatch.from_arrays([
                pa.array([b], pa.int64()), pa.array([at.astype(np.uint16).tobytes() if thin else None], pa.binary()),
                pa.array([(part[at] if thin else part).astype(kind).tobytes()], pa.binary())], names=["block", "places", "counts"])


def _flags(blocks: DataFrame, buckets: int) -> Flags:
    bits, size = np.zeros(buckets // 8, np.uint8), BLOCK // 8
    for row in blocks.collect():
        bits[row["block"] * size : (row["block"] + 1) * size] |= np.frombuffer(row["bits"], np.uint8)
    return Flags(bits)


def flags_of(phrases: DataFrame, sizes: Sizes) -> Flags:
    """Flags of the column ``hash`` of a phrase table."""

    def mark(batches):
        own = np.zeros(sizes.buckets, np.uint8)
        for got in batches:
            own[bucket_of(np.asarray(got.column(0)).view(np.uint64), sizes.buckets)] = 1
        yield from _blocks(own, np.uint8)

    def unite(batches):
        total: dict[int, np.ndarray] = {}
        for got in batches:
            for block, places, counts in zip(*(got.column(i).to_pylist() for i in range(3))):
                sums = total.setdefault(block, np.zeros(BLOCK, np.uint8))
                at = slice(None) if places is None else np.frombuffer(places, np.uint16).astype(np.int64)
                sums[at] |= np.frombuffer(counts, np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([np.packbits(v, bitorder="little").tobytes() for v in total.values()], pa.binary())], names=["block", "bits"])

    n = shuffle_partitions(phrases.sparkSession)
    return _flags(phrases.select("hash").mapInArrow(mark, BLOCKS).repartition(n, "block").mapInArrow(unite, "block bigint, bits binary"), sizes.buckets)


def task_counts(docs: DataFrame, now: list[Flags], before: list[Flags] | None, full: Flags, most: int, sizes: Sizes) -> DataFrame:
    """What each task counts (``GRAMS``) of the candidates in (lang, text) whose bucket is ``full``.

    A task adds up what its chunks hold before the shuffle, up to ``sizes.held`` phrases at a time. In the first pass a row of length 0
    holds a language's number of words.
    """
    shared = docs.sparkSession.sparkContext.broadcast((now, before, full))

    def run(batches):
        filters, earlier, bounded = shared.value
        held: dict[str, Tally] = {}
        for lang, texts in _chunks(batches, sizes.chunk_bytes):
            tally = held.setdefault(lang, Tally())
            x, word_hash, spelled = counted_apart(texts)
            if earlier is None:
                tally.add(0, [b""], np.zeros(1, np.uint64), np.array([np.count_nonzero(x)]))
            for k, first, hashes, counts in chosen_grams(x, word_hash, lang, filters, earlier, most, bounded):
                kept = bounded.has(hashes)
                first, hashes, counts = first[kept], hashes[kept], counts[kept]
                tally.add(k, [b" ".join([spelled[w] for w in row]) for row in x[first[:, None] + np.arange(k)].tolist()], hashes, counts)
            if sum(map(len, held.values())) > sizes.held:
                for lang in list(held):
                    yield from held.pop(lang).rows(lang)
        for lang, tally in held.items():
            yield from tally.rows(lang)

    return docs.mapInArrow(run, GRAMS)


def gram_counts(docs: DataFrame, now: list[Flags], before: list[Flags] | None, full: Flags, most: int, sizes: Sizes) -> DataFrame:
    """Exact counts (``GRAMS``) of the candidates in (lang, text) whose bucket is ``full``, and what else ``task_counts`` holds."""
    return task_counts(docs, now, before, full, most, sizes).groupBy("lang", "len", "phrase").agg(F.min("hash").alias("hash"), F.sum("n").alias("n"))


def mine_sample(docs: DataFrame, rate: float, min_count: int, max_words: int, sizes: Sizes, seed: int) -> list[Flags]:
    """What a sample proposes: flags of the phrases of 1 to ``max_words`` - 1 words that are frequent in it at a lowered threshold, level by level.

    The threshold is three standard deviations below what ``min_count`` occurrences leave in the sample, 2 at least. Phrases are
    counted in buckets, so some that share one are proposed too.
    """
    expected = min_count * rate
    lowered = max(2, int(expected - 3 * np.sqrt(expected)))
    sample = docs.sample(False, rate, seed)
    proposed: list[Flags] = []
    for k in range(1, max_words):
        proposed.append(full_buckets(sample, proposed, None, range(k, k + 1), lowered, sizes))
    return proposed


def _failed(found: DataFrame, now: list[Flags], max_words: int) -> bool:
    """Whether a frequent phrase that can be part of a longer one is missing in ``now``."""
    shared = found.sparkSession.sparkContext.broadcast(now)

    def missing(batches):
        for got in batches:
            lengths, hashes = np.asarray(got.column(0)), np.asarray(got.column(1)).view(np.uint64)
            lost = sum(int((~f.has(hashes[lengths == k])).sum()) for k, f in enumerate(shared.value, 1))
            yield pa.RecordBatch.from_arrays([pa.array([lost], pa.int64())], names=["lost"])

    rows = found.where((F.col("len") > 0) & (F.col("len") < max_words)).select("len", "hash")
    return bool(rows.mapInArrow(missing, "lost bigint").agg(F.sum("lost")).first()[0])


def frequent_phrases(docs: DataFrame, min_count: int = 100, max_words: int = 5, rate: float = 0.25, text_col: str = "text", lang_col: str = "lang",
                     sizes: Sizes = Sizes(), seed: int = 41) -> DataFrame:
    """(lang, len, phrase, n): all phrases of 1 to ``max_words`` words with ``n >= min_count`` occurrences, and per language a row of length 0 with its number of words.

    Words are lower-cased (A-Z) runs of other signs than spaces and tabs inside pieces, which end at ``.,;:!?`` and line
    ends. Counts are exact, overlaps included. ``rate`` is the share of rows in the sample; it decides how much work is saved, never the
    result. Null texts count as empty, null languages as ``und``; repeated rows all count; a language without words has no phrases; an empty
    table gives an empty result. Texts are read whole; one text's words must fit in a task's memory. Other columns of the input are not
    read. Flag arrays have ``sizes.buckets`` buckets; where phrases outgrow them more is counted one by one, and the result stays the same.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    texts = gathered(texts)
    now = mine_sample(texts, rate, min_count, max_words, sizes, seed)
    full = full_buckets(texts, now, None, range(1, max_words + 1), min_count, sizes)
    found = stored(gram_counts(texts, now, None, full, max_words, sizes).where((F.col("n") >= min_count) | (F.col("len") == 0)))
    if _failed(found, now, max_words):
        before, now = now, [flags_of(found.where(F.col("len") == k), sizes) for k in range(1, max_words)]
        full = full_buckets(texts, now, before, range(2, max_words + 1), min_count, sizes)
        grown = stored(gram_counts(texts, now, before, full, max_words, sizes).where(F.col("n") >= min_count))
        found = found.unionByName(grown)
    return found.drop("hash")


def collocations(frequent: DataFrame, top: int = 2000, min_words: int = 2, salts: int = 16) -> DataFrame:
    """The ``top`` phrases per language by score: (lang, rank, phrase, a, l, r, n, score), numbers long.

    ``frequent`` is what ``frequent_phrases`` returns, stored. The score is the least over all cuts of a phrase into two parts of
    floor(1000 * a * n / (l * r)), ties to the shorter first part, in decimal arithmetic of 38 digits. A phrase inside a longer one that is
    as frequent is dropped; as counts never grow with length, a look at phrases of one word more is enough. Order: score
    and a falling, phrase in byte order. A part of one word may be shared by very many phrases: its rows are spread over ``salts``.
    """
    totals = frequent.where("len = 0").select("lang", F.col("n").alias("total"))
    known = frequent.where("len > 0").select("lang", "len", "phrase", "n")
    words = F.split("phrase", " ")
    candidates = known.where(F.col("len") >= min_words)
    cuts = candidates.select("lang", "phrase", F.col("n").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("len") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("rest"))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(salts)).cast("int")
    copies = F.when(F.col("len") == 1, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    parts = known.select("lang", F.col("phrase").alias("part"), "n", F.explode(copies).alias("salt"))
    for side, out in (("first", "l"), ("rest", "r")):
        keyed = cuts.withColumn("salt", F.when(F.instr(side, " ") == 0, salt).otherwise(F.lit(0)))
        cuts = keyed.join(parts.select("lang", F.col("part").alias(side), F.col("n").alias(out), "salt"), ["lang", side, "salt"]).drop("salt")
    exact = "((cast(a as decimal(19,0)) * 1000) * cast(total as decimal(16,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    scored = cuts.join(bounded_broadcast(totals, 100_000), "lang").withColumn("score", F.expr(exact))
    best = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("total").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    longer = known.where(F.col("len") > min_words).select(
        "lang", F.explode(F.array(F.array_join(F.slice(words, F.lit(1), F.col("len") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("len") - 1), " "))).alias("phrase"), "n")
    longer = longer.groupBy("lang", "phrase").agg(F.max("n").alias("within"))
    left = best.join(longer, ["lang", "phrase"], "left").where("within IS NULL OR 100 * within < 100 * a").select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    near = left.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(salts))).withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_place") <= top)
    ranked = near.drop("_part", "_place").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

