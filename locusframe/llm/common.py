"""Helpers the corpus operators share."""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def step_path(spark: SparkSession) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{folder.rstrip('/')}/step-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write a step as Parquet in the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor costs the tasks that ran on it, not the steps before.
    """
    spark = df.sparkSession
    path = step_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes not to be a column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_bucket(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def bounded_broadcast(df: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """Hint a broadcast of a stored table after counting it; larger ones are joined by a shuffle."""
    return F.broadcast(df) if df.count() <= max_rows else df


class WordHashes(dict):
    """64-bit hashes of words, remembered per worker process up to ``limit`` words."""

    limit = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = WordHashes()


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words between ASCII white space, A-Z lower-cased, other letters as they are."""
    if not text:
        return np.empty(0, np.uint64)
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` neighbouring words, in order."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    return mix(out)
