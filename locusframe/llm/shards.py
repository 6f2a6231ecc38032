"""Seeded two-pass shuffle of records into shards, built from Column expressions only.

First pass: every whole record goes to the shard its id decides and, inside it, to one of the buckets
that a seeded hash draws; the number of buckets follows from the measured bytes of each shard, so that a
bucket fits in memory also where one key holds much of the data, and each bucket is one task. Second pass: the records of each bucket are permuted by Spark's ``shuffle`` (Fisher-Yates)
and written; a bucket's slots begin behind the buckets before it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusframe.llm.common import free_names, step_path


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text plus one; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def rendezvous_shard(key: Column, shards: int, seed: int) -> Column:
    """The shard whose seeded hash of the key is highest: one more shard takes keys only into itself."""
    scores = [F.xxhash64(F.lit(seed), F.lit(s), key) for s in range(shards)]
    best = F.greatest(*scores) if shards > 1 else scores[0]
    return reduce(lambda rest, s: F.when(scores[s] == best, s).otherwise(rest), reversed(range(shards)), F.lit(0)).cast("int")


def write_shards(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", shards: int = 8, seed: int = 17,
                 bucket_bytes: int = 64 << 20, bucket_rows: int = 65_536) -> None:
    """Write all columns of the records below ``path/_shard=N``, bucket by bucket in shuffled order.

    ``_bucket`` and ``_place``, the place in the bucket, are added; where the records have columns of these names, the
    added ones get more underscores. Repeated rows all stay. A key's copies stay
    in one shard but spread over its buckets, so that no bucket grows beyond memory.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    bucket_name, place_name, shard_name = free_names(df, "_bucket", "_place", "_shard")
    shard = rendezvous_shard(F.col(f"`{key}`"), shards, seed)
    sums = df.groupBy(shard.alias("shard")).agg(F.sum(text_bytes(F.col(f"`{text}`"))).alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
    buckets = [1] * shards
    for r in sums:
        buckets[r["shard"]] = max(1, -(-r["bytes"] // bucket_bytes), -(-r["rows"] // bucket_rows))
    first = [sum(buckets[:s]) for s in range(shards)]  # the buckets of a shard follow each other, each is one partition

    def of_shard(values: list[int]) -> Column:
        return F.element_at(F.array(*(F.lit(v) for v in values)), F.col("shard") + 1)

    records = df.select(
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("record"), F.col(f"`{key}`").alias("key"), F.crc32(body.cast("binary")).alias("text_crc32"),
        shard.alias("shard"), F.monotonically_increasing_id().alias("row"))
    drawn = F.pmod(F.xxhash64(F.lit(seed + 1), "key", "text_crc32", "row"), of_shard(buckets)).cast("int")
    records = records.withColumn("bucket", drawn).withColumn("part", (of_shard(first) + F.col("bucket")).cast("int"))
    dealt = records.repartitionById(sum(buckets), F.col("part")).sortWithinPartitions("part", "key", "text_crc32", "row")
    packed = dealt.groupBy("part").agg(F.collect_list("record").alias("records"), F.first("shard").alias("shard"), F.first("bucket").alias("bucket"))
    placed = packed.select(F.col("shard").alias(shard_name), F.col("bucket").alias(bucket_name), F.posexplode(F.shuffle("records", seed)).alias(place_name, "record"))
    added = (bucket_name, place_name, shard_name)
    placed.select("record.*", *added).sortWithinPartitions(shard_name, bucket_name, place_name).write.partitionBy(shard_name).parquet(path)


def shuffle_into_shards(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 8, seed: int = 17,
                        bucket_bytes: int = 64 << 20, bucket_rows: int = 65_536) -> DataFrame:
    """Shard and slot of every record, read from what ``write_shards`` wrote to the shared folder: (key, size, text_crc32, shard, slot, grown_shard, bucket).

    ``grown_shard`` is the shard with one shard more. Slots of a shard run from 0 without gaps. Null
    texts have size 1 and checksum 0; null keys are one key; repeated rows all keep a slot of their
    own; an empty table gives no rows. Other columns of the records, whatever their names, are written and not returned.
    """
    path = step_path(df.sparkSession)
    added = free_names(df, "_bucket", "_place", "_shard")
    write_shards(df, path, key, text, shards, seed, bucket_bytes, bucket_rows)
    schema = T.StructType([*df.schema.fields, *(T.StructField(c, T.IntegerType()) for c in added)])
    written = df.sparkSession.read.schema(schema).parquet(path).select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), *[F.col(c).alias(n) for c, n in zip(added, ("_bucket", "_place", "_shard"))])
    before = Window.partitionBy("_shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = written.groupBy("_shard", "_bucket").agg(F.count(F.lit(1)).alias("n")).select("_shard", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return written.join(F.broadcast(starts), ["_shard", "_bucket"]).select(
        F.col("key").alias(key), text_bytes(F.col("text")).alias("size"), F.crc32(body).alias("text_crc32"), F.col("_shard").alias("shard"),
        (F.col("_start") + F.col("_place")).alias("slot"), rendezvous_shard(F.col("key"), shards + 1, seed).alias("grown_shard"), F.col("_bucket").alias("bucket"))
