"""Operator 2, sharding: jump consistent hashing of a stable key, with a gapless slot in every shard.

The hash needs no table of the ring: shard numbers follow from key and shard count alone, and one more shard takes the
share it needs out of all others and moves nothing else (Lamping and Veach, "A Fast, Minimal Memory, Consistent Hash
Algorithm", 2014). Slots are numbered without gathering a shard in one task: every task numbers its own rows per shard,
and a table with one row per task and shard holds where each begins.

Defined cases: a null key is hashed like the number 0 with another seed, so all null keys share a shard; rows with
equal keys share a shard and get different slots; an empty table gives no rows. Sizes are UTF-8 bytes plus 1; a null
text has size 1 and the checksum of no bytes, 0.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from siltline.llm.common import settle

STEP = np.uint64(2862933555777941757)  # fixed by the published algorithm


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key, 0 to ``shards - 1``."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    jump = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        shard[moving] = jump[moving]
        state[moving] = state[moving] * STEP + np.uint64(1)
        draw = ((state[moving] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        jump[moving] = ((shard[moving] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        moving = moving[jump[moving] < shards]
    return shard


def key_hash(column: str):
    """A 64-bit hash of the key, as jump hashing wants its keys evenly spread."""
    return F.when(F.col(column).isNull(), F.xxhash64(F.lit(0), F.lit("null"))).otherwise(F.xxhash64(column))


def with_shard(rows: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    @F.pandas_udf("int")
    def place(hashes: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(hashes.to_numpy().view(np.uint64), shards), dtype="int32")

    return rows.withColumn(name, place(key_hash(key)))


def with_slot(rows: DataFrame, shard: str = "shard", name: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps. The rows are settled once; no row is shuffled to count."""
    schema = StructType([*rows.schema.fields, StructField("__part", IntegerType()), StructField("__place", LongType())])

    def number(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seen = TaskContext.get().partitionId(), {}
        for frame in frames:
            place = frame.groupby(shard).cumcount().to_numpy() + frame[shard].map(lambda s: seen.get(s, 0)).to_numpy()
            for s, n in frame[shard].value_counts().items():
                seen[s] = seen.get(s, 0) + n
            yield frame.assign(__part=part, __place=place.astype("int64"))

    numbered = settle(rows.mapInPandas(number, schema))
    held = numbered.groupBy(shard, "__part").agg(F.count("*").alias("__rows"))
    before = Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    begins = held.select(shard, "__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__begin"))
    return (
        numbered.join(begins, [shard, "__part"])
        .withColumn(name, F.expr("__begin + __place"))
        .drop("__part", "__place", "__begin")
    )


def assign(
    docs: DataFrame, shards: int, *, key: str = "doc_id", text: str = "text", also: int | None = None
) -> DataFrame:
    """``key, size, text_crc32, shard, slot`` and, with ``also``, ``grown_shard`` for that many shards."""
    data = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    rows = docs.select(
        F.col(key).alias(key), (F.length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32")
    )
    placed = with_shard(rows, key, shards)
    if also is not None:
        placed = with_shard(placed, key, also, "grown_shard")
    return with_slot(placed)


def op2_sharding(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    placed = assign(docs, 16, also=17).withColumn("law", F.lit("key"))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
