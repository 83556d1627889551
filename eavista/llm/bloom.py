"""A blocked Bloom filter of fixed size, built by an aggregation and tested inside Arrow batches.

It has ``2 ** block_bits`` blocks of 512 bits whatever the number of keys, so it may be sent to every
task; more keys only let more other rows through, and what follows it must be exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PROBES = 6


def hashes(key: Column) -> tuple[Column, Column]:
    """The two hashes of a key; null for a null key."""
    return (
        F.when(key.isNotNull(), F.xxhash64(key)),
        F.when(key.isNotNull(), F.xxhash64(F.lit("bits"), key)),
    )


def build(keys: DataFrame, key: str, block_bits: int) -> np.ndarray:
    """Blocks x 8 words; at most ``2 ** block_bits`` rows come to the driver."""
    first, second = hashes(F.col(key))
    spots = [F.shiftrightunsigned(second, 9 * i).bitwiseAND(511).cast("int") for i in range(PROBES)]
    words = [
        F.expr("bit_or(" + " | ".join(
            f"if(shiftright(s{i}, 6) = {w}, shiftleft(1L, s{i} & 63), 0L)" for i in range(PROBES)
        ) + f") AS word{w}")
        for w in range(8)
    ]
    rows = (
        keys.filter(F.col(key).isNotNull())
        .select(F.shiftrightunsigned(first, 64 - block_bits).alias("block"), *[s.alias(f"s{i}") for i, s in enumerate(spots)])
        .groupBy("block").agg(*words).collect()
    )
    filled = np.zeros((1 << block_bits, 8), dtype=np.int64)
    for row in rows:
        filled[row[0]] = row[1:]
    return filled.view(np.uint64)


def tester(spark: SparkSession, blocks: np.ndarray):
    """A column function of a key: may it be one of the keys? False for null."""
    shared = spark.sparkContext.broadcast(blocks)
    block_bits = int(len(blocks)).bit_length() - 1

    @F.pandas_udf("boolean")
    def hit(first: pd.Series, second: pd.Series) -> pd.Series:
        words = shared.value
        known = (first.notna() & second.notna()).to_numpy()
        a = first.fillna(0).to_numpy(np.int64).view(np.uint64)
        b = second.fillna(0).to_numpy(np.int64).view(np.uint64)
        block = (a >> np.uint64(64 - block_bits)).astype(np.int64)
        for i in range(PROBES):
            spot = (b >> np.uint64(9 * i)) & np.uint64(511)
            word = words[block, (spot >> np.uint64(6)).astype(np.int64)]
            known = known & ((word >> (spot & np.uint64(63))) & np.uint64(1)).astype(bool)
        return pd.Series(known)

    return lambda key: hit(*hashes(key))
