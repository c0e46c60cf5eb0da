"""A membership filter of fixed size, whatever the number of keys.

A bitmap of 2**26 bits (8 MB) is broadcast to say that a key is surely absent. Keys that
pass may be absent too, so an exact join decides about them. The more keys, the more rows
reach that join; results do not change.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26


def bitmap(keys: DataFrame, bit: Column) -> Broadcast:
    """Broadcast the bitmap of `bit`, a long whose low 26 bits are used.

    Bits are combined to words of 64 in the aggregation: at most 2**20 rows, 16 MB, reach
    the driver.
    """
    low = bit.bitwiseAND(F.lit(BITS - 1))
    word = F.bit_or(F.expr("shiftleft(1L, cast(low & 63 as int))"))
    found = keys.select(low.alias("low")).groupBy(F.shiftright("low", 6).alias("at")).agg(word.alias("word"))
    table = found.toPandas()
    out = np.zeros(BITS // 64, np.int64)
    out[table["at"].to_numpy(np.int64)] = table["word"].to_numpy(np.int64)
    return keys.sparkSession.sparkContext.broadcast(out)


def test(words: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether the low 26 bits of each value are set."""
    low = bits.astype(np.int64) & (BITS - 1)
    return (words[low >> 6] >> (low & 63)) & 1 == 1


def _maybe(keys: DataFrame, on: list[str]):
    shared = bitmap(keys, F.xxhash64(*on))

    @F.arrow_udf("boolean")
    def maybe(hashed: pa.Array) -> pa.Array:
        return pa.array(test(shared.value, hashed.to_numpy()))

    return maybe(F.xxhash64(*on))


def _join(df: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join where null equals null."""
    right = keys.select([F.col(c).alias(f"_k_{c}") for c in on]).distinct()
    return df.join(right, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in on]), how)


def only(df: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    """Rows of `df` whose `on` is among `keys`: only rows that pass the bitmap are shuffled."""
    return _join(df.where(_maybe(keys, [*on])), keys, [*on], "left_semi")


def without(df: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    """Rows of `df` whose `on` is not among `keys`."""
    hit = _maybe(keys, [*on])
    return df.where(~hit).unionByName(_join(df.where(hit), keys, [*on], "left_anti"))
