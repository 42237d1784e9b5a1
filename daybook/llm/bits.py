"""Sets of hashes as bitmaps of a fixed size, which tasks use to leave out most of what is not in a set.

A hash that is not in the set may be found, at the rate at which bits are set; one that
is in it is always found. So a bitmap may only save work, never decide a result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the bits of a bitmap: 16 MB, whatever the input.
BITS = 27
MASK = (1 << BITS) - 1
#: Words of 64 bits that come to the driver as one row.
_CHUNK = 1 << 13


def has(bits: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Which of the indices (uint64) are set in the bytes of a bitmap."""
    return (bits[index >> np.uint64(3)] >> (index & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def _chunk(rows: pd.DataFrame) -> pd.DataFrame:
    bits = np.zeros(_CHUNK, dtype=np.int64)
    bits[rows["word"].to_numpy(dtype=np.int64) % _CHUNK] = rows["bits"].to_numpy(dtype=np.int64)
    return pd.DataFrame({"chunk": [int(rows["chunk"].iloc[0])], "bits": [bits.tobytes()]})


def bitmap(index: Column, keys: DataFrame):
    """The bits of the rows' indices, broadcast as bytes.

    Bits are united by a shuffle, 64 to a row; they come to the driver in chunks, 16 MB together at most.
    """
    spark = keys.sparkSession
    word, bit = F.shiftright(index, 6), index.bitwiseAND(F.lit(63)).cast("int")
    words = (
        keys.select(word.alias("word"), bit.alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .withColumn("chunk", F.expr(f"word div {_CHUNK}"))
    )
    whole = bytearray(1 << (BITS - 3))
    for row in words.groupBy("chunk").applyInPandas(_chunk, "chunk long, bits binary").toLocalIterator():
        at = row["chunk"] * _CHUNK * 8
        whole[at : at + _CHUNK * 8] = row["bits"]
    return spark.sparkContext.broadcast(bytes(whole))
