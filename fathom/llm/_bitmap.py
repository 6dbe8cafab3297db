"""A bitmap of fixed size over 64-bit hashes: what a task need not look at further. False marks are joined away."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def slot(h: Column, bits: int) -> Column:
    """The place of a hash: its highest bits."""
    return F.shiftrightunsigned(h, 64 - bits).cast("int")


def bitmap(df: DataFrame, h: Column, bits: int) -> np.ndarray:
    """2**bits marks as words of 64, gathered by aggregation: the driver gets 2**bits / 64 rows at most."""
    words = df.select(slot(h, bits).alias("s")).selectExpr("shiftright(s, 6) AS word", "shiftleft(1L, s & 63) AS mark").groupBy("word").agg(F.bit_or("mark").alias("mark"))
    out = np.zeros(1 << (bits - 6), np.uint64)
    for r in words.toLocalIterator():
        out[r["word"]] = np.uint64(r["mark"] & (1 << 64) - 1)
    return out


def marked(words: np.ndarray, slots: np.ndarray) -> np.ndarray:
    s = slots.astype(np.int64)
    return (words[s >> 6] >> (s & 63).astype(np.uint64)) & np.uint64(1) == 1
