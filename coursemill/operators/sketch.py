"""Approximate membership: a split-block Bloom filter built and probed as a distributed table.

A block is eight words of 32 bits. A key belongs to one block and sets one bit in each of its words, so a probe meets 32
bytes and tests bits of whole numbers.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS, WORD_BITS = 8, 32
SIZE = 1_000_000  # fixed values: expected members and target share of false positives
FPP = 0.01


def expected_fpp(size: int, blocks: int) -> float:
    """Share of others that pass: keys fall into blocks at random, so a block's number of keys is Poisson."""
    mean = size / blocks
    most = int(mean + 12 * math.sqrt(mean) + 20)
    share, seen = 0.0, math.exp(-mean)
    for keys in range(most):
        share += seen * (1 - (1 - 1 / WORD_BITS) ** keys) ** WORDS
        seen *= mean / (keys + 1)
    return share


def bloom_blocks(size: int = SIZE, fpp: float = FPP) -> int:
    """The least number of blocks that keeps ``size`` members within a false-positive share of ``fpp``."""
    # Between a block per key and the fewest that a mean of 400 keys to a block needs.
    low, high = max(1, size // 400), max(1, size)
    while expected_fpp(size, high) > fpp:
        low, high = high, high * 2
    while low < high:
        middle = (low + high) // 2
        low, high = (middle + 1, high) if expected_fpp(size, middle) > fpp else (low, middle)
    return low


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """For each word the number that has the key's bit set: five bits of one hash say which."""
    spot = F.xxhash64(key, F.lit(1))
    spots = [F.shiftright(spot, 5 * i).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1), s) for s in spots]


def bloom_build(members: DataFrame, key: str, size: int = SIZE, fpp: float = FPP) -> DataFrame:
    """The filter as rows (block, w0 to w7).

    Bits are set inside each task and merged by block, so the shuffle carries
    blocks and not keys. Null is never a member.
    """
    c = F.col(key)
    set_bits = members.where(c.isNotNull()).select(
        _block(c, bloom_blocks(size, fpp)).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits(c))])
    return set_bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def bloom_membership(probe: DataFrame, key: str, bloom: DataFrame, size: int = SIZE, fpp: float = FPP) -> DataFrame:
    """``probe`` with ``maybe``: false means surely no member.

    A probe row meets one block, so its row is not copied per hash. ``size``
    and ``fpp`` must be those the filter was built with.
    """
    c = F.col(key)
    names = {"block": "_block", **{f"w{i}": f"_w{i}" for i in range(WORDS)}}
    met = probe.withColumn("_block", _block(c, bloom_blocks(size, fpp))).join(bloom.withColumnsRenamed(names), "_block", "left")
    hit = reduce(lambda a, b: a & b, [F.col(f"_w{i}").bitwiseAND(bit) != 0 for i, bit in enumerate(_bits(c))])
    return met.withColumn("maybe", F.coalesce(hit & c.isNotNull(), F.lit(False))).drop(*names.values())
