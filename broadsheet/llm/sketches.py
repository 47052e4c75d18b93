"""Sketches: the low bits of minima, packed into integers, a plane of bits for each; and what they estimate."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOW_BITS = 2
BY_CHANCE = 0.5**LOW_BITS


def plane_size(hashes: int) -> int:
    """Integers that hold one bit of each minimum."""
    return -(-hashes // 64)


def pack_rows(least: np.ndarray) -> np.ndarray:
    """The sketches of rows of minima."""
    n, hashes = least.shape
    planes = np.zeros((n, LOW_BITS, plane_size(hashes) * 64), dtype=np.uint8)
    for bit in range(LOW_BITS):
        planes[:, bit, :hashes] = (least >> np.uint32(bit)) & np.uint32(1)
    packed = np.packbits(planes, axis=2, bitorder="little")
    return packed.reshape(n, LOW_BITS * plane_size(hashes) * 8).view(np.int64)


def pack(least: np.ndarray) -> np.ndarray:
    """The sketch of the minima of one set."""
    return pack_rows(least[None, :])[0]


def estimate(a: Column, b: Column, hashes: int) -> Column:
    """Similarity estimated from two sketches, corrected for agreement by chance."""
    different = F.lit(0)
    size = plane_size(hashes)
    for i in range(size):
        unequal = F.lit(0).cast("long")
        for bit in range(LOW_BITS):
            at = F.lit(bit * size + i)
            unequal = unequal.bitwiseOR(F.get(a, at).bitwiseXOR(F.get(b, at)))
        different = different + F.bit_count(unequal)
    agreement = F.lit(1.0) - different / F.lit(float(hashes))
    return (agreement - F.lit(BY_CHANCE)) / F.lit(1 - BY_CHANCE)


def estimates(some: np.ndarray, others: np.ndarray, hashes: int) -> np.ndarray:
    """:func:`estimate` of each row of sketches with that of others, or of one sketch with them all."""
    unequal = (others ^ some).reshape(len(others), LOW_BITS, others.shape[1] // LOW_BITS)
    different = np.bitwise_count(np.bitwise_or.reduce(unequal, axis=1).view(np.uint64)).sum(axis=1)
    return (1.0 - different / hashes - BY_CHANCE) / (1 - BY_CHANCE)
