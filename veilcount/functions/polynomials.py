"""Share values of many messages at once, for the tasks that seal.

The coefficients are those of ``shares.share_values``. They depend on the class only, so a batch makes them once for all
its messages of a class, and evaluates its polynomials together.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

PRIME = 2**31 - 1
LIMBS = 8

_X1, _X2, _X3, _X4, _X5 = (
    np.uint64(n)
    for n in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _turned(number: np.ndarray, bits: int) -> np.ndarray:
    return (number << np.uint64(bits)) | (number >> np.uint64(64 - bits))


def _spread(number: np.ndarray) -> np.ndarray:
    number = (number ^ (number >> np.uint64(33))) * _X2
    number = (number ^ (number >> np.uint64(29))) * _X3
    return number ^ (number >> np.uint64(32))


def _hash_long(number: np.ndarray) -> np.ndarray:
    """``F.xxhash64`` of a BIGINT column."""
    mixed = np.uint64(42) + _X5 + np.uint64(8)
    return _spread(_turned(mixed ^ (_turned(number * _X2, 31) * _X1), 27) * _X1 + _X4)


def _hash_int(number: np.ndarray, before: np.ndarray) -> np.ndarray:
    """``F.xxhash64`` of an INT column behind columns of the hash ``before``."""
    return _spread(_turned((before + (_X5 + np.uint64(4))) ^ (number * _X1), 23) * _X2 + _X3)


def _folded(number: np.ndarray) -> np.ndarray:
    """At most 4 above the remainder by the prime 2^31 - 1 of numbers from 0 to 2^63."""
    for _ in range(2):
        number = (number & PRIME) + (number >> 31)
    return number


def values_at(seeds: np.ndarray, thresholds: np.ndarray, xs: np.ndarray, limbs: np.ndarray) -> np.ndarray:
    """A row of values for each message: Horner's rule from the highest degree, k - 1, down to the limbs.

    One degree's coefficients are held at a time, so memory does not grow with thresholds.
    """
    if len(seeds) and thresholds.min() < 2:
        raise ValueError("a threshold below 2 cannot be shared")
    order = np.argsort(-thresholds, kind="stable")
    ordered, x = thresholds[order], xs[order, None]
    # Classes in the order of their thresholds, so that the first ones are those that have a degree.
    classes, first, of_row = np.unique(np.stack((-ordered, seeds[order])), axis=1, return_index=True, return_inverse=True)
    of_row = of_row.reshape(-1)
    hashed = _hash_long(np.ascontiguousarray(classes[1]).view(np.uint64))
    values = np.zeros((len(seeds), LIMBS), np.int64)
    numbers = np.arange(LIMBS, dtype=np.uint64)
    for degree in range(int(thresholds.max(initial=1)) - 1, 0, -1):
        rows = int(np.searchsorted(-ordered, -degree))
        some = int(np.searchsorted(classes[0], -degree))
        made = _hash_int(numbers, _hash_int(np.array([degree], np.uint64), hashed[:some])[:, None])
        made = made.view(np.int64) % PRIME
        values[:rows] = _folded((values[:rows] + made[of_row[:rows]]) * x[:rows])
    found = np.empty_like(values)
    found[order] = values
    return (found + limbs) % PRIME


@F.arrow_udf(returnType=ArrayType(LongType()))
def _share_values(seed: pa.Array, threshold: pa.Array, x: pa.Array, limbs: pa.Array) -> pa.Array:
    numbers = limbs.flatten()
    known = numbers.is_valid().to_numpy(zero_copy_only=False).reshape(-1, LIMBS).all(axis=1)
    known &= threshold.is_valid().to_numpy(zero_copy_only=False)
    values = np.zeros((len(seed), LIMBS), np.int64)
    given = [column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[known] for column in (seed, threshold, x)]
    values[known] = values_at(*given, numbers.fill_null(0).to_numpy(zero_copy_only=False).reshape(-1, LIMBS)[known])
    listed = pa.array(values.reshape(-1), pa.int64(), mask=np.repeat(~known, LIMBS))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(seed) + 1) * LIMBS, pa.int32()), listed)


def share_values(seed: Column, threshold: Column, x: Column, limbs: Column) -> Column:
    """One y per limb, as ``shares.share_values`` gives it, from the class's ``shares.class_seed`` and its key's limbs."""
    return _share_values(seed, threshold, x, limbs)


# The functions that run in Python workers travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
