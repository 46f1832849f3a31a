"""64-bit mixing, and Bloom filters of bounded size that are made in parts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U = np.uint64
#: Bits of a filter: about so many for each hash, a power of two and MOST_BITS (16 MB) at most. With more
#: hashes than that more passes that is not in it, and what passes is always joined exactly.
BITS_EACH, MOST_BITS, PROBES_EACH = 32, 1 << 27, 4


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def bits_for(n: int) -> int:
    return min(MOST_BITS, max(64, 1 << (BITS_EACH * max(1, n) - 1).bit_length()))


def _place(h: np.ndarray, i: int, bits: int) -> np.ndarray:
    return (mix(h + U(0xA24BAED4963EE407 * i % 2**64)) if i else h) & U(bits - 1)


def bloom(hashes: DataFrame, bits: int) -> np.ndarray:
    """A filter of the well-mixed hashes in column h, made in parts and joined bit by bit.

    The driver holds the filter and its words with their places as Arrow blocks: three times its size.
    """

    def run(batches):
        for b in batches:
            h = np.asarray(b.column(0)).view(U)
            at = np.unique(np.concatenate([_place(h, i, bits) for i in range(PROBES_EACH)]))
            word, first = np.unique(at >> U(6), return_index=True)
            value = np.bitwise_or.reduceat(U(1) << (at & U(63)), first) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(value.view(np.int64))], ["word", "value"])

    out = np.zeros(bits >> 6, U)
    words = hashes.select("h").mapInArrow(run, "word bigint, value bigint").groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
    for b in words.to_batches():
        out[np.asarray(b.column(0))] = np.asarray(b.column(1)).view(U)
    return out


def passes(h: np.ndarray, filter_: np.ndarray) -> np.ndarray:
    """Indices of the hashes that a filter lets pass."""
    left = np.arange(len(h))
    for i in range(PROBES_EACH):
        at = _place(h[left], i, len(filter_) << 6)
        left = left[(filter_[(at >> U(6)).astype(np.int64)] >> (at & U(63)) & U(1)) == 1]
    return left
