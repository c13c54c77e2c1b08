"""A blocked Bloom filter of 64-bit keys, of bounded size, that tasks fill and Spark joins."""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Blocks have 8 words of 64 bits, for 32 keys each; at most MAX_BLOCKS of them, which is 64 MB. More keys
# than that make the filter let through more.
BLOCK_KEYS, LANES, MAX_BLOCKS = 32, 8, 1 << 20
SALTS = np.random.default_rng(7).integers(0, 1 << 32, LANES, dtype=np.uint64) | np.uint64(1)


def places(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Block of each key, and its bit in each word of the block."""
    x = keys.view(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(31))
    low = x & np.uint64(0xFFFFFFFF)
    bits = [np.uint64(1) << ((low * s & np.uint64(0xFFFFFFFF)) >> np.uint64(26)) for s in SALTS]
    return ((x >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64), bits


def set_bits(blocks: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, bits = places(batch.column(0).to_numpy(zero_copy_only=False), blocks)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block), *[pa.array(b.view(np.int64)) for b in bits]],
                names=["block", *[f"l{i}" for i in range(LANES)]])

    return run


def build(keys: DataFrame, max_blocks: int = MAX_BLOCKS) -> np.ndarray:
    """Filter (blocks, LANES) of the one column of `keys`, a long without nulls. The driver gets the blocks."""
    blocks = max(1, min(max_blocks, keys.count() // BLOCK_KEYS + 1))
    lanes = [f"l{i}" for i in range(LANES)]
    filled = keys.mapInArrow(set_bits(blocks), "block long, " + ", ".join(f"{c} long" for c in lanes))
    found = filled.groupBy("block").agg(*[F.bit_or(c).alias(c) for c in lanes]).toArrow()
    out = np.zeros((blocks, LANES), np.uint64)
    if found.num_rows:
        out[found["block"].to_numpy()] = np.stack([found[c].to_numpy().view(np.uint64) for c in lanes], 1)
    return out


def may_hold(bloom: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys the filter lets through: all it was built from, and few others."""
    block, bits = places(keys, len(bloom))
    out = np.ones(len(keys), bool)
    for lane, bit in enumerate(bits):
        out &= (bloom[block, lane] & bit) != 0
    return out
