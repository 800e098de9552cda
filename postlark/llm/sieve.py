"""A bitmap of fixed size that tells which 64-bit keys cannot be in a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlark.llm.words import mix

BITS = 26


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The word of 64 bits, and the bit in it, of each key."""
    spread = mix(keys.astype(np.int64).view(np.uint64))
    word = (spread >> np.uint64(64 - bits + 6)).astype(np.int64)
    return word, np.uint64(1) << (spread & np.uint64(63))


def _first_column(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).drop_null().to_numpy()


def sieve(
    keys: DataFrame,
    bits: int = BITS,
    key_of: Callable[[pa.RecordBatch], np.ndarray] = _first_column,
) -> bytes:
    """The bitmap of the values of one bigint column: ``2 ** bits`` bits for any number of rows.

    ``key_of`` makes the keys of other rows, in the same worker.

    Its words are combined before they are shuffled, so at most ``2 ** (bits - 6)`` rows of two
    numbers reach the driver. The more keys, the more others pass too; a join drops those.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, bit = _places(key_of(batch), bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(word), pa.array(bit.view(np.int64))], names=["word", "bit"]
            )

    words = keys.mapInArrow(run, "word bigint, bit bigint")
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out.tobytes()


def passes(keys: np.ndarray, bitmap: bytes) -> np.ndarray:
    """Which keys may be in the table."""
    words = np.frombuffer(bitmap, dtype=np.uint64)
    word, bit = _places(keys, len(words).bit_length() - 1 + 6)
    return (words[word] & bit) != 0
