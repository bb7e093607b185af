"""Sketches of fixed size: a bitmap that never misses a key of a set, and rough counts of hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24  # 2 MB, whatever the set; a fuller bitmap lets more rows pass, and joins decide
COUNTERS, BLOCKS = 1 << 20, 256  # 4 MB, whatever is counted


def _places(keys: list[bytes] | np.ndarray) -> np.ndarray:
    if isinstance(keys, list):  # digests
        keys = np.frombuffer(b"".join(k[:8] for k in keys), np.uint64)
    return (keys.view(np.uint64) % np.uint64(BITS)).astype(np.int64)


def _keys(column: pa.Array) -> list[bytes] | np.ndarray:
    return column.to_numpy() if pa.types.is_int64(column.type) else column.to_pylist()


def bitmap(keys: DataFrame) -> Broadcast:
    """The bitmap of a frame with one column of digests (binary) or hashes (long); at most 262,144 rows come back."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(BITS // 64, np.uint64)
        for batch in batches:
            place = _places(_keys(batch.column(0)))
            np.bitwise_or.at(own, place >> 6, np.uint64(1) << (place & 63).astype(np.uint64))
        at = own.nonzero()[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(own[at].view(np.int64))], ["word", "bits"])

    merged = keys.mapInArrow(words, "word long, bits long").groupBy("word").agg(F.expr("bit_or(bits)").alias("bits"))
    rows = merged.toArrow()
    full = np.zeros(BITS // 64, np.uint64)
    full[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(full)


def possible(full: np.ndarray, keys: list[bytes] | np.ndarray) -> np.ndarray:
    """Which keys can be in the set."""
    place = _places(keys)
    return (full[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1


def counters(rows: DataFrame, hashes: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]) -> Broadcast:
    """Counts of the hashes that ``hashes`` draws from batches of ``rows``; hashes may share a counter.

    Every task sends its counters in blocks, which are added up block by block.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def blocks(counts: dict[int, np.ndarray]) -> pa.RecordBatch:
        values = [np.minimum(c, 0xFFFFFFFF).astype(np.uint32).tobytes() for c in counts.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(values, pa.binary())], ["block", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(COUNTERS, np.uint32)
        for part in hashes(batches):
            np.add.at(own, (part % np.uint64(COUNTERS)).astype(np.int64), np.uint32(1))
        yield blocks({k: c for k, c in enumerate(own.reshape(BLOCKS, -1)) if c.any()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                own = sums.setdefault(block, np.zeros(COUNTERS // BLOCKS, np.uint64))
                own += np.frombuffer(counts, np.uint32)
        yield blocks(sums)

    schema = "block int, counts binary"
    found = rows.mapInArrow(count, schema).repartition(parts, "block").mapInArrow(add, schema).toArrow()
    whole = np.zeros((BLOCKS, COUNTERS // BLOCKS), np.uint32)
    for block, counts in zip(*(column.to_pylist() for column in found.columns), strict=True):
        whole[block] = np.frombuffer(counts, np.uint32)
    return spark.sparkContext.broadcast(whole.reshape(-1))


def tally(counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The counter of every hash."""
    return counts[(hashes % np.uint64(COUNTERS)).astype(np.int64)]
