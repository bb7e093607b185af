"""Connected groups over edges that no task and no driver holds as a whole."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsettle.session import staged


def equal_key_links(entries: DataFrame) -> DataFrame:
    """Edges ``a, b`` that connect all nodes of each ``key`` (``entries``: key long, node binary).

    Entries are range-partitioned by key *and* node, so a key with a third of all entries is
    spread over many tasks. Each task links a key's nodes to the first one it sees; keys that
    continue in the next task are linked by the first and last row of every task.
    """
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = entries.repartitionByRange(parts, "key", "node").sortWithinPartitions("key", "node")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = first = last = None
        edges: tuple[list, list, list] = ([], [], [])

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(edges[0], pa.int64()), pa.array(edges[1], pa.binary()), pa.array(edges[2], pa.binary())],
                ["key", "a", "b"],
            )
            for column in edges:
                column.clear()
            return out

        for batch in batches:
            keys, nodes = batch.column(0).to_numpy(), batch.column(1)
            if not len(keys):
                continue
            starts = [0, *((keys[1:] != keys[:-1]).nonzero()[0] + 1).tolist(), len(keys)]
            if key is None:  # the first row of the task
                edges[0].append(int(keys[0])), edges[1].append(nodes[0].as_py()), edges[2].append(None)
            for begin, end in zip(starts, starts[1:], strict=False):
                if end - begin == 1 and keys[begin] != key:
                    continue
                run = nodes[begin:end].to_pylist()
                head = first if keys[begin] == key else run[0]
                for node in run:
                    if node != head:
                        edges[0].append(None), edges[1].append(head), edges[2].append(node)
            begin = starts[-2]
            if keys[begin] != key:
                key, first = keys[begin], nodes[begin].as_py()
            last = nodes[len(keys) - 1].as_py()
            if len(edges[0]) > 50_000:
                yield flush()
        if key is not None:
            edges[0].append(int(key)), edges[1].append(last), edges[2].append(None)
            yield flush()

    found = staged(ordered.mapInArrow(runs, "key long, a binary, b binary"), "links")
    ends = found.where("b IS NULL").select("key", "a").distinct()  # two rows a task
    joints = ends.select("a", F.min("a").over(Window.partitionBy("key")).alias("b")).where("a != b")
    return found.where("b IS NOT NULL").select("a", "b").union(joints)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (a, b); the root is a group's smallest node.

    Large-star and small-star steps in turn: each joins edges with one minimum per node, so no
    group meets in one task; rounds grow with the logarithm of a group's diameter. Every
    round is a table in the shared folder.
    """

    def state(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())

    now = staged(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    before, after = None, state(now)
    while before != after and after[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = staged(small.union(low).distinct(), "edges")
        before, after = after, state(now)
    pairs = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def batch_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a text column, without decoding them."""
    return pc.cast(column, pa.large_binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Parts of the batches, so that few texts are in pieces at once.

    Workers live on between tasks, so what was freed goes back to the system after each batch.
    """
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)
        del batch
        pa.default_memory_pool().release_unused()
        if trim:
            trim(0)
