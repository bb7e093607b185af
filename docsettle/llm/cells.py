"""Exact links inside cells: groups of nodes outside of which a node has no link.

``cells`` rows are ``cell, node`` (binary), ``payload`` (binary, what a node is compared by)
and ``weight`` (long, its share of a task's memory).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsettle.session import discard, staged

#: ``links(left, right)``: index pairs of linked payloads; ``right`` None: within ``left``, enough to connect what belongs together.
Links = Callable[[list[bytes], list[bytes] | None], list[tuple[int, int]]]

EDGE = "a binary, b binary"
FEW_HEAVY = 100_000  # so many heavy cells' names are sent to all tasks


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of equal leading columns of sorted batches."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield key, rows


def _edges(pairs: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in pairs], pa.binary()), pa.array([b for _, b in pairs], pa.binary())], ["a", "b"]
    )


def cell_links(cells: DataFrame, links: Links, task_weight: int) -> DataFrame:
    """Edges ``a, b`` that connect each cell's linked nodes.

    A cell of up to ``task_weight`` goes to one task. A heavier one is never gathered: first
    its least node is the pivot and every other node is compared with it where it lies; only
    nodes without a link to the pivot then meet the cell's other nodes, block by block, each
    block of bounded weight. Two nodes that both have a link to the pivot are connected already.
    """
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = staged(cells.select("cell", "node", "payload", "weight"), "cells")
    totals = cells.groupBy("cell").agg(F.sum("weight").alias("total"), F.count("*").alias("nodes"))
    heavy = totals.where(F.col("total") > task_weight).where("nodes > 1")
    few = heavy.limit(FEW_HEAVY + 1).count()  # mostly none, and then nothing has to move for them
    kept = cells.join(F.broadcast(heavy) if few <= FEW_HEAVY else heavy, "cell", "left_anti") if few else cells
    light = (
        kept.select("cell", "node", "payload")
        .repartition(parts, "cell")
        .sortWithinPartitions("cell", "node")
    )

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, 1):
            if len(rows) > 1:
                yield _edges([(rows[i][0], rows[j][0]) for i, j in links([p for _, p in rows], None)])

    found = light.mapInArrow(within, EDGE)
    blocks = heavy.select("cell", F.ceil(2 * F.col("total") / task_weight).cast("long").alias("blocks"))
    if not few:
        return found

    found = staged(found, "found")  # so that what it shuffles is gone before heavy cells are compared
    members = cells.join(blocks, "cell")
    least = members.groupBy("cell").agg(F.min("node").alias("node"))
    pivots = members.join(least, ["cell", "node"]).select("cell", F.col("node").alias("pivot"), F.col("payload").alias("of"))

    def star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot, of, payload = (batch.column(n).to_pylist() for n in ("pivot", "of", "payload"))
            node = batch.column("node").to_pylist()
            near = [node[i] == pivot[i] or bool(links([payload[i]], [of[i]])) for i in range(len(node))]
            columns = {n: batch.column(n) for n in ("cell", "node", "payload", "blocks", "pivot")}
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(near, pa.bool_())], [*columns, "near"])

    spread = F.pmod(F.xxhash64("node"), F.col("blocks"))
    tried = staged(
        members.join(pivots, "cell")
        .select("cell", "node", "payload", "blocks", "pivot", "of")
        .mapInArrow(star, "cell binary, node binary, payload binary, blocks long, pivot binary, near boolean")
        .withColumn("block", spread),
        "star",
    )
    discard(cells)
    far = tried.where("NOT near")
    rows_of = far.select("cell", F.col("block").alias("i")).distinct()
    left = far.select("cell", F.col("block").alias("i"), F.explode(F.expr("sequence(0L, blocks - 1)")).alias("j"), "node", "payload", F.lit(True).alias("is_left"))
    right = tried.join(rows_of, "cell").select("cell", "i", F.col("block").alias("j"), "node", "payload", F.lit(False).alias("is_left"))
    met = left.union(right).repartition(parts, "cell", "i", "j").sortWithinPartitions("cell", "i", "j")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, 3):
            one, two = [r for r in rows if r[2]], [r for r in rows if not r[2]]
            if one and two:
                yield _edges([(one[i][0], two[j][0]) for i, j in links([r[1] for r in one], [r[1] for r in two])])

    near = tried.where("near AND node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    return found.union(near).union(met.mapInArrow(across, EDGE))
