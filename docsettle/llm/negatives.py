"""Hard negatives by exact integer scores, looked up in tables of subset sums.

Vectors become integers. For every group of eight dimensions of an anchor, a table holds the sums over
all 256 subsets of its components. A candidate's components are packed by bit planes: the byte of a
group and plane names the dimensions with that bit set, so the table has their sum ready, and a score is
one look-up per group and plane, shifted and added from the highest plane down (which counts negative, as
numbers are in two's complement). Tables of many anchors lie side by side, so one look-up reads the
sums of all of them.

Anchors are a stated part of the rows and meet all rows in blocks: a group of anchors of bounded size
goes to all tasks, which score their rows against it and keep no more than the best of each slot. An
anchor's positives are found first, from rows of its label only; they bound the scores of its negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsettle.session import staged

LIMIT = (1 << 25) - 1  # largest component
GROUP_ANCHORS = 32_768  # anchors that go to the tasks at once
_CHUNK, _ROWS, _ANCHORS = 65_536, 1_024, 256
_NONE = -(1 << 62)


def subset_sums(vectors: np.ndarray, kind: type) -> np.ndarray:
    """Per group of eight dimensions (their number divides by eight) the sums over its subsets: group, byte, vector."""
    groups = vectors.shape[1] // 8
    out = np.zeros((groups, 256, len(vectors)), kind)
    for g in range(groups):
        for i in range(8):
            np.add(out[g, : 1 << i], vectors[:, 8 * g + i].astype(kind), out=out[g, 1 << i : 2 << i])
    return out


def bit_planes(vectors: np.ndarray, bits: int) -> np.ndarray:
    """Components' bits in two's complement, eight dimensions to a byte: plane (highest first), group, vector."""
    planes = [np.packbits((vectors >> k & 1).astype(bool), axis=1, bitorder="little").T for k in reversed(range(bits))]
    return np.ascontiguousarray(np.stack(planes))


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products, one row per candidate and one column per vector of the tables."""
    shape = (planes.shape[2], tables.shape[2])
    out, sums = np.zeros(shape, tables.dtype), np.empty(shape, tables.dtype)
    for level, plane in enumerate(planes):
        out <<= 1
        for table, byte in zip(tables, plane, strict=True):
            np.take(table, byte, axis=0, out=sums, mode="clip")
            if level:
                out += sums
            else:
                out -= sums
    return out


class Best:
    """For each slot the ``k`` entries of the highest score, then smallest order."""

    def __init__(self, slots: int, k: int) -> None:
        self.k = k
        self.score = np.full((slots, k), _NONE)
        self.order = np.full((slots, k), np.iinfo(np.int64).max)

    def bar(self) -> np.ndarray:
        """The score from which on an entry can still come in."""
        return self.score[:, -1]

    def add(self, slot: np.ndarray, score: np.ndarray, order: np.ndarray) -> None:
        if not len(slot):
            return
        own = np.unique(slot)
        slot = np.concatenate((slot, np.repeat(own, self.k)))
        score = np.concatenate((score, self.score[own].ravel()))
        order = np.concatenate((order, self.order[own].ravel()))
        at = np.lexsort((order, -score, slot))
        first = np.concatenate(([0], (slot[at][1:] != slot[at][:-1]).nonzero()[0] + 1))
        take = at[(first[:, None] + np.arange(self.k)).ravel()]
        self.score[own], self.order[own] = score[take].reshape(-1, self.k), order[take].reshape(-1, self.k)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, place = (self.score != _NONE).nonzero()
        return slot, self.score[slot, place], self.order[slot, place]


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of ``dims`` integers; shorter vectors end in zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), dims), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = column.flatten().to_numpy()
    return out


def _chunks(batches: Iterator[pa.RecordBatch], rows: int = _CHUNK) -> Iterator[pa.Table]:
    held, count = [], 0
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            held.append(batch.slice(begin, rows))
            count += held[-1].num_rows
            if count >= rows:
                yield pa.Table.from_batches(held)
                held, count = [], 0
    if count:
        yield pa.Table.from_batches(held)


def best_rows(
    rows: DataFrame, anchors: dict[str, np.ndarray], kind: type, bits: int, k: int, slots: dict[str, np.ndarray] | None = None
) -> DataFrame:
    """``slot, score, order`` of the ``k`` best rows of each slot, as far as each task knows.

    Without ``slots``, an anchor's slot takes other rows of its label; else a slot names an anchor and the lowest and
    highest score that rows of other labels may have. ``order`` is a row's ``order``.
    """
    sent = rows.sparkSession.sparkContext.broadcast((anchors, slots))
    dims = anchors["q"].shape[1]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, slots = sent.value
        count, every = len(anchors["q"]), slots is not None
        best = Best(len(slots["anchor"]) if every else count, k)
        by_label = np.argsort(anchors["label"], kind="stable")
        cuts = (anchors["label"][by_label][1:] != anchors["label"][by_label][:-1]).nonzero()[0] + 1
        parts = [np.arange(count)] if every else np.split(by_label, cuts)  # anchors of one label meet rows of that label
        for chunk in _chunks(batches):
            label, order = (chunk.column(n).to_numpy() for n in ("label", "order"))
            vectors = _vectors(chunk.column("q").combine_chunks(), dims)
            for part in parts:
                mine = np.arange(len(label)) if every else (label == anchors["label"][part[0]]).nonzero()[0]
                planes = bit_planes(vectors[mine], bits)
                for begin in range(0, len(part), _ANCHORS):
                    own = part[begin : begin + _ANCHORS]
                    tables = subset_sums(anchors["q"][own], kind)
                    start, step = 0, _ROWS // 8  # few rows first, which set the bar
                    while start < len(mine):
                        at = mine[start : start + step]
                        found = scores(tables, planes[:, :, start : start + step])
                        if every:
                            other = label[at][:, None] != anchors["label"][own]
                            _into_slots(best, found, other, own, order[at], slots)
                        else:
                            hit = (found >= best.bar()[own]) & (order[at][:, None] != anchors["order"][own])
                            row, column = hit.nonzero()
                            best.add(own[column], found[row, column].astype(np.int64), order[at[row]])
                        start, step = start + step, _ROWS
        slot, score, order = best.rows()
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(score), pa.array(order)], ["slot", "score", "order"])

    return rows.select("label", "order", "q").mapInArrow(search, "slot long, score long, `order` long")


def _into_slots(
    best: Best, found: np.ndarray, other: np.ndarray, own: np.ndarray, order: np.ndarray, slots: dict[str, np.ndarray]
) -> None:
    """Scores of rows of ``other`` labels with anchors ``own`` into those anchors' slots, which stand in the order of anchors."""
    first, last = (np.searchsorted(slots["anchor"], own, side) for side in ("left", "right"))
    for nth in range(int((last - first).max(initial=0))):
        there = (first + nth < last).nonzero()[0]
        slot = first[there] + nth
        scored = found[:, there]
        hit = other[:, there] & (scored >= np.maximum(slots["low"][slot], best.bar()[slot])) & (scored <= slots["high"][slot])
        row, column = hit.nonzero()
        best.add(slot[column], scored[row, column].astype(np.int64), order[row])


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    scale: int = 256,
    group_anchors: int = GROUP_ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of each anchor's positives.

    Rows with a null label, a null vector, or a null or non-finite component take no part. A component is
    floor(scale * x), at most 2^25 either way; missing components of a shorter vector are 0. Scores are inner products with the anchor;
    higher ones come first, then smaller ids, then rows as they are staged (rows may share an id; null ids come last). Positives are
    the first ``positives`` other rows of the anchor's label. For each, the first ``negatives`` rows of other
    labels with ``low_percent`` to ``high_percent`` hundredths of its score; none where its score is negative.
    ``anchor`` says which rows are anchors (null: not). Without anchors or rows the result is empty. Other columns are not read.
    """
    spark = rows.sparkSession
    x = F.col("v").cast("array<double>")
    finite = F.forall(x, lambda c: F.coalesce(c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False)))
    whole = F.transform(x, lambda c: F.greatest(F.least(F.floor(F.greatest(F.least(scale * c, F.lit(1e9)), F.lit(-1e9))), F.lit(LIMIT)), F.lit(-LIMIT)))
    given = rows.select(
        F.col(id_col).alias("id"), F.col(vector_col).alias("v"), F.col(label_col).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    found = given.where("label IS NOT NULL AND v IS NOT NULL").where(finite)
    found = found.select("id", "label", "anchor", whole.cast("array<int>").alias("q"))
    # ids may repeat or be null: rows are known by their place in the order of ids
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = found.repartitionByRange(parts, F.col("id").asc_nulls_last()).sortWithinPartitions(F.col("id").asc_nulls_last())
    known = staged(first.withColumn("order", F.monotonically_increasing_id()), "vectors")
    most = known.agg(F.max(F.size("q")), F.max(F.array_max(F.transform("q", lambda c: F.abs(c)))), F.count_if("anchor")).first()
    dims, largest, count = (v or 0 for v in most)
    dims = max(8, -(-dims // 8) * 8)
    bits = max(int(largest).bit_length() + 1, 2)
    kind = np.int32 if dims * (largest + 1) ** 2 * 2 < 1 << 31 else np.int64
    groups = -(-count // group_anchors)
    kind_of_id = known.schema["id"].dataType.simpleString()
    names = known.select("order", "id")
    by_slot = Window.partitionBy("slot").orderBy(F.col("score").desc(), "order")

    def first_of(part: DataFrame, k: int) -> DataFrame:
        return part.withColumn("rank", F.row_number().over(by_slot)).where(F.col("rank") <= k)

    result = None
    for group in range(groups):
        own = known.where("anchor").where(F.pmod(F.xxhash64("order"), F.lit(groups)) == group)
        table = own.select("order", "label", "q", "id").toArrow().sort_by("order")  # about ``group_anchors`` rows
        if not table.num_rows:
            continue
        held = {n: table.column(n).to_numpy() for n in ("order", "label")} | {"q": _vectors(table.column("q").combine_chunks(), dims)}
        chosen = first_of(best_rows(known, held, kind, bits, positives), positives).join(names, "order")
        chosen = chosen.toArrow().sort_by([("slot", "ascending"), ("rank", "ascending")])  # ``positives`` rows an anchor
        slot, score = (chosen.column(n).to_numpy() for n in ("slot", "score"))
        slots = {"anchor": slot, "low": -(-low_percent * score // 100), "high": high_percent * score // 100}
        mined = first_of(best_rows(known, held, kind, bits, negatives, slots), negatives)
        pairs = {"slot": np.arange(len(slot)), "anchor_id": table.column("id").take(pa.array(slot))}
        pairs |= {"positive_id": chosen.column("id"), "positive_score": score}
        pairs = spark.createDataFrame(pa.table(pairs), f"slot long, anchor_id {kind_of_id}, positive_id {kind_of_id}, positive_score long")
        part = mined.join(F.broadcast(pairs), "slot").join(names.withColumnRenamed("id", "negative_id"), "order")
        part = part.withColumnRenamed("score", "negative_score").select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        )
        part = staged(part, "mined") if groups > 1 else part
        result = part if result is None else result.union(part)
    if result is None:
        schema = "anchor_id {0}, positive_id {0}, rank int, negative_id {0}, positive_score long, negative_score long"
        return spark.createDataFrame([], schema.format(kind_of_id))
    return result
