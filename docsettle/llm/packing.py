"""Documents packed into sequences of a fixed number of tokens: best fit, then local search.

Pieces are dealt into groups of bounded size by their hash, so no task holds more. A group is
packed best-fit decreasing; then documents move between its underfull sequences, one for one,
two for one or alone, whenever the sum of squared fills grows, until sequences are empty or no
exchange helps. The underfull sequences of all groups meet in fewer groups and the search goes
on, until one group holds what is left or a round empties no sequence.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsettle.llm.components import slices
from docsettle.llm.tokens import MOST_WORDS, worker_encoder
from docsettle.session import staged

END = np.array([0], "<u4").tobytes()


def cut(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces; only the first may be shorter than the capacity."""
    if tokens <= capacity:
        return [(0, tokens)]
    first = tokens % capacity
    whole = [(start, capacity) for start in range(first, tokens, capacity)]
    return [(0, first), *whole] if first else whole


def pieces(
    documents: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    with_ids: bool = True,
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """``id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` (little-endian, 4 bytes each).

    A document is the ids of its whole text and id 0; a null text is an empty one. ``most_words`` bounds the words
    whose ids a worker remembers: memory for time.
    """
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_path, most_words)
        for part in slices(batches, 512):
            rows, numbers, starts, lengths, sums, ids = [], [], [], [], [], []
            for row, text in enumerate(part.column(1).to_pylist()):
                found = encoder.ids(text or "") + END
                for number, (start, length) in enumerate(cut(len(found) // 4, capacity)):
                    own = found[4 * start : 4 * (start + length)]
                    rows.append(row), numbers.append(number), starts.append(start), lengths.append(length)
                    sums.append(zlib.crc32(own)), ids.append(own if with_ids else None)
            columns = {
                "id": part.column(0).take(pa.array(rows, pa.int64())),
                "piece": pa.array(numbers, pa.int32()),
                "start": pa.array(starts, pa.int64()),
                "length": pa.array(lengths, pa.int64()),
                "ids_crc32": pa.array(sums, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kind = rows.schema["id"].dataType.simpleString()
    ids = ", ids binary" if with_ids else ""
    return rows.mapInArrow(encode, f"id {kind}, piece int, start long, length long, ids_crc32 long{ids}")


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item: the fullest one it fits in, longest items first."""
    bins = np.empty(len(lengths), np.int64)
    free: list[tuple[int, int]] = []  # of open bins, sorted
    opened = 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        at = bisect_left(free, (size, -1))
        if at == len(free):
            room, into = capacity, opened
            opened += 1
        else:
            room, into = free.pop(at)
        bins[item] = into
        if room > size:
            insort(free, (room - size, into))
    return bins


def local_search(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Better bins: exchanges that grow the sum of squared fills, until none does.

    Bins are taken from the emptiest up. For each, the exchange that fills another underfull bin
    most is made: an item moves there, or takes the place of a shorter one, or two items do.
    """
    bins = bins.copy()
    fill = np.bincount(bins, lengths).astype(np.int64)
    loose = np.isin(bins, ((fill > 0) & (fill < capacity)).nonzero()[0])
    item = loose.nonzero()[0]  # items of underfull bins
    size, of = lengths[item].astype(np.int64), bins[item]
    settled: set[int] = set()
    while True:
        open_bins = [b for b in np.unique(of).tolist() if fill[b] < capacity and b not in settled]
        if not open_bins:
            break
        low = min(open_bins, key=lambda b: (fill[b], b))
        if not _improve(low, size, of, fill, capacity):
            settled.add(low)
    bins[item] = of
    return bins


def _improve(low: int, size: np.ndarray, of: np.ndarray, fill: np.ndarray, capacity: int) -> bool:
    """Make the best exchanges of one bin until it is empty or none is left; whether any was made."""
    made = False
    while fill[low]:
        own = (of == low).nonzero()[0]
        other = (of != low).nonzero()[0]
        if not len(other):
            return made
        room, full = capacity - fill[of[other]], fill[of[other]]
        best, change = 0, None

        def consider(gain: np.ndarray, step: np.ndarray, given: list[int], swapped: bool, other=other, full=full, room=room) -> None:
            nonlocal best, change
            squared = np.where((step > 0) & (step <= room), 2 * step * (full - fill[low] + step), 0)
            k = int(np.argmax(squared))
            if squared[k] > best:
                best, change = int(squared[k]), (given, int(other[k]), swapped)

        seen: set[int] = set()
        for i in own.tolist():
            if size[i] not in seen:  # equal lengths are alike
                seen.add(int(size[i]))
                consider(None, np.full(len(other), size[i]), [i], False)
                consider(None, size[i] - size[other], [i], True)
        first = {int(s): k for k, s in zip(own[::-1].tolist(), size[own][::-1], strict=True)}
        last = {int(s): k for k, s in zip(own.tolist(), size[own], strict=True)}
        lengths = sorted(first)
        for x, a in enumerate(lengths):
            for b in lengths[x:]:
                if (a != b or first[a] != last[b]) and a + b <= capacity:
                    consider(None, a + b - size[other], [first[a], last[b]], True)
        if change is None:
            return made
        given, partner, swapped = change
        into = of[partner]
        if swapped:
            of[partner] = low
            fill[low] += size[partner]
            fill[into] -= size[partner]
        for i in given:
            of[i] = into
            fill[low] -= size[i]
            fill[into] += size[i]
        made = True
    return made


def pack(pieces: DataFrame, capacity: int = 2048, group_rows: int = 20_000, underfull: float = 0.98) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: places without gaps or overlap.

    Every column of the input stays; it must have ``length`` (1 to ``capacity``) and none of the
    two new names. Repeated rows are pieces of their own; an empty table gives an empty one.
    Sequences are at most ``capacity`` long; numbers are unique, not dense. ``group_rows``
    bounds what a task packs; sequences filled to less than ``underfull`` are searched again
    with those of other groups.
    """
    plain = staged(pieces, "pieces")
    count = plain.count()
    groups = max(1, -(-count // group_rows))
    spread = F.xxhash64(*plain.columns, F.monotonically_increasing_id())  # also for rows that are alike
    state = plain.withColumn("_group", F.pmod(spread, F.lit(groups)))
    state = state.withColumn("_bin", F.lit(None).cast("long")).withColumn("_place", F.lit(0).cast("long"))
    state = state.withColumn("_fill", F.lit(0).cast("long"))

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].to_numpy()
        number = int(rows["_group"].iloc[0])
        if rows["_bin"].isna().any():
            bins = best_fit(lengths, capacity)
            names = number * (1 << 31) + np.arange(bins.max() + 1)
        else:
            names, bins = np.unique(rows["_bin"].to_numpy(np.int64), return_inverse=True)
        bins = local_search(lengths, bins, capacity)
        order = np.lexsort((np.arange(len(bins)), bins))
        place = np.cumsum(lengths[order]) - lengths[order]
        starts = np.concatenate(([True], bins[order][1:] != bins[order][:-1]))
        place -= np.repeat(place[starts], np.diff(np.append(starts.nonzero()[0], len(bins))))
        rows = rows.copy()
        rows["_bin"] = names[bins]
        rows.loc[rows.index[order], "_place"] = place
        rows["_fill"] = np.bincount(bins, lengths).astype(np.int64)[bins]
        return rows

    done, before, turn = None, None, 0
    while True:
        solved = staged(state.groupBy("_group").applyInPandas(solve, state.schema), "packed")
        full = F.col("_fill") >= int(underfull * capacity)
        settled = solved.where(full) if groups > 1 else solved
        done = settled if done is None else done.union(settled)
        if groups == 1:
            break
        state = solved.where(~full)
        sequences = state.groupBy("_bin").agg(F.count("*").alias("n")).agg(F.count("*"), F.sum("n")).first()
        if not sequences[0]:
            break
        if before is not None and sequences[0] >= before:  # the last round has emptied none
            done = done.union(state)
            break
        before, turn = sequences[0], turn + 1
        groups = max(1, -(-sequences[1] // group_rows))
        state = state.withColumn("_group", F.pmod(F.xxhash64(F.lit(turn), "_bin"), F.lit(groups)))
    return done.select(*plain.columns, F.col("_bin").alias("sequence_id"), F.col("_place").alias("offset"))
