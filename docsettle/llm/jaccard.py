"""Exact join of texts by the Jaccard distance of their word shingles, a metric.

A text's set holds 64-bit hashes of its shingles; two different shingles of a pair share one
with a probability of about 1e-13, so intersections are exact for all purposes.

Document pivots alone do not divide a corpus: unrelated texts are all at a distance of nearly 1
from every pivot, and windows of twice the radius reach them all. Regions are therefore made in
two levels. First, shingles are dealt into one more class than the radius allows differences,
and a set's part in each class is a pivot: of two sets within the radius, one class has equal
parts, so both lie at distance 0 from that class's pivot. The number of classes follows a size
range; sets near its lower bound are replicated into the range they can still reach. Connected
regions form a cell. Second, in a cell, document pivots split the rest: distances to a pivot
give links at once, and the triangle inequality bounds which others are worth comparing.

Passages that many texts share can chain unrelated texts into one cell. A cell too heavy for a
task is divided again, before any set is moved: its sets' least common shingles are pivots, and a
set lies in the regions of as many of them as the radius asks for, so that two sets within the
radius have one in common. This repeats for the cells that stay heavy while it helps.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsettle.llm.cells import cell_links
from docsettle.llm.components import batch_bytes, components, equal_key_links, slices
from docsettle.llm.sketch import bitmap, counters, possible, tally
from docsettle.session import discard, settled, staged

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_MASK = (1 << 64) - 1
_SEEDS = 16


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """Hashes of words, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_digest(word)
        return value

    def of(self, words: Iterable[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, words)), np.uint64)


def shingle_set(text: bytes | None, size: int, hashes: _WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's ``size``-word shingles, A-Z in lower case."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    width = min(size, len(h))
    out = np.full(len(h) - width + 1, np.uint64(width))
    for i in range(width):
        out = _mix(out * _M1 + h[i : len(h) - width + 1 + i])
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def size_ranges(limit: int = 1 << 40) -> list[int]:
    """Lower bounds of the size ranges; each is half as large again as the one before."""
    bounds = [1]
    while bounds[-1] < limit:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * 3 // 2))
    return bounds


def region_keys(s: np.ndarray, percent: int, ranges: list[int]) -> np.ndarray:
    """Keys of the regions a set lies in; two sets within the radius have one in common.

    A class without a shingle says nothing. Sets with such a class are dealt again with another
    seed, so that a pair which agrees in nothing but empty classes meets there. Of ``c`` classes
    a third and more are equal and not empty for two sets just within the radius, by chance; once
    30 are to be expected, the chance of none is below 1e-12 and no other seed is needed.
    """
    n, keys = len(s), []
    at = bisect_right(ranges, n) - 1
    while at == bisect_right(ranges, n) - 1 or 100 * n >= percent * ranges[at]:
        most = ranges[at + 1] - 1
        classes = (100 - percent) * 2 * most // (100 + percent) + 1
        expected = 0.0
        for seed in range(_SEEDS):
            own = _mix(s + np.uint64((seed + 1) * int(_M1) & _MASK))
            of = ((own >> np.uint64(32)) % np.uint64(classes)).astype(np.int64)
            part = np.zeros(classes, np.uint64)
            np.add.at(part, of, own)
            full = np.bincount(of, minlength=classes) > 0
            tag = _mix(np.arange(classes, dtype=np.uint64) * _M1 + np.uint64((at << 8) + seed))
            key = _mix(part ^ tag)
            if full.all() or seed == _SEEDS - 1:
                keys.append(key)
                break
            keys.append(key[full])
            expected += 0.34 * classes
            if expected >= 30:
                break
        at += 1
    return np.concatenate(keys).view(np.int64)


def _linked(inter: np.ndarray, a: int, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * inter >= percent * (a + b - inter)


def jaccard_links(percent: int):
    """The exact comparison within a cell, and between two blocks of one."""

    def links(left: list[bytes], right: list[bytes] | None) -> list[tuple[int, int]]:
        one = [np.frombuffer(x, np.uint64) for x in left]
        two = one if right is None else [np.frombuffer(x, np.uint64) for x in right]
        if len(one) * len(two) <= 4:
            found = []
            for i, a in enumerate(one):
                for j, b in enumerate(two):
                    if (right is not None or i < j) and _linked(len(np.intersect1d(a, b, True)), len(a), len(b), percent):
                        found.append((i, j))
            return found
        sizes = np.array([len(x) for x in two])
        flat = np.concatenate(two)
        owner = np.repeat(np.arange(len(two), dtype=np.int32), sizes)
        order = np.argsort(flat, kind="stable")
        values, starts, counts = np.unique(flat[order], return_index=True, return_counts=True)
        owner = owner[order]
        group = np.arange(len(two)) if right is None else np.full(len(two), -1)
        found, pivots = [], []

        def overlap(x: np.ndarray) -> np.ndarray:
            """Shared elements of x with every set on the right."""
            at = np.minimum(np.searchsorted(values, x), len(values) - 1)
            at = at[values[at] == x]
            if not len(at):
                return np.zeros(len(two), np.int64)
            rows = np.concatenate([owner[starts[k] : starts[k] + counts[k]] for k in at])
            return np.bincount(rows, minlength=len(two))

        for i, x in enumerate(one):
            if right is None and (group == group[i]).all():
                break
            near = None
            if right is None and len(pivots) < 8 and (group == group[i]).sum() == 1:
                inter = overlap(x)  # a document pivot: its distances to the whole cell
                pivots.append(1 - inter / (len(x) + sizes - inter))
                near = _linked(inter, len(x), sizes, percent)
            else:
                at = np.minimum(np.searchsorted(values, x), len(values) - 1)
                held = counts[at] * (values[at] == x)
                rare = np.argsort(held, kind="stable")[: (100 - percent) * len(x) // 100 + 1]
                rows = [owner[starts[k] : starts[k] + counts[k]] for k in at[rare][held[rare] > 0]]
                other = np.unique(np.concatenate(rows)) if rows else np.empty(0, np.int64)
                if right is None:
                    other = other[group[other] != group[i]]
                    for distance in pivots:  # triangle inequality
                        other = other[np.abs(distance[other] - distance[i]) <= (100 - percent) / 100 + 1e-9]
                near = np.zeros(len(two), bool)
                for j in other:
                    if min(len(x), sizes[j]) * 100 >= percent * max(len(x), sizes[j]):
                        near[j] = _linked(len(np.intersect1d(x, two[j], True)), len(x), sizes[j], percent)
            for j in near.nonzero()[0]:
                if right is not None:
                    found.append((i, int(j)))
                elif group[j] != group[i]:
                    found.append((i, int(j)))
                    group[group == group[j]] = group[i]
        return found

    return links


def shingle_sets(documents: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """``id, digest, n_shingles, keys`` per row; ``keys`` once per set and task, null otherwise.

    Empty sets have a null digest.
    """
    ranges = size_ranges()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = _WordHashes(), set()
        for batch in slices(batches):
            digests, sizes, keys = [], [], []
            for text in batch_bytes(batch.column(1)):
                s = shingle_set(text, size, hashes)
                digest = xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
                fresh = digest is not None and digest not in seen
                if fresh:
                    seen.add(digest)
                digests.append(digest), sizes.append(len(s))
                keys.append(region_keys(s, percent, ranges) if fresh else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                ["id", "digest", "n_shingles", "keys"],
            )

    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(parse, f"id {kind}, digest binary, n_shingles long, keys array<long>")


def sets_among(batches: Iterator[pa.RecordBatch], size: int, full: np.ndarray) -> Iterator[dict[bytes, np.ndarray]]:
    """Sets by digest of those texts that the bitmap lets pass, once per set and task, in parts."""
    hashes, seen = _WordHashes(), set()
    for batch in slices(batches):
        found: dict[bytes, np.ndarray] = {}
        for text in batch_bytes(batch.column(0)):
            s = shingle_set(text, size, hashes)
            if len(s):
                node = xxhash.xxh3_128_digest(s.tobytes())
                if node not in seen and possible(full, [node])[0]:
                    seen.add(node)
                    found[node] = s
        yield found


def least_common(s: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """As many of a set's least counted shingles as a set within the radius cannot lack altogether.

    Two sets within the radius share ``percent`` of either one. In whatever order, the same for
    all sets, the first of the shared shingles is then among the first ``n - shared + 1`` of both.
    """
    first = len(s) + (-percent * len(s) // 100) + 1
    order = np.lexsort((s, tally(counts, s)))
    return s[order[:first]].view(np.int64)


def finer_regions(texts: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """``node, root`` of the ``nodes`` that share a region of a least common shingle, connected."""
    full = bitmap(nodes)

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for found in sets_among(batches, size, full.value):
            if found:
                yield np.concatenate(list(found.values()))

    counts = counters(texts, shingles)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in sets_among(batches, size, full.value):
            keys = [least_common(s, counts.value, percent) for s in found.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["node", "keys"])

    dealt = staged(texts.mapInArrow(deal, "node binary, keys array<long>"), "least_common")
    return components(equal_key_links(dealt.select(F.explode("keys").alias("key"), "node")))


def divide_heavy(cells: DataFrame, sizes: DataFrame, texts: DataFrame, size: int, percent: int, task_weight: int) -> DataFrame:
    """``cell, node`` with cells over ``task_weight`` divided, as long as that halves what is in them.

    Nodes that share no finer region with another one have no link and are left out.
    """
    weight = None
    while True:
        totals = cells.join(sizes, "node").groupBy("cell").agg(F.sum("weight").alias("total"), F.count("*").alias("nodes"))
        heavy = staged(totals.where((F.col("total") > task_weight) & (F.col("nodes") > 1)).select("cell", "total"), "heavy")
        now = heavy.agg(F.sum("total")).first()[0] or 0
        if not now or (weight is not None and 2 * now > weight):
            return cells
        weight = now
        crowded = staged(cells.join(heavy.select("cell"), "cell", "left_semi").select("cell", "node"), "crowded")
        finer = crowded.join(finer_regions(texts, crowded.select("node"), size, percent), "node")
        finer = finer.select(F.unhex(F.md5(F.concat("cell", "root"))).alias("cell"), "node")
        rest = cells.join(heavy.select("cell"), "cell", "left_anti").select("cell", "node")
        cells = staged(rest.union(finer), "regions")


def jaccard_components(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
    task_weight: int = 2_000_000,
) -> DataFrame:
    """``id, n_shingles, component_id`` per row: the smallest id reachable by links.

    Texts link when ``100 * intersection >= percent * union`` of their shingle sets. Every row
    of the input has one in the result. A null or empty text has no shingles and no links: its
    component is its own id. Equal sets are one node, whatever their ids; repeated rows stay.
    A row without an id takes part in links, though only ids that are not null name a
    component; it is null where there is none. Other columns are not read.
    ``task_weight`` bounds the shingles that one task compares.
    """
    keyed = staged(shingle_sets(documents, id_col, text_col, size, percent), "sets")
    entries = keyed.where("keys IS NOT NULL").select(F.explode("keys").alias("key"), F.col("digest").alias("node"))
    regions = settled(lambda: components(equal_key_links(entries)).select(F.col("root").alias("cell"), "node"), "regions")
    sets = staged(keyed.drop("keys"), "names")
    discard(keyed)  # the keys are most of what is on disk
    texts = documents.select(F.col(text_col).cast("string").alias("text"))
    sizes = sets.where("digest IS NOT NULL").groupBy(F.col("digest").alias("node")).agg(F.first("n_shingles").alias("weight"))
    cells = settled(lambda: divide_heavy(regions, sizes, texts, size, percent, task_weight), "cells_of")

    # the sets themselves are built again, for those that share a region
    full = bitmap(cells.select("node"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in sets_among(batches, size, full.value):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(found), pa.binary()),
                    pa.array([s.tobytes() for s in found.values()], pa.binary()),
                    pa.array([len(s) for s in found.values()], pa.int64()),
                ],
                ["node", "payload", "weight"],
            )

    built = texts.mapInArrow(build, "node binary, payload binary, weight long").join(cells, "node")
    built = built.groupBy("cell", "node").agg(F.first("payload").alias("payload"), F.first("weight").alias("weight"))
    groups = settled(lambda: components(cell_links(built, jaccard_links(percent), task_weight)), "groups")

    named = sets.select("id", "digest", "n_shingles").join(
        groups.withColumnRenamed("node", "digest"), "digest", "left"
    )
    named = named.withColumn("root", F.coalesce("root", "digest"))
    least = named.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("least"))
    hot = named.join(least, "root", "left")
    return hot.select("id", "n_shingles", F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))
