"""URL verdicts by a cascade of Bloom filters, which is exact for every key a corpus can ask for.

Rules and listed keys name a host, which stands for its subdomains too, and the beginning of a path.
What a URL can match is a handful of keys: endings of its host with beginnings of its path, in the
shapes (labels, path characters) that entries have. The first filter of the cascade encodes all
entries; the second one those keys of the corpus that pass the first without being entries; the third
one the entries that pass the second, and so on until nothing passes wrongly. The first filter that
does not know a key decides: even ones say yes. All keys of the corpus took part, so the answer is exact,
and URLs are judged where they lie, without a join.

Keys are 128-bit hashes, dealt into shards by one half of it. A shard has a bounded number of entries,
and filter sizes make its false positives about as many, so one task builds its filters. Filters
reach the tasks in groups of shards of bounded size; if there are more, the URLs are judged once for
each group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsettle.llm.jaccard import _mix
from docsettle.session import staged

SHARD_KEYS = 1 << 20
GROUP_BYTES = 64 << 20
_MOST_LEVELS = 200
Shape = tuple[int, int]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for a null or a text without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, UPPER, LOWER), path


def labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def shapes(entries: DataFrame) -> list[Shape]:
    """Numbers of labels and path characters that entries (host, path) have; one row per shape comes back."""
    found = entries.select(labels(F.col("host")).alias("n"), F.length("path").alias("m")).distinct().collect()
    return sorted((r["n"], r["m"]) for r in found)


def keys(host: Column, path: Column, wanted: list[Shape]) -> list[Column]:
    """The key of each shape; null where host or path is too short for it."""
    return [
        F.when(
            (labels(host) >= n) & (F.length(path) >= m),
            F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, m)),
        )
        for n, m in wanted
    ]


def _hashed(found: list[Column]) -> list[Column]:
    """Two columns of 64-bit hashes, each an array with one per key."""
    first = F.array(*(F.when(k.isNotNull(), F.xxhash64(k)) for k in found))
    second = F.array(*(F.when(k.isNotNull(), F.xxhash64(F.lit(1), k)) for k in found))
    return [first.alias("a"), second.alias("b")]


class Filter:
    """Bloom filters of one level for all shards of a group, end to end; a shard without one knows no key."""

    def __init__(self, level: int, hashes: int, bits: list[bytes | None]) -> None:
        self.level, self.hashes = level, hashes
        words = [np.frombuffer(b or b"", np.uint64) for b in bits]
        self.size = np.array([64 * len(w) for w in words], np.uint64)
        self.start = np.cumsum(self.size) - self.size
        self.words = np.concatenate(words) if words else np.empty(0, np.uint64)

    def has(self, a: np.ndarray, b: np.ndarray, shard: np.ndarray) -> np.ndarray:
        size = self.size[shard]
        out = size > 0
        at = out.nonzero()[0]
        for k in range(self.hashes):
            place = self.start[shard[at]] + _place(a[at], b[at], self.level, k) % size[at]
            known = self.words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1) == 1
            out[at[~known]] = False
            at = at[known]
        return out


def _place(a: np.ndarray, b: np.ndarray, level: int, k: int) -> np.ndarray:
    return _mix(a + _mix(b ^ np.uint64(64 * level + k + 1)))


def _encoded(a: np.ndarray, b: np.ndarray, level: int, hashes: int) -> bytes:
    words = np.zeros(-(-math.ceil(len(a) * hashes / math.log(2)) // 64), np.uint64)
    for k in range(hashes):
        place = _place(a, b, level, k) % np.uint64(64 * len(words))
        np.bitwise_or.at(words, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
    return words.tobytes()


def _levels(table: pa.Table, hashes: int) -> Iterator[tuple[int, bytes]]:
    """The filters of one shard, given its keys (a, b) and which of them are entries."""
    a, b = (table.column(n).to_numpy().view(np.uint64) for n in ("a", "b"))
    entry = table.column("entry").to_numpy(zero_copy_only=False)
    inside, outside = entry.nonzero()[0], (~entry).nonzero()[0]
    for level in range(1, _MOST_LEVELS):
        own = hashes if level == 1 else 1
        bits = _encoded(a[inside], b[inside], level, own)
        yield level, bits
        known = Filter(level, own, [bits])
        outside = outside[known.has(a[outside], b[outside], np.zeros(len(outside), np.int64))]
        if not len(outside):
            return
        inside, outside = outside, inside
    raise ValueError("an entry and another key have the same hash")


class Cascade:
    """Filters in a table of the shared folder: ``shard, level, bits``."""

    def __init__(self, filters: DataFrame, shards: int, hashes: int) -> None:
        self.filters, self.shards, self.hashes = filters, shards, hashes

    def groups(self, most_bytes: int = GROUP_BYTES) -> Iterator[tuple[Broadcast, int, int]]:
        """Filters of consecutive shards, at most so many bytes together or one shard, with first and last shard."""
        sizes = self.filters.groupBy("shard").agg(F.sum(F.length("bits")).alias("n")).collect()  # one row per shard
        first, held = 0, 0
        weight = {r["shard"]: r["n"] for r in sizes}
        for shard in range(self.shards):
            if held and held + weight.get(shard, 0) > most_bytes:
                yield self._group(first, shard - 1), first, shard - 1
                first, held = shard, 0
            held += weight.get(shard, 0)
        yield self._group(first, self.shards - 1), first, self.shards - 1

    def _group(self, first: int, last: int) -> Broadcast:
        found = self.filters.where(F.col("shard").between(first, last)).toArrow().to_pylist()
        bits = {(r["level"], r["shard"]): r["bits"] for r in found}
        levels = range(1, max((level for level, _ in bits), default=0) + 1)
        group = [
            Filter(level, self.hashes if level == 1 else 1, [bits.get((level, s)) for s in range(first, last + 1)]) for level in levels
        ]
        return self.filters.sparkSession.sparkContext.broadcast(group)


def _answers(filters: list[Filter], a: np.ndarray, b: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Whether keys are entries: the first filter that does not know a key decides."""
    out, at = np.zeros(len(a), bool), np.arange(len(a))
    for level, known in enumerate(filters, 1):
        hit = known.has(a[at], b[at], shard[at])
        out[at[~hit]] = level % 2 == 0
        at = at[hit]
    out[at] = len(filters) % 2 == 1
    return out


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes in a column of arrays, 0 for nulls, and which are none."""
    values = column.flatten()
    return pc.fill_null(values, 0).to_numpy(zero_copy_only=False).view(np.uint64), pc.is_valid(values).to_numpy(zero_copy_only=False)


def build_cascade(
    entries: DataFrame, corpus: DataFrame, shard_keys: int = SHARD_KEYS, group_bytes: int = GROUP_BYTES
) -> Cascade:
    """The cascade of ``entries`` (a, b) over ``corpus`` (arrays a, b), which holds every key that will be asked for."""
    entries = staged(entries.distinct(), "entries")
    count = entries.count()
    shards = max(1, -(-count // shard_keys))
    asked = corpus.select(F.explode("a").alias("a")).agg(F.approx_count_distinct("a")).first()[0]
    hashes = min(max(round(math.log2(max(asked, 1) / max(count, 1)) + 0.5), 1), 40)  # false positives: about 0.7 an entry
    shard = F.pmod(F.col("b"), F.lit(shards)).cast("int").alias("shard")

    def first_level(table: pa.Table) -> pa.Table:
        bits = _encoded(*(table.column(n).to_numpy().view(np.uint64) for n in ("a", "b")), 1, hashes)
        return pa.table({"shard": table.column("shard")[:1], "level": pa.array([1], pa.int32()), "bits": pa.array([bits], pa.binary())})

    schema = "shard int, level int, bits binary"
    first = Cascade(staged(entries.select("a", "b", shard).groupBy("shard").applyInArrow(first_level, schema), "level"), shards, hashes)
    passed = entries.select("a", "b", F.lit(True).alias("entry"))
    for group, low, high in first.groups(group_bytes):

        def through(batches: Iterator[pa.RecordBatch], group=group, low=low, high=high) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                (a, valid), (b, _) = _flat(batch.column(0)), _flat(batch.column(1))
                place = b.view(np.int64) % shards
                own = (valid & (place >= low) & (place <= high)).nonzero()[0]
                own = own[np.unique(a[own], return_index=True)[1]] if len(own) else own
                if group.value:
                    own = own[group.value[0].has(a[own], b[own], place[own] - low)]
                else:
                    own = own[:0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[own].view(np.int64)), pa.array(b[own].view(np.int64)), pa.array(np.zeros(len(own), bool))], ["a", "b", "entry"]
                )

        passed = passed.union(staged(corpus.mapInArrow(through, "a long, b long, entry boolean").distinct(), "passed"))
    passed = passed.groupBy("a", "b").agg(F.bool_or("entry").alias("entry"))

    def filters(table: pa.Table) -> pa.Table:
        found = list(_levels(table.combine_chunks(), hashes))
        own = table.column("shard")[0].as_py()
        return pa.table(
            {
                "shard": pa.array([own] * len(found), pa.int32()),
                "level": pa.array([level for level, _ in found], pa.int32()),
                "bits": pa.array([bits for _, bits in found], pa.binary()),
            }
        )

    return Cascade(staged(passed.select("a", "b", "entry", shard).groupBy("shard").applyInArrow(filters, schema), "cascade"), shards, hashes)


def listed(rows: DataFrame, cascade: Cascade, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``rows`` with an array ``listed`` in place of the arrays ``a`` and ``b`` (the last two columns): which keys are entries.

    A null key is none. Every key must have been in the corpus that the cascade was built for.
    """
    carried = rows.drop("a", "b").schema.fields
    names = [f.name for f in carried]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in carried)
    rows = rows.select(*names, "a", "b", F.transform("a", lambda x: F.lit(False)).alias("listed"))
    groups = list(cascade.groups(group_bytes)) if cascade.shards == 1 else cascade.groups(group_bytes)
    for group, low, high in groups:

        def answer(batches: Iterator[pa.RecordBatch], group=group, low=low, high=high, shards=cascade.shards) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                arrays = batch.column(batch.num_columns - 3)
                (a, valid), (b, _) = _flat(arrays), _flat(batch.column(batch.num_columns - 2))
                out = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).copy()
                place = b.view(np.int64) % shards
                own = (valid & (place >= low) & (place <= high)).nonzero()[0]
                out[own] = _answers(group.value, a[own], b[own], place[own] - low)
                ends = np.concatenate(([0], np.cumsum(pc.list_value_length(arrays).to_numpy(zero_copy_only=False)))).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(ends), pa.array(out))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names=batch.schema.names)

        full = f"{schema}, a array<long>, b array<long>, listed array<boolean>"
        rows = rows.mapInArrow(answer, full)
        if high < cascade.shards - 1:
            rows = staged(rows, "judged")
    return rows.drop("a", "b")


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    blocked: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    shard_keys: int = SHARD_KEYS,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """``id, host, path, rule, verdict`` of every row of ``pages``.

    ``rules`` has ``host, path, verdict`` (``allow`` or ``block``), ``blocked`` has ``host, path``. An entry fits its
    host and all subdomains where the path starts with its own. The longest rule that fits decides (host and path
    characters, then host labels); one given with both verdicts blocks. Where none fits, ``rule`` is null and a URL is blocked if
    an entry of ``blocked`` fits it. Entries with a null host or path are none; hosts are compared in lower case (A-Z).
    A null URL or one without ``://`` has an empty host and path. Repeated rows and null ids are rows
    like others. Empty tables of rules, blocked keys or pages are allowed; other columns are not read.
    """

    def entries(table: DataFrame, *more: Column) -> DataFrame:
        host = F.translate(F.col("host").cast("string"), UPPER, LOWER).alias("host")
        return table.select(host, F.col("path").cast("string").alias("path"), *more).where("host IS NOT NULL AND path IS NOT NULL")

    rules, blocked = staged(entries(rules, F.col("verdict")), "rules"), staged(entries(blocked), "blocked")
    host, path = url_parts(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rule_shapes, blocked_shapes = shapes(rules), shapes(blocked)

    def tagged(tag: str, found: list[Column]) -> list[Column]:  # one cascade for the three lists
        return [F.concat(F.lit(tag), k) for k in found]

    by_rule = keys(F.col("host"), F.col("path"), rule_shapes)
    by_list = keys(F.col("host"), F.col("path"), blocked_shapes)
    asked = tagged("rule ", by_rule) + tagged("block ", by_rule) + tagged("listed ", by_list)
    if not asked:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    own = F.concat("host", "path")
    known = (
        rules.select(F.concat(F.lit("rule "), own).alias("key"))
        .union(rules.where("verdict = 'block'").select(F.concat(F.lit("block "), own)))
        .union(blocked.select(F.concat(F.lit("listed "), own)))
    )
    known = known.select(F.xxhash64("key").alias("a"), F.xxhash64(F.lit(1), "key").alias("b"))
    cascade = build_cascade(known, rows.select(*_hashed(asked)), shard_keys, group_bytes)
    judged = listed(rows.select("id", "host", "path", *_hashed(asked)), cascade, group_bytes)
    n = len(by_rule)
    fits = [
        F.when(
            F.col("listed")[i],
            F.struct(F.length(k).alias("chars"), F.lit(shape[0]).alias("labels"), k.alias("rule"), F.col("listed")[n + i].alias("blocks")),
        )
        for i, (k, shape) in enumerate(zip(by_rule, rule_shapes, strict=True))
    ]
    kind = "array<struct<chars:int,labels:int,rule:string,blocks:boolean>>"
    judged = judged.withColumn("best", F.array_max(F.array(*fits).cast(kind)))
    blocks = F.coalesce(F.col("best.blocks"), F.exists(F.slice("listed", 2 * n + 1, len(by_list) + 1), lambda x: x))
    return judged.select(
        "id", "host", "path", F.col("best.rule").alias("rule"), F.when(blocks, "block").otherwise("allow").alias("verdict")
    )
