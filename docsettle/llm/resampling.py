"""Draw the documents that look like a target collection, by hashed n-grams and exact bit-sliced weights.

A document's features are its runs of one to three words; CRC-32 deals them into buckets. A bucket's
gain is the logarithm of how much more frequent it is in the target than in the documents, as an
integer. A document's weight is the sum of gains over its features. With a Gumbel-distributed term
added, the highest scores are a draw without replacement in proportion to the exponential weights.

Weights are aggregated by bit slices. A document's bucket counts are turned into planes, plane ``j``
holding bit ``j`` of every bucket's count; gains are planes of their two's complement. The weight is
the sum over pairs of planes of the number of buckets set in both, times the planes' powers of two,
the last gain plane counting negative. All of it is integers, so nothing depends on order.

CRC-32 is linear over bits: the checksum of a run follows from those of its words, which are taken
once per distinct word. Texts are read twice (corpus counts, then weights) and never shuffled; counts
are added up in every task before they meet. The draw sorts only what can be drawn.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsettle.llm.components import batch_bytes, slices
from docsettle.llm.decontaminate import words_of
from docsettle.session import staged

BUCKETS = 10_000
ORDERS = 3
_GROUP_DOCS, _GROUP_WORDS = 64, 50_000
_BINS = 1 << 16


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def _through(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by what it makes of each byte in each place."""
    out = tables[..., 0, crc & 255]
    for k in (1, 2, 3):
        out = out ^ tables[..., k, (crc >> np.uint32(8 * k)) & 255]
    return out


class CrcJoin:
    """Checksums of texts put together from parts whose checksums and lengths are known."""

    def __init__(self) -> None:
        table = _byte_table()
        tables = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])]
        for _ in range(64):
            tables.append(table[tables[-1] & 255] ^ (tables[-1] >> np.uint32(8)))
        self.short = np.stack(tables[:64])  # maps for 0 to 63 bytes more
        self.doubled = [tables[64]]  # maps for 64, 128, 256, ... bytes more

    def after(self, crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What the checksums of heads add to those of texts that go on by so many bytes."""
        low = lengths & 63
        out = self.short[low, 0, crc & 255]
        for k in (1, 2, 3):
            out = out ^ self.short[low, k, (crc >> np.uint32(8 * k)) & 255]
        rest, j = lengths >> 6, 0
        while rest.any():
            if j == len(self.doubled):
                self.doubled.append(_through(self.doubled[-1], self.doubled[-1]))
            odd = (rest & 1).nonzero()[0]
            out[odd] = _through(self.doubled[j], out[odd])
            rest, j = rest >> 1, j + 1
        return out

    def joined(self, head: np.ndarray, tail: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Checksums of ``head``, a blank and ``tail``, which has so many bytes."""
        blank = _through(self.short[1], head) ^ np.uint32(zlib.crc32(b" "))
        return self.after(blank, lengths) ^ tail


class _WordCrcs(dict):
    """Checksum and length of words, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = struct.pack("<II", zlib.crc32(word), len(word))
        return value


def feature_groups(texts: list[bytes | None], crcs: _WordCrcs, join: CrcJoin, orders: int) -> Iterator[tuple]:
    """Texts' features in groups of few texts and words: ``first row, rows, row and CRC-32 per feature, words per row``.

    A text of more words than a group holds goes on in the next entry, which begins with its last words.
    """
    rows: list[int] = []
    held: list[list[bytes]] = []
    carried: list[int] = []
    words = 0

    def group() -> tuple:
        sizes = np.array([len(x) for x in held])
        flat = [w for x in held for w in x]
        pairs = np.frombuffer(b"".join(map(crcs.__getitem__, flat)), "<u4").reshape(-1, 2)
        crc, length = pairs[:, 0], pairs[:, 1].astype(np.int64)
        at = np.repeat(np.array(rows) - rows[0], sizes)
        position = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        old = np.repeat(np.array(carried), sizes)  # words that the group before has counted
        found, where = [], []
        run = crc
        for order in range(orders):
            if order:  # runs that end at each word, from those that end at the word before
                run = join.joined(run[:-1], crc[order:], length[order:])
            whole = (position[order:] >= order) & (position[order:] >= old[order:])
            found.append(run[whole]), where.append(at[order:][whole])
        count = rows[-1] - rows[0] + 1
        words_in = np.bincount(at[position >= old], minlength=count)
        return rows[0], count, np.concatenate(where), np.concatenate(found), words_in

    for row, text in enumerate(texts):
        rest = text or b""
        before: list[bytes] = []
        while True:
            own, rest = next_words(rest, _GROUP_WORDS)
            rows.append(row), held.append(before + own), carried.append(len(before))
            words += len(own)
            if len(rows) == _GROUP_DOCS or words >= _GROUP_WORDS:
                yield group()
                words = 0
                rows.clear(), held.clear(), carried.clear()
            if not rest:
                break
            before = (before + own)[1 - orders :] if orders > 1 else []
    if rows:
        yield group()


def next_words(text: bytes, limit: int) -> tuple[list[bytes], bytes]:
    """The text's first words, about ``limit`` at most, and the text after them."""
    cut = 16 * limit
    if len(text) <= cut:
        return words_of(text), b""
    folded = text[:cut]
    own = words_of(folded)
    if words_of(folded[-1:]) and words_of(text[cut : cut + 1]):  # a word is cut through
        if len(own) > 1:
            cut -= len(own.pop())
        else:  # one word longer than that
            own = words_of(text)
            return own, b""
    return own, text[cut:]


class Planes:
    """Signed integers per bucket as bit planes, and sums of them over counted buckets."""

    def __init__(self, gains: np.ndarray) -> None:
        self.width = -(-len(gains) // 64) * 64
        self.buckets = len(gains)
        bits = max(int(np.abs(gains).max(initial=0)).bit_length() + 1, 1)  # and one for the sign
        self.gains = [self._packed((gains >> k & 1)[None, :])[0] for k in range(bits)]
        self.weights = [1 << k for k in range(bits - 1)] + [-(1 << bits - 1)]

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(bits), self.width), bool)
        padded[:, : bits.shape[1]] = bits
        return np.packbits(padded, axis=1).view(np.uint64)

    def weigh(self, rows: np.ndarray, buckets: np.ndarray, count: int) -> np.ndarray:
        """The sum of gains of each of ``count`` rows over its buckets, each as often as it stands there."""
        counts = np.bincount(rows * self.width + buckets, minlength=count * self.width).reshape(count, self.width)
        out = np.zeros(count, np.int64)
        at, j = np.arange(count), 0
        while len(at):
            plane = np.packbits((counts >> j & 1).astype(bool), axis=1).view(np.uint64)
            for gain, weight in zip(self.gains, self.weights, strict=True):
                out[at] += np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64) * (weight << j)
            j += 1
            more = (counts >> j).any(axis=1)
            at, counts = at[more], counts[more]
        return out


def bucket_counts(documents: DataFrame, text_col: str, buckets: int = BUCKETS, orders: int = ORDERS) -> np.ndarray:
    """How many features of all texts lie in each bucket; every task sends one row per bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, crcs, join = np.zeros(buckets, np.int64), _WordCrcs(), CrcJoin()
        for part in slices(batches):
            for _, _, _, crc, _ in feature_groups(batch_bytes(part.column(0)), crcs, join, orders):
                own += np.bincount(crc.astype(np.int64) % buckets, minlength=buckets)
        at = own.nonzero()[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(own[at])], ["bucket", "n"])

    texts = documents.select(F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    found = texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    whole = np.zeros(buckets, np.int64)
    whole[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return whole


def bucket_gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(((t+1) * (S+B)) / ((s+1) * (T+B)))) of each of B buckets, in doubles."""
    size, s_all, t_all = len(documents), float(documents.sum()), float(target.sum())
    pairs = zip(documents.tolist(), target.tolist(), strict=True)
    return np.array(
        [math.floor(1000 * math.log(((t + 1.0) * (s_all + size)) / ((s + 1.0) * (t_all + size)))) for s, t in pairs], np.int64
    )


def weights(documents: DataFrame, gains: np.ndarray, id_col: str, text_col: str, orders: int = ORDERS) -> DataFrame:
    """``id, n_words, n_features, weight`` of every row."""
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    buckets = len(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, crcs, join = Planes(gains), _WordCrcs(), CrcJoin()
        for part in slices(batches):
            n_words, n_features, weight = np.zeros((3, part.num_rows), np.int64)
            for first, count, row, crc, words in feature_groups(batch_bytes(part.column(1)), crcs, join, orders):
                own = slice(first, first + count)
                n_words[own] += words
                n_features[own] += np.bincount(row, minlength=count)
                weight[own] += planes.weigh(row, crc.astype(np.int64) % buckets, count)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n_words), pa.array(n_features), pa.array(weight)], ["id", "n_words", "n_features", "weight"]
            )

    return rows.mapInArrow(weigh, f"id {kind}, n_words long, n_features long, weight long")


def gumbel(id_column: Column, seed: int = 42) -> Column:
    """floor(-1000 * ln(-ln(u))), u from the first 32 bits of SHA-256 of ``seed:id``; a null id is an empty one."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0))).cast("long")


def highest(scored: DataFrame, wanted: int, eligible: Column) -> DataFrame:
    """``scored`` with ``rank``: 1 to ``wanted`` by falling ``score``, then ``id`` (null last), then ``row``; null for all others.

    Counts of scores in bins of equal width tell from which score on a row can be drawn; only such rows are
    sorted, in ranges of score, id and row, so equal scores may be any number. Rows before a range come from
    one count per range.
    """
    spark = scored.sparkSession
    low, high = scored.where(eligible).agg(F.min("score"), F.max("score")).first()
    if low is None or wanted < 1:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    width = (high - low) // _BINS + 1
    bins = scored.where(eligible).groupBy(F.floor((F.col("score") - low) / width).alias("bin")).count().collect()
    above, floor = 0, low
    for bin_, count in sorted(((r["bin"], r["count"]) for r in bins), reverse=True):  # at most _BINS
        above += count
        if above >= wanted:
            floor = low + bin_ * width
            break
    possible = eligible & (F.col("score") >= floor)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = (F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row"))
    ranged = scored.where(possible).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("part", F.spark_partition_id())

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            yield batch.append_column("place", pa.array(np.arange(done + 1, done + batch.num_rows + 1)))
            done += batch.num_rows

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema.fields)
    ranged = staged(ranged.mapInArrow(numbered, f"{kinds}, place long"), "ranged")
    before, starts = 0, []
    for part, count in sorted((r["part"], r["count"]) for r in ranged.groupBy("part").count().collect()):
        starts.append((part, before))
        before += count
    known = spark.createDataFrame(starts, "part int, before long")  # one row per range
    rank = F.col("before") + F.col("place")
    drawn = ranged.join(F.broadcast(known), "part").withColumn("rank", F.when(rank <= wanted, rank))
    others = scored.where(~F.coalesce(possible, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return others.unionByName(drawn.select(others.columns))


def importance_resample(
    documents: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    percent: int = 5,
    min_words: int = 20,
    buckets: int = BUCKETS,
    orders: int = ORDERS,
    seed: int = 42,
) -> DataFrame:
    """``id, n_words, n_features, weight, score, rank`` of every row of ``documents``.

    ``rank`` counts the drawn rows from 1: of the rows with at least ``min_words`` words, ``percent``
    in a hundred (rounded down), highest score first, equal scores by smaller id, equal ids in the order
    of the staged rows, null ids last. Null and empty texts have no features and a weight of 0. Repeated
    rows are rows of their own, which all have the same score. An empty table of documents gives an empty
    result; with an empty target, gains tell rare buckets from frequent ones. Other columns are not read.
    What reaches the driver and the tasks besides rows is one number per bucket.
    """
    own = bucket_counts(documents, text_col, buckets, orders)
    wanted = bucket_counts(target, target_text_col, buckets, orders)
    gains = bucket_gains(own, wanted)
    weighed = weights(documents, gains, id_col, text_col, orders)
    scored = weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    scored = staged(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    eligible = F.col("n_words") >= min_words
    share = percent * scored.where(eligible).count() // 100
    return highest(scored, share, eligible).drop("row")
