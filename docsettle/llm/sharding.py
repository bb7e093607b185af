"""Shards of nearly equal size by sampled splitters.

Records are ordered by a key: the hash of their text, their id, and their number in the staged
table, so equal texts are neighbours and no two records are alike. Splitters are quantiles of a
sample in which a record's chance follows its size; they divide the records into ranges that a
task can order. Ranges that came out too large are divided again by a sample of their own.
Shards are consecutive stretches of the order with equal shares of all bytes, cut exactly, since
the bytes before every range are known.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsettle.session import staged

GROUP_SHARE = 8  # a group of equal texts stays whole up to this part of a shard
SAMPLE = 1_000_000  # splitters come from about as many records at most


def _keys(batch: pa.RecordBatch, names: tuple[str, ...]) -> np.ndarray:
    """24-byte keys that sort as the unsigned values of the columns do."""
    columns = [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]
    flipped = [(c.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8") for c in columns]
    return np.ascontiguousarray(np.stack(flipped, axis=1)).view("S24").ravel()


def _quantiles(sample: pa.Table, ranges: int) -> list[tuple[int, int, int]]:
    """Keys that divide a size-weighted sample into as many parts."""
    a, b, c = (sample.column(n).to_numpy() for n in ("a", "b", "c"))
    order = np.lexsort((c, b, a))
    at = order[sorted({len(order) * k // ranges for k in range(1, ranges)})] if len(order) else order
    return sorted({(int(a[i]), int(b[i]), int(c[i])) for i in at})


def shard(
    documents: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    range_bytes: int = 1 << 30,
    ranges_per_shard: int = 4,
) -> DataFrame:
    """``id, size, text_crc32, shard, slot`` per row.

    A row's size is its text's UTF-8 bytes and 8. Shards are 0 to ``shards - 1``; their sizes
    differ by less than the longest row or an eighth of a shard or so. ``slot`` counts a shard's rows from 0 in order.
    Rows of equal texts are neighbours in that order. A group of them that has up to an eighth of a shard's share is never
    cut: it goes where its middle lies. A larger group goes on in the next shard where the shares ask for it.
    A null text has no bytes and the checksum of an empty one. Null ids sort as 0; repeated rows
    stay, each with a slot of its own. An empty table gives an empty result.
    """
    rows = documents.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("bytes"),
        F.crc32(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_crc32"),
        F.xxhash64(F.col(text_col)).alias("a"),
        F.xxhash64(F.col(id_col)).alias("b"),
        F.monotonically_increasing_id().alias("c"),
    )
    rows = staged(rows.withColumn("size", F.col("bytes") + 8).drop("bytes"), "sizes")
    total = rows.agg(F.sum("size")).first()[0]
    if total is None:
        return rows.select("id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))

    def sampled(part: DataFrame, share: float) -> pa.Table:
        # a hash of the key decides, so a retry draws the same records
        draw = F.pmod(F.xxhash64(F.lit(7), "a", "b", "c"), F.lit(1 << 40)) / float(1 << 40)
        return part.where(draw < F.col("size") * share).select("a", "b", "c").toArrow()

    def ranged(part: DataFrame, cuts: list, first: int) -> DataFrame:
        bounds = np.array(cuts, np.int64).reshape(-1, 3)
        flipped = (bounds.view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8")
        splitters = np.ascontiguousarray(flipped).view("S24").ravel()

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = np.searchsorted(splitters, _keys(batch, ("a", "b", "c")), "right") + first
                yield batch.append_column("range", pa.array(at.astype(np.int64)))

        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in part.schema.fields)
        return part.mapInArrow(place, f"{kinds}, range long")

    wanted = max(shards * ranges_per_shard, -(-total // range_bytes))
    cuts = _quantiles(sampled(rows, min(SAMPLE, 50 * wanted) / total), wanted)
    while True:
        dealt = staged(ranged(rows, cuts, 0), "ranged")
        sizes = dealt.groupBy("range").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
        heavy = [r for r in sizes if r["size"] > 2 * max(range_bytes, total / wanted) and r["n"] > 1]
        if not heavy:
            break
        part = dealt.where(F.col("range").isin([r["range"] for r in heavy]))
        more = _quantiles(sampled(part, 200 * len(heavy) / sum(r["size"] for r in heavy)), 8 * len(heavy))
        if not set(more) - set(cuts):
            break
        cuts = sorted({*cuts, *more})
    before, shift, starts = 0, 0, []
    for r in sorted(sizes, key=lambda r: r["range"]):  # one row per range
        starts.append((r["range"], before, shift))
        before, shift = before + r["size"], shift + r["n"]
    spark = documents.sparkSession
    known = spark.createDataFrame(starts, "range long, bytes_before long, rows_before long")
    order = Window.partitionBy("range").orderBy("a", "b", "c").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.join(F.broadcast(known), "range").select(
        "id",
        "size",
        "text_crc32",
        "a",
        (F.col("bytes_before") + F.sum("size").over(order) - F.col("size")).alias("start"),
        (F.col("rows_before") + F.count("*").over(order) - 1).alias("row"),
    )
    placed = staged(placed, "ordered")
    groups = placed.groupBy("a").agg(F.min("start").alias("begin"), F.sum("size").alias("held"), F.count("*").alias("n"))
    whole = groups.where((F.col("n") > 1) & (F.col("held") * GROUP_SHARE * shards <= total))
    whole = whole.select("a", (F.col("begin") + F.col("held") / 2).alias("group_middle"))
    middle = F.coalesce("group_middle", F.col("start") + F.col("size") / 2)
    placed = placed.join(whole, "a", "left").select(
        "id", "size", "text_crc32", F.least(F.floor(middle * shards / total), F.lit(shards - 1)).cast("int").alias("shard"), "row"
    )
    placed = staged(placed, "placed")
    heads = placed.groupBy("shard").agg(F.min("row").alias("head"))  # as many rows as shards
    return placed.join(F.broadcast(heads), "shard").select(
        "id", "size", "text_crc32", "shard", (F.col("row") - F.col("head")).alias("slot")
    )
