"""Which documents earlier batches have processed, from as few files as can hold them.

The ledger's keys lie in hash buckets, batch by batch. A Bloom filter per batch and bucket says which
buckets can hold a new batch's keys, and only their files are opened. Several batches are merged
into one run as they pile up, so a key meets a bounded number of filters.

Which runs hold is written per batch, under the batch's number. Running a batch again starts from what
earlier batches left and writes the same again, so nothing depends on how often it ran.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["kind", "document_id"]
KEY_TABLE = "kind string, document_id bigint"
FILTERS = "block bigint, blocks bigint, bits bigint, words array<bigint>, bucket int"
RUNS = "first bigint, last bigint, entries bigint"
HASHES = 7
BITS_PER_KEY = 10
BLOCK_BITS = 1 << 16


def _hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *KEYS)


def bucket_of(buckets: int) -> Column:
    return F.pmod(_hash(0), F.lit(buckets)).cast("int")


def _place(number: int, bits: Column) -> Column:
    """The bit of a key's ``number``-th hash."""
    return F.pmod(_hash(2 + number), bits)


def _block(blocks: Column) -> Column:
    return F.pmod(_hash(1), blocks)


def filters_of(keys: DataFrame, buckets: int) -> DataFrame:
    """Filters of ``keys``: per bucket as many blocks of at most ``BLOCK_BITS`` bits as its keys need.

    Set bits are merged word by word before a block's words meet, so a task holds one block at a time.
    """
    placed = keys.select(bucket_of(buckets).alias("bucket"), *KEYS)
    needed = F.count("*") * BITS_PER_KEY
    sizes = placed.groupBy("bucket").agg(
        F.ceil(needed / BLOCK_BITS).alias("blocks"), F.least(F.greatest(needed, F.lit(64)), F.lit(BLOCK_BITS)).alias("bits")
    )
    sized = placed.join(F.broadcast(sizes), "bucket")  # a row per bucket
    at = F.explode(F.array(*(_place(k, F.col("bits")) for k in range(HASHES)))).alias("at")
    places = ["bucket", "block", "blocks", "bits"]
    bits = sized.select("bucket", _block(F.col("blocks")).alias("block"), "blocks", "bits", at)
    one = F.expr("shiftleft(1L, CAST(at % 64 AS int))")
    merged = bits.groupBy(*places, F.expr("at div 64").alias("word")).agg(F.bit_or(one).alias("value"))
    listed = merged.groupBy(*places).agg(F.map_from_entries(F.collect_list(F.struct("word", "value"))).alias("set"))
    numbers = F.sequence(F.lit(0).cast("long"), F.expr("(bits - 1) div 64"))
    words = F.transform(numbers, lambda i: F.coalesce(F.col("set")[i], F.lit(0)))
    return listed.select(*places, words.alias("words"))


def can_hold() -> Column:
    """Whether a filter's bits allow a key beside it."""
    answer = F.lit(True)
    for k in range(HASHES):
        at = _place(k, F.col("bits"))
        word = F.get("words", F.floor(at / 64).cast("int"))
        answer = answer & (F.getbit(word, at % 64) == 1)
    return answer


class Membership:
    """The processed documents below a folder, as batches leave them."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 256, most_runs: int = 8):
        self.spark, self.root = spark, root.rstrip("/")
        self.buckets, self.most_runs = buckets, most_runs

    def _run(self, first: int, last: int, part: str) -> str:
        return f"{self.root}/{part}/run={first}-{last}"

    def runs(self, batch_id: int) -> list[tuple[int, int, int]]:
        """Runs (first and last batch, keys) that batches before this one left."""

        def listed(path: str) -> DataFrame | None:
            try:
                return self.spark.read.schema(RUNS).parquet(path)
            except AnalysisException as missing:
                if missing.getCondition() != "PATH_NOT_FOUND":
                    raise
            return None

        found = listed(f"{self.root}/runs/batch={batch_id - 1}")  # batches of a stream have consecutive numbers
        if found is None:
            try:
                whole = self.spark.read.schema(f"{RUNS}, batch bigint").parquet(f"{self.root}/runs")
            except AnalysisException as missing:
                if missing.getCondition() != "PATH_NOT_FOUND":
                    raise
                return []
            last = whole.where(F.col("batch") < batch_id).agg(F.max("batch")).first()[0]
            if last is None:
                return []
            found = listed(f"{self.root}/runs/batch={last}")
        return sorted(tuple(r) for r in found.collect())

    def _stored(self, paths: list[str]) -> DataFrame:
        base = f"{self.root}/keys"
        return self.spark.read.schema(KEY_TABLE).option("basePath", base).parquet(*paths).select(*KEYS)

    def _keys(self, runs: list[tuple[int, int, int]]) -> DataFrame:
        paths = [self._run(first, last, "keys") for first, last, entries in runs if entries]
        if not paths:
            return self.spark.createDataFrame([], KEY_TABLE)
        return self._stored(paths)

    def candidates(self, keys: DataFrame, batch_id: int) -> DataFrame:
        """Earlier keys in the buckets that can hold one of ``keys``; files of other buckets are not opened.

        Each key meets one block of filter bits per run. What comes to the driver is at most one row per run and bucket.
        """
        runs = [r for r in self.runs(batch_id) if r[2]]
        if not runs:
            return self.spark.createDataFrame([], KEY_TABLE)
        wanted = keys.select(*KEYS).distinct().withColumn("bucket", bucket_of(self.buckets))
        own = [r["bucket"] for r in wanted.select("bucket").distinct().collect()]  # at most all buckets
        hits = None
        for first, last, _ in runs:
            filters = self.spark.read.schema(FILTERS).parquet(self._run(first, last, "filters")).where(F.col("bucket").isin(own))
            sizes = filters.select("bucket", "blocks", "bits").distinct()  # a row per bucket
            placed = wanted.join(F.broadcast(sizes), "bucket").withColumn("block", _block(F.col("blocks"))).drop("blocks", "bits")
            hit = placed.join(filters, ["bucket", "block"]).where(can_hold())
            hit = hit.select(F.lit(first).alias("first"), F.lit(last).alias("last"), "bucket")
            hits = hit if hits is None else hits.union(hit)
        places = sorted((r["first"], r["last"], r["bucket"]) for r in hits.distinct().collect())
        if not places:
            return self.spark.createDataFrame([], KEY_TABLE)
        paths = [f"{self._run(first, last, 'keys')}/bucket={bucket}" for first, last, bucket in places]
        return self._stored(paths)

    def unseen(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Rows of the batch whose document no earlier batch has processed."""
        return batch.join(self.candidates(batch, batch_id).distinct(), KEYS, "left_anti")

    def add(self, keys: DataFrame, batch_id: int) -> None:
        """What this batch has processed. Of the earlier runs, those that are no larger than all after them are merged with it.

        So runs grow at least twofold from one to the one before, and their number with the logarithm
        of the keys; more than ``most_runs`` are merged in any case.
        """
        earlier = self.runs(batch_id)
        entries = self._write(keys.select(*KEYS).distinct(), batch_id, batch_id)
        if not entries:
            return self._list(earlier, batch_id)
        kept, held = len(earlier), entries
        while kept and (earlier[kept - 1][2] <= held or kept >= self.most_runs):
            kept -= 1
            held += earlier[kept][2]
        merged = [*earlier[kept:], (batch_id, batch_id, entries)]
        if len(merged) > 1:
            held = self._write(self._keys(merged).distinct(), merged[0][0], batch_id)
        self._list([*earlier[:kept], (merged[0][0], batch_id, held)], batch_id)

    def _list(self, listed: list[tuple[int, int, int]], batch_id: int) -> None:
        self.spark.createDataFrame(listed, RUNS).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/runs/batch={batch_id}")

    def _write(self, keys: DataFrame, first: int, last: int) -> int:
        """Keys and filters of one run; their number."""
        path = self._run(first, last, "keys")
        bucketed = keys.withColumn("bucket", bucket_of(self.buckets)).repartition("bucket").sortWithinPartitions("bucket", *KEYS)
        bucketed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(path)
        written = self._stored([path])
        entries = written.count()
        if entries:
            found = filters_of(written, self.buckets)
            found.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(self._run(first, last, "filters"))
        return entries

