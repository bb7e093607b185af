"""Joins that hold when one key has a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1_000


def hot_keys(keyed: DataFrame, count: str) -> DataFrame:
    """The most frequent keys, at most ``HOT_KEYS`` of them.

    Every key left out has less than one part in ``HOT_KEYS`` of all rows.
    """
    return keyed.orderBy(F.desc(count)).limit(HOT_KEYS)


def lookup(
    rows: DataFrame, keyed: DataFrame, key: str, value: str, count: str, spread: str
) -> DataFrame:
    """Left join of ``rows`` with one ``value`` per ``key``.

    ``keyed`` has one row per key with its row ``count``. The hottest keys are resolved
    by a broadcast of at most ``HOT_KEYS`` rows; their rows then carry a salt drawn from
    ``spread``, so that the shuffle of the second join meets no hot key. Rows without
    a key are spread in the same way.
    """
    hot = hot_keys(keyed, count).select(key, F.col(value).alias("_hot"))
    settled = F.col("_hot").isNotNull() | F.col(key).isNull()
    salt = F.when(settled, F.abs(F.hash(spread) % 1_000_000) + 1).otherwise(0)
    marked = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", salt)
    cold = keyed.select(key, F.lit(0).alias("_salt"), F.col(value).alias("_cold"))
    joined = marked.join(cold, [key, "_salt"], "left")
    return joined.withColumn(value, F.coalesce("_hot", "_cold")).drop("_hot", "_cold", "_salt")
