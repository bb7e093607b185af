"""Publications: as a whole or not at all, and once however often a batch runs."""

import os

import pytest
from pyspark.sql import functions as F

from docsettle.sinks.publication import publish, published

SCHEMA = "id bigint, name string"


def records(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], SCHEMA)


def ids(spark, path):
    return sorted((r["id"], r["batch_id"]) for r in published(spark, path, SCHEMA).collect())


def parts(path):
    return sorted(os.listdir(f"{path}/parts")) if os.path.isdir(f"{path}/parts") else []


def test_batches_and_repeats(spark, tmp_path):
    path = str(tmp_path / "out")
    publish(records(spark, *range(20)).repartition(4), path, 0)
    publish(records(spark, 30, 31), path, 1)
    publish(records(spark, 30, 31), path, 1)
    publish(records(spark), path, 2)
    assert ids(spark, path) == [(i, 0) for i in range(20)] + [(30, 1), (31, 1)]


def test_a_failing_task_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    good = records(spark, *range(12)).repartition(6)
    bad = good.withColumn("name", F.when(F.col("id") == 5, F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="lost"):
        publish(bad, path, 0)
    assert not os.path.isdir(f"{path}/manifests")
    publish(good, path, 0)
    assert ids(spark, path) == [(i, 0) for i in range(12)]
    kept = parts(path)
    with pytest.raises(Exception, match="lost"):
        publish(bad, path, 0)  # the publication of before stays
    assert ids(spark, path) == [(i, 0) for i in range(12)]
    assert set(kept) <= set(parts(path))


def test_parts_that_no_manifest_names(spark, tmp_path):
    """A task whose driver has gone leaves a part; readers do not see it."""
    path = str(tmp_path / "out")
    publish(records(spark, 1, 2), path, 7)
    stray = f"{path}/parts/7-stray.parquet"
    with open(f"{path}/parts/{parts(path)[0]}", "rb") as known, open(stray, "wb") as copy:
        copy.write(known.read())
    assert ids(spark, path) == [(1, 7), (2, 7)]
