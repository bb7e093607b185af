"""Membership in what earlier batches processed, and the files that a look-up opens."""

import random

import pytest

from docsettle.operators.membership import KEY_TABLE, KEYS, Membership, can_hold, filters_of


def keys(spark, *ids, kind="bill"):
    return spark.createDataFrame([(kind, i) for i in ids], KEY_TABLE)


def unseen(index, batch, batch_id):
    return sorted((r["kind"], r["document_id"]) for r in index.unseen(batch, batch_id).collect())


def test_batches_and_replays(spark, tmp_path):
    index = Membership(spark, str(tmp_path), buckets=8, most_runs=3)
    rng, seen = random.Random(3), set()
    for batch_id in range(6):
        ids = rng.sample(range(60), rng.choice([0, 1, 9]))
        batch = keys(spark, *ids, *ids[:2])
        for _ in range(2):  # every batch twice: it does not see what it wrote itself
            assert unseen(index, batch, batch_id) == sorted(("bill", i) for i in [*ids, *ids[:2]] if i not in seen)
            index.add(batch, batch_id)
        seen.update(ids)
        assert len(index.runs(batch_id + 1)) <= 3
    assert unseen(index, keys(spark, *range(60)), 6) == sorted(("bill", i) for i in range(60) if i not in seen)
    assert unseen(index, keys(spark, *seen, kind="payout"), 6) == sorted(("payout", i) for i in seen)
    assert unseen(index, keys(spark, *range(60)), 0) == sorted(("bill", i) for i in range(60))


def test_batch_numbers_may_have_gaps(spark, tmp_path):
    index = Membership(spark, str(tmp_path), buckets=4)
    for batch_id in (2, 7, 20):
        index.add(keys(spark, batch_id), batch_id)
    assert unseen(index, keys(spark, 2, 7, 20, 21), 12) == [("bill", 20), ("bill", 21)]
    assert unseen(index, keys(spark, 2, 7, 20, 21), 21) == [("bill", 21)]
    assert unseen(index, keys(spark, 2), 2) == [("bill", 2)]


def test_few_files_are_opened(spark, tmp_path):
    index = Membership(spark, str(tmp_path), buckets=64)
    index.add(keys(spark, *range(10_000)), 0)
    assert len(index._keys(index.runs(1)).inputFiles()) == 64
    assert len(index.candidates(keys(spark, 17), 1).inputFiles()) == 1
    assert len(index.candidates(keys(spark, *range(20_000, 20_020)), 1).inputFiles()) <= 3  # wrongly passed ones only
    found = index.candidates(keys(spark, 17, 18, 19), 1)
    assert len(found.inputFiles()) <= 3
    assert found.count() < 10_000 / 64 * 3 * 1.5


@pytest.mark.parametrize("count", [1, 6, 9_000, 60_000])
def test_filters_know_their_keys(spark, count):
    own = spark.range(count).selectExpr("'bill' AS kind", "id AS document_id")
    filters = filters_of(own, 2)
    from docsettle.operators import membership

    def hits(frame):
        placed = frame.withColumn("bucket", membership.bucket_of(2)).join(filters, "bucket")
        return placed.where(membership._block(placed["blocks"]) == placed["block"]).where(can_hold()).count()

    assert hits(own) == count
    strange = spark.range(10_000).selectExpr("'other' AS kind", "id AS document_id")
    assert hits(strange) < 400
    assert filters.selectExpr("max(size(words))").first()[0] <= 1024


def test_null_ids_are_never_seen(spark, tmp_path):
    index = Membership(spark, str(tmp_path), buckets=4)
    index.add(keys(spark, 1, None), 0)
    assert unseen(index, keys(spark, 1, 2), 1) == [("bill", 2)]
    assert KEYS == ["kind", "document_id"]
