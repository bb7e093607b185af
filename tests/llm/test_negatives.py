"""Hard negatives against sorting all scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsettle.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, id int, q string, slot int, rank int, `order` int, anchor string"


def plain(rows, positives, negatives_, low=30, high=90):
    known = [
        (i, label, [math.floor(256 * x) for x in np.array(v, np.float32).astype(float)], k)
        for k, (i, v, label, *_) in enumerate(rows)
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]

    def score(a, b):
        return sum(x * y for x, y in zip(a[2], b[2], strict=False))

    def order(a):
        return lambda r: (-score(a, r), r[0] is None, r[0] or 0)

    out = []
    for a in known:
        if a[0] is not None and a[0] % 10 == 0:
            for p in sorted((r for r in known if r[1] == a[1] and r[3] != a[3]), key=order(a))[:positives]:
                s = score(a, p)
                fit = [r for r in known if r[1] != a[1] and low * s <= 100 * score(a, r) <= high * s]
                for rank, n in enumerate(sorted(fit, key=order(a))[:negatives_], 1):
                    out.append((a[0], p[0], rank, n[0], s, score(a, n)))
    return sorted(out, key=str)


def corpus(kind):
    rng = random.Random(kind)
    spread = {"plain": 0.4, "ties": 0.02, "large": 300.0}[kind]
    rows = [(i, [rng.uniform(-spread, spread) for _ in range(13)], rng.randint(0, 3), 1, "q", 2, 3, 4, "a") for i in range(150)]
    rows += [(200 + i, rows[20][1], 1, 1, "q", 2, 3, 4, "a") for i in range(8)]  # copies with ids of their own
    more = [(300, None, 1), (301, [0.1, None], 1), (302, [float("nan")] * 13, 2), (303, [float("inf")] * 13, 2), (304, [0.5] * 13, None)]
    more += [(310, [], 1), (311, [0.3] * 5, 2), (None, rows[3][1], 0), (None, None, None)]
    return rows + [(*r, None, None, None, None, None, None) for r in more]


@pytest.mark.parametrize("kind", ["plain", "ties", "large"])
@pytest.mark.parametrize(("positives", "wanted", "group"), [(5, 10, 32_768), (2, 1, 3), (1_000, 1_000, 32_768)])
def test_hard_negatives(spark, monkeypatch, kind, positives, wanted, group):
    monkeypatch.setattr(negatives, "_ANCHORS", 2)
    monkeypatch.setattr(negatives, "_ROWS", 16)
    rows = corpus(kind)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0, positives=positives, negatives=wanted, group_anchors=group)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows, positives, wanted)


def test_repeated_rows(spark):
    """Rows that share an id are rows of their own: a copy of the anchor is a positive of it."""
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [0.5, 0.5], 2), (1, [0.5, 0.5], 2)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label bigint")
    found = negatives.hard_negatives(frame, F.col("vec_id") == 0)
    assert sorted(tuple(r)[:4] for r in found.collect()) == [(0, 0, 1, 1), (0, 0, 1, 1), (0, 0, 2, 1), (0, 0, 2, 1)]


def test_without_rows_or_anchors(spark):
    frame = spark.createDataFrame(corpus("plain"), SCHEMA)
    assert negatives.hard_negatives(frame.limit(0), F.col("vec_id") % 10 == 0).collect() == []
    none = negatives.hard_negatives(frame, F.lit(None).cast("boolean"))
    assert none.collect() == [] and none.schema["anchor_id"].dataType.simpleString() == "bigint"


@pytest.mark.parametrize(("high", "kind"), [(300, np.int32), (negatives.LIMIT, np.int64)])
def test_scores_are_inner_products(high, kind):
    rng = np.random.default_rng(high)
    a, c = (rng.integers(-high, high + 1, (n, 24)) for n in (7, 33))
    a[0], c[0] = -high, high
    found = negatives.scores(negatives.subset_sums(a, kind), negatives.bit_planes(c, int(high).bit_length() + 1))
    assert (found == c @ a.T).all()
