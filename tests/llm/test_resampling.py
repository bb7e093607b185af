"""Importance resampling against plain counting of every n-gram."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from docsettle.llm import resampling

WORDS = "alpha Beta gamma delta ärger 漢字 x1 ZETA eta".split()
SCHEMA = "doc_id bigint, text string, row int, rank string, score string, id int"


def features(text, orders=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(c if c.isascii() and (c.isdigit() or c.islower()) or ord(c) > 127 else " " for c in low).split(" ")
    words = [w for w in words if w]
    return words, [" ".join(words[i : i + k]) for k in range(1, orders + 1) for i in range(len(words) - k + 1)]


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def plain(rows, target, percent=5, min_words=20, buckets=10_000):
    s = Counter(bucket(f, buckets) for _, t, *_ in rows for f in features(t)[1])
    g = Counter(bucket(f, buckets) for t in target for f in features(t)[1])
    s_all, t_all = sum(s.values()), sum(g.values())
    out = []
    for i, t, *_ in rows:
        words, found = features(t)
        weight = sum(
            math.floor(1000 * math.log((g[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
            for b in (bucket(f, buckets) for f in found)
        )
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(words), len(found), weight, score))
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = able[: percent * len(able) // 100]
    return out, [(r[0], r[4], k + 1) for k, r in enumerate(drawn)]


def corpus():
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.randint(0, 60))), 1, "r", "s", 2) for i in range(120)]
    rows += [(200 + i, rows[7][1], 1, "r", "s", 2) for i in range(5)]
    rows += [rows[9], rows[9], (None, rows[3][1] * 3, None, None, None, None), (None, None, 1, "", "", 1), (300, "", 1, "", "", 1)]
    rows += [(301, " \n.;", 1, "", "", 1), (302, "w" * 5_000 + " " + "é" * 300 + " ok " * 30, 1, "", "", 1)]
    return rows, [" ".join(rng.choices(WORDS[:4], k=30)) for _ in range(4)] + [None, ""]


@pytest.mark.parametrize(("percent", "buckets"), [(5, 10_000), (60, 70)])
def test_resample(spark, percent, buckets):
    rows, target = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.importance_resample(docs, goal, percent=percent, buckets=buckets).collect()
    wanted, drawn = plain(rows, target, percent, buckets=buckets)
    assert sorted((tuple(r)[:5] for r in found), key=str) == sorted(wanted, key=str)
    ranked = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    assert [(r["id"], r["score"], r["rank"]) for r in ranked] == drawn


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    goal = spark.createDataFrame([("alpha beta",)], "text string")
    assert resampling.importance_resample(none, goal).collect() == []
    docs = spark.createDataFrame([(1, "alpha " * 30)], "doc_id bigint, text string")
    found = resampling.importance_resample(docs, goal.limit(0), percent=100).collect()
    assert [tuple(r)[:4] + (r["rank"],) for r in found] == [tuple(r[:4]) + (1,) for r in plain([(1, "alpha " * 30)], [])[0]]


def test_checksums_of_joined_texts():
    rng, join = random.Random(2), resampling.CrcJoin()
    parts = [bytes(rng.choices(range(256), k=rng.choice([0, 1, 5, 63, 64, 65, 1_000, 70_000]))) for _ in range(40)]
    crc = np.array([zlib.crc32(p) for p in parts], np.uint32)
    length = np.array([len(p) for p in parts])
    found = join.joined(crc[:-1], crc[1:], length[1:])
    assert found.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(parts, parts[1:], strict=False)]


def test_planes_are_exact():
    rng = np.random.default_rng(3)
    gains = rng.integers(-20_000, 20_000, 130)
    gains[:3] = [-(1 << 14), 0, (1 << 14) - 1]
    rows, buckets = rng.integers(0, 9, 5_000), rng.integers(0, 130, 5_000) % rng.integers(1, 130, 5_000)
    found = resampling.Planes(gains).weigh(rows, buckets, 10)
    assert found.tolist() == [int(gains[buckets[rows == k]].sum()) for k in range(10)]
    assert resampling.Planes(np.zeros(5, np.int64)).weigh(rows[:9], rows[:9] % 5, 10).tolist() == [0] * 10


def test_long_texts_in_parts(monkeypatch):
    """Runs across the parts of a text count once, whatever stands between words."""
    monkeypatch.setattr(resampling, "_GROUP_WORDS", 5)
    rng = random.Random(4)
    texts = [b"".join(rng.choice([b"ab", b"cde", b"f"]) + rng.choice([b" ", b"--", b" " * 200]) for _ in range(n)) for n in (0, 1, 2, 3, 90, 400, 3)]
    texts += [b"q" * 500 + b" r s", None, b"a b c"]
    found, words = [Counter() for _ in texts], Counter()
    for first, _, rows, crc, count in resampling.feature_groups(texts, resampling._WordCrcs(), resampling.CrcJoin(), 3):
        for row, value in zip(rows.tolist(), crc.tolist(), strict=True):
            found[first + row][value] += 1
        for k, n in enumerate(count.tolist()):
            words[first + k] += n
    for k, text in enumerate(texts):
        own, wanted = features((text or b"").decode())
        assert found[k] == Counter(zlib.crc32(f.encode()) for f in wanted) and words[k] == len(own)


@pytest.mark.parametrize("wanted", [0, 1, 7, 50, 99, 100, 1000])
def test_highest_with_ties(spark, monkeypatch, wanted):
    monkeypatch.setattr(resampling, "_BINS", 4)
    rng = random.Random(wanted)
    rows = [(rng.choice([None, k % 40]), rng.choice([1, 1, 2, 50]), k, k < 100) for k in range(120)]
    frame = spark.createDataFrame(rows, "id long, score long, row long, able boolean").repartition(5)
    found = resampling.highest(frame, wanted, frame["able"]).collect()
    order = sorted((r for r in rows if r[3]), key=lambda r: (-r[1], r[0] is None, r[0] or 0, r[2]))
    assert len(found) == 120
    assert {r["row"]: r["rank"] for r in found if r["rank"]} == {r[2]: k + 1 for k, r in enumerate(order[:wanted])}
