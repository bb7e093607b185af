"""URL verdicts against trying every entry on every URL."""

import random

import numpy as np
import pyarrow as pa
import pytest

from docsettle.llm import urls

SCHEMA = "page_id bigint, url string, host string, path string, rule string, verdict string, a int, b int, listed int"
RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("COM", "/fr/", "allow"),
    ("com", "/de/", "block"), ("b.example.org", "", "allow"), ("net", "/x", "allow"), ("net", "/x", "block"), (None, "/", "block"),
    ("deep.example.com", "/de/", "allow"), ("", "", "allow"), ("m.com:80", "/", "block"), ("com", "/é", "block"), ("org", None, "block"),
]
BLOCKED = [("spam.example.net", ""), ("ads.com", "/en/"), ("bad.org", ""), (None, None)]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[end:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    return host, path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]


def fits(entry, host, path):
    own = entry[0].lower()
    return (host == own or host.endswith("." + own)) and path.startswith(entry[1])


def plain(rows, rules, blocked):
    out = []
    for i, url, *_ in rows:
        host, path = parts(url)
        own = [r for r in rules if None not in r[:2] and fits(r, host, path)]
        best = max(own, key=lambda r: (len(r[0] + r[1]), r[0].count(".")), default=None)
        if best:
            same = [r[2] for r in own if (r[0].lower(), r[1]) == (best[0].lower(), best[1])]
            out.append((i, host, path, best[0].lower() + best[1], "block" if "block" in same else "allow"))
        else:
            hit = any(None not in e and fits(e, host, path) for e in blocked)
            out.append((i, host, path, None, "block" if hit else "allow"))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(5)
    hosts = ["example.org", "www.Example.ORG", "b.example.org", "deep.example.com", "a.deep.example.com", "xdeep.example.com", "m.com:80"]
    hosts += ["spam.example.net", "www.spam.example.net", "nospam.example.net", "ads.com", "x.ads.com", "bad.org", "org", "", ".org", "a..net"]
    paths = ["", "/", "/es/", "/es", "/en/12", "/en/2", "/fr/x", "/de/1", "/x", "/xy", "/é/1", "/ES/", "/en/1\n/es/"]
    rows = [
        (k, f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=/de/', '#/fr/', '?a://b/fr/'])}")
        for k in range(400)
    ]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (None, "http://org/"), (401, None), (402, ""), (403, "example.org/es/"), (404, "a://b://org/de/")]
    rows += [(405, "http://" + "a." * 3_000 + "example.org/es/" + "x" * 50_000), (406, "mailto:x@org"), (407, "x://")]
    return [(*r, "h", "p", "r", "v", 1, 2, 3) for r in rows]


@pytest.mark.parametrize(("shard_keys", "group_bytes"), [(1 << 20, 1 << 26), (2, 1)])
@pytest.mark.parametrize("without", ["", "rules", "blocked"])
def test_judge(spark, shard_keys, group_bytes, without):
    rows = corpus()
    rules, blocked = ([] if without == "rules" else RULES), ([] if without == "blocked" else BLOCKED)
    found = urls.judge_urls(
        spark.createDataFrame(rows, SCHEMA).repartition(3),
        spark.createDataFrame(rules, "host string, path string, verdict string"),
        spark.createDataFrame(blocked, "host string, path string"),
        shard_keys=shard_keys,
        group_bytes=group_bytes,
    )
    assert found.columns == ["id", "host", "path", "rule", "verdict"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows, rules, blocked)


def test_empty_tables(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    blocked = spark.createDataFrame(BLOCKED, "host string, path string")
    pages = spark.createDataFrame(corpus(), SCHEMA)
    assert urls.judge_urls(pages.limit(0), rules, blocked).collect() == []
    found = urls.judge_urls(pages, rules.limit(0), blocked.limit(0)).select("rule", "verdict").distinct().collect()
    assert [tuple(r) for r in found] == [(None, "allow")]


@pytest.mark.parametrize("shard_keys", [1 << 20, 300])
def test_cascade_is_exact_over_its_corpus(spark, shard_keys):
    """Every key of the corpus, with filters so small that many pass wrongly."""
    corpus_keys = spark.range(20_000).selectExpr("array(xxhash64(id), null) AS a", "array(xxhash64(1, id), null) AS b", "id")
    entries = spark.range(0, 20_000, 13).union(spark.range(50_000, 50_400)).selectExpr("xxhash64(id) AS a", "xxhash64(1, id) AS b")
    cascade = urls.build_cascade(entries.union(entries), corpus_keys.select("a", "b"), shard_keys, 1_000)
    found = urls.listed(corpus_keys.select("id", "a", "b"), cascade, 1_000).collect()
    assert {r["id"] for r in found if r["listed"][0]} == set(range(0, 20_000, 13))
    assert len(found) == 20_000 and not any(r["listed"][1] for r in found)
    assert cascade.filters.agg({"level": "max"}).first()[0] > 2


def test_levels_end_only_when_nothing_passes_wrongly():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(1 << 62), 1 << 62, (2, 4_000))
    table = pa.table({"a": a, "b": b, "entry": np.arange(4_000) < 900})
    levels = [urls.Filter(level, 3 if level == 1 else 1, [bits]) for level, bits in urls._levels(table, 3)]
    found = urls._answers(levels, a.view(np.uint64), b.view(np.uint64), np.zeros(4_000, np.int64))
    assert (found == (np.arange(4_000) < 900)).all() and len(levels) > 3
    with pytest.raises(ValueError, match="same hash"):
        list(urls._levels(pa.table({"a": [1, 1], "b": [2, 2], "entry": [True, False]}), 1))
