"""Each operator on small tables with nulls, empty texts, repeated rows and clashing columns, against brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from docsettle.llm import cells, components, decontaminate, jaccard, lines, ngrams, offsets, packing, pages, quality, sharding, sketch, tokens, warc
from docsettle.llm.queries import token_file

WORDS = [a + b for a in "ka lo mi nu pe ri sa to vu xe".split() for b in ("", "ba", "do", "gi")]
SCHEMA = "doc_id bigint, text string, lang string, n_words int, kept string, shard int, id int, node string"


def corpus(seed=3, size=60):
    rng = random.Random(seed)
    texts = [" ".join(rng.choices(WORDS, k=rng.randint(1, 120))) for _ in range(size)]
    for k in range(15):  # near copies of one text, each with an edit of its own
        words = (texts[0] + " " + texts[1]).split()
        words[rng.randrange(len(words))] = f"edit{k}"
        texts.append(" ".join(words))
    texts += [texts[2], texts[2], "", None, " \n\t ", "one", "two words", "x" * 50_000, texts[3] + "\n" + texts[4] + "\n" + texts[3]]
    rows = [(i, t, rng.choice(["en", "de", None]), 1, "no", 2, 3, "n") for i, t in enumerate(texts)]
    return [*rows, rows[5], (None, texts[6], "en", 1, "no", 2, 3, "n"), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def groups(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def shingles(text, size):
    words = (text or "").encode().lower().split()
    width = min(size, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


@pytest.mark.parametrize(("size", "percent", "weight"), [(3, 90, 2_000_000), (5, 80, 2_000_000), (3, 90, 300), (5, 80, 300)])
def test_jaccard(docs, rows, size, percent, weight):
    sets = {}
    for i, t, *_ in rows:
        sets.setdefault(frozenset(shingles(t, size)), []).append(i)
    known = [s for s in sets if s]
    linked = [
        (a, b)
        for a in range(len(known))
        for b in range(a)
        if 100 * len(known[a] & known[b]) >= percent * len(known[a] | known[b])
    ]
    group = groups(range(len(known)), linked)
    least = {}
    for k, s in enumerate(known):
        for i in sets[s]:
            if i is not None:
                least[group[k]] = min(i, least.get(group[k], i))
    place = {s: k for k, s in enumerate(known)}
    wanted = []
    for i, t, *_ in rows:
        s = frozenset(shingles(t, size))
        wanted.append((i, len(s), least.get(group[place[s]]) if s else i))
    found = [tuple(r) for r in jaccard.jaccard_components(docs, size=size, percent=percent, task_weight=weight).collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str)


@pytest.mark.parametrize("percent", [80, 90])
def test_least_common_shingles_of_linked_sets_meet(percent):
    """Whatever the counts, ties included, two sets within the radius have a region in common."""
    rng = np.random.default_rng(7)
    counts = rng.integers(0, 3, sketch.COUNTERS).astype(np.uint32)
    for _ in range(300):
        shared = rng.integers(0, 1 << 62, rng.integers(1, 60)).astype(np.uint64)
        own = [rng.integers(0, 1 << 62, rng.integers(0, 12)).astype(np.uint64) for _ in range(2)]
        a, b = (np.unique(np.concatenate([shared, o])) for o in own)
        inter, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if 100 * inter >= percent * union:
            assert set(jaccard.least_common(a, counts, percent)) & set(jaccard.least_common(b, counts, percent))


def test_counters_add_up_over_tasks(spark):
    frame = spark.range(3000).selectExpr("id % 1000 AS h").repartition(3)
    found = sketch.counters(frame, lambda batches: (b.column(0).to_numpy().astype(np.uint64) for b in batches)).value
    assert (sketch.tally(found, np.arange(1000, dtype=np.uint64)) == 3).all()
    assert found.sum() == 3000
    assert sketch.counters(frame.limit(0), lambda batches: iter(())).value.sum() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (7, 7)], "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 99: 99, 100: 99}
    assert components.components(edges.limit(0)).count() == 0


def test_edit_distance_and_simhash():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 9))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
            row = new
        assert lines.edit_distance(a, b) == row[-1]


@pytest.mark.parametrize("weight", [8_000_000, 200])
def test_line_dedup(spark, weight):
    rng = random.Random(9)
    base = [" ".join(rng.choices(WORDS, k=40)) for _ in range(12)]
    changed = [b.upper() + "!" for b in base[:4]] + [b + " also" for b in base[:6]]
    texts = ["\n".join(rng.choices(base + changed, k=5)) for _ in range(20)] + ["", None, "short line\nshort line"]
    rows = [(i, t, 5) for i, t in enumerate(texts)] + [(None, base[0], 5), (3, texts[3], 5)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, dropped_lines int")
    places = {}
    for i, t, _ in rows:
        for n, line in enumerate((t or "").encode().split(b"\n")):
            words = decontaminate.words_of(line)
            if len(words) >= 5:
                h = (i is not None, i or 0, t, n)
                places.setdefault(b" ".join(words), set()).add(h)
    forms = sorted(places)
    marks = lines.simhashes([f.split() for f in forms], jaccard._WordHashes()).view(np.uint64)
    near = [
        (a, b)
        for a in range(len(forms))
        for b in range(a)
        if np.bitwise_count(marks[a] ^ marks[b]) <= 3
        and lines.edit_distance(forms[a].decode(), forms[b].decode()) <= 0.2 * max(len(forms[a]), len(forms[b])) + 1e-9
    ]
    found = lines.dedup_lines(frame, task_weight=weight)
    assert found.columns == ["doc_id", "text", "dropped_lines", "_dropped_lines"]
    got = sorted(map(tuple, found.collect()), key=str)
    assert len(got) == len(rows)
    group = groups(range(len(forms)), near)
    kept = {}
    for k, f in enumerate(forms):
        kept.setdefault(group[k], set()).update(places[f])
    left = sum(r[3] for r in set(got))
    assert left == sum(len(p) - 1 for p in kept.values())
    assert {r[1] for r in got if r[0] == 21} == {None} and {r[1] for r in got if r[0] == 22} == {"short line\nshort line"}


def meet(a, b):
    """Whether two lines share a block and their marks are near."""
    marks, line, keys = lines.sketch([a.encode(), b.encode()], jaccard._WordHashes())
    return bool(set(keys[line == 0]) & set(keys[line == 1])) and bool(lines.near_marks(marks[:1], marks[1:])[0])


def test_line_sketches_find_near_lines():
    rng = random.Random(2)
    letters = ["".join(rng.choices("aeiourstlnmdkp", k=rng.randint(2, 8))) for _ in range(3000)]
    base = [" ".join(rng.choices(letters, k=rng.randint(8, 60))) for _ in range(400)]
    han = ["".join(chr(0x4E00 + rng.randrange(2000)) for _ in range(40)) for _ in range(100)]

    def words(line, share):
        own = line.split()
        for i in rng.sample(range(len(own)), max(1, int(len(own) * share))):
            own[i] = "".join(rng.choices("bcdfgh", k=4))
        return " ".join(own)

    def chars(line, share, letters):
        own = list(line)
        for i in rng.sample(range(len(own)), max(1, int(len(own) * share))):
            own[i] = rng.choice(letters)
        return "".join(own)

    def recall(lines_, change):
        pairs = [(a, change(a)) for a in lines_]
        near = [(a, b) for a, b in pairs if lines.edit_distance(a, b) <= 0.2 * max(len(a), len(b))]
        assert len(near) > 60
        return np.mean([meet(a, b) for a, b in near])

    assert recall(base, lambda x: words(x, 0.1)) >= 0.97 and recall(base, lambda x: words(x, 0.2)) >= 0.85
    assert recall(base, lambda x: chars(x, 0.02, "qwxz")) >= 0.95
    assert recall(base, lambda x: chars(x, 0.05, "qwxz")) >= 0.4  # what the method loses, see README
    assert recall(han, lambda x: chars(x, 0.1, "好的是")) >= 0.98 and recall(han, lambda x: chars(x, 0.2, "好的是")) >= 0.9
    short = [" ".join(rng.choices(letters, k=rng.randint(3, 7))) for _ in range(300)]
    assert recall(short, lambda x: chars(x, 0.03, "qwxz")) >= 0.6
    assert sum(meet(a, b) for a, b in zip(base, base[1:], strict=False)) == 0


def test_sketches_of_very_long_lines_and_many_repeats():
    rng = random.Random(4)
    long = " ".join(rng.choices(WORDS, k=30_000))
    other = " ".join(f"w{rng.randrange(9_000)}" for _ in range(30_000))
    assert meet(long, long + " end") and meet(other, other.replace("w77 ", "v77 ")) and not meet(long, other)
    marks, line, keys = lines.sketch(["a a a a a a a a a".encode(), "漢字".encode() * 9], jaccard._WordHashes())
    assert marks.shape == (2, 2) and len(line) == len(keys)


def test_members_of_blocks(spark):
    """Near marks in one block, whichever task they come from; a hot block is not compared."""
    rows = [(1, k // 3, k // 3, 9, 7) for k in range(6)] + [(2, 5, 0, 9, 7), (2, 6, 0, 9, -1)]
    rows += [(3, n, 0, n << 40, n * 77_777_777) for n in range(lines._HOT * 18)]
    frame = spark.createDataFrame([([k], n, m1, m2) for k, n, _, m1, m2 in rows], "keys array<long>, node long, m1 long, m2 long")
    found = lines.block_members(frame.select("node", "m1", "m2", "keys"))
    counts = {r["key"]: r["count"] for r in found.groupBy("key").count().collect()}
    assert counts == {1: 2, 3: lines._HOT * 18}


def test_within():
    rng = random.Random(6)
    for _ in range(400):
        a = " ".join(rng.choices(["ab", "abc", "b", "ca"], k=rng.randint(1, 9)))
        b = " ".join(x if rng.random() < 0.8 else rng.choice(["ab", "", "cc"]) for x in a.split(" "))
        limit = rng.randint(0, 8)
        assert lines.within(a, b, limit) == (lines.edit_distance(a, b) <= limit)
        assert not lines.close_words(a, b, limit) or lines.within(a, b, limit)


def test_lines_of_a_cell_are_compared_once(monkeypatch):
    """Lines with the same marks, the same words in another order: each pair is aligned once, and where the least key is."""
    rng = random.Random(3)
    words = [f"{a}{b}x" for a in "abcdefgh" for b in "pqrst"]
    forms = [" ".join(rng.sample(words, len(words))) for _ in range(6)]
    asked = []
    monkeypatch.setattr(lines, "within", lambda a, b, limit: asked.append(frozenset((a, b))))

    def payload(cell, keys, form):
        return cell + len(keys).to_bytes(2, "big") + b"".join(keys) + b"\0" * 16 + form.encode()

    here, less = b"\0\0\0\2", b"\0\0\0\1"
    links = lines.line_links(0.8)
    assert links([payload(here, [here], x) for x in forms], None) == []
    assert len(asked) == len(set(asked)) == 15
    asked.clear()
    some = [payload(here, [here, less] if k < 3 else [here], x) for k, x in enumerate(forms)]
    assert links(some[:3], some) == [] and len(asked) == len(set(asked)) == 9  # but for those that meet in the lesser key's cell


@pytest.mark.parametrize("weight", [8_000_000, 300])
def test_line_dedup_as_the_query_asks(spark, weight):
    """Edit similarity alone decides: nothing else goes, and of the near lines nearly all meet."""
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("aeiourstlnmdkp", k=rng.randint(2, 8))) for _ in range(600)]
    base = [" ".join(rng.choices(vocabulary, k=rng.randint(4, 40))) for _ in range(40)]
    base += ["".join(chr(0x4E00 + rng.randrange(900)) for _ in range(30)) for _ in range(10)]

    def change(line):
        if " " not in line:
            return line[:7] + "好" + line[8:]
        own = line.split()
        own[rng.randrange(len(own))] = "zz"
        return " ".join(own)

    pool = base + [change(x) for x in base for _ in range(2)] + ["ok", "two words", "", "!!"]
    rows = [(i, "\n".join(rng.choices(pool, k=6)), 1, 2) for i in range(60)] + [(60, None, 1, 2), (61, "", 1, 2), (None, pool[0], 1, 2)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, dropped_lines_id int, dropped_lines_h int")
    found = {r["doc_id"]: r for r in lines.dedup_lines(frame, min_words=1, max_bits=None, task_weight=weight).collect()}
    assert len(found) == len(rows) and found[60]["text"] is None and found[61]["text"] == ""
    forms, places = {}, []
    for i, text, *_ in rows:
        for n, line in enumerate((text or "").split("\n")):
            words = decontaminate.words_of(line.encode())
            if words:
                forms.setdefault(b" ".join(words).decode(), []).append((i is not None, i or 0, n))
    names = sorted(forms)
    near = [
        (a, b)
        for a in range(len(names))
        for b in range(a)
        if min(len(names[a]), len(names[b])) >= 9
        and lines.edit_distance(names[a], names[b]) <= 0.2 * max(len(names[a]), len(names[b]))
    ]
    group = groups(range(len(names)), near)
    kept = {}
    for k, name in enumerate(names):
        kept.setdefault(group[k], []).extend(forms[name])
    places = sum(map(len, forms.values()))
    dropped = sum(r["dropped_lines"] for r in found.values())
    assert 0.95 * (places - len(kept)) <= dropped <= places - len(kept)
    left = sum(1 for r in found.values() for x in (r["text"] or "").split("\n") if decontaminate.words_of(x.encode()))
    assert left == places - dropped


def test_near_lines(spark):
    line = "one two three four five six seven eight nine ten eleven twelve"
    texts = [line, line.replace("eight", "other"), "another line of five words"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = lines.dedup_lines(frame, max_bits=None)
    assert [r["dropped_lines"] for r in found.orderBy("doc_id").collect()] == [0, 1, 0]


def test_near_and_short_lines(spark):
    line = "one two three four five six seven eight nine ten eleven twelve"
    other = "one two three four five six seven other nine ten eleven twelve"
    han = "".join(chr(0x4E00 + 37 * k) for k in range(40))
    texts = [line, other, "all rights reserved", "All rights reserved.", "!", "!", han, han, han[:20] + "口" + han[21:], "another line"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = lines.dedup_lines(frame, min_words=1, max_bits=None)
    assert [r["dropped_lines"] for r in found.orderBy("doc_id").collect()] == [0, 1, 0, 1, 0, 0, 0, 1, 1, 0]


def brute_hits(text, items, size=13):
    words = decontaminate.words_of(None if text is None else text.encode())
    hit, found = set(), set()
    for name, item in items:
        own = decontaminate.words_of(None if item is None else item.encode())
        k = min(size, len(own))
        for p in range(len(own) - k + 1) if own else ():
            for q in range(len(words) - k + 1):
                if words[q : q + k] == own[p : p + k]:
                    hit.update(range(q, q + k))
                    found.add(name)
    return len(words), len(hit), sorted(found)


def test_decontaminate(spark, docs, rows):
    rng = random.Random(1)
    items = [(f"i{k}", " ".join(rng.choices(WORDS, k=rng.randint(2, 30)))) for k in range(12)]
    items += [("copy", rows[3][1]), ("copy2", rows[3][1]), ("tiny", "lo"), ("none", None), ("blank", " - "), (None, "ka lo")]
    bench = spark.createDataFrame(items + items[:2], "item_id string, text string")
    found = decontaminate.decontaminate(docs, bench, max_span=13).collect()
    wanted = [(r[0], *brute_hits(r[1], [x for x in items if x[0]])) for r in rows]
    key = lambda x: (str(x[0]), *x[1:4])
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"]) for r in found]
    assert sorted(got, key=key) == sorted([(i, w, h, len(f)) for i, w, h, f in wanted], key=key)
    for r in found:
        assert r["contaminated"] == (r["n_hit"] > 0 and 20 * r["n_hit"] >= r["n_words"])
        assert (r["clean_text"] is None) >= r["contaminated"]
    nothing = decontaminate.decontaminate(docs, bench.limit(0))
    assert nothing.where("n_hit > 0 OR contaminated").count() == 0
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0
    assert decontaminate.without_spans(b"a b, c d", [(1, 2)]) == b"a c d"


def test_decontaminate_by_blocks_of_items(spark, docs, monkeypatch):
    rng = random.Random(1)
    items = [(f"i{k}", " ".join(rng.choices(WORDS, k=rng.randint(2, 30)))) for k in range(12)]
    bench = spark.createDataFrame([*items, ("blank", " - ")], "item_id string, text string")
    whole = decontaminate.decontaminate(docs, bench, max_span=13)
    monkeypatch.setattr(decontaminate, "MAX_ITEM_WORDS", 20)  # items of up to 30 words are cut as well
    assert len(list(decontaminate.item_blocks(bench))) > 3
    assert max(sum(len(w) for _, w in block) for block in decontaminate.item_blocks(bench)) <= 20
    parts = decontaminate.decontaminate(docs, bench, max_span=13)
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))


def test_quality(docs, rows, empty):
    found = {(r["doc_id"], r["n_words"]): r for r in quality.assess(docs).collect()}
    for i, t, *_ in rows:
        words = [w for w in (t or "").replace("\n", " ").replace("\t", " ").split(" ") if w]
        seen, covered = {}, set()
        for p in range(len(words) - 4):
            seen.setdefault(tuple(words[p : p + 5]), []).append(p)
        for places in seen.values():
            if len(places) > 1:
                covered.update(x for p in places for x in range(p, p + 5))
        r = found[(i, len(words))]
        assert (r["word_chars"], r["n_repeat_words"]) == (sum(map(len, words)), len(covered))
        assert r["base_failed"] == (len(words) < 10 or 5 * len(covered) > len(words))
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.assess(empty).count() == 0


def test_rules_are_ordered_given_those_before():
    # the second rule rejects most, but only what the first one rejects for less
    verdicts = [(True, True, False)] * 6 + [(False, True, False)] + [(False, False, True)] * 3 + [(False,) * 3] * 5
    assert quality.greedy_order(verdicts, [1.0, 1.4, 1.0]) == [0, 2, 1]
    assert quality.greedy_order(verdicts, [1.0, 1.0, 1.0]) == [1, 2, 0]
    assert quality.greedy_order([], [2.0, 1.0]) == [1, 0]


def test_the_order_of_rules_does_not_change_the_verdict(spark, docs, empty):
    rules = quality.BASE + quality.RULES
    assert quality.cascade_order(empty, "text", rules) == rules
    assert sorted(r.name for r in quality.cascade_order(docs, "text", rules)) == sorted(r.name for r in rules)
    text = docs["text"]
    kept = [docs.where(quality.passes(text, order)).count() for order in (rules, rules[::-1])]
    assert kept[0] == kept[1] == quality.keep_good(docs).count()


def test_encoder_is_the_tokenizer():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(token_file())
    special = next(t.content for t in plain.get_added_tokens_decoder().values())
    encoder = tokens.Encoder(token_file())
    rng = random.Random(2)
    for _ in range(1500):
        text = "".join(rng.choices(" \n\t\r\x0b\x85\xa0 ​\x1cab1½,.!'sé中😀<|>", k=rng.randint(0, 14)))
        wanted = plain.encode(text, add_special_tokens=False)
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == wanted.ids
        first, end = encoder.offsets(text)
        assert list(zip(first.tolist(), end.tolist(), strict=True)) == wanted.offsets


@pytest.mark.parametrize("group_rows", [20_000, 7])
def test_packing(docs, rows, empty, group_rows):
    cut = packing.pieces(docs, token_file(), capacity=64)
    got = packing.pack(cut, capacity=64, group_rows=group_rows).toPandas()
    assert got["length"].sum() == sum(len(tokens.Encoder(token_file()).ids(r[1] or "")) // 4 + 1 for r in rows)
    for _, one in got.sort_values("offset").groupby("sequence_id"):
        assert one["length"].sum() <= 64
        assert one["offset"].tolist() == [0, *np.cumsum(one["length"])[:-1]]
    for r in got.itertuples():
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
        assert r.length == 64 or r.piece == 0
    if group_rows > len(got):
        assert got["sequence_id"].nunique() <= packing.best_fit(got["length"].to_numpy(), 64).max() + 1
    assert packing.pack(packing.pieces(empty, token_file())).count() == 0


def fewest(lengths, capacity):
    """The least number of bins, by trying every way."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def place(k, fills):
        if len(fills) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(fills)
            return
        for i in range(len(fills)):
            if fills[i] + lengths[k] <= capacity and fills[i] not in fills[:i]:
                place(k + 1, [*fills[:i], fills[i] + lengths[k], *fills[i + 1 :]])
        place(k + 1, [*fills, lengths[k]])

    place(0, [])
    return best[0]


def test_packing_against_the_optimum():
    """On small cases nearly always the least number of bins, and never more than best fit needs."""
    rng = np.random.default_rng(5)
    extra = 0
    for _ in range(60):
        lengths = rng.integers(5, 60, 11)
        bins = packing.best_fit(lengths, 100)
        found = packing.local_search(lengths, bins, 100)
        assert np.bincount(found, lengths).max() <= 100
        used, least = len(set(found.tolist())), fewest(lengths.tolist(), 100)
        assert least <= used <= len(set(bins.tolist()))
        extra += used - least
    assert extra <= 6


def test_rounds_over_groups_empty_sequences(spark):
    """Sequences of different groups meet in later rounds, though the number of groups does not fall."""
    rng = random.Random(3)
    rows = [(k, rng.choice([35, 36, 37])) for k in range(400)] + [(k, 28) for k in range(400, 800)]
    frame = spark.createDataFrame(rows, "id long, length long")
    placed = packing.pack(frame, capacity=100, group_rows=150).toPandas()
    assert len(placed) == 800 and placed.groupby("sequence_id")["length"].sum().max() <= 100
    alone = sum(len(set(packing.best_fit(np.array([n for _, n in rows[k::6]]), 100).tolist())) for k in range(6))
    assert placed["sequence_id"].nunique() <= alone


def test_local_search_empties_bins():
    lengths = np.array([6, 4, 3, 5, 2])
    bins = packing.local_search(lengths, np.array([0, 1, 1, 2, 2]), 10)
    assert len(set(bins.tolist())) == 2 and np.bincount(bins, lengths).max() <= 10


def test_sections(docs, rows, empty):
    got = offsets.section_tokens(docs, token_file()).toPandas()
    encoder = tokens.Encoder(token_file())
    assert got["n_tokens"].sum() == sum(len(encoder.ids(r[1] or "")) // 4 for r in rows)
    assert got["n_chars"].sum() == sum(len(r[1] or "") for r in rows)
    wanted = {}
    for i, text, *_ in rows:  # character by character
        starts = [0] + [k + 1 for k, c in enumerate(text or "") if c == "\n" and k + 1 < len(text)]
        line = [sum(k >= s for s in starts) - 1 for k in range(len(text or ""))]
        counts = [0] * len(starts)
        for a, b in zip(*encoder.offsets(text or ""), strict=True):
            own = [line[k] for k in range(a, b)]
            counts[max(sorted(set(own)), key=own.count)] += 1
        wanted.setdefault((i, text), []).append(counts)
    for (i, text), lists in wanted.items():
        mine = got[got["id"].isna() if i is None else got["id"] == i]
        assert sorted(n for c in lists for n in c) == sorted(mine["n_tokens"].tolist()) or sum(r[0] == i for r in rows) > len(lists)
    first, end = np.array([0, 2, 4]), np.array([2, 5, 6])
    assert offsets.attribute(first, end, np.array([0, 3]), 6, "overlap").tolist() == [1, 2]
    assert offsets.attribute(first, end, np.array([0, 3]), 6, "start").tolist() == [2, 1]
    assert offsets.section_tokens(empty, token_file()).count() == 0


@pytest.mark.parametrize("range_bytes", [1 << 30, 300])
def test_sharding(docs, rows, empty, range_bytes):
    got = sharding.shard(docs, shards=4, range_bytes=range_bytes).toPandas()
    sizes = [len((r[1] or "").encode()) + 8 for r in rows]
    assert sorted(got["size"]) == sorted(sizes)
    assert sorted(got["text_crc32"]) == sorted(zlib.crc32((r[1] or "").encode()) for r in rows)
    for _, one in got.groupby("shard"):
        assert sorted(one["slot"]) == list(range(len(one)))
    assert sharding.shard(empty).count() == 0
    assert set(got["shard"]) <= set(range(4))
    # rows in order of text, id and row, cut where a quarter of all bytes lies before the middle of a row or small group
    ordered = got.sort_values(["shard", "slot"]).reset_index(drop=True)
    start, total = ordered["size"].cumsum() - ordered["size"], sum(sizes)
    middle = start + ordered["size"] / 2
    for _, one in ordered[ordered["text_crc32"] != 0].groupby("text_crc32"):
        if len(one) > 1 and one["size"].sum() * 32 <= total:
            middle[one.index] = start[one.index[0]] + one["size"].sum() / 2
            assert one["shard"].nunique() == 1
    certain = ordered["text_crc32"] != 0  # null texts and empty ones are two groups of one checksum
    assert (np.minimum(np.floor(middle * 4 / total), 3) == ordered["shard"])[certain].all()
    texts = [t for t in ordered["text_crc32"].tolist() if t]  # without null and empty ones
    assert len([1 for a, b in zip(texts, texts[1:], strict=False) if a != b]) + 1 == len(set(texts))  # equal texts are neighbours


def test_pages(spark, empty):
    page = "<html><body><nav><a href=x>Home</a></nav>{}<footer>&copy; site</footer>"
    article = page.format("<div class='ad'>buy</div><article><h1>T</h1><p>one&nbsp;&amp; two<p>three <b>x</b><div class=comments>no</div></article>")
    table = [
        (1, "http://a.org/p/1", article, "t"),
        (2, "https://a.org/p/2?x=1", page.format("<p>All rights</p><p>own text</p>"), "t"),
        (3, "https://a.org/p/3.html", page.format("<p>All rights</p><p>other text</p>"), "t"),
        (4, None, None, "t"),
        (5, "", "<p>plain < text", "t"),
        (5, "", "<p>plain < text", "t"),
    ]
    frame = spark.createDataFrame(table, "page_id bigint, url string, html string, text string")
    got = pages.extract(frame).collect()
    texts = {r["id"]: r["text"] for r in got}
    assert len(got) == 6 and texts[1] == "T one & two three x" and texts[4] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert texts[2] == "own text" and texts[3] == "other text" and texts[5] == "plain < text"
    assert pages.extract(frame.limit(0)).count() == 0
    rng = random.Random(4)
    for _ in range(300):
        a, b = (rng.choices("abcd", k=rng.randint(0, 9)) for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert len(pages.shared_lines(a, b)) == len(pages._common(a, b, 4)) == best[-1][-1]


def expected_page_texts(table):
    """Neighbours by looking at all pages of a host in order."""
    from urllib.parse import urlsplit

    known = []
    for i, url, page, *_ in table:
        split = urlsplit(url or "")
        path = split.path.removesuffix("/").removesuffix(".html")
        known.append((split.netloc, path, tuple(b.text for b in pages.blocks_of(page)), (i, url, page)))
    texts = {}
    for host, path, lines, key in known:
        others = [o for o in known if o[0] == host and o[2] != lines]
        before = max((o for o in others if o[1] < path), key=lambda o: o[1], default=None)
        after = min((o for o in others if o[1] > path), key=lambda o: o[1], default=None)
        beside = [None if o is None else (o[1], list(o[2])) for o in (before, after)]
        texts[key] = pages.main_text(pages.blocks_of(key[2]), set(pages.difference(list(lines), path, *beside)))
    return texts


def test_pages_are_the_same_however_they_are_dealt(spark):
    """With 1, 3 and 64 ranges; runs of copies go over several of them."""
    rng = random.Random(7)
    table = []
    for k in range(60):
        host = rng.choice(["a.org", "b.org", "c.org"])
        kind = rng.choice(["p", "main", "article"])
        own = "".join(f"<p>{' '.join(rng.choices(WORDS, k=5))}</p>" for _ in range(rng.randint(1, 6)))
        page = f"<body><p>Site {host}</p><p>Menu</p><{kind}>{own}<p>Site note</p></{kind}><p>All rights</p></body>"
        table.append((k, f"http://{host}/x/{k:03}", page))
    copy = table[20][2]
    table += [(100 + k, f"http://a.org/x/{k + 30:03}5", copy) for k in range(25)] + [table[3], table[3], (200, "http://d.org/1", copy)]
    table += [(201, f"http://e.org/{k}", None) for k in range(3)]
    frame = spark.createDataFrame(table, "page_id bigint, url string, html string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for parts in ("1", "3", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            results.append(sorted((r["id"], r["url"], r["text"]) for r in pages.extract(frame).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]
    wanted = {key[:2]: text for key, text in expected_page_texts(table).items()}
    assert results[0] == sorted((i, u, wanted[(i, u)]) for i, u, _ in table)
    for i, url, page in table[:60]:
        text = wanted[(i, url)]
        assert "All rights" not in text and "Menu" not in text
        assert ("Site note" in text) == ("<article>" in page)


def test_warc(spark):
    table = [
        ("<urn:uuid:1>", "http://a/1", "2024-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\nServer: x", "<p>one<p>two &amp; more", 1),
        (None, None, None, None, None, 1),
        ("<urn:uuid:2>", "http://a/\r\nX: y", "d", "", "<script>a<b</script>", 1),
    ]
    frame = spark.createDataFrame(table, "record_id string, target_uri string, date string, http_headers string, payload string, type int")
    got = warc.derive(frame).collect()
    assert [r["type"] for r in got] == ["metadata", "conversion"] * 3
    data = b"".join(warc.serialise(r["headers"], bytes(r["block"])) for r in got)
    for r, (fields, block) in zip(got, warc.parse(data), strict=True):
        assert block == bytes(r["block"]) and fields["WARC-Refers-To"] == r["refers_to"]
        assert fields["WARC-Block-Digest"] == warc.digest(block) and "X" not in fields
    assert bytes(got[1]["block"]) == b"one\ntwo & more" and b"source-header: Server: x" in bytes(got[0]["block"])
    assert warc.derive(frame.limit(0)).count() == 0


def test_kneser_ney_sums_to_one(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choices(WORDS, k=30)) for _ in range(40)]
    trusted = spark.createDataFrame([(t,) for t in texts], "text string")
    classes = spark.sparkContext.broadcast(ngrams.alphabet(trusted))
    table = ngrams.log_table(ngrams.kneser_ney(ngrams.ngram_counts(trusted, classes)))
    sums = np.exp(table, dtype=np.float64).reshape(-1, ngrams.SYMBOLS).sum(axis=1)
    assert np.allclose(sums, 1, atol=1e-3)


def test_classifier(spark):
    rng = random.Random(8)
    good = [" ".join(rng.choices(WORDS, k=60)) for _ in range(60)]
    bad = ["".join(rng.choices("qzwjxk!#", k=200)) for _ in range(10)]
    rows = [(i, t, "en" if i % 2 else None, "x") for i, t in enumerate([*good, *bad, "", None])] + [(None, good[0], "en", "x")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, kept string")
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(60, 0), (None, 1), (5, None), (31, None)], "doc_id bigint, quality int")
    got = {r["id"]: r for r in ngrams.classify(frame, labels).collect()}
    assert sum(got[i]["trusted"] for i in range(72)) == 29
    assert sum(got[i]["kept"] for i in range(30, 60)) >= 25  # texts the model has not seen
    assert not any(got[i]["kept"] for i in range(60, 72))
    unjudged = ngrams.classify(frame, labels.limit(0)).where("kept").count()
    assert unjudged == 71 and ngrams.classify(frame.limit(0), labels).count() == 0


def test_every_character_has_symbols_of_its_own(spark):
    texts = ["".join(map(chr, range(0x20, 0x180))), "Straße ИÍẞßİıſ", "你好 \U0001f600", *(chr(c) * 9 for c in range(0x4E00, 0x4E00 + 4000))]
    classes = ngrams.alphabet(spark.createDataFrame([(t,) for t in [*texts, None, ""]], "text string"))
    seen = sorted(set("".join(texts)))
    spelled = {c: tuple(ngrams.symbols_of(c, classes).tolist()) for c in seen}
    of = {s: c for c, s in spelled.items()}
    assert len(of) == len(seen) and not any(s[:k] in of for s in of for k in range(1, len(s)))  # none begins with another
    assert spelled["I"][1:] == spelled["i"]
    for text in texts:
        assert ngrams.symbols_of(text, classes).tolist() == [x for c in text for x in spelled[c]]
    assert tuple(ngrams.symbols_of("\u3042", classes).tolist()) not in of  # stands in no text


def test_classifier_in_a_script_beside_the_most_frequent_characters(spark):
    rng = random.Random(8)
    common = [*"abcdefghijklmnopqrstuvwxyz0123456789 ", *map(chr, range(0xE0, 0xF8))]
    latin = ["".join(rng.choices(common, k=600)) for _ in range(60)]
    words = [a + b for a in "ко ло ми ну пе ри са то ву зе".split() for b in ("", "ба", "до", "ги")]
    good = [" ".join(rng.choices(words, k=60)) for _ in range(60)]
    bad = [" ".join("".join(rng.sample(w, len(w))) if len(w) < 3 else "".join(rng.choices("коламинупервстзгбд", k=len(w))) for w in t.split()) for t in good[:10]]
    good += [t.upper() for t in good]
    bad += [t.upper() for t in bad]
    rows = [(i, t, "ru" if i < 140 else "en") for i, t in enumerate([*good, *bad, *latin])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(200) if i < 120 and i % 60 < 40 or i >= 140], "doc_id bigint, quality int")
    kept = {r["id"] for r in ngrams.classify(frame, labels).where("kept").collect()}
    assert not kept & set(range(120, 140))
    assert len(kept & {i for i in range(120) if i % 60 >= 40}) >= 30  # texts the model has not seen


def _plain_kneser_ney(trusted, of):
    """The probability of a symbol after the symbols before it, by the textbook; ``of``: a text's symbols."""
    start = (0,) * (ngrams.ORDER - 1)
    counts = Counter()
    for text in trusted:
        s = (*start, *of(text))
        counts.update(s[i - ngrams.ORDER + 1 : i + 1] for i in range(ngrams.ORDER - 1, len(s)))
    levels = []
    for _ in range(ngrams.ORDER):
        n = Counter(counts.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0.5
        cut = [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k - 0.05) if n[k] and n[k + 1] else 0.5 * k for k in (1, 2, 3)]
        total, lost = Counter(), Counter()
        for gram, k in counts.items():
            total[gram[:-1]] += k
            lost[gram[:-1]] += cut[min(k, 3) - 1]
        levels.insert(0, (counts, cut, total, lost))
        counts = Counter(gram[1:] for gram in counts)

    def probability(gram):
        p = 1 / ngrams.SYMBOLS
        for order, (counts, cut, total, lost) in enumerate(levels, 1):
            own = gram[len(gram) - order :]
            k = counts[own]
            if total[own[:-1]]:
                p = ((k - cut[min(k, 3) - 1]) / total[own[:-1]] if k else 0) + lost[own[:-1]] / total[own[:-1]] * p
        return p

    def perplexity(text):
        s = (*start, *of(text))
        grams = [s[i - ngrams.ORDER + 1 : i + 1] for i in range(ngrams.ORDER - 1, len(s))]
        return np.exp(-sum(np.log(probability(gram)) for gram in grams) / len(text))

    return perplexity


def test_perplexities_of_groups_against_a_plain_model(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "GROUP_BYTES", 500)  # several groups, some in one task
    monkeypatch.setattr(ngrams, "_AT_ONCE", 100)
    rng = random.Random(9)
    texts = [" ".join(rng.choices([*WORDS, "Zoë", "你好"], k=20)) for _ in range(40)] + ["xbcdy" * 9, "zbcdw" * 9]
    others = ["xbcdy" * 4, "xbcdw" * 4, "qq", "\U0001f600 unseen", texts[0], texts[0], "", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *others])], "i int, text string")
    classes = ngrams.alphabet(frame)
    held = spark.sparkContext.broadcast(classes)
    orders = ngrams.kneser_ney(ngrams.ngram_counts(frame.where(f"i < {len(texts)}").select("text"), held))
    got = [r[1] for r in sorted(ngrams.perplexities(frame, held, orders).collect(), key=lambda r: r[0])]
    plain = _plain_kneser_ney(texts, lambda text: ngrams.symbols_of(text, classes).tolist())
    assert got[-2:] == [None, None]
    assert np.allclose(got[:-2], [plain(t) for t in [*texts, *others[:-2]]], rtol=1e-4)
    assert got[len(texts) + 1] > 1.5 * got[len(texts)]  # what follows "bcd" is told by the symbol before it
    assert all(parts[name].count() for parts in orders for name in ("own", "weights"))  # tables, whatever their size


def test_cells_need_no_second_row(spark):
    frame = spark.createDataFrame([(b"c", b"n", b"p", 5)], "cell binary, node binary, payload binary, weight bigint")
    assert cells.cell_links(frame, jaccard.jaccard_links(90), 1).count() == 0
