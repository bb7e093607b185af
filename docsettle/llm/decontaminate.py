"""Benchmark passages in training texts, found by a suffix automaton over all items.

The automaton holds every run of words of every item, in a number of states bounded by twice
the items' words. Items of more than ``MAX_ITEM_WORDS`` words are cut into blocks of at most so
many, an automaton each, small enough to travel with each task. A text is
streamed through a block's automaton once; the state tells the longest run that ends at each word.
Several blocks scan in turn, each a job of its own, and what they find is merged by row. The driver and a task hold one automaton
and one batch of texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsettle.llm.components import batch_bytes
from docsettle.session import staged

WINDOW = 13
MAX_ITEM_WORDS = 100_000  # an automaton of so many words takes about 76 MB in the process that holds it

# bytes of words as they are, in lower case; all others blank. Bytes above 0x7F belong to words.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 0x20
    for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton of word sequences, with what each state reports.

    ``size`` is the window; an item of fewer words is one window as a whole.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], size: int = WINDOW) -> None:
        self.size = size
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names: list[str] = []
        ends: list[list[int]] = []
        for name, words in items:
            if words:
                self.names.append(name)
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
                last, path = 0, []
                for c in ids:
                    last = self._extend(last, c)
                    path.append(last)
                ends.append(ids)
        self.shortest = min([size, *(len(x) for x in ends)])
        self._mark(ends)

    def _extend(self, last: int, c: int) -> int:
        nexts, link, length = self.next, self.link, self.length
        q = nexts[last].get(c)
        if q is not None and length[q] == length[last] + 1:
            return q
        if q is None:
            cur = len(nexts)
            nexts.append({}), link.append(0), length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in nexts[p]:
                nexts[p][c] = cur
                p = link[p]
            if p < 0:
                return cur
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
                return cur
            link[cur] = self._clone(p, q, c)
            return cur
        return self._clone(last, q, c)

    def _clone(self, p: int, q: int, c: int) -> int:
        nexts, link, length = self.next, self.link, self.length
        copy = len(nexts)
        nexts.append(dict(nexts[q])), link.append(link[q]), length.append(length[p] + 1)
        link[q] = copy
        while p >= 0 and nexts[p].get(c) == q:
            nexts[p][c] = copy
            p = link[p]
        return copy

    def _mark(self, items: list[list[int]]) -> None:
        """Per state: the window-long run's items, and the short items that end there."""
        whole: dict[int, set[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        for item, ids in enumerate(items):
            state, n = 0, 0
            for c in ids:
                state, n = self.step(state, n, c)
                if n >= self.size:
                    whole.setdefault(self.at(state), set()).add(item)
            if len(ids) < self.size:
                self.short.setdefault(state, []).append((len(ids), item))
        self.whole = {s: tuple(sorted(found)) for s, found in whole.items()}
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        self.above = [0] * len(self.next)  # the nearest state by suffix links, itself included, where a short item ends
        for s in order:
            self.above[s] = s if s in self.short else self.above[self.link[s]]
        # the state that stands for the window-long suffix of a state's runs, itself included
        self.window_state = [self.at(s) if self.length[s] >= self.size else 0 for s in range(len(self.next))]

    def at(self, state: int) -> int:
        while self.length[self.link[state]] >= self.size:
            state = self.link[state]
        return state

    def step(self, state: int, n: int, c: int) -> tuple[int, int]:
        nexts = self.next
        while state and c not in nexts[state]:
            state = self.link[state]
            n = self.length[state]
        state = nexts[state].get(c, 0)
        return (state, n + 1) if state else (0, 0)

    def hits(self, texts: list[bytes | None]) -> list[tuple[list[tuple[int, int]], set[str]]]:
        """Spans and names of items of each text."""
        found = (self.scan(words_of(text)) for text in texts)
        return [(spans, {self.names[k] for k in items}) for spans, items in found]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged word spans inside windows, and the items whose windows occur."""
        if len(words) < self.shortest or not self.names:
            return [], set()
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))
        blank = np.concatenate(([-1], (ids == 0).nonzero()[0], [len(ids)]))
        long = (np.diff(blank) - 1 >= self.shortest).nonzero()[0]  # an unknown word ends every match
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for k in long:
            begin, end = int(blank[k]) + 1, int(blank[k + 1])
            state = n = 0
            for i, c in enumerate(ids[begin:end].tolist(), begin):
                state, n = self.step(state, n, c)
                reach = 0
                if n >= self.size:
                    reach = self.size
                    items.update(self.whole[self.window_state[state]])
                s = self.above[state]
                while s:
                    for size, item in self.short[s]:
                        if size <= n:
                            items.add(item)
                            reach = max(reach, size)
                    s = self.above[self.link[s]]
                if reach:
                    start = i + 1 - reach
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, i + 1))
        return spans, items


def item_blocks(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", words: int | None = None, size: int = WINDOW
) -> Iterator[list]:
    """Items with their words, in blocks of at most ``words`` words (``MAX_ITEM_WORDS``).

    A longer item is several, which overlap so that none of its windows is lost. Items come to the driver a partition
    at a time, and one block of them is held.
    """
    words = max(words or MAX_ITEM_WORDS, size)
    items = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))
    rows = items.where("t IS NOT NULL AND i IS NOT NULL").distinct().orderBy("i", "t")
    block, held = [], 0
    for row in rows.toLocalIterator():
        whole = words_of(row["t"].encode())
        for begin in range(0, max(len(whole) - size, 0) + 1, words - size + 1):
            own = whole[begin : begin + words]
            if block and held + len(own) > words:
                yield block
                block, held = [], 0
            if own:
                block.append((row["i"], own))
                held += len(own)
    yield block


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and out[-1][1] >= begin:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _word_bounds(text: bytes) -> list[tuple[int, int]]:
    return [m.span() for m in re.finditer(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(_FOLD))]


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans, given as word positions, and the blanks that follow them."""
    bounds = _word_bounds(text)
    parts, at = [], 0
    for first, end in spans:
        parts.append(text[at : bounds[first][0]])
        at = bounds[end][0] if end < len(bounds) else len(text)
    return b"".join([*parts, text[at:]])


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
    size: int = WINDOW,
    max_coverage: float = 0.05,
    max_span: int | None = None,
    with_text: bool = True,
    block_words: int | None = None,
) -> DataFrame:
    """What of each text is in the benchmark, one row per input row.

    Returns the ``carry`` columns, then ``n_words``, ``n_hit`` (words inside an occurrence of a
    window: ``size`` consecutive words of an item, or a shorter item as a whole), ``n_items``,
    ``items_sha256`` (of the ids of the items that occur, sorted and joined by commas),
    ``contaminated`` (hit words are ``max_coverage`` of all, or more), ``spans`` (word positions,
    end exclusive) and ``clean_text``: null where contaminated, else the text without spans of
    ``max_span`` words or more (None: spans stay). ``with_text`` False leaves the text out.

    A null or empty text has no words and is not contaminated. Items without words, null items
    and null item ids match nothing; equal texts under several ids are several items; an id with
    several texts, or repeated, counts once. An empty benchmark leaves all as it is. Columns outside
    ``carry`` are not read. ``block_words`` bounds the words of one automaton's items; where there are several
    automata, the carried columns and texts are staged once, with a number for each row.
    """
    context = documents.sparkSession.sparkContext
    blocks = item_blocks(benchmark, words=block_words, size=size)
    block, following = next(blocks), next(blocks, None)
    parts = round(max_coverage * 10_000)
    names = [f"c{i}" for i in range(len(carry))]
    keep = documents.select(*(F.col(c).alias(n) for c, n in zip(carry, names, strict=True)), F.col(text_col).cast("string").alias("t"))
    kinds = ", ".join(f"{n} {keep.schema[n].dataType.simpleString()}" for n in names)

    def report(texts: list[bytes | None], hits: list[tuple[list, set]]) -> list[pa.Array]:
        out: dict[str, list] = {n: [] for n in ("w", "h", "i", "s", "bad", "spans", "clean")}
        for (spans, items), text in zip(hits, texts, strict=True):
            count = len(words_of(text))
            spans = merged_spans(spans)
            hit = sum(end - begin for begin, end in spans)
            bad = hit > 0 and 10_000 * hit >= parts * count
            found = sorted(items)
            out["w"].append(count), out["h"].append(hit), out["i"].append(len(found))
            out["s"].append(hashlib.sha256(",".join(found).encode()).hexdigest())
            out["bad"].append(bad)
            out["spans"].append([{"first": a, "end": b} for a, b in spans])
            cut = [x for x in spans if max_span is not None and x[1] - x[0] >= max_span]
            clean = without_spans(text, cut) if cut else text
            out["clean"].append(clean.decode() if with_text and text is not None and not bad else None)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), _SPANS, pa.string()]
        return [pa.array(v, k) for v, k in zip(out.values(), types, strict=True)]

    reported = f"{kinds}, w long, h long, i long, s string, bad boolean, {SPANS}, clean string"
    columns = [*names, "w", "h", "i", "s", "bad", "spans", "clean"]
    if following is None:
        shared = context.broadcast(Automaton(block, size))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch_bytes(batch.column(batch.num_columns - 1))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *report(texts, shared.value.hits(texts))], columns)

        found = keep.mapInArrow(scan, reported)
    else:
        numbered = staged(keep.withColumn("row", F.monotonically_increasing_id()), "numbered")
        hits = None
        while block is not None:  # one automaton on the driver and in the tasks at a time
            part = _block_hits(numbered, Automaton(block, size))
            hits = part if hits is None else hits.union(part)
            block, following = following, next(blocks, None) if following is not None else None
        merged = hits.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
        joined = numbered.join(merged, "row", "left").select(*names, "spans", "items", "t")

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch_bytes(batch.column(batch.num_columns - 1))
                spans, items = (batch.column(batch.num_columns - k).to_pylist() for k in (3, 2))
                own = [([(x["first"], x["end"]) for x in s or []], set(i or [])) for s, i in zip(spans, items, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *report(texts, own)], columns)

        found = joined.mapInArrow(gather, reported)
    return found.select(
        *(F.col(n).alias(c) for c, n in zip(carry, names, strict=True)),
        F.col("w").alias("n_words"),
        F.col("h").alias("n_hit"),
        F.col("i").alias("n_items"),
        F.col("s").alias("items_sha256"),
        F.col("bad").alias("contaminated"),
        "spans",
        *([F.col("clean").alias("clean_text")] if with_text else []),
    )


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
SPANS = "spans array<struct<first: long, end: long>>"


def _block_hits(numbered: DataFrame, automaton: Automaton) -> DataFrame:
    """``row, spans, items`` of the rows in which one block's items occur, as a table of the shared folder."""
    shared = numbered.sparkSession.sparkContext.broadcast(automaton)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = shared.value.hits(batch_bytes(batch.column(1)))
            at = [k for k, (spans, _) in enumerate(hits) if spans]
            spans = [[{"first": a, "end": b} for a, b in hits[k][0]] for k in at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(spans, _SPANS), pa.array([sorted(hits[k][1]) for k in at], pa.list_(pa.string()))],
                ["row", "spans", "items"],
            )

    found = staged(numbered.select("row", "t").mapInArrow(scan, f"row long, {SPANS}, items array<string>"), "hits")
    shared.destroy()
    return found
