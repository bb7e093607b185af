"""Main text of web pages: page differencing between neighbours by URL, beside the page's own marks.

A page is cut into blocks. Blocks in menus, headers, footers, side columns, notices, adverts,
forms and comments, by element or by class, id and role, are no content. Each page is paired
with the page of the same host whose path is nearest in order, the blocks of the two are aligned
by a longest common subsequence, and shared blocks are deleted, for they belong to the site.
Blocks inside an article element are the page's own by its author's word: they stay
even when a neighbour shares them. In a main element, or in pages without either, differencing decides.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsettle.session import staged

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|title|textarea|select|button|object|canvas|math)\b"
    r"(?:[^<>\"']|\"[^\"]*\"|'[^']*')*(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
_MARK = re.compile(r"\b(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"\bhidden(?![\w-])|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_SPACE = re.compile(r"\s+")

_OUT = frozenset("nav header footer aside form menu dialog fieldset".split())
_MAIN = frozenset("article main".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_OUT_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget footer notice cookie cookies consent "
    "banner ad ads advert adverts advertisement advertising adsense promo promotion sponsor sponsored comment "
    "comments reply replies respond disqus share sharing social related recommended newsletter subscribe "
    "subscription signup login popup modal overlay masthead copyright skip pagination pager toolbar topbar alert "
    "contentinfo complementary search gdpr disclaimer feedback discussion".split()
)
_COMMENT_WORDS = frozenset("comment comments reply replies discussion ad ads advert advertisement sponsored promo".split())


@dataclass(frozen=True)
class Block:
    text: str
    in_main: bool
    in_article: bool
    is_links: bool  # all of its text is link text


def _marked(attributes: str) -> set[str]:
    words: set[str] = set()
    for m in _MARK.finditer(attributes):
        words.update(w.lower() for w in _WORD.findall(m[2] or m[3] or m[4] or ""))
    return words


def _is_out(tag: str, attributes: str, in_main: bool) -> bool:
    if tag in ("html", "body", "main"):
        return False
    if tag in _OUT:
        return tag != "header" or not in_main
    if not attributes:
        return False
    if _HIDDEN.search(attributes):
        return True
    words = _marked(attributes)
    if tag == "article":
        return bool(words & _COMMENT_WORDS)
    return bool(words & _OUT_WORDS) or (not in_main and "header" in words)


def _end_of(tokens: list[re.Match], at: int, tag: str) -> tuple[int, bool]:
    """Index after the element that starts at a token, and whether it holds a main element.

    An element that is never closed ends before the next main element, or with the page.
    """
    depth, first_main = 0, None
    for k in range(at, len(tokens)):
        name = (tokens[k][3] or "").lower()
        if name in _MAIN and k > at and first_main is None and not tokens[k][2]:
            if not _is_out(name, tokens[k][4], False):
                first_main = k
        if name == tag:
            depth += -1 if tokens[k][2] else 1
            if depth == 0:
                return k + 1, first_main is not None
    return (first_main, False) if first_main is not None else (len(tokens), False)


def blocks_of(page: str | None) -> list[Block]:
    """Blocks of a page's text, without those in elements that hold no content."""
    page = page or ""
    tokens = list(_TOKEN.finditer(page))
    out: list[Block] = []
    run: list[str] = []
    linked = plain = False
    main = article = links = 0

    def close() -> None:
        nonlocal linked, plain
        text = _SPACE.sub(" ", html.unescape("".join(run))).strip()
        if text:
            out.append(Block(text, main > 0, article > 0, linked and not plain))
        run.clear()
        linked = plain = False

    def add(text: str) -> None:
        nonlocal linked, plain
        if text:
            run.append(text)
            if not text.isspace():
                linked |= links > 0
                plain |= links == 0

    at, k = 0, 0
    while k < len(tokens):
        token = tokens[k]
        add(page[at : token.start()])
        at, k = token.end(), k + 1
        name = (token[3] or "").lower()
        if not name:
            continue
        if name not in _INLINE:
            close()
        if token[2]:
            if name in _MAIN:
                main = max(0, main - 1)
                article = max(0, article - (name == "article"))
            elif name == "a":
                links = max(0, links - 1)
            continue
        if name in _VOID or token[4].endswith("/"):
            continue
        if _is_out(name, token[4], main > 0):
            end, holds_main = _end_of(tokens, k - 1, name)
            if not holds_main:
                at = tokens[end].start() if end < len(tokens) and not tokens[end - 1][2] else tokens[end - 1].end()
                if end == len(tokens) and not (tokens[end - 1][2] and tokens[end - 1][3].lower() == name):
                    at = len(page)
                k = end
                continue
        if name in _MAIN:
            main += 1
            article += name == "article"
        elif name == "a":
            links += 1
    add(page[at:])
    close()
    return out


def _row_lengths(a: list, b: list) -> list[int]:
    """Bit vectors of the rows of the LCS matrix; row i's zero bits below j count its length at j."""
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v, rows = full, []
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    return rows


def shared_lines(a: list[str], b: list[str]) -> set[int]:
    """Positions in ``a`` of one longest common subsequence with ``b``."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = {*range(head), *range(len(a) - tail, len(a))}
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    known = set(y)
    kept = [i for i, line in enumerate(x) if line in known]  # others match nothing
    x = [x[i] for i in kept]
    known = set(x)
    y = [line for line in y if line in known]
    return found | {head + kept[i] for i in _common(x, y)}


def _common(a: list[str], b: list[str], most_bits: int = 1 << 30) -> set[int]:
    if not a or not b:
        return set()
    if len(a) * len(b) > most_bits and len(a) > 1:  # halve the longer side, where the two halves' lengths are best
        half = len(a) // 2
        front, back = _row_lengths(a[:half], b)[-1], _row_lengths(a[half:][::-1], b[::-1])[-1]
        ahead, behind, best = 0, len(b) - back.bit_count(), (-1, 0)
        for j in range(len(b) + 1):
            best = max(best, (ahead + behind, -j))
            if j < len(b):
                ahead += not front >> j & 1
                behind -= not back >> (len(b) - 1 - j) & 1
        cut = -best[1]
        return _common(a[:half], b[:cut], most_bits) | {half + i for i in _common(a[half:], b[cut:], most_bits)}
    rows = _row_lengths(a, b)

    def length(i: int, j: int) -> int:
        return j - (rows[i - 1] & ((1 << j) - 1)).bit_count() if i else 0

    found, i, j = set(), len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            found.add(i)
        elif length(i - 1, j) >= length(i, j - 1):
            i -= 1
        else:
            j -= 1
    return found


def main_text(own: list[Block], deleted: set[int]) -> str:
    """The article of a page, given the blocks that it shares with a neighbour.

    What stands in an article element is the article. Elsewhere shared blocks go: within main elements if there are
    any, else in the whole page, where blocks of links alone go too.
    """
    marked = any(b.in_main for b in own)
    kept = [
        b.text
        for i, b in enumerate(own)
        if (b.in_main and (b.in_article or i not in deleted) if marked else i not in deleted and not b.is_links)
    ]
    return " ".join(kept)


#: A page is a near copy of another one that has nine tenths of its lines.
NEARLY_ALL = 9
Beside = tuple[str, list[int]]  # path and lines of a page


def difference(lines: list[int], path: str, before: Beside | None, after: Beside | None) -> list[int]:
    """Positions of a page's lines that it shares with its neighbour: the one of the two that has more of its path in common.

    On a tie the one that shares more lines counts, then the one before. A neighbour that has nearly all of the lines
    is a near copy and tells nothing about them; then the other one counts.
    """
    found = []
    for place, other in enumerate((before, after)):
        if other is not None:
            shared = shared_lines(lines, other[1])
            found.append((-_nearness(other[0], path), -len(shared), place, shared))
    for _, _, _, shared in sorted(found, key=lambda x: x[:3]):
        if len(shared) * 10 < len(lines) * NEARLY_ALL:
            return sorted(shared)
    return []


def _site(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; the path without query, fragment, ending and last slash."""
    rest = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), "^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return host, F.regexp_replace(path, r"(\.html?)?/*$", "")


def _nearness(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


_LINES = pa.list_(pa.int64())
_FOUND = pa.schema(
    [
        *(("k1", pa.int64()), ("k2", pa.int64()), ("deleted", pa.list_(pa.int32()))),
        *(("open", pa.int32()), ("part", pa.int32()), ("place", pa.int32()), ("host", pa.string())),
        *(("path", pa.string()), ("lines", _LINES), ("b_path", pa.string()), ("b_lines", _LINES), ("a_path", pa.string()), ("a_lines", _LINES)),
    ]
)
_FOUND_TABLE = (
    "k1 long, k2 long, deleted array<int>, open int, part int, place int, host string, path string, lines array<long>, "
    "b_path string, b_lines array<long>, a_path string, a_lines array<long>"
)


def _differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of pages (``host, path, k1, k2, lines, part``): deleted lines, pages that wait, and the range's ends.

    ``open`` tells what a page waits for: 1 the page before, 2 the page after. An end has a ``place``: 0 and 1 are the first
    pages of the first two runs of equal lines, 2 and 3 the last pages of the last two.
    """
    out: list[dict] = []
    run: list[tuple] = []
    runs = 0
    before: Beside | None = None
    earlier: tuple | None = None  # last page of the run before

    def place(number: int, page: tuple) -> None:
        out.append({"place": number, "part": page[5], "host": page[0], "path": page[1], "lines": page[4]})

    def settle(after: Beside | None, last: bool) -> None:
        waits = (runs == 1) + 2 * last
        lines = run[0][4]
        for _, path, k1, k2, _, part in run:
            if waits:
                out.append({"k1": k1, "k2": k2, "open": waits, "part": part, "path": path, "lines": lines} | _sides(before, after))
            elif deleted := difference(lines, path, before, after):
                out.append({"k1": k1, "k2": k2, "open": 0, "part": part, "deleted": deleted})

    for batch in batches:
        for page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if run and run[0][0] == page[0] and run[0][4] == page[4]:
                run.append(page)
                continue
            if run:
                same = run[0][0] == page[0]
                settle((page[1], page[4]) if same else None, False)
                earlier = run[-1]
                before = (earlier[1], earlier[4]) if same else None
            run = [page]
            runs += 1
            if runs <= 2:
                place(runs - 1, page)
        if len(out) >= 1_000:
            yield pa.RecordBatch.from_pylist(out, _FOUND)
            out.clear()
    if run:
        settle(None, True)
        place(3, run[-1])
        if earlier is not None:
            place(2, earlier)
    yield pa.RecordBatch.from_pylist(out, _FOUND)


def _sides(before: Beside | None, after: Beside | None) -> dict:
    known = {"b": before, "a": after}
    return {f"{k}_{n}": v for k, side in known.items() if side is not None for n, v in zip(("path", "lines"), side, strict=True)}


def _across(ends: list[dict[int, tuple]], at: int, ways: range, near: int, beyond: int, own: int) -> Beside | None:
    """The next page of other lines on the host of an end of range ``at``, in the ranges ``ways``."""
    host, _, lines = ends[at][own]
    for k in ways:
        page = ends[k][near]
        if page[0] == host and page[2] == lines:  # the same run goes on
            if beyond not in ends[k]:
                continue
            page = ends[k][beyond]
        return (page[1], page[2]) if page[0] == host else None
    return None


def differences(ordered: DataFrame) -> DataFrame:
    """``k1, k2, deleted`` of the pages (``host, path, k1, k2, lines``, sorted in ranges) that share lines with a neighbour.

    Neighbours of a page are the nearest ones before and after it on its host whose lines differ from its own, so copies have the
    same ones. Pages whose neighbour lies in another range wait: the four ends of each range, which are few rows for the driver,
    tell them. Nothing depends on where ranges begin.
    """
    found = staged(ordered.withColumn("part", F.spark_partition_id()).mapInArrow(_differ, _FOUND_TABLE), "differences")
    rows = found.where("place IS NOT NULL").select("part", "place", "host", "path", "lines").collect()
    by_part: dict[int, dict[int, tuple]] = {}
    for r in rows:
        by_part.setdefault(r["part"], {})[r["place"]] = (r["host"], r["path"], r["lines"])
    parts = sorted(by_part)
    ends = [by_part[k] for k in parts]
    context = []
    for at, part in enumerate(parts):
        before = _across(ends, at, range(at - 1, -1, -1), 3, 2, 0)
        after = _across(ends, at, range(at + 1, len(parts)), 0, 1, 3)
        context.append((part, *(before or (None, None)), *(after or (None, None))))
    schema = "part int, from_path string, from_lines array<long>, to_path string, to_lines array<long>"
    known = ordered.sparkSession.createDataFrame(context, schema)  # one row per range

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                beside = []
                for own, far, bit in (("b", "from", 1), ("a", "to", 2)):
                    side = far if r["open"] & bit else own
                    path, lines = r[f"{side}_path"], r[f"{side}_lines"]
                    beside.append(None if path is None else (path, lines))
                if deleted := difference(r["lines"], r["path"], *beside):
                    out.append({"k1": r["k1"], "k2": r["k2"], "deleted": deleted})
            yield pa.RecordBatch.from_pylist(out, pa.schema([_FOUND.field(k) for k in range(3)]))

    waiting = found.where("open > 0").drop("deleted", "place", "host").join(F.broadcast(known), "part")
    settled = waiting.mapInArrow(settle, "k1 long, k2 long, deleted array<int>")
    return found.where("open = 0").select("k1", "k2", "deleted").union(settled)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, text, n_chars``, one row per input row; ``text`` is empty where there is no article.

    Pages are put in order of host and path, by hashes of their blocks; a page's neighbour is the nearest page before or after it on
    its host that has other blocks, the one that shares more of its path (on a tie, more blocks). If that is a
    near copy, the other one counts. A page without such a neighbour keeps its blocks. Texts are cut where the pages lie, and only what is
    deleted is joined to them. A null html is an empty page; pages with a null or empty url are one host. Repeated
    rows and copies have the same neighbours.
    """
    url, page = F.col(url_col).cast("string"), F.col(html_col).cast("string")
    host, path = _site(url)
    first = F.xxhash64(F.col(id_col), F.col(url_col), page).alias("k1")
    second = F.xxhash64(F.lit(1), F.col(id_col), F.col(url_col), page).alias("k2")
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [[xxhash.xxh3_64_intdigest(b.text) - (1 << 63) for b in blocks_of(p)] for p in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(lines, _LINES)], ["host", "path", "k1", "k2", "lines"])

    light = pages.select(host.alias("host"), path.alias("path"), first, second, page.alias("html"))
    light = light.mapInArrow(hashed, "host string, path string, k1 long, k2 long, lines array<long>")
    order = ("host", "path", "k1", "k2")
    deleted = differences(light.repartitionByRange(parts, *order).sortWithinPartitions(*order)).dropDuplicates(["k1", "k2"])
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), page.alias("html"), first, second)
    joined = rows.join(staged(deleted, "deleted"), ["k1", "k2"], "left").select("id", "url", "html", "deleted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            texts = [main_text(blocks_of(p), set(gone or [])) for p, gone in both]
            lengths = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string()), lengths], ["id", "url", "text", "n_chars"])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", "url")]
    return joined.mapInArrow(cut, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
