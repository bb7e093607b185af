import random

import pytest
from pyspark.sql import functions as F

from docsettle.operators import blocks, landing, ranges
from docsettle.sources.config import ImportConfig, PlatformConfig, RelativeRange
from docsettle.sources.ranges import Range

SCHEMA = "document_id bigint, sheet string, row_no bigint, vals array<string>"


def sheet(spark, rows):
    return spark.createDataFrame([(d, s, r, v) for d, s, r, v in rows], SCHEMA)


def land(rows, config, position, target=None):
    documents = rows.select("document_id").distinct()
    landed = landing.land_block(documents, rows, config, position, target)
    return [tuple(row) for row in landed.orderBy("document_id", "row_no").collect()], landed.columns


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(blocks, "BITS", 2)
    monkeypatch.setattr(blocks, "SIZE", 4)
    monkeypatch.setattr(ranges, "JOIN_BLOCK_BITS", 3)


def test_slice_and_cells(spark):
    cells = spark.createDataFrame(
        [(1, "S", 2, 1, "a"), (1, "S", 2, 3, "c"), (1, "S", 3, 2, "b"), (1, "T", 2, 1, "x")],
        "document_id bigint, sheet string, row_no bigint, col_no int, value string",
    )
    rows = ranges.assemble_rows(cells)
    cut = ranges.slice_range(rows, "S", Range.parse("B1:D2")).collect()
    assert [tuple(row) for row in cut] == [(1, 2, None, "c", None)]


def expected_bounds(present, config):
    """First, last and end row of every import of one document, row by row; ``present`` maps rows to kinds."""
    firsts, ends, out = {}, {}, {}
    for position, one in enumerate(config.import_configs):
        window = config.window(position)
        first = window.first_row
        if one.is_relative:
            first = ends[one.relative_range.relative_config_index] + one.relative_range.rows_offset
        limit = window.last_row
        own = [r for r in present if r >= first and (limit is None or r <= limit)]
        last = None
        if config.stops_at_empty(one):
            if any(present[r] != "blank" for r in own):
                last = first - 1
                while present.get(last + 1, "blank") != "blank" and (limit is None or last < limit):
                    last += 1
        elif own:
            last = max(own)
        out[position] = None if last is None else (first, last)
        if config.uses_row_service:
            data = [r for r in own if last is not None and first + one.has_header <= r <= last and present[r] != "bad"]
            count = len(data) - (bool(one.footer) and bool(data)) + bool(one.footer) - (not one.has_header)
            ends[position] = first + max(count, 0)
        else:
            ends[position] = limit if limit is not None else max(first, first if last is None else last)
        firsts[position] = first
    return out, ends


@pytest.mark.parametrize("method", ["", "libreoffice"])
def test_bounds_of_all_imports_against_brute_force(spark, small_blocks, method):
    """Chained relative blocks, closed ends, stops at empty rows, footers, in stretches of four rows."""
    rng = random.Random(7)
    imports = (
        ImportConfig("a", "S", "A3:B", stop_at_empty=True),
        ImportConfig("b", "S", "A1:B", stop_at_empty=True, footer=True),
        ImportConfig("b", "S", relative_range=RelativeRange(1, 2), stop_at_empty=True, header=False),
        ImportConfig("b", "S", relative_range=RelativeRange(2, 3), stop_at_empty=False),
        ImportConfig("c", "S", "A4:B9", stop_at_empty=True, footer=True),
        ImportConfig("c", "S", relative_range=RelativeRange(4, 1), stop_at_empty=True),
        ImportConfig("d", "S", "A2:B6", header=False),
    )
    config = PlatformConfig(method, imports).validate()
    rows, kinds = [], {"full": ["x", None], "blank": [" ", ""], "bad": ["#REF!", "1"]}
    wanted = {}
    for document in range(80):
        present = {}
        for r in range(1, rng.choice([1, 3, 9, 30])):
            if rng.random() < 0.85:
                present[r] = rng.choices(["full", "blank", "bad"], [8, 1, 1])[0]
        rows += [(document, "S", r, kinds[k]) for r, k in present.items()]
        wanted[document] = expected_bounds(present, config)
    rows.append((100, "other", 1, ["x", "y"]))
    wanted[100] = expected_bounds({}, config)
    frame = sheet(spark, rows).repartition(3)
    documents = spark.createDataFrame([(d,) for d in wanted], "document_id bigint")
    found = blocks.SheetBlocks(documents, frame, config)
    for position in range(len(imports)):
        bounds = {r["document_id"]: (r["first_row"], r["last_row"]) for r in found.bounds(position).collect()}
        assert bounds == {d: b[position] for d, (b, _) in wanted.items() if b[position] is not None}
        ends = {r["document_id"]: r["end_row"] for r in found.ends(position).collect()}
        assert ends == {d: e[position] for d, (_, e) in wanted.items()}
    assert len(found._stretches) == 1  # the sheet has been read once


def test_a_block_over_many_join_blocks(spark, small_blocks):
    """One document with nearly all rows, cut at its first empty row."""
    long = [(1, "S", r, [str(r), "x"]) for r in range(1, 200) if r != 150]
    short = [(2, "S", r, [str(r), "x"]) for r in (1, 2, 3)]
    rows = sheet(spark, long + short)
    config = PlatformConfig("", (ImportConfig("t", "S", "A1:B", header=False, stop_at_empty=True),))
    found, _ = land(rows, config, 0)
    assert [(d, r) for d, r, *_ in found] == [(1, r) for r in range(1, 150)] + [(2, r) for r in (1, 2, 3)]


def test_stop_at_empty_looks_at_the_window_only(spark):
    rows = sheet(
        spark,
        [
            (1, "S", 1, ["h", "x", "k"]), (1, "S", 2, ["a", "1", "k"]), (1, "S", 3, [" ", "", "k"]),
            (1, "S", 4, ["b", "2", "k"]), (2, "S", 2, ["only", "2", "k"]),
        ],
    )
    config = PlatformConfig("", (ImportConfig("t", "S", "A1:B", stop_at_empty=True),))
    found, columns = land(rows, config, 0)
    assert columns == ["document_id", "row_no", "h", "x"]
    assert found == [(1, 2, "a", "1")]


def test_header_by_name_by_position_and_missing(spark):
    rows = sheet(
        spark,
        [
            (1, "S", 1, ["A", "B\n2"]), (1, "S", 2, ["a1", "b1"]),
            (2, "S", 1, ["b 2", "a"]), (2, "S", 2, ["b2", "a2"]),
            (3, "S", 1, ["X", "Y"]), (3, "S", 2, ["p", "q"]),
            (4, "S", 1, ["A"]), (4, "S", 2, ["only a"]),
            (5, "S", 2, ["no", "header"]),
        ],
    )
    config = PlatformConfig("", (ImportConfig("t", "S", "A1:B"),))
    found, columns = land(rows, config, 0)
    assert columns[2:] == ["A", "B 2"]
    assert found == [
        (1, 2, "a1", "b1"), (2, 2, "a2", "b2"), (3, 2, "p", "q"), (4, 2, "only a", None),
        (5, 2, "no", "header"),
    ]


def test_header_names_are_usable(spark):
    rows = sheet(spark, [(1, "S", 1, ["A", "a", "", "row_no"]), (1, "S", 2, ["1", "2", "3", "4"])])
    config = PlatformConfig("", (ImportConfig("t", "S", "A1:D"),))
    found, columns = land(rows, config, 0)
    assert columns[2:] == ["A", "a_1", "c3", "row_no_1"]
    assert found == [(1, 2, "1", "2", "3", "4")]


def test_no_range_takes_the_whole_first_sheet(spark):
    rows = spark.createDataFrame(
        [
            (1, "S", 1, 1, ["A", "B"]), (1, "S", 1, 2, ["1", "2"]), (1, "T", 2, 1, ["x", "y"]),
            (1, "S", 1, 4, ["below", "an empty row"]),
        ],
        "document_id bigint, sheet string, sheet_no int, row_no bigint, vals array<string>",
    )
    found, columns = land(rows, PlatformConfig("", (ImportConfig("t"),)), 0)
    assert (found, columns[2:]) == ([(1, 2, "1", "2")], ["A", "B"])
    whole = PlatformConfig("", (ImportConfig("t", stop_at_empty=False),))
    assert [row[1] for row in land(rows, whole, 0)[0]] == [2, 4]
    service = PlatformConfig("libreoffice", (ImportConfig("t"),))
    assert [row[1] for row in land(rows, service, 0)[0]] == [2, 4]


def stacked(first, second, header=True, offset=3, sheet_name="S", start=5):
    """Rows of two stacked blocks, the second ``offset`` rows below the first one's end."""
    rows, row = [], start
    for number, block in enumerate((first, second)):
        if header:
            rows.append((sheet_name, row, ["K", "V"]))
        body_start = row + header
        rows += [(sheet_name, body_start + n, [f"{number}{n}", v]) for n, v in enumerate(block)]
        count = len(block)
        row = row + max(count if header else count - 1, 0) + offset
    return rows


@pytest.mark.parametrize("header", [True, False])
def test_relative_ranges(spark, small_blocks, header):
    sizes = [(3, 2), (0, 2), (1, 0), (12, 9), (0, 0)]
    rows, expected = [], []
    for document, (n, m) in enumerate(sizes):
        blocks = [["v"] * n, ["w"] * m]
        rows += [(document, s, r, v) for s, r, v in stacked(*blocks, header=header)]
        rows.append((document, "other", 1, ["x"]))
        expected += [(document, "w")] * m
    imports = (
        ImportConfig("u", "other", "A1:B", header=False),
        ImportConfig("t", "S", "A5:B", header=header, stop_at_empty=True),
        ImportConfig("t", "S", relative_range=RelativeRange(1, 3), header=header, stop_at_empty=True),
    )
    config = PlatformConfig("", imports).validate()
    names = ["K", "V"]
    found, _ = land(sheet(spark, rows), config, 2, names)
    assert [(d, v) for d, _, _, v in found] == expected
    found, _ = land(sheet(spark, rows), config, 1, names)
    assert [d for d, *_ in found] == [d for d, (n, _) in enumerate(sizes) for _ in range(n)]


def test_chained_relative_ranges_and_closed_end(spark):
    body = [(r, ["h", "v"] if r in (2, 6, 10) else [f"r{r}", "v"]) for r in (2, 3, 6, 7, 10, 11, 12)]
    rows = sheet(spark, [(1, "S", r, v) for r, v in body] + [(1, "other", 1, ["x"])])
    chain = [
        ImportConfig("t", "S", relative_range=RelativeRange(n, 3), stop_at_empty=True) for n in (1, 2)
    ]
    first = ImportConfig("t", "S", "A2:B", stop_at_empty=True)
    config = PlatformConfig("", (ImportConfig("u", "other", "A1:B"), first, *chain)).validate()
    found, _ = land(rows, config, 3)
    assert [row[2] for row in found] == ["r11", "r12"]
    closed = PlatformConfig("", (ImportConfig("u", "other", "A1:B"), ImportConfig("t", "S", "A2:B3")))
    documents = rows.select("document_id").distinct()
    assert blocks.range_ends(documents, rows, closed, 1).first()["end_row"] == 3


def test_footer_after_formula_errors(spark):
    rows = sheet(
        spark,
        [
            (1, "S", 1, ["a", "1"]), (1, "S", 2, ["#REF!", "2"]), (1, "S", 3, ["x #REF!", "3"]),
            (1, "S", 4, ["total", "6"]), (1, "S", 5, ["#REF!", None]), (2, "S", 1, ["f", None]),
        ],
    )
    config = PlatformConfig("libreoffice", (ImportConfig("t", "S", "A1:B", header=False, footer=True),))
    found, _ = land(rows, config, 0)
    assert [row[2] for row in found] == ["a", "x #REF!"]
    kept, _ = land(rows, PlatformConfig("", config.import_configs), 0)
    assert [row[2] for row in kept] == ["a", "#REF!", "x #REF!", "total"]


def test_blank_rows(spark):
    frame = spark.createDataFrame([([None, "", " "],), (["a"],), ([],)], "vals array<string>")
    assert [r[0] for r in frame.select(ranges.is_blank(F.col("vals"))).collect()] == [True, False, True]


@pytest.mark.parametrize("method", ["", "libreoffice"])
@pytest.mark.parametrize("stop", [True, False])
@pytest.mark.parametrize("header", [True, False])
def test_footer_in_all_ways(spark, method, stop, header):
    rows = sheet(
        spark,
        [
            (1, "S", 1, ["A", "B"]), (1, "S", 2, ["a", "1"]), (1, "S", 3, ["b", "2"]),
            (1, "S", 4, ["sum", "3"]), (2, "S", 1, ["A", "B"]), (2, "S", 2, ["sum", "0"]),
            (3, "S", 1, ["A", "B"]),
        ],
    )
    one = ImportConfig("t", "S", "A1:B", header=header, stop_at_empty=stop, footer=True)
    found, _ = land(rows, PlatformConfig(method, (one,)), 0, ["A", "B"])
    body = [(1, 2, "a", "1"), (1, 3, "b", "2")]
    tops = [(1, 1, "A", "B"), (2, 1, "A", "B")]
    assert found == (body if header else sorted(body + tops))
