import datetime as dt
import json

import pytest

from docsettle.functions.expressions import NamedExpression, resolve_positions
from docsettle.plans.platforms import shipped_platforms
from docsettle.sources.config import (
    ExportConfig,
    ImportConfig,
    PlatformConfig,
    RelativeRange,
    configured_platforms,
    load_platforms,
    load_versions,
    platforms_from_json,
    to_json,
)
from docsettle.sources.ranges import Cell, Range


def test_cells_and_ranges():
    assert Cell.parse("AR") == Cell("AR", 0)
    assert Cell.parse("B17") == Cell("B", 17)
    assert Cell("AR").column_no == 44
    window = Range.parse("A3:AR")
    assert (window.first_row, window.last_row, window.width) == (3, None, 44)
    assert str(window) == "A3:AR"
    assert str(window.starting_at(9)) == "A9:AR"
    assert Range.parse("B11:C16").last_row == 16
    assert Range.parse("B11:C16").column_names == ["c1", "c2"]


@pytest.mark.parametrize("text", ["", "A1", "A1:B2:C3"])
def test_bad_ranges(text):
    with pytest.raises(ValueError):
        Range.parse(text)


@pytest.mark.parametrize("text", ["1A", "A1B", "A1B2"])
def test_bad_cells(text):
    with pytest.raises(ValueError):
        Cell.parse(text)


def test_lower_case_columns_are_not_columns():
    with pytest.raises(ValueError):
        _ = Range.parse("a1:b2").width


def test_table_names():
    assert ImportConfig(sheet="All Orders", range="A2:AL").table_for("Foo-Bar") == (
        "payout_foo-bar_All_Orders_A2_AL"
    )
    assert ImportConfig("named").table_for("x") == "named"


def test_options_only_hold_what_is_set():
    assert ImportConfig("t", "S", "A1:B", header=False).options() == {
        "header": False,
        "sheet": "S",
        "range": "A1:B",
    }
    assert ImportConfig("t").options() == {}
    assert ImportConfig("t").has_header
    assert not ImportConfig("t", header=False).has_header


def test_method_without_regard_to_case():
    assert PlatformConfig("LibreOffice").uses_row_service
    assert not PlatformConfig("duckdb").uses_row_service
    assert not PlatformConfig().uses_row_service


def test_relative_import_must_point_back():
    forward = ImportConfig("t", "S", relative_range=RelativeRange(1, 3))
    with pytest.raises(ValueError):
        PlatformConfig("", (ImportConfig("u", "S", "A1:B"), forward)).validate()


def test_chained_relative_import_takes_over_the_columns():
    first = ImportConfig("t", "S", "B5:H")
    chain = [ImportConfig("t", "S", relative_range=RelativeRange(n, 3)) for n in (1, 2)]
    config = PlatformConfig("", (ImportConfig("u", "S", "A1:B"), first, *chain)).validate()
    assert str(config.window(3)) == "B5:H"


def test_positions():
    columns = ["document_id", "Order date", "a`b"]
    assert resolve_positions("min(#2) || '#2' || `#3`", columns) == "min(`Order date`) || '#2' || `#3`"
    assert resolve_positions("sum(#3)", columns) == "sum(`a``b`)"
    with pytest.raises(ValueError):
        resolve_positions("#4", columns)


RAW = {
    "platforms": {
        "p": {
            "method": "libreoffice",
            "import_configs": [
                {"table_name": "t", "sheet": "S", "range": "A1:B", "footer": True},
                {"table_name": "t", "range": "A5:B"},
                {"relative_range": {"relative_config_index": 1, "rows_offset": 2}},
            ],
            "export_configs": [
                {"table_name": "t", "reader_configs": [{"column_name": "X", "expression": "1"}]},
                {"table_name": "t"},
            ],
        },
        "untagged": {},
    }
}


def test_platforms_from_a_file(spark, tmp_path):
    path = tmp_path / "platforms.json"
    path.write_text(json.dumps(RAW))
    platforms = load_platforms(spark, str(path))
    assert platforms == platforms_from_json(json.dumps(RAW))
    config = platforms["p"]
    assert config.uses_row_service
    assert config.import_configs[0].footer is True
    assert config.import_configs[2].is_relative
    assert config.export_configs[0].reader_configs[0].expression == "1"
    assert config.export_configs[1].reader_configs == ()
    assert load_platforms(spark, None) == {}
    tags = spark.createDataFrame([(7, "p"), (8, "P"), (9, "other")], "id int, name string")
    assert configured_platforms(platforms, tags) == {7: "p"}


def test_shipped_platforms():
    platforms = shipped_platforms(2024)
    assert set(platforms) == {"swiggy", "zomato", "swiggy-dineout"}
    imports = [one for config in platforms.values() for one in config.import_configs]
    exports = [one for config in platforms.values() for one in config.export_configs]
    assert len(imports) == 8
    assert len(exports) == 7
    assert sum(len(one.reader_configs) for one in exports) == 31


def test_versions_from_files(spark, tmp_path):
    early, late = tmp_path / "a", tmp_path / "b"
    early.mkdir(), late.mkdir()
    one = PlatformConfig("", (ImportConfig("t", "S", "A1:B", footer=True),), (ExportConfig("t", (NamedExpression("x", "count(1)"),)),))
    (early / "v.json").write_text(to_json({"p": one}, dt.date(2024, 1, 1)))
    (late / "w.json").write_text(to_json({"p": one, "q": PlatformConfig("libreoffice")}))
    found = load_versions(spark, str(tmp_path))
    assert found.starts == (None, dt.date(2024, 1, 1)) and found.platforms == ({"p": one, "q": PlatformConfig("libreoffice")}, {"p": one})
    days = spark.createDataFrame([(dt.date(2023, 5, 1),), (dt.date(2024, 1, 1),), (None,)], "day date")
    assert [r[0] for r in days.select(found.number(days["day"])).collect()] == [0, 1, 0]


@pytest.mark.parametrize(
    "text",
    [
        '{"platforms": {"p": {"metod": ""}}}',
        '{"platforms": {"p": {"import_configs": [{"sheets": "S"}]}}}',
        '{"platforms": {"p": {"import_configs": [{"relative_range": {"index": 1}}]}}}',
        '{"platforms": {"p": {"export_configs": [{"table_name": "t", "reader_configs": [{"column_name": "x", "expression": "1"}]}]}}}',
        '{"platforms": {}, "valid": "2024-01-01"}',
        '{"platforms": {}, "valid_from": "soon"}',
    ],
)
def test_faulty_versions_are_refused(spark, tmp_path, text):
    (tmp_path / "v.json").write_text(text)
    with pytest.raises(ValueError):
        load_versions(spark, str(tmp_path))


def test_two_versions_of_one_day(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text('{"platforms": {}, "valid_from": "2024-01-01"}')
    with pytest.raises(ValueError, match="same day"):
        load_versions(spark, str(tmp_path))
