"""Platform configuration: what to import from a workbook and what to export from it."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsettle.fixed import SERVICE_METHOD
from docsettle.functions.expressions import NamedExpression
from docsettle.sources.ranges import Range


@dataclass(frozen=True)
class RelativeRange:
    """Start below an earlier import: its end row plus ``rows_offset``. Index 0 is unset."""

    relative_config_index: int = 0
    rows_offset: int = 0


@dataclass(frozen=True)
class ImportConfig:
    """One block of a sheet. Options left at None take the default of the scan."""

    table_name: str = ""
    sheet: str = ""
    range: str = ""
    relative_range: RelativeRange = field(default_factory=RelativeRange)
    header: bool | None = None
    stop_at_empty: bool | None = None
    all_varchar: bool | None = None
    footer: bool | None = None
    columns: tuple[str, ...] = ()

    @property
    def is_relative(self) -> bool:
        return self.relative_range.relative_config_index > 0

    @property
    def has_header(self) -> bool:
        return self.header is not False

    @property
    def parsed_range(self) -> Range | None:
        return Range.parse(self.range) if self.range else None

    def options(self) -> dict[str, object]:
        """The scan options that are set."""
        named = {
            "header": self.header,
            "stop_at_empty": self.stop_at_empty,
            "all_varchar": self.all_varchar,
            "sheet": self.sheet or None,
            "range": self.range or None,
        }
        return {name: value for name, value in named.items() if value is not None}

    def table_for(self, platform: str) -> str:
        if self.table_name:
            return self.table_name
        sheet, window = self.sheet.replace(" ", "_"), self.range.replace(":", "_")
        return f"payout_{platform.lower()}_{sheet}_{window}"


@dataclass(frozen=True)
class ExportConfig:
    """Named expressions over one landing table."""

    table_name: str
    reader_configs: tuple[NamedExpression, ...] = ()


@dataclass(frozen=True)
class PlatformConfig:
    method: str = ""
    import_configs: tuple[ImportConfig, ...] = ()
    export_configs: tuple[ExportConfig, ...] = ()

    @property
    def uses_row_service(self) -> bool:
        """Whether rows arrive as JSON payloads instead of workbook bytes."""
        return self.method.lower() == SERVICE_METHOD

    def validate(self) -> PlatformConfig:
        """Relative imports must point at an earlier import of known columns."""
        for position, one in enumerate(self.import_configs):
            if one.is_relative and one.relative_range.relative_config_index >= position:
                raise ValueError(f"import {position} must refer to an earlier import")
            self.window(position)
        return self

    def window(self, position: int) -> Range | None:
        """Range of an import; a relative one takes over its reference's columns."""
        one = self.import_configs[position]
        if one.is_relative:
            window = self.window(one.relative_range.relative_config_index)
            if window is None:
                raise ValueError(f"import {position} refers to an import without a range")
            return window
        return one.parsed_range

    def stops_at_empty(self, one: ImportConfig) -> bool:
        """The import's own setting; unset, a workbook scan stops only without a range."""
        if one.stop_at_empty is not None:
            return one.stop_at_empty
        return not (self.uses_row_service or one.range or one.is_relative)

    def check_exports(self, platform: str) -> None:
        """Every export must read a table that some import fills."""
        read = {one.table_name for one in self.export_configs if one.reader_configs}
        unknown = read - set(self.tables(platform))
        if unknown:
            raise ValueError(f"no import of {platform} fills {sorted(unknown)}")

    def tables(self, platform: str) -> list[str]:
        return list(dict.fromkeys(one.table_for(platform) for one in self.import_configs))


def _only(raw: Mapping, kind: type, where: str, *more: str) -> None:
    """Settings that the configuration does not know are mistakes, not decoration."""
    unknown = set(raw) - {one.name for one in fields(kind)} - set(more)
    if unknown:
        raise ValueError(f"{where} has unknown settings {sorted(unknown)}")


def check_platform(name: str, raw: Mapping) -> PlatformConfig:
    """A platform whose settings are known, whose relative imports refer to earlier ones, and whose exports read tables that it fills."""
    _only(raw, PlatformConfig, name)
    for number, one in enumerate(raw.get("import_configs") or []):
        _only(one, ImportConfig, f"import {number} of {name}")
        _only(one.get("relative_range") or {}, RelativeRange, f"the relative range of import {number} of {name}")
    for number, one in enumerate(raw.get("export_configs") or []):
        _only(one, ExportConfig, f"export {number} of {name}")
        for reader in one.get("reader_configs") or []:
            _only(reader, NamedExpression, f"a field of export {number} of {name}")
    config = platform_from_dict(raw)
    config.check_exports(name)
    return config


@dataclass(frozen=True)
class Versions:
    """Configurations in the order of the day from which they hold; the first may hold from ever."""

    starts: tuple[dt.date | None, ...]
    platforms: tuple[dict[str, PlatformConfig], ...]

    def number(self, day: Column) -> Column:
        """Which version holds on a day; null before the first. There are a few, so they go into the plan."""
        number = F.lit(None).cast("int")
        for k, start in enumerate(self.starts):
            holds = F.lit(True) if start is None else day >= F.lit(start)
            number = F.when(holds, F.lit(k)).otherwise(number)
        return number


def load_versions(spark: SparkSession, path: str) -> Versions:
    """The JSON files below a folder, each a configuration with the day it is ``valid_from``; all are checked."""
    rows = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).collect()  # one per file
    found = []
    for row in rows:
        raw = json.loads(row["value"])
        unknown = set(raw) - {"platforms", "valid_from"}
        if unknown:
            raise ValueError(f"a configuration has unknown settings {sorted(unknown)}")
        start = dt.date.fromisoformat(raw["valid_from"]) if raw.get("valid_from") else None
        found.append((start, {name: check_platform(name, one) for name, one in (raw.get("platforms") or {}).items()}))
    found.sort(key=lambda one: one[0] or dt.date.min)
    starts = tuple(start for start, _ in found)
    if len(set(starts)) < len(starts):
        raise ValueError("two configurations are valid from the same day")
    return Versions(starts, tuple(platforms for _, platforms in found))


def to_json(platforms: Mapping[str, PlatformConfig], valid_from: dt.date | None = None) -> str:
    """Platforms as the text of a configuration file."""
    head = {"valid_from": valid_from.isoformat()} if valid_from else {}
    return json.dumps({**head, "platforms": {name: asdict(one) for name, one in platforms.items()}})


def platform_from_dict(raw: Mapping) -> PlatformConfig:
    imports = []
    for one in raw.get("import_configs") or []:
        one = dict(one)
        one["relative_range"] = RelativeRange(**(one.get("relative_range") or {}))
        one["columns"] = tuple(one.get("columns") or ())
        imports.append(ImportConfig(**one))
    exports = [
        ExportConfig(
            one.get("table_name", ""),
            tuple(NamedExpression(**reader) for reader in one.get("reader_configs") or []),
        )
        for one in raw.get("export_configs") or []
    ]
    return PlatformConfig(raw.get("method", ""), tuple(imports), tuple(exports)).validate()


def load_platforms(spark: SparkSession, path: str | None) -> dict[str, PlatformConfig]:
    """Platforms of a JSON file on any file system Spark reads; no path, no platforms."""
    if not path:
        return {}
    text = spark.read.text(path, wholetext=True).first()[0]
    return platforms_from_json(text)


def platforms_from_json(text: str) -> dict[str, PlatformConfig]:
    platforms = json.loads(text).get("platforms") or {}
    return {name: platform_from_dict(raw) for name, raw in platforms.items()}


def tag_ids(tags: DataFrame, names: Iterable[str]) -> dict[str, int]:
    """Ids of the tags with exactly these names, the greatest id for a repeated name.

    The result has at most one entry per given name, so it is safe on the driver.
    """
    names = list(names)
    if not names:
        return {}
    found = tags.where(F.col("name").isin(names)).groupBy("name").agg(F.max("id").alias("id"))
    return {row["name"]: row["id"] for row in found.collect()}


def configured_platforms(
    platforms: Mapping[str, PlatformConfig], tags: DataFrame
) -> dict[int, str]:
    """Tag id to platform, for the platforms whose name is also a tag."""
    return {number: name for name, number in tag_ids(tags, platforms).items()}
