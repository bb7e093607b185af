"""Row payloads: JSON text of one block, in three envelopes, to ordered rows.

Accepted bodies, in this order: ``{"data": [{..}], "headers": [..]}``,
``{"data": [[key, value], ..]}`` and a bare ``[{..}]``. Everything is narrow: a payload
is parsed where it is read, and only its rows leave the record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsettle.fixed import FORMULA_ERROR
from docsettle.functions.scalars import clean_name
from docsettle.session import setting

_OBJECT = "map<string,string>"
_PAIR = "array<variant>"


def has_formula_error(values: Column) -> Column:
    return F.exists(values, lambda v: v.eqNullSafe(F.lit(FORMULA_ERROR)))


def _sides(entries: Column) -> Column:
    """Keys and values from last to first, so that the first hit is the last entry."""
    backwards = F.reverse(entries)
    return F.struct(
        F.transform(backwards, lambda e: e["key"]).alias("keys"),
        F.transform(backwards, lambda e: e["value"]).alias("vals"),
    )


def _value_of(keys: Column, vals: Column, name: Column) -> Column:
    return F.get(vals, F.array_position(keys, name) - 1)


def _object_sides(objects: Column) -> Column:
    empty = F.create_map().cast("map<string,string>")

    def sides(row: Column) -> Column:
        whole = F.coalesce(row, empty)
        return F.struct(
            F.transform(F.reverse(F.map_keys(whole)), clean_name).alias("keys"),
            F.reverse(F.map_values(whole)).alias("vals"),
        )

    return F.transform(objects, sides)


def _pair_entries(pairs: Column) -> Column:
    """Usable pairs: two elements, the first of them a text that is not blank."""
    usable = F.filter(
        pairs, lambda p: (F.size(p) == 2) & (F.schema_of_variant(F.get(p, F.lit(0))) == "STRING")
    )
    entries = F.transform(
        usable,
        lambda p: F.struct(
            clean_name(F.try_variant_get(F.get(p, F.lit(0)), "$", "string")).alias("key"),
            F.try_variant_get(F.get(p, F.lit(1)), "$", "string").alias("value"),
        ),
    )
    return F.filter(entries, lambda e: F.length(e["key"]) > 0)


def _fitting(items: Column, kind: str) -> Column:
    """Every element as this kind, null if one is of another; JSON nulls are let through."""
    casted = F.transform(items, lambda v: F.try_variant_get(v, "$", kind))
    odd = F.filter(items, lambda v: ~F.is_variant_null(v) & F.try_variant_get(v, "$", kind).isNull())

    def checked(found: Column) -> Column:
        return F.when(~F.exists(found, lambda c: c.isNull()) | (F.size(odd) == 0), found)

    # bound once, so that no element is cast again where all of them fit
    return F.get(F.transform(F.array(casted), checked), F.lit(0))


REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


def _with_variant(payloads: DataFrame) -> DataFrame:
    """Adds ``_v``, the body as a variant; of repeated keys the last one counts, whatever the session has set.

    The setting is read when the column is analysed, so it is only held for that.
    """
    with setting(payloads.sparkSession, REPEATED_KEYS, "true"):
        parsed = payloads.withColumn("_v", F.try_parse_json("body"))
        parsed.schema  # noqa: B018
    return parsed


def _parsed(payloads: DataFrame) -> DataFrame:
    """Adds ``objects``, ``entries`` (of pairs) and ``given`` headers, null where absent.

    The kind of the first element that is not null decides what all are read as.
    Numbers come out in their plain form, 2.50 as 2.5.
    """
    bare = F.col("body").rlike(r"^\s*\[")
    data = F.when(bare, F.try_variant_get("_v", "$", "array<variant>")).otherwise(F.try_variant_get("_v", "$.data", "array<variant>"))
    first = F.get(F.filter("_data", lambda v: ~F.is_variant_null(v)), F.lit(0))
    kind = F.when(first.isNotNull(), F.substring(F.schema_of_variant(first), 1, 5)).otherwise("")
    is_pairs = (F.col("_kind") == "ARRAY") & ~bare
    return (
        _with_variant(payloads)
        .withColumns({"_data": data, "given": F.try_variant_get("_v", "$.headers", "array<string>")})
        .withColumn("_kind", kind)
        .withColumn("objects", F.when(F.col("_kind").isin("", "OBJEC"), _fitting(F.col("_data"), _OBJECT)))
        .withColumn("_pairs", F.when(is_pairs, _fitting(F.col("_data"), _PAIR)))
        .withColumn("entries", F.when(F.col("_pairs").isNotNull(), _pair_entries(F.col("_pairs"))))
        .drop("_v", "_data", "_kind", "_pairs")
    )


def payload_blocks(payloads: DataFrame) -> DataFrame:
    """All readable payloads: the key columns, ``names`` and ``rows``.

    ``names`` are the given headers, else the keys of the first row in their order. Pairs
    make up one wide row, in which the last value of a repeated key wins. ``payloads`` has
    a ``body`` column; every other column is carried along as a key.
    """
    keys = [name for name in payloads.columns if name != "body"]
    bare = F.col("body").rlike(r"^\s*\[")
    first_row = F.when(bare, F.get_json_object("body", "$[0]")).otherwise(F.get_json_object("body", "$.data[0]"))
    row_names = F.when(F.size("given") > 0, F.col("given")).otherwise(F.json_object_keys(first_row))
    is_object = F.col("objects").isNotNull()
    names = F.when(
        is_object, F.transform(F.coalesce(row_names, F.array().cast("array<string>")), clean_name)
    ).otherwise(F.array_distinct(F.transform("entries", lambda e: e["key"])))
    wide = F.transform("names", lambda n: _value_of(F.col("_last.keys"), F.col("_last.vals"), n))
    rows = F.when(is_object, _object_sides(F.col("objects"))).when(
        F.col("entries").isNotNull(),
        F.array(F.struct(F.col("names").alias("keys"), wide.alias("vals"))),
    )
    prepared = _parsed(payloads).withColumns({"names": names, "_last": _sides(F.col("entries"))})
    return prepared.select(*keys, "names", rows.alias("rows"))


def block_rows(blocks: DataFrame) -> DataFrame:
    """One record per row, ``row_no`` and ``row``, without rows that hold a formula error."""
    rest = [name for name in blocks.columns if name != "rows"]
    present = F.coalesce("rows", F.array().cast("array<struct<keys:array<string>,vals:array<string>>>"))
    rows = blocks.select(*rest, F.posexplode(present).alias("_pos", "row"))
    number = (F.col("_pos") + 1).cast("bigint")
    return rows.where(~has_formula_error(F.col("row.vals"))).select(
        *rest, number.alias("row_no"), "row"
    )


def row_value(name: Column) -> Column:
    """Value of a column of ``row`` by its clean name."""
    return _value_of(F.col("row.keys"), F.col("row.vals"), name)


def unreadable_payloads(payloads: DataFrame) -> DataFrame:
    """Payloads in none of the three envelopes.

    They are generated and not filtered, as a filter would move below the parsing and
    parse every body once more.
    """
    unreadable = F.col("objects").isNull() & F.col("entries").isNull()
    once = F.when(unreadable, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    return _parsed(payloads).select(*payloads.columns, F.explode(once).alias("_once")).drop("_once")
