"""Dimensions: platform by tag, get-or-create by name, custom fields by name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsettle.fixed import (
    ACCOUNT_TYPE,
    CONTACT_TYPE,
    CUSTOM_FIELDS,
    DEFAULT_BANK,
    DEFAULT_VENDOR,
    OPENING_BALANCE,
    ORIGINALS_FOLDER,
)
from docsettle.functions.scalars import or_default
from docsettle.operators.landing import earlier_batches
from docsettle.operators.lookups import lookup
from docsettle.session import staged
from docsettle.sources.config import tag_ids

ID_BUCKET_DIGITS = 3


def _literal_map(entries: Mapping) -> Column:
    """A small map from the configuration as a literal; it has an entry per config name."""
    return F.create_map(*[F.lit(part) for pair in entries.items() for part in pair])


def resolve_platform(documents: DataFrame, platforms: Mapping[int, str]) -> DataFrame:
    """Adds ``platform``: that of the first tag which stands for a configured one.

    The tag ids of the configured platforms are at most as many as the platforms, so
    they go into the plan as a literal and the documents are not shuffled.
    """
    if not platforms:
        return documents.withColumn("platform", F.lit(None).cast("string"))
    by_tag = _literal_map(platforms)
    hits = F.filter(F.transform("tags", lambda tag: by_tag[tag]), lambda name: name.isNotNull())
    return documents.withColumn("platform", F.get(hits, F.lit(0)))


def original_path(media_filename: Column) -> Column:
    return F.concat(F.lit(ORIGINALS_FOLDER), media_filename)


def is_processable(filename: Column, platform: Column) -> Column:
    """A workbook by its name, of a known platform."""
    return F.lower(filename).rlike(r"[.]xlsx?\z") & platform.isNotNull()


class Resolved:
    """Rows with their ids, and the dimension entries that had to be created."""

    def __init__(self, rows: DataFrame, created: DataFrame):
        self.rows = rows
        self.created = created


def known_entries(dimension: DataFrame, root: str, table: str, batch_id: int) -> DataFrame:
    """A dimension with the entries that earlier batches created and wrote to ``table``.

    Resolving against it, and writing what is created with ``write_table``, gives each
    name one id over all batches, also when a batch runs again.
    """
    earlier = earlier_batches(dimension.sparkSession, root, table, dimension.schema, batch_id)
    return dimension.unionByName(earlier)


def new_ids(missing: DataFrame, key: str, greatest: DataFrame) -> DataFrame:
    """Adds a dense ``id`` above the ``greatest`` one, in the order of the key's digest.

    The digest's first digits split the keys into even buckets of a fixed number, so
    numbering runs in parallel; only one count per bucket is put in sequence, after the
    greatest id, which takes part as the count of a first bucket.
    """
    digest = F.md5(F.col(key))
    bucketed = missing.withColumns(
        {"_digest": digest, "_bucket": F.substring(digest, 1, ID_BUCKET_DIGITS)}
    )
    in_bucket = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", key))
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    base = greatest.select(F.lit("").alias("_bucket"), F.coalesce("greatest", F.lit(0)).alias("_n"))
    # at most 16 ** ID_BUCKET_DIGITS + 1 rows are put in sequence
    earlier = (
        Window.partitionBy(F.lit(1)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = base.unionByName(counts).select("_bucket", F.sum("_n").over(earlier).alias("_start"))
    return (
        bucketed.withColumn("_rank", in_bucket)
        .join(F.broadcast(starts), "_bucket")
        .withColumn("id", (F.col("_start") + F.col("_rank")).cast("bigint"))
        .drop("_digest", "_bucket", "_rank", "_start")
    )


def get_or_create(
    rows: DataFrame,
    name: str,
    dimension: DataFrame,
    id_column: str,
    order: str = "document_id",
    candidates: Column | None = None,
) -> Resolved:
    """Resolve ``rows[name]`` to ids of ``dimension (id, name)`` without regard to case.

    The least id of equal names is taken. Each unknown name gets one new entry, spelled
    as in its first row by ``order``. ``candidates`` limits the entries that may match;
    new ids stay above those of all entries. The ids, one row per name, are staged as a
    table, since the rows and the created entries both come from them.
    """
    keyed_rows = rows.withColumn("_key", F.lower(F.col(name)))
    wanted = keyed_rows.groupBy("_key").agg(
        F.count(F.lit(1)).alias("_rows"), F.min(F.struct(order, name)).alias("_first")
    )
    usable = dimension if candidates is None else dimension.where(candidates)
    known = usable.groupBy(F.lower("name").alias("_key")).agg(F.min("id").alias("_known"))
    matched = wanted.where(F.col("_key").isNotNull()).join(known, "_key", "left")
    fresh = new_ids(
        matched.where(F.col("_known").isNull()),
        "_key",
        dimension.agg(F.max("id").cast("bigint").alias("greatest")),
    )
    found = matched.where(F.col("_known").isNotNull()).withColumn("id", F.col("_known"))
    ids = staged(
        found.unionByName(fresh).select(
            "_key",
            "_rows",
            F.col("id").cast("bigint").alias(id_column),
            F.col("_known").isNull().alias("_created"),
            F.col("_first")[name].alias("_name"),
        ),
        id_column,
    )
    keyed = ids.select("_key", "_rows", id_column)
    resolved = lookup(keyed_rows, keyed, "_key", id_column, "_rows", order).drop("_key")
    created = ids.where("_created").select(F.col(id_column).alias("id"), F.col("_name").alias("name"))
    return Resolved(resolved, created)


def get_or_create_vendors(bills: DataFrame, contacts: DataFrame, name: str = "supplier") -> Resolved:
    """Vendor per bill, in ``contact_id``; an empty name becomes the default vendor."""
    named = bills.withColumn("_vendor", or_default(F.col(name), DEFAULT_VENDOR))
    is_vendor = F.col("type") == CONTACT_TYPE
    result = get_or_create(named, "_vendor", contacts, "contact_id", candidates=is_vendor)
    created = result.created.withColumn("type", F.lit(CONTACT_TYPE))
    return Resolved(result.rows.drop("_vendor"), created)


def get_or_create_accounts(
    statements: DataFrame, accounts: DataFrame, name: str = "bank_name"
) -> Resolved:
    """Bank account per statement, in ``account_id``, among accounts of any type."""
    named = statements.withColumn("_bank", or_default(F.col(name), DEFAULT_BANK))
    result = get_or_create(named, "_bank", accounts, "account_id")
    created = result.created.withColumns(
        {
            "type": F.lit(ACCOUNT_TYPE),
            "opening_balance": F.lit(OPENING_BALANCE).cast("bigint"),
        }
    )
    return Resolved(result.rows.drop("_bank"), created)


def get_or_create_correspondents(
    documents: DataFrame, correspondents: DataFrame, name: str = "supplier"
) -> Resolved:
    """Correspondent per document; documents without a supplier keep none."""
    named = documents.withColumn("_corr", F.nullif(F.col(name), F.lit("")))
    result = get_or_create(named, "_corr", correspondents, "correspondent")
    return Resolved(result.rows.drop("_corr"), result.created)


def bind_custom_fields(values: Mapping[str, Column], fields: DataFrame) -> Column:
    """``array<struct<field, value>>`` of the values whose field exists in ``fields``.

    Only the ids of the few fixed field names come to the driver.
    """
    ids = tag_ids(fields, [name for name, _ in CUSTOM_FIELDS])
    bound = [
        F.when(
            values[source].isNotNull(),
            F.struct(F.lit(ids[name]).cast("bigint").alias("field"), values[source].alias("value")),
        )
        for name, source in CUSTOM_FIELDS
        if name in ids and source in values
    ]
    if not bound:
        return F.array().cast("array<struct<field: bigint, value: string>>")
    return F.filter(F.array(*bound), lambda one: one.isNotNull())
