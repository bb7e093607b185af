"""Publication of a batch's records in two phases: tasks write parts, the driver's commit makes them visible.

A task writes its records to a part of its own and reports it. Only when all tasks have done so does one small
manifest per batch name the parts, by which readers find them. A failed or repeated task leaves parts that no manifest names;
a batch that is published again replaces its manifest. So each record is there once or not at all.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "publication"


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Part(WriterCommitMessage):
    """What a task has written: a file below the publication's folder, and how many records; no file for none."""

    name: str
    records: int


class PublicationWriter(DataSourceArrowWriter):
    def __init__(self, path: str, batch_id: int):
        self.path, self.batch_id = path.rstrip("/"), batch_id

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        files, base = _file_system(self.path)
        name, records, out = f"parts/{self.batch_id}-{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if out is None:
                    files.create_dir(f"{base}/parts")
                    out = pq.ParquetWriter(f"{base}/{name}", batch.schema, filesystem=files)
                out.write_batch(batch)
                records += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Part(name if out is not None else "", records)

    def commit(self, messages: list[Part | None]) -> None:
        """All tasks have written: their parts become the batch."""
        files, base = _file_system(self.path)
        files.create_dir(f"{base}/manifests")
        parts = sorted(m.name for m in messages if m is not None and m.name)
        text = json.dumps({"batch_id": self.batch_id, "parts": parts, "records": sum(m.records for m in messages if m)})
        draft = f"{base}/manifests/.{self.batch_id}-{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            out.write(text.encode())
        files.move(draft, f"{base}/manifests/{self.batch_id}.json")

    def abort(self, messages: list[Part | None]) -> None:
        """A task has failed for good: what the others wrote goes, and an earlier publication of the batch stays."""
        files, base = _file_system(self.path)
        for message in messages:
            if message is not None and message.name:
                files.delete_file(f"{base}/{message.name}")


class Publication(DataSource):
    """Options ``path`` and ``batch_id``; for writing only, :func:`published` reads."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> PublicationWriter:
        return PublicationWriter(self.options["path"], int(self.options["batch_id"]))


def publish(records: DataFrame, path: str, batch_id: int) -> None:
    """Publish the batch's records as a whole, or leave what was published of the batch before."""
    spark = records.sparkSession
    spark.dataSource.register(Publication)
    records.write.format(FORMAT).mode("append").option("batch_id", str(batch_id)).save(path)


def published(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Records of all batches, with ``batch_id``; parts that no manifest names are not read.

    The names of the parts come to the driver, as those of any files do that Spark reads.
    """
    base = path.rstrip("/")
    kept = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    manifests = spark.read.schema("batch_id bigint, parts array<string>").json(f"{base}/manifests").collect()
    found = spark.createDataFrame([], kept).selectExpr("*", "CAST(NULL AS bigint) AS batch_id")
    names = [posixpath.join(base, name) for row in manifests for name in row["parts"]]
    if names:
        batch = "CAST(regexp_extract(_metadata.file_name, '^(-?[0-9]+)-', 1) AS bigint) AS batch_id"
        found = spark.read.schema(kept).parquet(*names).selectExpr("*", batch)
    return found
