"""Incremental intake: a stream of requests, each document processed once.

A request is decided twice. Keyed state of the stream knows the documents of the last days and
drops their repeats without reading a table. What passes is looked up in the ledger's membership
index, which opens only the files that can hold it and also knows what the state has forgotten.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docsettle import schemas
from docsettle.fixed import FLOWS
from docsettle.functions.scalars import document_id
from docsettle.operators.landing import write_table
from docsettle.operators.ledger import first_requests
from docsettle.operators.membership import Membership
from docsettle.session import setting
from docsettle.streaming.repeats import decide, with_outcomes

Flow = Callable[[DataFrame, int], Mapping[str, DataFrame]]
LEDGER_TABLE, ACCEPTED_TABLE, REJECTED_TABLE, REJECTS_TABLE = "ledger", "accepted", "rejected", "rejects"
RECEIVED_TABLE, MEMBERSHIP = "received", "membership"
RECEIVED = f"{schemas.REQUESTS}, document_id bigint"
HORIZON_DAYS = 30


def request_stream(
    spark: SparkSession, path: str, source: str = "json", **options: str
) -> DataFrame:
    """Requests from files that keep coming in; ``maxFilesPerTrigger`` bounds a batch."""
    return spark.readStream.schema(schemas.REQUESTS).options(**options).format(source).load(path)


def with_document_id(requests: DataFrame) -> DataFrame:
    return requests.withColumn("document_id", document_id(F.col("doc_url")))


def is_valid() -> Column:
    return F.coalesce(F.col("document_id").isNotNull() & F.col("kind").isin(FLOWS), F.lit(False))


def _own(spark: SparkSession, root: str, table: str, schema: str, batch_id: int) -> DataFrame:
    """What this batch wrote to a table, by its own folder; none if it wrote no row."""
    found = spark.read.schema(f"{schema}, batch_id bigint").parquet(f"{root}/{table}")
    return found.where(F.col("batch_id") == batch_id).drop("batch_id")


def process_batch(
    requests: DataFrame, batch_id: int, root: str, flows: Mapping[str, Flow]
) -> None:
    """One micro-batch. Running it again writes the same partitions again.

    Requests are written first and read back, so that the stream's plan runs once and every flow
    starts from a table. A flow gives ``ledger``, results by table, and ``rejects``: documents that it could not
    process, which stay open. A kind without a request is not run. The ledger comes after all results, and the
    index of what is processed last: until it is written, the batch has not happened.
    """
    spark = requests.sparkSession
    write_table(with_document_id(requests).select("kind", "doc_url", "received_at", "document_id"), root, RECEIVED_TABLE, batch_id)
    parsed = _own(spark, root, RECEIVED_TABLE, RECEIVED, batch_id)
    write_table(parsed.where(~is_valid()).drop("document_id"), root, REJECTED_TABLE, batch_id)
    index = Membership(spark, f"{root}/{MEMBERSHIP}")
    fresh = index.unseen(first_requests(parsed.where(is_valid()), "received_at"), batch_id)
    write_table(fresh, root, ACCEPTED_TABLE, batch_id)
    accepted = _own(spark, root, ACCEPTED_TABLE, RECEIVED, batch_id)
    present = {row["kind"] for row in accepted.select("kind").distinct().collect()}  # at most the kinds there are
    ledgers, rejects = [], []
    for kind, flow in flows.items():
        if kind not in present:
            continue
        outputs = dict(flow(accepted.where(F.col("kind") == kind), batch_id))
        ledgers.append(outputs.pop(LEDGER_TABLE))
        if REJECTS_TABLE in outputs:
            rejects.append(outputs.pop(REJECTS_TABLE).withColumn("kind", F.lit(kind)))
        for table, result in outputs.items():
            write_table(result, root, table, batch_id)
    if rejects:
        write_table(reduce(DataFrame.unionByName, rejects), root, REJECTS_TABLE, batch_id)
    if ledgers:
        write_table(reduce(DataFrame.unionByName, ledgers), root, LEDGER_TABLE, batch_id)
        done = _own(spark, root, LEDGER_TABLE, schemas.LEDGER, batch_id)
    else:
        done = accepted.limit(0)
    index.add(done, batch_id)


def undecided(requests: DataFrame, root: str, horizon_days: int = HORIZON_DAYS) -> DataFrame:
    """The stream without repeats of requests that it has passed on within the horizon.

    Malformed requests pass; they are rejected by the batch. A document that a flow rejected is open again as
    soon as the stream has read its reject: in the next batch, or, for a run over what is available, in the next run.
    """
    spark = requests.sparkSession
    write_table(spark.createDataFrame([], schemas.REJECTS), root, REJECTS_TABLE, -1)  # makes the folder
    rejects = spark.readStream.schema(schemas.REJECTS).parquet(f"{root}/{REJECTS_TABLE}")
    parsed = with_document_id(requests)
    passed = decide(with_outcomes(parsed.where(is_valid()), rejects), horizon_days * 86_400_000)
    names = ["kind", "doc_url", "received_at"]
    return passed.select(*names).union(parsed.where(~is_valid()).select(*names))


def run_intake(
    requests: DataFrame, root: str, checkpoint: str, flows: Mapping[str, Flow], horizon_days: int = HORIZON_DAYS
) -> StreamingQuery:
    """Start the intake over a streaming ``(kind, doc_url, received_at)`` source.

    It takes what is available and ends; a scheduler or a longer trigger repeats it. State that has
    expired goes with the next requests and not in batches of its own, which would have nothing to process.
    """
    with setting(requests.sparkSession, "spark.sql.streaming.noDataMicroBatches.enabled", "false"):  # a query keeps it
        return (
            undecided(requests, root, horizon_days)
            .writeStream.option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(lambda batch, number: process_batch(batch, number, root, flows))
            .start()
        )
