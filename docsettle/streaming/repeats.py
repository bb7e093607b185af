"""Requests decided by keyed state: the first one of a document passes, repeats do not."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

KEYS = ["kind", "document_id"]
DECIDED = "kind string, document_id bigint, doc_url string, received_at timestamp_ntz"
STATE = "documents array<bigint>, arrived array<bigint>"
#: Documents of a page. What a group costs in Python hardly depends on its rows, and its state is bounded by this.
PAGE_BITS = 6


def with_outcomes(requests: DataFrame, rejects: DataFrame) -> DataFrame:
    """One stream of events: requests ``(kind, document_id, doc_url, received_at)``, and rejects, which open a document again."""
    names = ["kind", "document_id", "doc_url", "received_at"]
    opened = rejects.select(
        *KEYS, F.lit(None).cast("string").alias("doc_url"), F.lit(None).cast("timestamp_ntz").alias("received_at")
    )
    return requests.select(*names, F.lit(False).alias("reopens")).union(opened.withColumn("reopens", F.lit(True)))


def _fewer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each Arrow batch the first request of a document, so that a hot document is no hot group."""
    order = ["reopens", "received_at", "doc_url"]
    for frame in frames:
        yield frame.sort_values(order, na_position="last").drop_duplicates([*KEYS, "reopens"])


def _first_of(frame: pd.DataFrame) -> pd.DataFrame:
    """Of each document the first request; those without a time come last."""
    if frame["document_id"].is_unique:
        return frame
    ordered = frame.sort_values(["received_at", "doc_url"], na_position="last")
    return ordered.drop_duplicates("document_id")


def decide(events: DataFrame, horizon_ms: int) -> DataFrame:
    """The requests that nothing in the state speaks against, at most one of a document and batch: its first.

    State is the last times of arrival of a page of ``1 << PAGE_BITS`` documents with neighbouring ids, by which repeats
    are known without reading any table. A reject clears its document's time before the batch's requests are looked at.
    ``horizon_ms`` after the last request came in it no longer counts; it goes when its page is seen again, and a page
    when the watermark has passed for all of its documents; a later repeat passes and is for the ledger to stop. The time
    of arrival is that of the batch, so no request is ever too late for the watermark, whatever time it bears.
    """

    def first(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best, reopened, arrived = None, set(), 0
        for frame in frames:
            arrived = max(arrived, int(frame["arrived"].iat[0].timestamp() * 1000))  # one time for all of a batch
            opens = frame["reopens"].to_numpy(bool)
            if opens.any():
                reopened.update(frame["document_id"].to_numpy()[opens].tolist())
                frame = frame[~opens]
            if len(frame):
                best = _first_of(frame if best is None else pd.concat([best, frame]))
        known = dict(zip(*state.get, strict=True)) if state.exists else {}
        known = {k: seen for k, seen in known.items() if k not in reopened and arrived <= seen + horizon_ms}
        asked = [] if best is None else best["document_id"].tolist()
        fresh = [k not in known for k in asked]
        now = max(arrived, state.getCurrentWatermarkMs() + 1)
        known.update(dict.fromkeys(asked, now))
        if known:
            state.update((list(known), list(known.values())))
            state.setTimeoutTimestamp(max(max(known.values()) + horizon_ms, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        if any(fresh):
            yield best.loc[fresh, ["kind", "document_id", "doc_url", "received_at"]]

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema.fields)
    cores = events.sparkSession.sparkContext.defaultParallelism
    return (
        events.repartition(cores, *events.columns)  # a batch's file is mostly one task; by hash, which needs no sort
        .mapInPandas(_fewer, schema)
        .withColumn("page", F.shiftright("document_id", PAGE_BITS))
        .withColumn("arrived", F.current_timestamp())
        .withWatermark("arrived", "0 seconds")
        .groupBy("kind", "page")
        .applyInPandasWithState(first, DECIDED, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )
