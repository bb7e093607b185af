import datetime as dt

from pyspark.sql import functions as F

from docsettle.operators import ledger
from docsettle.operators.landing import read_table
from docsettle.streaming import intake, repeats

SCHEMA = "kind string, doc_url string, received_at timestamp_ntz"


def flows():
    def bills(requests, batch_id):
        made = requests.select("document_id", F.lit(batch_id).alias("made_in"))
        return {"bills": made, "ledger": _ledger(requests, ledger.bill_ledger)}

    def payouts(requests, batch_id):
        return {"ledger": _ledger(requests, ledger.payout_ledger)}

    return {"bill": bills, "payout": payouts}


def _ledger(requests, build):
    blanks = ["file_name", "supplier", "invoice_date", "total_amount", "raw_ocr_data", "text", "media_filename"]
    documents = requests.withColumns({name: F.lit("") for name in blanks})
    return build(documents, F.col("received_at"))


def requests(*rows):
    return [(kind, url, dt.datetime(2024, 1, 1, 0, minute)) for kind, url, minute in rows]


BATCHES = [
    requests(("bill", "/d/1/", 1), ("bill", "/d/1/", 2), ("bill", "/d/x/", 3), ("payout", "/d/1", 4)),
    requests(("bill", "/d/1/", 5), ("bill", "/d/2/", 6), ("other", "/d/3/", 7)),
    requests(("payout", "/d/1/", 8), ("payout", "/d/2/", 9), ("bill", "/d/2/", 10)),
]
EXPECTED = {("bill", 1, 0), ("payout", 1, 0), ("bill", 2, 1), ("payout", 2, 2)}


def in_ledger(spark, root):
    rows = read_table(spark, root, "ledger").collect()
    return sorted((r["kind"], r["document_id"], r["batch_id"]) for r in rows)


def test_every_batch_twice_leaves_each_document_once(spark, tmp_path):
    root = str(tmp_path / "out")
    for number, batch in enumerate(BATCHES):
        frame = spark.createDataFrame(batch, SCHEMA)
        for _ in range(2):
            intake.process_batch(frame, number, root, flows())
    assert in_ledger(spark, root) == sorted(EXPECTED)
    bills = read_table(spark, root, "bills").collect()
    assert sorted((r["document_id"], r["batch_id"]) for r in bills) == [(1, 0), (2, 1)]
    rejected = read_table(spark, root, "rejected").collect()
    assert sorted(r["doc_url"] for r in rejected) == ["/d/3/", "/d/x/"]


def test_nothing_valid_at_first(spark, tmp_path):
    root = str(tmp_path / "out")
    intake.process_batch(spark.createDataFrame(BATCHES[0][2:3], SCHEMA), 0, root, flows())
    intake.process_batch(spark.createDataFrame(BATCHES[1], SCHEMA), 1, root, flows())
    assert in_ledger(spark, root) == [("bill", 1, 1), ("bill", 2, 1)]


def test_stream_over_runs(spark, tmp_path):
    """Each run takes in the files that came since the last one."""
    source, root = str(tmp_path / "log"), str(tmp_path / "out")
    for batch in BATCHES:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = intake.request_stream(spark, source, "parquet", maxFilesPerTrigger="1")
        intake.run_intake(stream, root, str(tmp_path / "cp"), flows()).awaitTermination()
    assert in_ledger(spark, root) == sorted(EXPECTED)


def run(spark, tmp_path, flows_, *batches, files="9"):
    """The stream over what comes in, a file per batch of rows."""
    source, root = str(tmp_path / "log"), str(tmp_path / "out")
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = intake.request_stream(spark, source, "parquet", maxFilesPerTrigger=files)
    intake.run_intake(stream, root, str(tmp_path / "cp"), flows_).awaitTermination()
    return root


def test_repeats_across_batches_and_a_restart(spark, tmp_path):
    """State drops repeats before the batch; files come one by one, then from the checkpoint on."""
    root = run(spark, tmp_path, flows(), *BATCHES, files="1")
    assert in_ledger(spark, root) == sorted(EXPECTED)
    received = read_table(spark, root, "received").where("document_id IS NOT NULL AND kind <> 'other'")
    assert received.count() == len(EXPECTED)  # no repeat has reached a batch
    run(spark, tmp_path, flows(), requests(("bill", "/d/1/", 20), ("bill", "/d/9/", 22), ("bill", "/d/9/", 21)))
    assert in_ledger(spark, root) == sorted({*EXPECTED, ("bill", 9, 3)})
    assert read_table(spark, root, "received").where("document_id = 9").collect()[0]["received_at"].minute == 21


def test_rejected_documents_are_open_again(spark, tmp_path):
    """The first time a flow rejects a document, the second time it takes it."""

    def bills(requests_, batch_id):
        bad = requests_.where("document_id = 1 AND minute(received_at) < 10")
        rejects = bad.selectExpr("document_id", "CAST(NULL AS int) AS import_no", "'bad' AS reason")
        good = requests_.join(bad, "document_id", "left_anti")
        return {"ledger": _ledger(good, ledger.bill_ledger), "rejects": rejects}

    first = requests(("bill", "/d/1/", 1), ("bill", "/d/2/", 2))
    root = run(spark, tmp_path, {"bill": bills}, first)
    assert in_ledger(spark, root) == [("bill", 2, 0)]
    run(spark, tmp_path, {"bill": bills}, requests(("bill", "/d/1/", 11), ("bill", "/d/2/", 12)))
    assert in_ledger(spark, root) == [("bill", 1, 1), ("bill", 2, 0)]
    run(spark, tmp_path, {"bill": bills}, requests(("bill", "/d/1/", 13)))
    assert in_ledger(spark, root) == [("bill", 1, 1), ("bill", 2, 0)]


def test_what_the_state_has_forgotten_is_in_the_ledger(spark, tmp_path):
    """With a horizon of nothing, every repeat passes the state and ends at the index."""
    source, root = str(tmp_path / "log"), str(tmp_path / "out")
    for minute in (1, 2, 3):
        spark.createDataFrame(requests(("bill", "/d/1/", minute)), SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = intake.request_stream(spark, source, "parquet")
        intake.run_intake(stream, root, str(tmp_path / "cp"), flows(), horizon_days=0).awaitTermination()
    assert in_ledger(spark, root) == [("bill", 1, 0)]
    assert read_table(spark, root, "received").count() > 1


def test_hot_document(spark, tmp_path):
    """Repeats of one document are dropped before they meet; requests without a time come last."""
    hot = [("bill", "/d/1/", None), *requests(*(("bill", "/d/1/", 59 - k % 50) for k in range(2_000)))]
    root = run(spark, tmp_path, flows(), hot + requests(("bill", "/d/2/", 3)))
    assert in_ledger(spark, root) == [("bill", 1, 0), ("bill", 2, 0)]
    assert read_table(spark, root, "received").where("document_id = 1").collect()[0]["received_at"].minute == 10


def test_a_page_of_documents_is_one_group(spark, tmp_path):
    """Neighbours share a group of the state, and each is decided for itself: new, known, rejected and open again."""
    assert repeats.STATE.count("array") == 2

    def bills(requests_, batch_id):
        bad = requests_.where("document_id IN (-1, 63) AND minute(received_at) < 10")
        rejects = bad.selectExpr("document_id", "CAST(NULL AS int) AS import_no", "'bad' AS reason")
        return {"ledger": _ledger(requests_.join(bad, "document_id", "left_anti"), ledger.bill_ledger), "rejects": rejects}

    ids = [-65, -64, -1, 0, 1, 62, 63, 64, 4_000_000_000_000]
    first = requests(*(("bill", f"/d/{k}/", 5) for k in ids[:-2]), ("bill", "/d/1/", 3), ("bill", "/d/1/", 4))
    root = run(spark, tmp_path, {"bill": bills}, first)
    assert read_table(spark, root, "received").where("document_id = 1").collect()[0]["received_at"].minute == 3
    run(spark, tmp_path, {"bill": bills}, requests(*(("bill", f"/d/{k}/", 20) for k in ids)))
    assert in_ledger(spark, root) == [("bill", k, int(k in (-1, 63, 64, 4_000_000_000_000))) for k in ids]
    again = [r["document_id"] for r in read_table(spark, root, "received").where("batch_id = 1").collect()]
    assert sorted(again) == [-1, 63, 64, 4_000_000_000_000]  # known ones have not reached the batch
