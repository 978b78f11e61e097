import datetime

import pytest
from pyspark.sql import functions as F

from geoferry import batch_log_rows, ingest_log_rows
from geoferry.fixed_values import BATCH_LOG_COLUMNS, INGEST_LOG_COLUMNS


def test_ingest_rows(spark):
    started = datetime.datetime(2024, 1, 2, 3, 4, 5, 6)
    layers = spark.createDataFrame(
        [("i", "0", "u", "n", "s.t", started)],
        "item_id string, sublayer_id string, layer_url string, layer_name string, target_path string, started timestamp",
    )
    pending = ingest_log_rows(layers, "run", "Pending")
    assert pending.columns == INGEST_LOG_COLUMNS and {kind for _, kind in pending.dtypes} == {"string"}
    row = pending.first()
    assert (row.timestamp, row.status, row.error_message) == ("2024-01-02 03:04:05.000006", "Pending", None)
    later = ingest_log_rows(layers, "run", "Failed", "why", F.lit(datetime.datetime(2025, 1, 1))).first()
    assert later.layer_attempt_id == row.layer_attempt_id and later.timestamp.startswith("2025")


@pytest.mark.parametrize(
    "status, message, expected",
    [
        ("Success", None, "Complete"),
        ("Success", "", "Complete"),
        ("Success", "done", "done"),
        ("Failed", None, "Unknown error"),
        ("Timeout", "", "Unknown error"),
    ],
)
def test_batch_messages(spark, status, message, expected):
    rows = batch_log_rows(spark.range(1), F.col("id"), "svc", "id", status, message)
    assert rows.columns == BATCH_LOG_COLUMNS
    row = rows.first()
    assert (row.batch, row.message, row.retry_attempts, row.user) == ("0", expected, 1, None)
    assert dict(rows.dtypes)["load_timestamp"] == "timestamp" and dict(rows.dtypes)["retry_attempts"] == "bigint"


def test_unknown_status_raises(spark):
    status = F.when(F.col("id") < 2, "Success").otherwise("Done")
    rows = batch_log_rows(spark.range(3), F.col("id"), "svc", "id", status)
    with pytest.raises(Exception, match="unknown batch status: Done"):
        rows.select("batch").collect()
    with pytest.raises(Exception, match="unknown batch status"):
        batch_log_rows(spark.range(1), F.col("id"), "svc", "id", None).collect()
