import json
import os
import tempfile

import pytest
from pyspark.sql import SparkSession

from tickloom.schema import RECORD, TOPIC
from tickloom.session import streaming_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tickloom-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def run_dir():
    """A new folder per test, left in place."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def tick(ts, price, quantity, trade_id, symbol="X"):
    return {
        "symbol": symbol,
        "price": str(price),
        "quantity": str(quantity),
        "timestamp": ts,
        "trade_id": trade_id,
    }


def heartbeat(ts):
    return {"type": "heartbeat", "timestamp": ts}


def topic_rows(records, first_offset=0):
    rows = []
    for i, record in enumerate(records):
        symbol = record.get("symbol") if isinstance(record, dict) else None
        value = json.dumps(record) if isinstance(record, dict) else record
        rows.append(
            (bytearray((symbol or "").encode()), bytearray(value.encode()), "t", 0, first_offset + i, None)
        )
    return rows


def topic_frame(spark, records):
    return spark.createDataFrame(topic_rows(records), TOPIC)


def record_frame(spark, records):
    """Typed records in order of arrival, as ``parse_records`` gives them."""
    from decimal import Decimal

    rows = []
    for i, r in enumerate(records):
        if r.get("type") == "heartbeat":
            rows.append(("heartbeat", None, None, None, r["timestamp"], None, i))
        else:
            rows.append(
                ("tick", r["symbol"], Decimal(r["price"]), Decimal(r["quantity"]), r["timestamp"], r["trade_id"], i)
            )
    return spark.createDataFrame(rows, RECORD)


class Replay:
    """Feeds record batches, one micro-batch per file, through a streaming pipeline."""

    def __init__(self, spark, folder, pipeline):
        self.spark = streaming_session(spark)
        self.spark.conf.set("spark.sql.shuffle.partitions", "2")
        self.folder = folder
        self.pipeline = pipeline
        self.offset = 0
        self.files = 0
        os.makedirs(f"{folder}/topic", exist_ok=True)

    def feed(self, *batches):
        for batch in batches:
            frame = self.spark.createDataFrame(topic_rows(batch, self.offset), TOPIC)
            path = f"{self.folder}/topic/part-{self.files:05d}"
            frame.coalesce(1).write.parquet(path)
            os.utime(path, (1_700_000_000 + self.files,) * 2)
            for name in os.listdir(path):
                os.utime(f"{path}/{name}", (1_700_000_000 + self.files,) * 2)
            self.offset += len(batch)
            self.files += 1
        return self

    def run(self):
        from tickloom.sources.topic import file_topics, parse_records

        records = parse_records(file_topics(self.spark, f"{self.folder}/topic/*", max_files_per_trigger=1))
        query = (
            self.pipeline(records)
            .writeStream.format("parquet")
            .option("path", f"{self.folder}/out")
            .option("checkpointLocation", f"{self.folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return self

    def rows(self):
        out = self.spark.read.parquet(f"{self.folder}/out")
        return sorted(tuple(str(v) if hasattr(v, "as_tuple") else v for v in row) for row in out.collect())

    def short(self, symbol="X"):
        """(start, open, high, low, close, volume, trades) with whole-number prices."""
        return [
            (r[1], *(int(float(v)) for v in r[3:8]), r[8]) for r in self.rows() if r[0] == symbol
        ]
