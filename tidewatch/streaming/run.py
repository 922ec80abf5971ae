"""Run a stream over what is available now, and read what it wrote."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..operators.skew import shared_folder


def run_available(stream: DataFrame, path: str | None = None) -> DataFrame:
    """Append the stream's rows to a table in the shared folder; return that table."""
    spark = stream.sparkSession
    base = path or f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", f"{base}/rows")
        .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


#: Key and time of the row that closes a stream; Arrow batches hold times up to 2262.
CLOSING, END_OF_TIME = "\x00closed", "2262-01-01"


def run_finite(make: Callable[[DataFrame], DataFrame], rows: DataFrame, key: str = "user_id", time: str = "timestamp") -> DataFrame:
    """Run ``make(rows)`` over a source that has ended, until nothing waits for the watermark any more.

    After the source is read, a second one delivers a single closing row at the end of time under a key of its own. It moves the
    watermark past all rows, so timers fire and windows close; its key is left out of the returned table.
    """
    spark = rows.sparkSession
    base = f"{shared_folder(spark).rstrip('/')}/finite-{uuid.uuid4().hex}"
    kinds = {f.name: f.dataType for f in rows.schema}
    closing = spark.range(1).select(*[
        F.lit(CLOSING if c == key else END_OF_TIME if c == time else None).cast(kind).alias(c) for c, kind in kinds.items()])
    closing.limit(0).write.parquet(f"{base}/closing")
    stream = make(rows.unionByName(spark.readStream.schema(rows.schema).parquet(f"{base}/closing")))
    run_available(stream, base)
    closing.write.mode("append").parquet(f"{base}/closing")
    return run_available(stream, base).filter(F.col(key) != CLOSING)


def run_to_the_end(stream: DataFrame, batch: DataFrame, key: str = "tx_id") -> DataFrame:
    """A backfill: what the stream emitted, and from ``batch`` what still waited for the watermark. See ``run_finite``.

    ``batch`` computes the same columns over all rows of the source, those without a time or user included.
    """
    done = run_available(stream)
    return done.unionByName(batch.select(*done.columns).join(done.select(key), key, "left_anti"))


def run_complete(stream: DataFrame) -> DataFrame:
    """Final counts of a windowed stream: every batch overwrites the table of results with all of them."""
    spark = stream.sparkSession
    base = f"{shared_folder(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    query = (
        stream.writeStream.outputMode("complete").option("checkpointLocation", f"{base}/state")
        .foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(f"{base}/rows"))
        .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")
