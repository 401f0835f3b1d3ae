"""Incremental load of newly landed files into a deduplicated table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from shelfscope.operators.merge import days_of, stored_rows
from shelfscope.sources.jsonl import on_disk


def stream_jsonl(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 1000) -> DataFrame:
    """New newline-JSON files below ``path``, with the fixed schema."""
    return (
        spark.readStream.schema(on_disk(schema))
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("recursiveFileLookup", "true")
        .json(path)
    )


def deduplicated(stream: DataFrame, keys: Sequence[str], at: str, delay: str = "1 day") -> DataFrame:
    """Rows whose keys were not seen within ``delay`` of event time; older state is dropped.

    Rows older than ``delay`` are dropped with it, so this is for feeds that only grow at their end. ``load_new``
    takes rows of any age.
    """
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def load_available(
    stream: DataFrame, target: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append everything that has landed so far to a Parquet table and stop.

    Offsets and state live in ``checkpoint``, a folder all executors share, so a load that is
    interrupted goes on where it stopped without doubling rows.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if partition_by:
        query = query.partitionBy(*partition_by)
    return query.start()


def load_new(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], day: str) -> StreamingQuery:
    """Append the rows whose keys the table does not hold yet, whatever their age, and stop.

    Rows are compared with the stored rows of their own days only (``day`` partitions the table and belongs to the
    keys' identity): a batch's days are literals in the plan, so a backfill opens the days it touches. A load that is interrupted and repeated finds its rows
    stored and adds none twice.
    """

    def add(batch: DataFrame, _: int) -> None:
        fresh = batch.dropDuplicates([*keys, day])
        stored = stored_rows(batch.sparkSession, target, batch.schema, day, days_of(batch, day))
        if stored is not None:
            same = [fresh[c].eqNullSafe(stored[c]) for c in (*keys, day)]
            fresh = fresh.join(stored, same, "left_anti")
        fresh.write.mode("append").partitionBy(day).parquet(target)

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def with_event_time(stream: DataFrame, column: str = "extracted_at", name: str = "extracted_ts") -> DataFrame:
    """Adds the ISO text of ``column`` as a timestamp to watermark on."""
    return stream.withColumn(name, F.col(column).try_cast("timestamp"))
