"""The funnel as a stream: rows come out once their slot can get no more events.

    readStream of the event table (files of (d, h) folders)
      -> valid events, branch by a stream-static hash join, slots              narrow
      -> state per (close, branch, day, slot, exposure): the earliest anchor, impression and click
      -> append: a group leaves the state, and its row comes out, when the watermark passes its close

``close`` is the last second at which the slot takes a click.  The watermark is kept on it: an event's close lies at most
``SPAN`` after the event, so a delay of ``SPAN`` plus the allowed lateness holds back every group until events of
``lateness`` after its close have been seen.  The state is the earliest rows alone (the partial aggregates of the batch
build), held by Spark's state store and checkpointed; a hot exposure is one entry.  Events that are later than
allowed are dropped by the watermark: repair their day from the table (``plans.repair``).

The sink is Parquet by ``d`` with Spark's file log, so a batch that runs again adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schema
from ..operators import funnel as fn
from ..operators import slots

#: Longest time from an event to the close of its slot, in seconds.
SPAN = max(max(row[1:]) - row[0] for is_ssp in (False, True) for row in slots.slot_table(is_ssp))


def close_of(is_ssp: Column, slot_d: Column, slot: Column) -> Column:
    """The last second at which a slot of a processed day takes events."""
    ends = F.when(is_ssp, F.array(*[F.lit(max(r[1:])) for r in slots.slot_table(True)])) \
        .otherwise(F.array(*[F.lit(max(r[1:])) for r in slots.slot_table(False)]))
    return slot_d.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.get(ends, slot))


def read_events(spark: SparkSession, events_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The event table as a stream of its files."""
    reader = spark.readStream.schema(spark.read.parquet(events_path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(events_path)


def funnel_stream(events: DataFrame, ssp_sites: DataFrame, lateness_seconds: int = 3600, tiebreak=()) -> DataFrame:
    """Funnel rows of a stream of events (also right on a batch frame)."""
    rows = fn.slot_rows(events, ssp_sites)
    rows = rows.withColumn("close", close_of(F.col("is_ssp"), F.col("slot_d"), F.col("slot")).cast("timestamp"))
    rows = rows.withWatermark("close", f"{SPAN + lateness_seconds} seconds")
    return fn.stitch(rows, tiebreak, also=["close"]).select(*schema.FUNNEL_COLUMNS)


def start(spark: SparkSession, events_path: str, ssp_sites: DataFrame, out_path: str, checkpoint: str | None = None,
          lateness_seconds: int = 3600, max_files_per_trigger: int | None = None, available_now: bool = True,
          tiebreak=()) -> StreamingQuery:
    """Start the streaming build; ``available_now`` takes what is there, then stops (open slots stay in the state)."""
    rows = funnel_stream(read_events(spark, events_path, max_files_per_trigger), ssp_sites, lateness_seconds, tiebreak)
    writer = (rows.writeStream.outputMode("append").format("parquet").partitionBy("d").option("path", out_path)
              .option("checkpointLocation", checkpoint or out_path.rstrip("/") + "_stream"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
