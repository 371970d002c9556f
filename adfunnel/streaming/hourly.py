"""Hour files -> event table as a Structured Streaming query.

    readStream (tab-separated hour files landing in a folder)
      -> each line with the hour named in its file's path
      -> foreachBatch: the batch load (classes, counted rejects, stage, publish by (d, h, shard))

A micro-batch replayed after a failure stages the same rows, which the publish finds present and
leaves.  Rows outside their file's hour go to the rejects.  An hour whose file comes in two parts must
arrive in one micro-batch: a later part makes the publish raise, nothing is dropped.  With ``parts`` each file is a part
of its own, kept apart by the ledger of files (``plans.parts``): parts may come in any batch, twice or under two names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import derive
from ..plans import ingest, parts as in_parts
from ..sources import tsv


def hour_files(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the landed files with their ``file`` and ``src_hour``, null where the path names no hour."""
    # landing layout <root>/<day>/<hour>_<shard>.txt: look into sub-folders
    reader = spark.readStream.option("lineSep", "\n").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    name = F.col("_metadata.file_path")
    return reader.text(landing_dir).select("value", name.alias("file"), tsv.hour_key(name).alias("src_hour"))


def start(spark: SparkSession, landing_dir: str, main_path: str, ug_from: int, ug_to: int,
          checkpoint: str | None = None, available_now: bool = True,
          max_files_per_trigger: int | None = None, rejects_path: str | None = None,
          parts: bool = False, ledger_path: str | None = None) -> StreamingQuery:
    """Start the ingest; ``available_now`` processes what has landed, then stops.

    The checkpoint, which remembers the files read, lies beside the table (``<table>_stream``) unless
    named.  Rejects of a micro-batch go to ``batch=<id>`` below ``rejects_path`` (default
    ``<table>_rejects``), replaced on replay.
    """
    derive.check_groups(ug_from, ug_to)
    base = main_path.rstrip("/")
    rejects = (rejects_path or base + "_rejects").rstrip("/")

    def publish_batch(batch: DataFrame, batch_id: int) -> None:
        if parts:
            in_parts.load_lines(batch.sparkSession, batch, ug_from, ug_to, main_path, ledger_path,
                                rejects_path=f"{rejects}/batch={batch_id}")
            return
        ingest.load_flagged(batch.sparkSession, ingest.flagged_lines(batch), ug_from, ug_to, main_path,
                            f"batch-{batch_id}", rejects_path=f"{rejects}/batch={batch_id}")

    writer = (hour_files(spark, landing_dir, max_files_per_trigger).writeStream.foreachBatch(publish_batch)
              .option("checkpointLocation", checkpoint or base + "_stream"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
