"""Incremental cleaning of landed monthly files with Structured Streaming.

The batch loader skips months whose files are already present and cleans
every file once. The streaming file source gives the same contract natively:
each run (``availableNow``) picks up only files it has not seen, recorded in
the checkpoint, cleans them and commits them to the clean zone through the
file sink's transaction log, so a retried or restarted run never cleans a
file twice and never leaves a half-written month behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdemand.operators import cleaning
from tripdemand.sources.trips import typed, wide_schema

_CLEANERS = {"yellow": cleaning.clean_yellow, "fhvhv": cleaning.clean_hvfhv}


def landed_stream(spark: SparkSession, root: str, service: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming view of one service's landed files, with ``file_month``."""
    reader = spark.readStream.schema(wide_schema(service))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return typed(reader.parquet(f"{root.rstrip('/')}/{service}_tripdata_*.parquet"), service)


def clean_new_files(spark: SparkSession, root: str, service: str, clean_root: str,
                    checkpoint: str, max_files_per_trigger: int | None = None) -> int:
    """Clean every landed file of ``service`` not yet processed; returns rows read.

    Runs to completion (``availableNow``) and stops, so it can be scheduled
    like the batch job it replaces. Each service is its own query with its
    own sink folder (``clean_root/<service>``) and its own ``checkpoint``,
    both on shared storage: a file sink keeps one commit log per folder.
    ``max_files_per_trigger`` cuts a backlog into micro-batches.
    """
    cleaned = _CLEANERS[service](landed_stream(spark, root, service, max_files_per_trigger))
    query = (cleaned.writeStream.format("parquet")
             .option("checkpointLocation", checkpoint)
             .partitionBy("file_month")
             .outputMode("append")
             .trigger(availableNow=True)
             .start(f"{clean_root.rstrip('/')}/{service}"))
    query.awaitTermination()
    progress = query.recentProgress
    return sum(p.get("numInputRows", 0) for p in progress) if progress else 0


def read_incremental_clean(spark: SparkSession, clean_root: str,
                           services=tuple(_CLEANERS)) -> DataFrame:
    """Committed clean rows of all services (each folder read through its commit log)."""
    frames = [spark.read.parquet(f"{clean_root.rstrip('/')}/{s}") for s in services]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.withColumn("file_month", F.col("file_month").cast("string"))
