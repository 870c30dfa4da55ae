"""Report folders as a file stream (S13 with exactly-once bookkeeping).

The daily job's "new files since the last run" is what Structured Streaming's
file source tracks in its checkpoint: each micro-batch sees only files it has
not processed, and a restarted query resumes from the checkpoint.  With
``availableNow`` the query drains what is there and stops, so it runs on the
same schedule as the batch job.  Each micro-batch goes through the same
date-dedup rule as the batch ingest and is appended to the raw table.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import dedup as DD
from tallyspark.sources import csv_reports as C
from tallyspark.sources.catalog import table_columns
from tallyspark.sources.files import with_file_rank
from tallyspark.sources.sinks import append_raw

log = logging.getLogger(__name__)


def report_file_stream(spark: SparkSession, folder: str, glob: str = "*.csv", max_files: int = 1000) -> DataFrame:
    """Streaming (path, modificationTime, length, content) of new report files, at most ``max_files`` per batch.

    Files wait for a later batch, none is dropped; the first file of a date wins across batches too,
    because a batch sees the dates its predecessors loaded.
    """
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return (spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob)
            .option("maxFilesPerTrigger", max_files).load(folder))


def start_dated_ingest(spark: SparkSession, folder: str, target_path: str, checkpoint: str,
                       date_col: str, date_format: str = "rpp_range", glob: str = "*.csv",
                       encoding: str = "UTF-8", available_now: bool = True, max_files: int = 1000):
    """Stream new header-CSV report files into a raw table, first file per date wins.

    ``checkpoint`` must be on the shared file system (e.g. under the session's
    ``spark.checkpoint.dir``).
    """
    def load(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        rows, status = C.parse_header_lines(C.lines_from_binary(batch, encoding), [date_col])
        for r in status.where("state <> 'ok'").collect():      # one row per file of this batch
            log.warning("%s left out: %s", r.path, r.reason)
        if rows is None:
            return
        ranked = with_file_rank(batch, "modificationTime").select(F.col("path").alias("source_file"), "file_rank")
        rows = rows.join(ranked, "source_file")
        target = spark.read.parquet(target_path) if table_columns(spark, target_path) is not None else None
        accepted = DD.first_writer_wins(rows, target, date_col, "file_rank", date_format)
        append_raw(spark, accepted, target_path, date_col)

    w = (report_file_stream(spark, folder, glob, max_files).writeStream.foreachBatch(load)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()

