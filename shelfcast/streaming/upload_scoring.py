"""Uploads scored as they land (the batch-scoring page, M17, as a stream).

The stream's rows are the *paths* of new CSV files; each micro-batch finds its files' headers in one job and
reads all files of one header at once by column name (columns may stand in any order, and differ between files). It joins them to
the static store dimension, scores them with a fitted pipeline and writes one folder ``batch=<id>``. A batch that is
repeated after a failure overwrites its own folder, and the checkpoint beside the output remembers
which files are done, so a restarted query neither drops nor repeats uploaded rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelfcast.operators.scoring import batch_score
from shelfcast.sources.csv_io import by_header, read_upload

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
FILES_PER_BATCH = 1000  # paths that the driver holds per micro-batch


def uploaded_files(spark: SparkSession, input_dir: str, max_files_per_trigger: int = FILES_PER_BATCH) -> DataFrame:
    """New files as a stream of paths; their content is read by the micro-batch, not by the stream."""
    return (spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", "*.csv")
            .option("maxFilesPerTrigger", max_files_per_trigger).load(input_dir).select("path"))


def start_upload_scoring(spark: SparkSession, model: PipelineModel, store: DataFrame, input_dir: str,
                         output_dir: str, checkpoint: str | None = None, available_now: bool = False,
                         processing_time: str = "30 seconds",
                         max_files_per_trigger: int = FILES_PER_BATCH) -> StreamingQuery:
    """Start the query; ``checkpoint`` defaults to a folder inside ``output_dir`` that readers ignore."""
    out = output_dir.rstrip("/")

    def score(files: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in files.collect()]  # at most max_files_per_trigger
        if paths:
            parts = [batch_score(model, read_upload(spark, same), store) for same in by_header(spark, paths)]
            if not parts:  # only empty files
                return
            with_id = any("id" in p.columns for p in parts)
            reduce(lambda a, b: a.unionByName(b, allowMissingColumns=with_id), parts) \
                .write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = (uploaded_files(spark, input_dir, max_files_per_trigger).writeStream.foreachBatch(score)
              .option("checkpointLocation", checkpoint or f"{out}/_checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
