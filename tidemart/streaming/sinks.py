"""Starting queries: checkpoints, file output, batch functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.functions.days import day_bucket

# Output is committed with the checkpoint in this rhythm (fixed value: 30 s).
TRIGGER = "30 seconds"
# Rows per output file; together with the trigger this takes the place of size and time rolling.
FILE_ROWS = 1_000_000


def _start(writer, checkpoint: str, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": TRIGGER}
    return writer.trigger(**trigger).start()


def to_files(stream: DataFrame, path: str, checkpoint: str, *, partition_by: str | None = None,
             fmt: str = "parquet", once: bool = False) -> StreamingQuery:
    """Append to files, each row exactly once: the sink's log and the checkpoint agree on which
    files count, also after a failure or restart."""
    writer = (stream.writeStream.format(fmt).outputMode("append").option("path", path)
              .option("maxRecordsPerFile", FILE_ROWS))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return _start(writer, checkpoint, once)


def to_day_buckets(stream: DataFrame, field: str, path: str, checkpoint: str,
                   once: bool = False) -> StreamingQuery:
    """JSON text (`value`) into one folder per day of an epoch field, `error_bucket` otherwise."""
    epoch = F.get_json_object("value", f"$.{field}").try_cast("bigint")
    day = F.regexp_replace(day_bucket(epoch), "^day=", "")
    return to_files(stream.withColumn("day", day), path, checkpoint, partition_by="day",
                    once=once)


def per_batch(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, *,
              mode: str = "append", once: bool = False) -> StreamingQuery:
    """Hand each micro-batch to a function. It must cope with seeing a batch twice."""
    return _start(stream.writeStream.outputMode(mode).foreachBatch(apply), checkpoint, once)


def keep_latest_result(path: str) -> Callable[[DataFrame, int], None]:
    """Batch function for complete mode: one folder per batch, rewritten when repeated.

    The folder before the last one stays for readers that began with it, older ones are removed.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number:019d}")
        spark = batch.sparkSession
        root = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("batch=") and int(name.removeprefix("batch=")) < number - 1:
                fs.delete(status.getPath(), True)
    return write


def latest_result(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last batch written by `keep_latest_result`."""
    rows = spark.read.parquet(path)
    last = rows.agg(F.max("batch").alias("batch"))
    return rows.join(last, "batch", "left_semi").drop("batch")


def to_console(stream: DataFrame, checkpoint: str) -> StreamingQuery:
    return _start(stream.writeStream.format("console").outputMode("append"), checkpoint, False)


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an `availableNow` query; its failure is raised here."""
    query.awaitTermination()
