"""Partitioned, idempotent and text output."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.merging import union_distinct

FORMAT = "orc"
COMPRESSION = "snappy"


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target)


def write_partition(df: DataFrame, path: str, day: str, fmt: str = FORMAT) -> None:
    """Replace one day. Writing into the day's folder also empties it when there are no rows."""
    (df.drop("ds").write.format(fmt).mode("overwrite").option("compression", COMPRESSION)
     .save(f"{path}/ds={day}"))


def write_by_day(df: DataFrame, path: str, column: str = "ds", fmt: str = FORMAT) -> None:
    """Replace every day that occurs in the rows and leave the others alone.

    The rebalance hint gathers a day's rows into few files and splits a day that is too large for
    one task.
    """
    (df.hint("rebalance", F.col(column)).write.format(fmt).mode("overwrite")
     .option("compression", COMPRESSION).option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).save(path))


def replace_table(df: DataFrame, path: str, fmt: str = FORMAT, **options) -> None:
    """Replace a whole table, which the rows may have been read from.

    Spark must not overwrite what it reads, so the rows go to a sibling folder first and the
    folders are swapped when they are complete. A swap that was cut short is put right by the
    next call.
    """
    spark = df.sparkSession
    fs, target = _filesystem(spark, path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    previous = jpath(path + "__previous")
    restore(spark, path)
    staging = f"{path}__staging_{uuid.uuid4().hex}"
    df.write.format(fmt).options(compression=COMPRESSION, **options).save(staging)
    if fs.exists(target):
        fs.delete(previous, True)
        _rename(fs, target, previous)
    else:
        fs.mkdirs(target.getParent())
    _rename(fs, jpath(staging), target)
    fs.delete(previous, True)


def restore(spark: SparkSession, path: str) -> None:
    """Bring the previous table back when a swap stopped between its two renames."""
    fs, target = _filesystem(spark, path)
    previous = spark._jvm.org.apache.hadoop.fs.Path(path + "__previous")
    if not fs.exists(target) and fs.exists(previous):
        _rename(fs, previous, target)


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"could not rename {source} to {target}")


def append_distinct(new: DataFrame, path: str, fmt: str = FORMAT) -> None:
    """Add rows to a report table; rows it already holds are not repeated.

    A rerun that yields other numbers keeps both versions.
    """
    spark = new.sparkSession
    restore(spark, path)
    history = (spark.read.format(fmt).schema(new.schema).load(path)
               if exists(spark, path) else None)
    replace_table(union_distinct(history, new), path, fmt)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", nullValue="\\N",
                                   timestampFormat="yyyy-MM-dd HH:mm:ss")


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def json_messages(df: DataFrame) -> DataFrame:
    """Each row as one JSON text, the value of a message."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


# Producer settings: a message counts as sent when all replicas have it; retries do not repeat it.
KAFKA_PRODUCER = {
    "kafka.acks": "all",
    "kafka.retries": "2147483647",
    "kafka.enable.idempotence": "true",
    "kafka.max.request.size": "10485760",
}


def send_to_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Send a bounded set of rows as JSON messages."""
    (json_messages(df).write.format("kafka").options(**KAFKA_PRODUCER)
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def stream_to_kafka(stream: DataFrame, servers: str, topic: str, checkpoint: str):
    return (json_messages(stream).writeStream.format("kafka").options(**KAFKA_PRODUCER)
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())
