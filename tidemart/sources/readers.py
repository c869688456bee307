"""Table scans, text files, JSON lines, JDBC and Kafka readers."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.functions.days import shift


def scan_day(table: DataFrame, day: str) -> DataFrame:
    """One day partition."""
    return table.where(F.col("ds") == day)


def scan_days(table: DataFrame, day: str, back: int = 1) -> DataFrame:
    """The day and the `back` days before it, as a list so that partitions are pruned."""
    return table.where(F.col("ds").isin([shift(day, -n) for n in range(back + 1)]))


def read_table(spark: SparkSession, path: str, fmt: str = "orc") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated text with a declared schema; `\\N` is null, as in text tables."""
    return spark.read.csv(path, schema=schema, sep="\t", nullValue="\\N")


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object per line."""
    return spark.read.schema(schema).json(path)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few rows written down in code.

    They travel as an Arrow table: Spark then knows how small they are and broadcasts them in a
    join, whereas a frame made from Python tuples counts as infinitely large.
    """
    fields = StructType.fromDDL(schema)
    arrays = [pa.array(values) for values in zip(*rows)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=fields.names), fields)


def jdbc_options(url: str, query: str, *, user: str | None = None, password: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 lower: object = None, upper: object = None, partitions: int = 1,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options for a query; column aliases of the query become the column names.

    With `partition_column` the query is read by `partitions` connections over value ranges.
    Spark takes a partitioned query only as a sub-query in `dbtable`.
    """
    options = {"url": url, "fetchsize": str(fetch_size)}
    for name, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            options[name] = value
    if partition_column is None:
        return {**options, "query": query}
    return {**options, "dbtable": f"({query}) t", "partitionColumn": partition_column,
            "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions)}


def read_jdbc(spark: SparkSession, url: str, query: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, query, **kwargs)).load()


def changed_since(table: DataFrame, day: str, created: str = "create_time",
                  operated: str = "operate_time") -> DataFrame:
    """Rows created or modified on or after the day."""
    start = F.lit(day).cast("timestamp")
    return table.where((F.col(created) >= start) | (F.col(operated) >= start))


def changed_since_query(table: str, day: str, created: str = "create_time",
                        operated: str = "operate_time") -> str:
    """The same filter as text for a JDBC source, so that the database does the filtering."""
    return f"select * from {table} where {created} >= '{day}' or {operated} >= '{day}'"


def kafka_options(servers: str, topic: str, group: str | None = None,
                  starting: str = "earliest", per_trigger: int | None = None) -> dict[str, str]:
    """Options of the Kafka reader; new partitions are picked up by Spark itself."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic,
               "startingOffsets": starting, "failOnDataLoss": "true"}
    if group is not None:
        options["kafka.group.id"] = group
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def read_kafka(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    """Stream of message texts."""
    stream = (spark.readStream.format("kafka")
              .options(**kafka_options(servers, topic, **kwargs)).load())
    return message_text(stream)


def message_text(messages: DataFrame) -> DataFrame:
    """Message values as text. Messages without a value (tombstones) are left out."""
    return (messages.where(F.col("value").isNotNull())
            .withColumn("value", F.col("value").cast("string")))


def read_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Stream of text lines, for trials only: a socket cannot be replayed after a failure."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


COMMON = ("common struct<ar:string, ba:string, ch:string, is_new:string, md:string, mid:string,"
          " os:string, sid:string, uid:string, vc:string>")
PAGE = ("page struct<item:string, item_type:string, last_page_id:string, page_id:string,"
        " from_pos_id:string, from_pos_seq:string, refer_id:string, during_time:bigint>")
SECTIONS = ("start struct<entry:string>, err struct<error_code:bigint>,"
            " displays array<struct<item:string>>, actions array<struct<action_id:string>>")
TIME = "ts bigint"
LOG_SCHEMA = f"{COMMON}, {PAGE}, {SECTIONS}, {TIME}"


def parse_log(lines: DataFrame, text: str = "log", schema: str = LOG_SCHEMA) -> DataFrame:
    """Add the parsed columns `common`, `page`, ..., `ts` to rows with a log line.

    Lines that are not JSON get nulls. `schema` names the parts a job needs; the parser skips the
    others. It runs inside a generator: a later filter on a parsed column then cannot be moved
    below it, where Spark would parse every line a second time.
    """
    return lines.select("*", F.inline(F.array(F.from_json(F.col(text), schema))))
