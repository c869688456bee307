import pytest
from pyspark.sql import functions as F

from tidemart import session
from tidemart.plans import daily, facts
from tidemart.queries import QUERIES
from tidemart.session import (
    SHUFFLE_BYTES, SQL_SETTINGS, WarehouseSession, fit, prepare, scratch_path, scratch_root)
from tidemart.sources import readers, tables, writers
from tidemart.sources.shop import Shop


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_scratch_is_the_configured_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_write_partition_replaces_and_empties(spark):
    path = scratch_path(spark, "parts")
    df = spark.createDataFrame([(1, "2025-01-01"), (2, "2025-01-01")], "k int, ds string")
    writers.write_partition(df, path, "2025-01-01")
    writers.write_partition(df, path, "2025-01-02")
    writers.write_partition(df.where("k = 2"), path, "2025-01-01")
    stored = readers.read_table(spark, path)
    assert dict(stored.dtypes)["ds"] == "string"
    assert rows(stored, "k", "ds") == [(1, "2025-01-02"), (2, "2025-01-01"), (2, "2025-01-02")]
    writers.write_partition(df.where("false"), path, "2025-01-02")
    assert rows(readers.read_table(spark, path), "k", "ds") == [(2, "2025-01-01")]


def test_partition_is_pruned(spark):
    path = scratch_path(spark, "prune")
    writers.write_by_day(spark.createDataFrame([(1, "2025-01-01"), (2, "2025-01-02")],
                                               "k int, ds string"), path)
    df = readers.scan_day(readers.read_table(spark, path), "2025-01-02")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan
    assert rows(df, "k") == [(2,)]
    both = readers.scan_days(readers.read_table(spark, path), "2025-01-02")
    assert both.count() == 2


def test_dynamic_write_leaves_other_days(spark):
    path = scratch_path(spark, "days")
    writers.write_by_day(spark.createDataFrame([(1, "a"), (2, "b")], "k int, ds string"), path)
    writers.write_by_day(spark.createDataFrame([(3, "b"), (4, "c")], "k int, ds string"), path)
    assert rows(readers.read_table(spark, path), "k", "ds") == [(1, "a"), (3, "b"), (4, "c")]


def test_replace_table_from_itself(spark):
    path = scratch_path(spark, "self")
    writers.replace_table(spark.range(5).toDF("k"), path)
    table = readers.read_table(spark, path)
    writers.replace_table(table.select((F.col("k") + 1).alias("k")), path)
    assert rows(readers.read_table(spark, path), "k") == [(1,), (2,), (3,), (4,), (5,)]


def test_interrupted_swap_is_repaired(spark):
    path = scratch_path(spark, "swap")
    writers.append_distinct(spark.range(2).toDF("k"), path)
    fs, target = writers._filesystem(spark, path)
    fs.rename(target, spark._jvm.org.apache.hadoop.fs.Path(path + "__previous"))
    writers.append_distinct(spark.range(1, 3).toDF("k"), path)
    assert rows(readers.read_table(spark, path), "k") == [(0,), (1,), (2,)]


def test_tsv_keeps_null_and_empty(spark):
    path = scratch_path(spark, "tsv")
    df = spark.createDataFrame([("a\tb", None, 1), ("", "x\"y", None)], "a string, b string, c int")
    writers.write_tsv(df, path)
    back = readers.read_tsv(spark, path, "a string, b string, c int")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_json_lines(spark):
    path = scratch_path(spark, "json")
    df = readers.literal_rows(spark, [(1, "x"), (2, None)], "k bigint, v string")
    writers.write_json_lines(df, path)
    assert rows(readers.read_json_lines(spark, path, "k bigint, v string"), "k", "v") == [
        (1, "x"), (2, None)]
    assert [r.value for r in writers.json_messages(df).collect()] == ['{"k":1,"v":"x"}', '{"k":2}']


def test_tombstones(spark):
    df = spark.createDataFrame([(bytearray(b"x"),), (None,)], "value binary")
    assert [r.value for r in readers.message_text(df).collect()] == ["x"]


def test_jdbc_options():
    plain = readers.jdbc_options("jdbc:x", "select 1", user="u", password="p")
    assert plain["query"] == "select 1" and "dbtable" not in plain
    ranged = readers.jdbc_options("jdbc:x", "select id from t", partition_column="id", lower=0,
                                  upper=100, partitions=8)
    assert ranged["dbtable"] == "(select id from t) t"
    assert (ranged["lowerBound"], ranged["upperBound"], ranged["numPartitions"]) == ("0", "100", "8")


def test_kafka_options():
    options = readers.kafka_options("h:1", "t", group="g", starting="latest", per_trigger=5)
    assert options["subscribe"] == "t" and options["kafka.group.id"] == "g"
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "5"
    assert writers.KAFKA_PRODUCER["kafka.acks"] == "all"


def test_changed_since(spark):
    df = spark.createDataFrame([(1, "2024-01-01", None), (2, "2024-01-01", "2024-01-09"),
                                (3, "2024-01-09", None)], "k int, c string, o string").select(
        "k", F.to_timestamp("c").alias("create_time"), F.to_timestamp("o").alias("operate_time"))
    assert rows(readers.changed_since(df, "2024-01-09"), "k") == [(2,), (3,)]
    assert "operate_time >= '2024-01-09'" in readers.changed_since_query("t", "2024-01-09")


def test_session_context(spark):
    # The running session is reused; leaving the block would stop it, so only entering is tried.
    session = WarehouseSession("again", {"spark.sql.shuffle.partitions": "4"})
    assert session.__enter__().sparkContext is not None


def test_remote_session_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Remote:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError):
        scratch_root(Remote())


def test_declared_table_replaces_only_its_days(spark):
    path = scratch_path(spark, "declared")
    df = spark.createDataFrame([(1, "x", "2025-01-01"), (2, "y", "2025-01-02")],
                               "k int, v string, ds string")
    tables.declare_table(df, "declared_orders", path)
    tables.insert_day(df, "declared_orders")
    tables.insert_day(df.where("k = 2").withColumn("k", F.lit(3)), "declared_orders")
    stored = spark.table("declared_orders")
    assert rows(stored, "k", "ds") == [(1, "2025-01-01"), (3, "2025-01-02")]
    assert stored.schema["ds"].dataType.simpleString() == "string"
    writers.write_partition(df.where("k = 1"), path, "2025-01-03")
    tables.refresh_days(spark, "declared_orders")
    assert spark.table("declared_orders").where("ds = '2025-01-03'").count() == 1
    spark.sql("DROP TABLE declared_orders")
    assert readers.read_table(spark, path).count() == 3


def test_declared_text_table(spark):
    path = scratch_path(spark, "declared-tsv")
    df = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    writers.write_tsv(df, path)
    tables.declare_tsv(df, "declared_report", path)
    assert rows(spark.table("declared_report").na.fill("-"), "k", "v") == [(1, "-"), (2, "b")]


def test_sizes_follow_the_tables_of_a_query(spark, monkeypatch):
    from tidemart import session

    before = dict(spark.conf.getAll)
    own = prepare(spark)
    assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    fit(own, "/root/testdata/sf0.001")
    assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(session, "table_bytes", lambda *_: 100 * 10**12)
    fit(own, "large")
    assert int(own.conf.get("spark.sql.shuffle.partitions")) == -(-100 * 10**12 // SHUFFLE_BYTES)
    assert all(own.conf.get(k) == v for k, v in SQL_SETTINGS.items())
    assert dict(spark.conf.getAll) == before


def test_tasks_of_a_large_table_are_not_merged_again(spark, monkeypatch):
    """A table of 320 MB, stored: adaptive execution would merge its stages to one task per core."""
    own = prepare(spark)
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    own.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1")  # the rows are few here
    monkeypatch.setattr(session, "table_bytes", lambda *_: 320 * 2**20)
    shop = Shop(own, "/root/testdata/sf0.001", sized=True)
    rows = daily.user_order(facts.order_line_measures(shop.order_detail(), shop.order_buyer(), "user_id"))
    assert rows.select(F.spark_partition_id()).distinct().count() >= 30
    assert "spark.sql.adaptive.coalescePartitions.minPartitionNum" not in spark.conf.getAll


def test_buckets_grow_with_the_table(spark, monkeypatch):
    for size, buckets in ((0, 8), (160 * 2**20, 10), (10 * 2**30, 640), (10**15, 100_000)):
        monkeypatch.setattr(tables, "table_bytes", lambda *_, size=size: size)
        assert tables.buckets_for(spark, "any") == buckets
    monkeypatch.setattr(tables, "table_bytes", lambda *_: 160 * 2**20)
    plan = QUERIES["order_totals_bucketed"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
    assert plan.toString().count("10 out of 10") == 2
