"""The given tables seen as the shop's source tables.

`Shop` derives every operational table the jobs read (orders, order lines, payments, carts, logs,
dimensions, ...) from the star-schema tables and the event stream, by formulas only: all rows are
kept and nothing is sampled. Amounts become DECIMAL(16,2) before any arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.functions import codes
from tidemart.functions.money import money
from tidemart.session import fit
from tidemart.sources.readers import literal_rows

PAGES = ("home", "good_detail", "cart", "order", "payment")


class Shop:
    """`sized`: the session belongs to this shop, and its shuffles are fitted to the tables read."""

    def __init__(self, spark: SparkSession, folder: str, sized: bool = False):
        self.spark = spark
        self.folder = folder
        self._sized = sized
        self._schemas: dict[str, StructType] = {}

    def table(self, name: str) -> DataFrame:
        """A given table; its footer is read once, however often a query uses the table."""
        path = f"{self.folder}/{name}.parquet"
        if name not in self._schemas:
            if self._sized:
                fit(self.spark, path)
            first = self.spark.read.parquet(path)
            self._schemas[name] = first.schema
            return first
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    # ---- dimensions -------------------------------------------------------------------------

    def sku_info(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("id"),
            money(F.col("p_retailprice")).alias("price"),
            F.col("p_name").alias("sku_name"),
            F.concat_ws(" ", "p_type", "p_name").alias("sku_desc"),
            money(F.col("p_size")).alias("weight"),
            F.lit(1).cast("tinyint").alias("is_sale"),
            F.col("p_size").cast("bigint").alias("spu_id"),
            F.col("p_name").alias("category3_id"),
            F.substring_index("p_brand", "#", -1).cast("bigint").alias("tm_id"),
            F.lit("1994-12-31").cast("timestamp").alias("create_time"))

    def spu_info(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_size").cast("bigint").alias("id"),
            F.concat(F.lit("SPU "), F.col("p_size").cast("string")).alias("spu_name")).distinct()

    def base_category3(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_name").alias("id"), F.substring_index("p_name", " ", -1).alias("name"),
            F.substring_index("p_name", " ", 1).alias("category2_id")).distinct()

    def base_category2(self) -> DataFrame:
        first = F.substring_index("p_name", " ", 1)
        return (self.table("part").groupBy(first.alias("id"))
                .agg(F.min("p_type").alias("category1_id"))
                .select("id", F.upper("id").alias("name"), "category1_id"))

    def base_category1(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_type").alias("id"), F.lower("p_type").alias("name")).distinct()

    def base_trademark(self) -> DataFrame:
        return self.table("part").select(
            F.substring_index("p_brand", "#", -1).cast("bigint").alias("id"),
            F.col("p_brand").alias("tm_name")).distinct()

    def sku_attr_value(self) -> DataFrame:
        def attribute(number, name, value):
            return F.struct(F.lit(number).cast("bigint").alias("attr_id"),
                            F.length(value).cast("bigint").alias("value_id"),
                            F.lit(name).alias("attr_name"), value.alias("value_name"))
        items = F.array(attribute(1, "size", F.col("p_size").cast("string")),
                        attribute(2, "type", F.col("p_type")),
                        attribute(3, "brand", F.col("p_brand")))
        return (self.table("part").select(F.col("p_partkey").alias("sku_id"),
                                          F.explode(items).alias("a")).select("sku_id", "a.*"))

    def sku_sale_attr_value(self) -> DataFrame:
        """Colour, for all but the smallest parts: those have no sales attribute."""
        colour = F.substring_index("p_name", " ", 1)
        return (self.table("part").where(F.col("p_size") > 5).select(
            F.col("p_partkey").alias("sku_id"), F.lit(1).cast("bigint").alias("sale_attr_id"),
            F.length(colour).cast("bigint").alias("sale_attr_value_id"),
            F.lit("colour").alias("sale_attr_name"), colour.alias("sale_attr_value_name")))

    def coupon_info(self) -> DataFrame:
        """One coupon per supplier."""
        amount = money(F.abs("s_acctbal"))
        nation = F.col("s_nationkey")
        return self.table("supplier").select(
            F.col("s_suppkey").alias("id"),
            F.concat(F.lit("coupon of "), F.col("s_name")).alias("coupon_name"),
            F.when(nation < 8, "3201").when(nation < 16, "3202").otherwise("3203")
            .alias("coupon_type"),
            amount.alias("condition_amount"),
            nation.cast("bigint").alias("condition_num"),
            nation.cast("bigint").alias("activity_id"),
            money(amount * F.lit("0.1").cast("decimal(2,1)")).alias("benefit_amount"),
            money(nation).alias("benefit_discount"),
            F.when(F.col("s_acctbal") < 0, "3301").when(F.col("s_acctbal") < 5000, "3302")
            .when(F.col("s_acctbal") < 9000, "3303").otherwise("3399").alias("range_type"),
            F.lit(100).cast("bigint").alias("limit_num"),
            nation.cast("bigint").alias("taken_count"),
            *[F.lit(t).cast("timestamp").alias(n) for n, t in (
                ("create_time", "1994-12-31"), ("start_time", "1995-01-01"),
                ("end_time", "2001-12-31"), ("expire_time", "2002-12-31"))],
            F.lit(None).cast("timestamp").alias("operate_time"))

    def activity_info(self) -> DataFrame:
        key = F.col("r_regionkey")
        return self.table("region").select(
            key.cast("bigint").alias("id"), F.concat("r_name", F.lit(" week")).alias("activity_name"),
            F.when(key < 2, "3101").when(key < 4, "3102").otherwise("3103").alias("activity_type"),
            F.lower("r_name").alias("activity_desc"),
            *[F.lit(t).cast("timestamp").alias(n) for n, t in (
                ("start_time", "1995-01-01"), ("end_time", "2001-12-31"),
                ("create_time", "1994-12-31"))])

    def activity_rule(self) -> DataFrame:
        region, nation = F.col("n_regionkey"), F.col("n_nationkey")
        return self.table("nation").select(
            nation.cast("bigint").alias("id"), region.cast("bigint").alias("activity_id"),
            F.when(region < 2, "3101").when(region < 4, "3102").otherwise("3103")
            .alias("activity_type"),
            money(nation * 10).alias("condition_amount"), nation.cast("bigint").alias("condition_num"),
            money(nation).alias("benefit_amount"), money(region).alias("benefit_discount"),
            region.cast("bigint").alias("benefit_level"))

    def base_dic(self) -> DataFrame:
        return literal_rows(self.spark, codes.DICTIONARY, codes.DICTIONARY_COLUMNS)

    def base_province(self) -> DataFrame:
        """Nations as provinces; region ids 0-4, so every province finds its region."""
        key = F.col("n_nationkey").cast("string")
        return self.table("nation").select(
            F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"),
            F.col("n_regionkey").cast("bigint").alias("region_id"),
            F.lpad(key, 6, "0").alias("area_code"), F.concat(F.lit("CN-"), key).alias("iso_code"),
            F.concat(F.lit("CN-N"), key).alias("iso_3166_2"))

    def base_region(self) -> DataFrame:
        return self.table("region").select(F.col("r_regionkey").cast("bigint").alias("id"),
                                           F.col("r_name").alias("region_name"))

    def promotion_pos(self) -> DataFrame:
        """Places of adverts, one per supplier."""
        return self.table("supplier").select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("pos_location"),
            F.when(F.col("s_acctbal") < 0, "banner").otherwise("list").alias("pos_type"),
            F.when(F.col("s_nationkey") < 12, "algorithm").otherwise("manual")
            .alias("promotion_type"),
            F.lit("1994-12-31").cast("timestamp").alias("create_time"),
            F.lit(None).cast("timestamp").alias("operate_time"))

    def promotion_refer(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").cast("bigint").alias("id"), F.lower("n_name").alias("refer_name"),
            F.lit("1994-12-31").cast("timestamp").alias("create_time"),
            F.lit(None).cast("timestamp").alias("operate_time"))

    def user_info(self) -> DataFrame:
        """Customers as users; the account balance decides on phone and age, the segment on
        e-mail and level, the nation on gender and registration day."""
        key = F.col("c_custkey").cast("string")
        segment = F.col("c_mktsegment")
        created = F.lit("2024-01-05 09:00:00").cast("timestamp") + F.make_dt_interval(
            F.col("c_nationkey"))
        return self.table("customer").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
            F.concat(F.when(F.col("c_acctbal") < 0, "120").otherwise("138"), F.lpad(key, 8, "0"))
            .alias("phone_num"),
            F.when(segment == "FURNITURE", F.concat(F.lit("user"), key))
            .when(segment != "BUILDING", F.concat(F.lit("user"), key, F.lit("@shop.example.com")))
            .alias("email"),
            F.substring(segment, 1, 1).alias("user_level"),
            F.date_add(F.lit("1980-01-01").cast("date"), F.floor("c_acctbal").cast("int"))
            .alias("birthday"),
            F.when(F.col("c_nationkey") < 12, "F").otherwise("M").alias("gender"),
            created.alias("create_time"),
            F.when(F.col("c_acctbal") < 0, created + F.make_dt_interval(F.lit(3)))
            .alias("operate_time"))

    # ---- orders -----------------------------------------------------------------------------

    def _only(self, name: str, key: str, ids: DataFrame | None) -> DataFrame:
        """A table, or its rows of the orders in `ids` (order_id): a semi join on few keys."""
        df = self.table(name)
        if ids is None:
            return df
        return df.join(ids.select(F.col("order_id").alias(key)), key, "left_semi")

    def order_info(self, ids: DataFrame | None = None) -> DataFrame:
        orders, customers = self._only("orders", "o_orderkey", ids), self.table("customer")
        total = money(F.col("o_totalprice"))
        off = F.when(F.col("o_orderpriority") == "1-URGENT",
                     money(total * F.lit("0.05").cast("decimal(2,2)"))).otherwise(money(F.lit(0)))
        coupon = F.when(F.col("o_orderpriority") == "5-LOW",
                        money(F.lit(5))).otherwise(money(F.lit(0)))
        return (orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
            F.col("c_nationkey").cast("bigint").alias("province_id"),
            F.col("o_orderdate").cast("timestamp").alias("create_time"),
            money(total + off + coupon).alias("original_total_amount"),
            off.alias("activity_reduce_amount"), coupon.alias("coupon_reduce_amount"),
            total.alias("total_amount")))

    def order_buyer(self) -> DataFrame:
        """Order and buyer, without the customer's province."""
        return self.table("orders").select(F.col("o_orderkey").alias("id"),
                                           F.col("o_custkey").alias("user_id"))

    def buyer_province(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_nationkey").cast("bigint").alias("province_id"))

    def order_detail(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Order lines; the line's creation day is its ship date.

        The bounds are applied to the stored column, so the file scan can skip other days.
        """
        lines = self.table("lineitem")
        if first is not None:
            lines = lines.where(F.col("l_shipdate") >= F.lit(first).cast("timestamp_ntz"))
        if last is not None:
            lines = lines.where(F.col("l_shipdate")
                                < F.date_add(F.lit(last), 1).cast("timestamp_ntz"))
        price, pieces = money(F.col("l_extendedprice")), F.col("l_quantity").cast("bigint")
        off = F.when(F.col("l_discount") > 0,
                     money(price * F.col("l_discount").cast("decimal(4,2)")))
        coupon = F.when(F.col("l_returnflag") == "R",
                        money(price * F.col("l_tax").cast("decimal(4,2)")))
        created = F.col("l_shipdate").cast("timestamp")
        return lines.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
            created.alias("create_time"), pieces.alias("sku_num"), price.alias("order_price"),
            money(pieces * price - F.coalesce(off, F.lit(0)) - F.coalesce(coupon, F.lit(0)))
            .alias("split_total_amount"),
            off.alias("split_activity_amount"), coupon.alias("split_coupon_amount"),
            F.date_format(created, "yyyy-MM-dd").alias("ds"))

    def order_days(self, first: str, last: str) -> DataFrame:
        """Orders of some days (order_id, ds); the bounds reach the scan."""
        orders = self.table("orders").where(
            (F.col("o_orderdate") >= F.lit(first).cast("timestamp_ntz"))
            & (F.col("o_orderdate") < F.date_add(F.lit(last), 1).cast("timestamp_ntz")))
        return orders.select(F.col("o_orderkey").alias("order_id"),
                             F.date_format("o_orderdate", "yyyy-MM-dd").alias("ds"))

    def order_detail_by_order_day(self, first: str, last: str) -> DataFrame:
        """Lines of the orders of some days, dated like the order."""
        return self.order_detail().drop("ds").join(self.order_days(first, last), "order_id")

    def order_detail_activity(self, ids: DataFrame | None = None) -> DataFrame:
        """Line numbers 1-4 are known activities (regions), higher ones are not."""
        return (self._only("lineitem", "l_orderkey", ids).where(F.col("l_discount") > 0).select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_detail_id"),
            F.col("l_linenumber").cast("bigint").alias("activity_id"),
            F.col("l_linenumber").cast("bigint").alias("activity_rule_id")).distinct())

    def order_detail_coupon(self, ids: DataFrame | None = None) -> DataFrame:
        return (self._only("lineitem", "l_orderkey", ids).where(F.col("l_returnflag") == "R")
                .groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber"))
                         .alias("order_detail_id"))
                .agg(F.min("l_suppkey").alias("coupon_id")))

    def payment_info(self, ids: DataFrame | None = None) -> DataFrame:
        """Orders with status F or P are paid, one second per unit of price after the order."""
        paid = F.col("o_orderstatus").isin("F", "P")
        return self._only("orders", "o_orderkey", ids).select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "1101")
            .when(F.col("o_orderpriority") == "2-HIGH", "1102")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "1103").otherwise("1199")
            .alias("payment_type"),
            F.when(paid, "1602").otherwise("1601").alias("payment_status"),
            money(F.col("o_totalprice")).alias("total_amount"),
            F.when(paid, self._paid_at()).alias("callback_time"))

    @staticmethod
    def _paid_at():
        return F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
                                   + F.floor("o_totalprice").cast("bigint"))

    def order_status_log(self) -> DataFrame:
        """Every order is logged as open, orders with status F also as finished a week after
        payment."""
        opened = F.struct(F.lit("1001").alias("order_status"),
                          F.col("o_orderdate").cast("timestamp").alias("create_time"))
        finished = F.when(F.col("o_orderstatus") == "F", F.struct(
            F.lit("1004").alias("order_status"),
            (self._paid_at() + F.make_dt_interval(F.lit(7))).alias("create_time")))
        return (self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.explode(F.array_compact(F.array(opened, finished))).alias("s"))
            .select("order_id", "s.*"))

    def coupon_use(self) -> DataFrame:
        """Lines with a coupon; used when the order is paid."""
        links = self.order_detail_coupon()
        orders = self.table("orders").select(
            "o_orderkey", "o_custkey",
            F.when(F.col("o_orderstatus").isin("F", "P"), self._paid_at()).alias("used_time"))
        order_id = F.expr("order_detail_id div 10")
        return (links.withColumn("order_id", order_id)
                .join(orders, F.col("order_id") == F.col("o_orderkey"), "inner")
                .select(F.col("order_detail_id").alias("id"), "coupon_id",
                        F.col("o_custkey").alias("user_id"), "order_id", "used_time"))

    # ---- behaviour --------------------------------------------------------------------------

    def events(self) -> DataFrame:
        """Events with the parsed key `k` and an absolute time."""
        return with_event_key(self.table("events"))

    def cart_info(self) -> DataFrame:
        return (self.events().where(F.col("event_type") == "click").select(
            F.col("event_id").alias("id"), "user_id", F.col("k").alias("sku_id"),
            F.concat(F.lit("product "), F.col("k").cast("string")).alias("sku_name"),
            (F.floor(F.col("value") / 100) + 1).cast("bigint").alias("sku_num"),
            F.when(F.col("value") > 60, "1").otherwise("0").alias("is_ordered"),
            F.col("ts").alias("create_time"), F.date_format("ts", "yyyy-MM-dd").alias("ds")))

    def favor_info(self) -> DataFrame:
        return (self.events().where(F.col("event_type") == "signup").select(
            F.col("event_id").alias("id"), "user_id", F.col("k").alias("sku_id"),
            F.col("ts").alias("create_time")))

    def searches(self) -> DataFrame:
        return (self.events().where(F.col("event_type") == "view").select(
            F.date_format("ts", "yyyy-MM-dd").alias("ds"), "user_id",
            F.concat(F.lit("w"), F.col("k").cast("string")).alias("term")))

    def z_log(self) -> DataFrame:
        return log_lines(self.table("events"))

    def documents(self) -> DataFrame:
        return self.table("documents").select(F.col("doc_id").alias("comment_id"),
                                              F.col("source").alias("user_id"),
                                              F.col("text").alias("review_text"))


def with_event_key(events: DataFrame) -> DataFrame:
    return (events.withColumn("ts", F.col("ts").cast("timestamp"))
            .withColumn("k", F.get_json_object("props", "$.k").try_cast("bigint")))


def log_lines(events: DataFrame) -> DataFrame:
    """One JSON log line per event, for a table as well as for a stream.

    Events with a value above 300 are garbled text, those above 290 carry a time beyond all
    calendars. Errors carry no user id.
    """
    e = with_event_key(events)
    user, k = F.col("user_id"), F.col("k")
    kind = F.col("event_type")
    brand = F.concat(F.lit("brand"), (user % 4).cast("string"))
    page = F.array(*[F.lit(p) for p in PAGES])
    line = F.to_json(F.struct(
        F.struct(
            (user % 25).cast("string").alias("ar"), brand.alias("ba"),
            F.concat(F.lit("channel"), (user % 3).cast("string")).alias("ch"),
            F.when(k < 50, "1").otherwise("0").alias("is_new"),
            F.concat(brand, F.lit(" X")).alias("md"),
            F.concat(F.lit("m"), user.cast("string")).alias("mid"),
            F.when(user % 2 == 0, "Android").otherwise("iOS").alias("os"),
            F.concat(F.lit("s"), user.cast("string"), F.date_format("ts", "-yyyyMMdd"))
            .alias("sid"),
            F.when(kind != "error", user.cast("string")).alias("uid"),
            F.concat(F.lit("v2."), (user % 5).cast("string")).alias("vc")).alias("common"),
        F.struct(
            k.cast("string").alias("item"), F.lit("sku_id").alias("item_type"),
            F.get(page, ((k + 1) % 5).cast("int")).alias("last_page_id"),
            F.get(page, (k % 5).cast("int")).alias("page_id"),
            F.when(k < 10, k.cast("string")).alias("from_pos_id"),
            F.when(k < 10, "1").alias("from_pos_seq"),
            F.when(k < 25, k.cast("string")).alias("refer_id"),
            F.floor(F.col("value") * 1000).cast("bigint").alias("during_time")).alias("page"),
        F.when(kind == "signup", F.struct(F.lit("icon").alias("entry"))).alias("start"),
        F.when(kind == "error", F.struct(k.alias("error_code"))).alias("err"),
        F.when(kind == "view", F.array(F.struct(k.cast("string").alias("item"))))
        .alias("displays"),
        F.when(kind == "click", F.array(F.struct(F.lit("cart_add").alias("action_id"))))
        .alias("actions"),
        F.when(F.col("value") > 290, F.lit(2**63 - 1)).otherwise(F.unix_millis("ts")).alias("ts")))
    text = F.when(F.col("value") > 300, F.concat(F.lit("garbled "), F.col("event_id").cast("string")))
    return e.select(F.col("event_id").alias("id"), F.coalesce(text, line).alias("log"))
