"""Detail facts. Rows carry the business day in `ds`, which partitions the stored table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import codes
from tidemart.functions.days import FAR_DAY, in_range, iso_day, iso_time, shift, shop_time
from tidemart.functions.money import money, or_zero
from tidemart.operators.lookup import decode
from tidemart.operators.merging import fill_columns
from tidemart.operators.ranking import first_rows, latest_rows
from tidemart.sources.readers import COMMON, PAGE, TIME, parse_log


def cart_add(cart: DataFrame) -> DataFrame:
    day = iso_day(F.col("create_time"))
    return cart.select("id", "user_id", "sku_id", day.alias("date_id"),
                       iso_time(F.col("create_time")).alias("create_time"), "sku_num",
                       day.alias("ds"))


def cart_snapshot(cart: DataFrame, day: str) -> DataFrame:
    """Cart rows of the day's snapshot that are not ordered yet."""
    return (cart.where(F.col("is_ordered") == "0")
            .select("id", "user_id", "sku_id", "sku_name", "sku_num", F.lit(day).alias("ds")))


def line_amounts(lines: DataFrame) -> DataFrame:
    """Lines with their four amounts; missing discounts are zero."""
    return lines.select(
        "id", "order_id", "sku_id", "create_time", "sku_num",
        money(F.col("sku_num") * F.col("order_price")).alias("split_original_amount"),
        or_zero(F.col("split_activity_amount")).alias("split_activity_amount"),
        or_zero(F.col("split_coupon_amount")).alias("split_coupon_amount"),
        money(F.col("split_total_amount")).alias("split_total_amount"))


def _with_links(lines: DataFrame, activity_links: DataFrame, coupon_links: DataFrame) -> DataFrame:
    acts = activity_links.select(F.col("order_detail_id").alias("id"), "activity_id",
                                 "activity_rule_id")
    coupons = coupon_links.select(F.col("order_detail_id").alias("id"), "coupon_id")
    return lines.join(acts, "id", "left").join(coupons, "id", "left")


def order_line(lines: DataFrame, orders: DataFrame, activity_links: DataFrame,
               coupon_links: DataFrame) -> DataFrame:
    """Order lines with buyer, province, activity and coupon; partition = creation day."""
    heads = orders.select(F.col("id").alias("order_id"), "user_id", "province_id")
    joined = _with_links(line_amounts(lines).join(heads, "order_id", "left"),
                         activity_links, coupon_links)
    day = iso_day(F.col("create_time"))
    return joined.select(
        "id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id",
        "coupon_id", day.alias("date_id"), iso_time(F.col("create_time")).alias("create_time"),
        "sku_num", "split_original_amount", "split_activity_amount", "split_coupon_amount",
        "split_total_amount", day.alias("ds"))


def order_line_measures(lines: DataFrame, orders: DataFrame, owner: str) -> DataFrame:
    """What a daily aggregate reads of `order_line`: no links, and only the owning column
    (`user_id` or `province_id`) of the order."""
    heads = orders.select(F.col("id").alias("order_id"), owner)
    return (line_amounts(lines).join(heads, "order_id", "left")
            .select("order_id", owner, "sku_id", "sku_num", "split_original_amount",
                    "split_activity_amount", "split_coupon_amount", "split_total_amount",
                    iso_day(F.col("create_time")).alias("ds")))


def order_totals(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """(order_id, user_id, line_count, sku_num, original_amount) per order with lines.

    Join and aggregate share the order as key: over tables stored in buckets of it (`sources.tables.store_bucketed`)
    neither needs an exchange.
    """
    return order_line_measures(lines, orders, "user_id").groupBy("order_id").agg(
        F.max("user_id").alias("user_id"), F.count("*").cast("bigint").alias("line_count"),
        F.sum("sku_num").cast("bigint").alias("sku_num"),
        F.sum("split_original_amount").cast("decimal(26,2)").alias("original_amount"))


def payment_line(lines: DataFrame, payments: DataFrame, orders: DataFrame,
                 activity_links: DataFrame, coupon_links: DataFrame,
                 dictionary: DataFrame) -> DataFrame:
    """Lines of paid orders; partition = day of the payment."""
    paid = (payments.where(F.col("payment_status") == codes.PAID)
            .select("order_id", "user_id", "payment_type", "callback_time"))
    heads = orders.select(F.col("id").alias("order_id"), "province_id")
    joined = line_amounts(lines).join(paid, "order_id").join(heads, "order_id", "left")
    joined = decode(_with_links(joined, activity_links, coupon_links), "payment_type", dictionary,
                    codes.PAYMENT_TYPE, "payment_type_name")
    day = iso_day(F.col("callback_time"))
    return joined.select(
        "id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id",
        "coupon_id", F.col("payment_type").alias("payment_type_code"), "payment_type_name",
        day.alias("date_id"), iso_time(F.col("callback_time")).alias("callback_time"), "sku_num",
        "split_original_amount", "split_activity_amount", "split_coupon_amount",
        F.col("split_total_amount").alias("split_payment_amount"), day.alias("ds"))


def payment_line_measures(lines: DataFrame, payments: DataFrame) -> DataFrame:
    """What a daily aggregate reads of `payment_line`: one join instead of five."""
    paid = (payments.where(F.col("payment_status") == codes.PAID)
            .select("order_id", "user_id", iso_day(F.col("callback_time")).alias("ds")))
    return (line_amounts(lines).join(paid, "order_id")
            .select("order_id", "user_id", "sku_id", "sku_num",
                    F.col("split_total_amount").alias("split_payment_amount"), "ds"))


def payment_line_daily(lines: DataFrame, payments: DataFrame, orders: DataFrame,
                       activity_links: DataFrame, coupon_links: DataFrame,
                       dictionary: DataFrame, day: str) -> DataFrame:
    """Lines paid by the payments delivered on one day, in the partition of that day.

    `payments` are all that were delivered with the day, whenever they were made: one of the last
    minute comes the day after. `lines` and `orders` reach back as far as the caller's look-back;
    deliveries of a line, order or link on several days count once, the latest wins.
    `unmatched_payments` holds the payments whose lines are not among them.
    """
    rows = payment_line(latest_delivery(lines, "id"), latest_payments(payments),
                        latest_delivery(orders, "id"),
                        latest_delivery(activity_links, "order_detail_id"),
                        latest_delivery(coupon_links, "order_detail_id"), dictionary)
    return rows.withColumn("ds", F.lit(day))


def latest_delivery(df: DataFrame, key: str) -> DataFrame:
    """Of keys delivered on several days only the rows of the last one; all rows without `ds`."""
    if "ds" not in df.columns:
        return df
    last = df.groupBy(F.col(key).alias("__key")).agg(F.max("ds").alias("__ds"))
    return df.join(last, (F.col(key) == F.col("__key")) & (F.col("ds") == F.col("__ds")),
                   "left_semi")


def latest_payments(payments: DataFrame) -> DataFrame:
    """The latest state of each order's payment."""
    keep = ["order_id", "user_id", "payment_type", "payment_status", "callback_time"]
    return latest_rows(payments.select(*keep), ["order_id"], ["callback_time", "payment_status"])


def unmatched_payments(payments: DataFrame, lines: DataFrame, day: str) -> DataFrame:
    """Payments delivered on a day whose order has no line within the look-back."""
    paid = latest_payments(payments).where(F.col("payment_status") == codes.PAID)
    return (paid.join(lines.select("order_id").distinct(), "order_id", "left_anti")
            .select("order_id", "user_id", F.col("payment_type").alias("payment_type_code"),
                    iso_time(F.col("callback_time")).alias("callback_time"), F.lit(day).alias("ds")))


FLOW_COLUMNS = ["order_id", "user_id", "province_id", "order_date_id", "order_time",
                "payment_date_id", "payment_time", "finish_date_id", "finish_time",
                "order_original_amount", "order_activity_amount", "order_coupon_amount",
                "order_total_amount", "payment_amount"]


FLOW_ORDER_COLUMNS = ["id", "create_time", "user_id", "province_id", "original_total_amount",
                      "activity_reduce_amount", "coupon_reduce_amount", "total_amount"]
#: Days within which an order that was closed may be delivered again.
LOOK_BACK_DAYS = 30


def _flow_orders(orders: DataFrame) -> DataFrame:
    """One row per order, its latest delivery."""
    return latest_rows(orders.select(*FLOW_ORDER_COLUMNS), ["id"], FLOW_ORDER_COLUMNS[1:]).select(
        F.col("id").alias("order_id"), "user_id", "province_id",
        iso_day(F.col("create_time")).alias("order_date_id"),
        iso_time(F.col("create_time")).alias("order_time"),
        F.col("original_total_amount").alias("order_original_amount"),
        F.col("activity_reduce_amount").alias("order_activity_amount"),
        F.col("coupon_reduce_amount").alias("order_coupon_amount"),
        F.col("total_amount").alias("order_total_amount"))


def _flow_payments(payments: DataFrame) -> DataFrame:
    """One row per paid order. Of several payments the first counts, as in the daily step, which fills empty
    cells only; a payment delivered again changes nothing."""
    first = (payments.where(F.col("payment_status") == codes.PAID)
             .groupBy("order_id").agg(F.min_by("total_amount", F.struct("callback_time", "total_amount")).alias(
                 "total_amount"), F.min("callback_time").alias("callback_time")))
    return first.select(
        "order_id", iso_day(F.col("callback_time")).alias("payment_date_id"),
        iso_time(F.col("callback_time")).alias("payment_time"),
        money(F.col("total_amount")).alias("payment_amount"))


def _flow_finishes(status_log: DataFrame) -> DataFrame:
    """One row per finished order, its first finish."""
    first = (status_log.where(F.col("order_status") == codes.FINISHED)
             .groupBy("order_id").agg(F.min("create_time").alias("create_time")))
    return first.select(
        "order_id", iso_day(F.col("create_time")).alias("finish_date_id"),
        iso_time(F.col("create_time")).alias("finish_time"))


def _flow_partition(rows: DataFrame) -> DataFrame:
    return rows.select(*FLOW_COLUMNS, F.coalesce("finish_date_id", F.lit(FAR_DAY)).alias("ds"))


def order_flow(orders: DataFrame, payments: DataFrame, status_log: DataFrame) -> DataFrame:
    """Accumulating snapshot of orders: ordered, paid, finished.

    Open orders are kept in the far-day partition; an unpaid order has no payment amount.
    """
    rows = (_flow_orders(orders).join(_flow_payments(payments), "order_id", "left")
            .join(_flow_finishes(status_log), "order_id", "left"))
    return _flow_partition(rows)


def order_flow_daily(flow: DataFrame, new_orders: DataFrame, payments: DataFrame,
                     status_log: DataFrame, day: str) -> DataFrame:
    """One day's step: open rows and new orders take over the day's payments and finishes.

    Orders, payments and finishes may be delivered more than once: an order stays one row, what is stored wins. An order
    that is stored, open or closed within `LOOK_BACK_DAYS`, is not opened again.

    `flow` is the stored table. The result holds the whole open partition and the whole partition
    `day`, which takes the rows closed by this step, so both can be overwritten. What an earlier
    run of the same day has stored is read back or computed anew, never doubled.
    """
    stored = flow.where(F.col("ds").isin(FAR_DAY, day) & (F.col("order_date_id") < day))
    recent = (F.col("ds") == FAR_DAY) | (F.col("ds") >= shift(day, -LOOK_BACK_DAYS))
    known = flow.where(recent & (F.col("order_date_id") < day)).select("order_id")
    rows = (stored.select(*FLOW_COLUMNS)
            .unionByName(_flow_orders(new_orders).join(known, "order_id", "left_anti"), allowMissingColumns=True))
    rows = fill_columns(rows, _flow_payments(payments), "order_id",
                        ["payment_date_id", "payment_time", "payment_amount"])
    rows = fill_columns(rows, _flow_finishes(status_log), "order_id",
                        ["finish_date_id", "finish_time"])
    closed = F.col("finish_date_id").isNotNull()
    return rows.select(*FLOW_COLUMNS, F.when(closed, day).otherwise(FAR_DAY).alias("ds"))


def coupon_used(uses: DataFrame) -> DataFrame:
    day = iso_day(F.col("used_time"))
    return (uses.where(F.col("used_time").isNotNull())
            .select("id", "coupon_id", "user_id", "order_id", day.alias("date_id"),
                    iso_time(F.col("used_time")).alias("payment_time"), day.alias("ds")))


def favorite_add(favorites: DataFrame) -> DataFrame:
    day = iso_day(F.col("create_time"))
    return favorites.select("id", "user_id", "sku_id", day.alias("date_id"),
                            iso_time(F.col("create_time")).alias("create_time"), day.alias("ds"))


def _log_partition(day: Column, loaded: str | None) -> Column:
    """The partition of a log row: its day at the shop, but no later than the day of its load.

    The shop's day begins before the UTC day, so a day's lines reach into the next one, whose own
    load would overwrite them.
    """
    return day if loaded is None else F.least(day, F.lit(loaded))


def _timed(parsed: DataFrame) -> DataFrame:
    """Lines with a usable event time; the others are in `log_rejects`."""
    return parsed.withColumn("ts", in_range(F.col("ts"))).where(F.col("ts").isNotNull())


def log_rejects(log: DataFrame, loaded: str | None = None) -> DataFrame:
    """Lines that no log fact takes: unreadable ones and those without a usable event time.

    With the lines of `page_view` they are all lines delivered.
    """
    parsed = parse_log(log, schema=f"{COMMON}, {TIME}")
    lost = parsed.where(in_range(F.col("ts")).isNull())
    reason = F.when(F.col("ts").isNotNull(), "time out of range").when(
        F.col("common").isNotNull(), "no time").otherwise("unreadable")
    rows = lost.select("id", reason.alias("reason"))
    return rows if loaded is None else rows.withColumn("ds", F.lit(loaded))


def page_view(log: DataFrame, loaded: str | None = None) -> DataFrame:
    """Page views from log lines; lines without a readable event time are left to the rejects."""
    parsed = _timed(parse_log(log, schema=f"{COMMON}, {PAGE}, {TIME}"))
    at = shop_time(F.col("ts"))
    return parsed.select(
        F.col("common.ar").alias("province_id"), F.col("common.ba").alias("brand"),
        F.col("common.ch").alias("channel"), F.col("common.is_new").alias("is_new"),
        F.col("common.md").alias("model"), F.col("common.mid").alias("mid_id"),
        F.col("common.os").alias("operate_system"), F.col("common.uid").alias("user_id"),
        F.col("common.vc").alias("version_code"), F.col("page.item").alias("page_item"),
        F.col("page.item_type").alias("page_item_type"),
        F.col("page.last_page_id").alias("last_page_id"),
        F.col("page.page_id").alias("page_id"), F.col("page.from_pos_id").alias("from_pos_id"),
        F.col("page.from_pos_seq").alias("from_pos_seq"),
        F.col("page.refer_id").alias("refer_id"), iso_day(at).alias("date_id"),
        iso_time(at).alias("view_time"), F.col("common.sid").alias("session_id"),
        F.col("page.during_time").alias("during_time"),
        _log_partition(iso_day(at), loaded).alias("ds"))


def login(log: DataFrame, loaded: str | None = None) -> DataFrame:
    """The first line of each session that names a user; ids that are no numbers name nobody."""
    rows = _timed(parse_log(log, schema=f"{COMMON}, {TIME}")).select(
        F.col("common.sid").alias("session_id"), "ts", "id",
        F.col("common.uid").try_cast("bigint").alias("user_id"), F.col("common.ch").alias("channel"),
        F.col("common.ar").alias("province_id"), F.col("common.vc").alias("version_code"),
        F.col("common.mid").alias("mid_id"), F.col("common.ba").alias("brand"),
        F.col("common.md").alias("model"), F.col("common.os").alias("operate_system"))
    first = first_rows(rows.where(F.col("user_id").isNotNull()), ["session_id"], ["ts", "id"])
    at = shop_time(F.col("ts"))
    return first.select(
        "user_id", iso_day(at).alias("date_id"),
        iso_time(at).alias("login_time"), "channel", "province_id", "version_code", "mid_id",
        "brand", "model", "operate_system", _log_partition(iso_day(at), loaded).alias("ds"))
