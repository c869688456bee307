"""First load plus one daily load must give what one load over both days gives."""

import pytest
from pyspark.sql import functions as F

from tidemart.functions.days import FAR_DAY, shift
from tidemart.nightly import Warehouse, daily_load, first_load
from tidemart.plans import daily, facts, horizon
from tidemart.session import scratch_path
from tidemart.sources.shop import Shop, log_lines

DAY = "1998-06-30"
BEFORE = shift(DAY, -1)
START = shift(DAY, -20)
# Brings the events' last days to the order days.
SHIFT_DAYS = 9345
SMALL = ["sku_info", "spu_info", "base_category3", "base_category2", "base_category1",
         "base_trademark", "sku_attr_value", "sku_sale_attr_value", "coupon_info",
         "activity_rule", "activity_info", "base_dic", "base_province", "base_region",
         "promotion_pos", "promotion_refer"]


class ShiftedShop(Shop):
    def table(self, name):
        df = super().table(name)
        if name == "events":
            df = df.withColumn("ts", F.col("ts") - F.make_dt_interval(F.lit(SHIFT_DAYS)))
        return df


def until(df, column, day):
    """History of a few weeks."""
    at = F.col(column)
    return df.where((at >= F.lit(START).cast("timestamp"))
                    & (at < F.lit(shift(day, 1)).cast("timestamp")))


@pytest.fixture(scope="module")
def loaded(spark):
    shop = ShiftedShop(spark, "/root/testdata/sf0.001")
    w = Warehouse(spark, scratch_path(spark, "warehouse"))
    log = log_lines(shop.table("events")).join(
        shop.events().select(F.col("event_id").alias("id"), F.col("ts").alias("at")), "id")
    timed = [("order_info", shop.order_info(), "create_time"),
             ("order_detail", shop.order_detail().drop("ds"), "create_time"),
             ("payment_info", shop.payment_info(), "callback_time"),
             ("order_status_log", shop.order_status_log(), "create_time"),
             ("cart_info", shop.cart_info().drop("ds"), "create_time"),
             ("favor_info", shop.favor_info(), "create_time"),
             ("coupon_use", shop.coupon_use(), "used_time"), ("z_log", log, "at")]
    for day in (BEFORE, DAY):
        for name in SMALL:
            w.deliver(name, getattr(shop, name)(), day)
        for name, df, column in timed:
            part = until(df, column, day)
            if day == DAY:
                part = part.where(F.col(column) >= F.lit(DAY).cast("timestamp"))
            w.deliver(name, part, day)
        for name in ("order_detail_activity", "order_detail_coupon"):
            w.deliver(name, getattr(shop, name)(), day)
    users = shop.user_info().withColumn(
        "create_time", F.col("create_time") - F.make_dt_interval(F.lit(SHIFT_DAYS)))
    w.deliver("user_info", users, BEFORE)
    w.deliver("user_info", users.where(F.col("user_level") == "M")
              .withColumn("user_level", F.lit("V")), DAY)
    first_load(w, BEFORE)
    daily_load(w, DAY)
    return shop, w


def same(left, right):
    columns = sorted(left.columns)
    assert sorted(right.columns) == columns
    a = sorted(map(str, left.select(*columns).collect()))
    b = sorted(map(str, right.select(*columns).collect()))
    assert a == b and a


def test_order_lines_and_aggregates(loaded):
    shop, w = loaded
    lines = until(shop.order_detail().drop("ds"), "create_time", DAY)
    full = facts.order_line(lines, until(shop.order_info(), "create_time", DAY),
                            shop.order_detail_activity(), shop.order_detail_coupon())
    stored = w.table("fact_order_line")
    assert stored.count() == full.count()
    by_user = daily.user_order(stored)
    same(w.table("user_order_1d"), by_user)
    same(w.day("user_order_td", DAY), horizon.user_order_total(by_user, DAY))


def test_order_flow(loaded):
    shop, w = loaded
    full = facts.order_flow(until(shop.order_info(), "create_time", DAY),
                            until(shop.payment_info(), "callback_time", DAY),
                            until(shop.order_status_log(), "create_time", DAY))
    same(w.table("fact_order_flow"), full)


def test_log_facts(loaded):
    shop, w = loaded
    views = w.table("fact_page_view")
    lines = until(shop.events(), "ts", DAY)
    assert views.count() == lines.where(F.col("value") <= 290).count()
    assert views.count() + w.table("log_rejects").count() == lines.count()
    same(w.table("session_page_view_1d").groupBy("ds").agg(
        F.sum("page_count_1d").cast("bigint").alias("n")),
        views.groupBy("ds").agg(F.count("*").alias("n")))


def test_users_are_versioned(loaded):
    shop, w = loaded
    users = w.table("dim_user")
    assert users.where(F.col("ds") == FAR_DAY).count() == shop.table("customer").count()
    closed = users.where(F.col("ds") == BEFORE)
    assert closed.count() == users.where(F.col("start_date") == DAY).count() > 0
    assert {r.user_level for r in closed.collect()} == {"M"}


def test_reports_cover_both_days(loaded):
    _, w = loaded
    for name in ("channel_traffic", "user_retention", "user_new_active", "user_funnel",
                 "province_order_stats", "brand_order_stats", "consecutive_order_users"):
        days = {r.ds for r in w.table(name).select("ds").distinct().collect()}
        assert days == {BEFORE, DAY}, name


def test_rerun_of_a_day_changes_nothing(loaded):
    _, w = loaded
    names = ["user_order_td", "fact_order_line", "channel_traffic", "dim_user",
             "fact_order_flow", "fact_page_view", "user_payment_1d", "province_order_stats"]
    before = {n: sorted(map(str, w.table(n).collect())) for n in names}
    daily_load(w, DAY)
    assert {n: sorted(map(str, w.table(n).collect())) for n in names} == before
