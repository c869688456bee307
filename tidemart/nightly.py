"""The nightly load: source partitions of a day through dimensions, facts and aggregates to reports.

Every step writes a table and later steps read it back, so no plan spans more than one layer, and
a step that is run again replaces its own partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.days import FAR_DAY, shift
from tidemart.plans import behaviour, daily, dims, facts, horizon, profile, reports
from tidemart.session import fit, prepare
from tidemart.sources import readers, writers


# Days before the payment's delivery in which its order lines are looked for; payments of older
# orders are kept in `payment_unmatched`.
LOOK_BACK = 7


class Warehouse:
    """Stored tables below one folder: `source/<table>` as delivered, `<table>` as computed."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self.spark = prepare(spark)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, name: str) -> DataFrame:
        fit(self.spark, self.path(name))
        return readers.read_table(self.spark, self.path(name))

    def day(self, name: str, day: str) -> DataFrame:
        return readers.scan_day(self.table(name), day)

    def source(self, name: str, day: str, back: int = 0) -> DataFrame:
        """A delivered table on a day, or also on the days before it."""
        return readers.scan_days(self.table(f"source/{name}"), day, back)

    def deliver(self, name: str, df: DataFrame, day: str) -> None:
        writers.write_partition(df, self.path(f"source/{name}"), day)

    def save_day(self, name: str, df: DataFrame, day: str) -> None:
        writers.write_partition(df, self.path(name), day)

    def save_days(self, name: str, df: DataFrame) -> None:
        writers.write_by_day(df, self.path(name))

    def report(self, name: str, df: DataFrame, day: str) -> None:
        """A report's rows of one day; a corrected rerun replaces those of the run before."""
        writers.write_partition(df, self.path(name), day)


def load_dimensions(w: Warehouse, day: str) -> None:
    def source(name):
        return w.source(name, day).drop("ds")

    dictionary = source("base_dic")
    w.save_day("dim_product", dims.product(
        source("sku_info"), source("spu_info"), source("base_category3"),
        source("base_category2"), source("base_category1"), source("base_trademark"),
        source("sku_attr_value"), source("sku_sale_attr_value")), day)
    w.save_day("dim_coupon", dims.coupon(source("coupon_info"), dictionary), day)
    w.save_day("dim_activity", dims.activity(source("activity_rule"), source("activity_info"),
                                             dictionary), day)
    w.save_day("dim_province", dims.province(source("base_province"), source("base_region")), day)
    w.save_day("dim_promotion_pos", dims.promotion_position(source("promotion_pos")), day)
    w.save_day("dim_promotion_refer", dims.promotion_channel(source("promotion_refer")), day)
    days = w.source("order_info", day).select(F.col("create_time").cast("date").alias("day"))
    w.save_day("dim_calendar", dims.calendar(days), day)


def first_facts(w: Warehouse, day: str) -> None:
    """Facts from the whole history that is delivered with the first day."""
    def source(name):
        return w.source(name, day)

    orders, lines, payments = (source(n).drop("ds") for n in (
        "order_info", "order_detail", "payment_info"))
    links = source("order_detail_activity"), source("order_detail_coupon")
    w.save_days("fact_order_line", facts.order_line(lines, orders, *links))
    w.save_days("fact_payment_line", facts.payment_line(lines, payments, orders, *links,
                                                        source("base_dic")))
    w.save_days("fact_order_flow", facts.order_flow(orders, payments, source("order_status_log")))


def daily_facts(w: Warehouse, day: str) -> None:
    """Facts of one day; payments may belong to lines of the `LOOK_BACK` days before."""
    def source(name, back=0):
        return w.source(name, day, back)

    orders = source("order_info").drop("ds")
    links = source("order_detail_activity"), source("order_detail_coupon")
    w.save_day("fact_order_line", facts.order_line(source("order_detail").drop("ds"), orders,
                                                   *links), day)
    lines, payments = source("order_detail", LOOK_BACK), source("payment_info").drop("ds")
    w.save_day("fact_payment_line", facts.payment_line_daily(
        lines, payments, source("order_info", LOOK_BACK), source("order_detail_activity", LOOK_BACK),
        source("order_detail_coupon", LOOK_BACK), source("base_dic"), day), day)
    w.save_day("payment_unmatched", facts.unmatched_payments(payments, lines, day), day)
    w.save_days("fact_order_flow", facts.order_flow_daily(
        w.table("fact_order_flow"), orders, source("payment_info"), source("order_status_log"),
        day))


def event_facts(w: Warehouse, day: str, first: bool) -> None:
    """On the first load each row goes to its own day, later all rows go to the day of the load:
    a row that is delivered late must not overwrite the day it belongs to."""
    def save(name, df):
        if first:
            w.save_days(name, df)
        else:
            w.save_day(name, df, day)

    cart, log = w.source("cart_info", day), w.source("z_log", day)
    save("fact_cart_add", facts.cart_add(cart.drop("ds")))
    w.save_day("fact_cart_snapshot", facts.cart_snapshot(cart, day), day)
    save("fact_coupon_used", facts.coupon_used(w.source("coupon_use", day)))
    save("fact_favorite_add", facts.favorite_add(w.source("favor_info", day)))
    save("fact_page_view", facts.page_view(log, day))
    save("fact_login", facts.login(log, day))
    w.save_day("log_rejects", facts.log_rejects(log, day), day)


def one_day_aggregates(w: Warehouse, day: str, first: bool) -> None:
    """The day's aggregates, or those of all stored days on the first load."""
    def fact(name):
        return w.table(name) if first else w.day(name, day)

    def save(name, df):
        if first:
            w.save_days(name, df)
        else:
            w.save_day(name, df, day)

    products, lines = w.day("dim_product", day), fact("fact_order_line")
    save("user_product_order_1d", daily.user_product_order(lines, products))
    save("user_order_1d", daily.user_order(lines))
    save("province_order_1d", daily.province_order(lines, w.day("dim_province", day)))
    save("user_cart_add_1d", daily.user_cart_add(fact("fact_cart_add")))
    save("user_payment_1d", daily.user_payment(fact("fact_payment_line")))
    save("user_coupon_used_1d", daily.user_coupon_used(fact("fact_coupon_used"),
                                                       w.day("dim_coupon", day)))
    save("product_favorite_1d", daily.product_favorite(fact("fact_favorite_add"), products))
    save("session_page_view_1d", daily.session_page_view(fact("fact_page_view")))
    save("visitor_page_view_1d", daily.visitor_page_view(fact("fact_page_view")))


def behaviour_indicators(w: Warehouse, day: str) -> None:
    """Visits, regions, paths and devices of the log lines delivered with the day, categories of its
    orders, and the profiles of the users seen."""
    log, views = w.source("z_log", day), w.day("fact_page_view", day)
    w.save_day("page_visits", behaviour.page_visits(views), day)
    w.save_day("login_region_heat", behaviour.login_region_heat(
        w.day("fact_login", day), w.day("dim_province", day)), day)
    w.save_day("page_path_edges", behaviour.page_path_edges(log), day)
    w.save_day("page_paths", behaviour.page_paths(log), day)
    w.save_day("device_rollup", behaviour.device_rollup(views), day)
    w.save_day("category_rollup", behaviour.category_rollup(w.day("user_product_order_1d", day)), day)
    w.save_day("user_profile", profile.user_profile(profile.user_activity(log)), day)


def longer_aggregates(w: Warehouse, day: str, first: bool) -> None:
    by_user = w.table("user_order_1d")
    w.save_day("user_product_order_nd",
               horizon.user_product_order(w.table("user_product_order_1d"), day), day)
    w.save_day("province_order_nd", horizon.province_order(w.table("province_order_1d"), day), day)
    if first:
        totals = horizon.user_order_total(by_user, day)
    else:
        totals = horizon.user_order_total_by_union(w.day("user_order_td", shift(day, -1)),
                                                   by_user, day)
    w.save_day("user_order_td", totals, day)
    if first:
        seen = horizon.login_seen(w.table("fact_login"), day)
    else:
        seen = horizon.login_seen_next(w.day("login_seen_td", shift(day, -1)),
                                       w.table("fact_login"), day)
    w.save_day("login_seen_td", seen, day)
    w.save_day("user_login_td", horizon.user_login_total(
        w.day("dim_user", FAR_DAY), w.day("login_seen_td", day), day), day)


def write_reports(w: Warehouse, day: str, first: bool) -> None:
    """All reports of the day, in the day's partition of each."""
    t = w.table
    logins = w.day("user_login_td", day)
    w.report("channel_traffic", reports.channel_traffic(t("session_page_view_1d"), day), day)
    if not first:  # needs the totals of the day before
        before = w.day("user_login_td", shift(day, -1))
        w.report("user_churn_return", reports.user_churn_return(logins, before, day), day)
    w.report("user_retention", reports.user_retention(logins, day), day)
    w.report("user_new_active", reports.user_new_active(logins, day), day)
    w.report("user_funnel", reports.user_funnel(
        t("visitor_page_view_1d"), t("user_cart_add_1d"), t("user_order_1d"),
        t("user_payment_1d"), day), day)
    w.report("new_order_users", reports.new_order_users(w.day("user_order_td", day), day), day)
    w.report("consecutive_order_users", reports.consecutive_order_users(t("user_order_1d"), day), day)
    recent, by_product = t("user_product_order_nd"), t("user_product_order_1d")
    w.report("brand_repeat_rate", reports.brand_repeat_rate(recent, day), day)
    w.report("brand_order_stats", reports.brand_order_stats(by_product, day), day)
    w.report("category_order_stats", reports.category_order_stats(by_product, day), day)
    w.report("cart_top3_by_category", reports.cart_top3_by_category(
        t("fact_cart_snapshot"), w.day("dim_product", day), day), day)
    w.report("favorite_top3_by_brand",
             reports.favorite_top3_by_brand(t("product_favorite_1d"), day), day)
    w.report("order_to_pay_seconds", reports.order_to_pay_seconds(t("fact_order_flow"), day), day)
    w.report("province_order_stats", reports.province_order_stats(t("province_order_1d"), day), day)
    w.report("coupon_stats", reports.coupon_stats(t("user_coupon_used_1d"), day), day)


def first_load(w: Warehouse, day: str) -> None:
    """Everything from the history delivered with `day`."""
    load_dimensions(w, day)
    w.save_days("dim_user", dims.user_open(w.source("user_info", day), day))
    first_facts(w, day)
    event_facts(w, day, first=True)
    one_day_aggregates(w, day, first=True)
    behaviour_indicators(w, day)
    longer_aggregates(w, day, first=True)
    write_reports(w, day, first=True)


def daily_load(w: Warehouse, day: str) -> None:
    """One more day. The user table delivered with it holds new and changed users only."""
    load_dimensions(w, day)
    w.save_days("dim_user", dims.user_history(w.day("dim_user", FAR_DAY),
                                              w.source("user_info", day), day))
    daily_facts(w, day)
    event_facts(w, day, first=False)
    one_day_aggregates(w, day, first=False)
    behaviour_indicators(w, day)
    longer_aggregates(w, day, first=False)
    write_reports(w, day, first=False)
