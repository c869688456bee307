"""One-day aggregates: aggregate the fact first, then add descriptive columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.money import money_sum, or_zero
from tidemart.plans.dims import PRODUCT_KEYS, product_labels


def _amounts() -> list[Column]:
    return [
        money_sum(F.col("split_original_amount")).alias("order_original_amount_1d"),
        money_sum(or_zero(F.col("split_activity_amount"))).alias("activity_reduce_amount_1d"),
        money_sum(or_zero(F.col("split_coupon_amount"))).alias("coupon_reduce_amount_1d"),
        money_sum(F.col("split_total_amount")).alias("order_total_amount_1d")]


AMOUNTS = ["order_original_amount", "activity_reduce_amount", "coupon_reduce_amount",
           "order_total_amount"]


def user_product_order(lines: DataFrame, products: DataFrame) -> DataFrame:
    """User x product x day; `order_count_1d` counts order lines, `distinct_order_count_1d` orders.

    A reader that does not use the latter does not pay for it: Spark drops unused aggregates.
    """
    facts = lines.groupBy("ds", "user_id", "sku_id").agg(
        F.count("*").cast("bigint").alias("order_count_1d"),
        F.count_distinct("order_id").cast("bigint").alias("distinct_order_count_1d"),
        F.sum("sku_num").cast("bigint").alias("order_num_1d"), *_amounts())
    return (facts.join(product_labels(products), "sku_id", "left")
            .select("user_id", "sku_id", *PRODUCT_KEYS, "order_count_1d",
                    "distinct_order_count_1d", "order_num_1d", *[f"{a}_1d" for a in AMOUNTS], "ds"))


def user_order(lines: DataFrame) -> DataFrame:
    return (lines.groupBy("user_id", "ds").agg(
        F.count_distinct("order_id").cast("bigint").alias("order_count_1d"),
        F.sum("sku_num").cast("bigint").alias("order_num_1d"), *_amounts())
        .select("user_id", "order_count_1d", "order_num_1d", *[f"{a}_1d" for a in AMOUNTS], "ds"))


def user_cart_add(cart_adds: DataFrame) -> DataFrame:
    return (cart_adds.groupBy("user_id", "ds").agg(
        F.count("*").cast("bigint").alias("cart_add_count_1d"),
        F.sum("sku_num").cast("bigint").alias("cart_add_num_1d"))
        .select("user_id", "cart_add_count_1d", "cart_add_num_1d", "ds"))


def user_payment(payment_lines: DataFrame) -> DataFrame:
    return (payment_lines.groupBy("user_id", "ds").agg(
        F.count_distinct("order_id").cast("bigint").alias("payment_count_1d"),
        F.sum("sku_num").cast("bigint").alias("payment_num_1d"),
        money_sum(F.col("split_payment_amount")).alias("payment_amount_1d"))
        .select("user_id", "payment_count_1d", "payment_num_1d", "payment_amount_1d", "ds"))


PROVINCE_KEYS = ["province_name", "area_code", "iso_code", "iso_3166_2"]


def province_order(lines: DataFrame, provinces: DataFrame) -> DataFrame:
    facts = lines.groupBy("province_id", "ds").agg(
        F.count_distinct("order_id").cast("bigint").alias("order_count_1d"), *_amounts())
    labels = provinces.select(F.col("id").alias("province_id"), *PROVINCE_KEYS)
    return (facts.join(labels, "province_id", "left")
            .select("province_id", *PROVINCE_KEYS, "order_count_1d",
                    *[f"{a}_1d" for a in AMOUNTS], "ds"))


def user_coupon_used(uses: DataFrame, coupons: DataFrame) -> DataFrame:
    facts = uses.groupBy("ds", "user_id", "coupon_id").agg(
        F.count("*").cast("bigint").alias("used_count_1d"))
    labels = coupons.select(F.col("id").alias("coupon_id"), "coupon_name", "coupon_type_code",
                            "coupon_type_name", "benefit_rule")
    return (facts.join(labels, "coupon_id", "left")
            .select("user_id", "coupon_id", "coupon_name", "coupon_type_code", "coupon_type_name",
                    "benefit_rule", "used_count_1d", "ds"))


def product_favorite(favorites: DataFrame, products: DataFrame) -> DataFrame:
    facts = favorites.groupBy("ds", "sku_id").agg(
        F.count("*").cast("bigint").alias("favor_add_count_1d"))
    return (facts.join(product_labels(products), "sku_id", "left")
            .select("sku_id", *PRODUCT_KEYS, "favor_add_count_1d", "ds"))


SESSION_KEYS = ["session_id", "mid_id", "brand", "model", "operate_system", "version_code",
                "channel"]
VISITOR_KEYS = ["mid_id", "brand", "model", "operate_system", "page_id"]


def session_page_view(views: DataFrame) -> DataFrame:
    return (views.groupBy(*SESSION_KEYS, "ds").agg(
        F.sum("during_time").cast("bigint").alias("during_time_1d"),
        F.count("*").cast("bigint").alias("page_count_1d"))
        .select(*SESSION_KEYS, "during_time_1d", "page_count_1d", "ds"))


def visitor_page_view(views: DataFrame) -> DataFrame:
    return (views.groupBy(*VISITOR_KEYS, "ds").agg(
        F.sum("during_time").cast("bigint").alias("during_time_1d"),
        F.count("*").cast("bigint").alias("view_count_1d"))
        .select(*VISITOR_KEYS, "during_time_1d", "view_count_1d", "ds"))
