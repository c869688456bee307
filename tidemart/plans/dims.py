"""Dimensions of a day.

Lookups are plain equi joins. Spark broadcasts a side when its size is below
`spark.sql.autoBroadcastJoinThreshold`, so a dimension that outgrows it is shuffled instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import codes
from tidemart.functions.days import FAR_DAY, iso_time
from tidemart.functions.money import money
from tidemart.functions.text import mask_email, mask_name, mask_phone
from tidemart.operators.lookup import decode
from tidemart.operators.merging import merge_validity

# Rule texts of the reports (fixed values).
OFF_AMOUNT = "满{0}元减{1}元"
OFF_PIECES = "满{0}件打{1} 折"
OFF_CASH = "减{0}元"
OFF_RATE = "打{0}折"


def _fill(template: str, *values: Column) -> Column:
    """Text with the values put in; null as soon as one of them is null."""
    parts, rest = [], template
    for number, value in enumerate(values):
        before, rest = rest.split("{%d}" % number)
        parts += [F.lit(before), value.cast("string")]
    return F.concat(*parts, F.lit(rest))


def attribute_lists(rows: DataFrame, key: str, name: str) -> DataFrame:
    """All distinct attribute structs of each key as one sorted array."""
    fields = [F.col(c).cast("string").alias(c) for c in rows.columns if c != key]
    return rows.groupBy(F.col(key)).agg(
        F.sort_array(F.collect_set(F.struct(*fields))).alias(name))


def product_named(sku: DataFrame, category3: DataFrame, category2: DataFrame,
                  category1: DataFrame, trademark: DataFrame) -> DataFrame:
    """Products with three category levels and brand; no product is lost to a missing level."""
    c3 = category3.select(F.col("id").alias("category3_id"), F.col("name").alias("category3_name"),
                          F.col("category2_id"))
    c2 = category2.select(F.col("id").alias("category2_id"), F.col("name").alias("category2_name"),
                          F.col("category1_id"))
    c1 = category1.select(F.col("id").alias("category1_id"), F.col("name").alias("category1_name"))
    brand = trademark.select(F.col("id").alias("tm_id"), "tm_name")
    return (sku.join(c3, "category3_id", "left").join(c2, "category2_id", "left")
            .join(c1, "category1_id", "left").join(brand, "tm_id", "left"))


def product(sku: DataFrame, spu: DataFrame, category3: DataFrame, category2: DataFrame,
            category1: DataFrame, trademark: DataFrame, attributes: DataFrame,
            sale_attributes: DataFrame) -> DataFrame:
    """The product dimension: names, group, categories, brand and attribute lists."""
    group = spu.select(F.col("id").alias("spu_id"), "spu_name")
    named = (product_named(sku, category3, category2, category1, trademark)
             .join(group, "spu_id", "left").withColumnRenamed("id", "sku_id"))
    attrs = attribute_lists(attributes, "sku_id", "sku_attr_values")
    sale = attribute_lists(sale_attributes, "sku_id", "sku_sale_attr_values")
    joined = named.join(attrs, "sku_id", "left").join(sale, "sku_id", "left")
    return joined.select(
        F.col("sku_id").alias("id"), money(F.col("price")).alias("price"), "sku_name", "sku_desc",
        money(F.col("weight")).alias("weight"), (F.col("is_sale") == 1).alias("is_sale"),
        "spu_id", "spu_name", "category3_id", "category3_name", "category2_id", "category2_name",
        "category1_id", "category1_name", "tm_id", "tm_name", "sku_attr_values",
        "sku_sale_attr_values", iso_time(F.col("create_time")).alias("create_time"))


PRODUCT_KEYS = ["sku_name", "category1_id", "category1_name", "category2_id", "category2_name",
                "category3_id", "category3_name", "tm_id", "tm_name"]


def product_labels(products: DataFrame) -> DataFrame:
    """The descriptive columns that aggregates and reports take from the product dimension."""
    return products.select(F.col("id").alias("sku_id"), *PRODUCT_KEYS)


def coupon(info: DataFrame, dictionary: DataFrame) -> DataFrame:
    named = decode(info, "coupon_type", dictionary, codes.COUPON_TYPE, "coupon_type_name")
    named = decode(named, "range_type", dictionary, codes.COUPON_RANGE, "range_type_name")
    need, pieces = money(F.col("condition_amount")), F.col("condition_num")
    off, rate = money(F.col("benefit_amount")), money(F.col("benefit_discount"))
    kind = F.col("coupon_type")
    rule = (F.when(kind == "3201", _fill(OFF_AMOUNT, need, off))
            .when(kind == "3202", _fill(OFF_PIECES, pieces, rate))
            .when(kind == "3203", _fill(OFF_CASH, off)))
    return named.select(
        "id", "coupon_name", kind.alias("coupon_type_code"), "coupon_type_name",
        need.alias("condition_amount"), pieces.cast("bigint").alias("condition_num"),
        "activity_id", off.alias("benefit_amount"), rate.alias("benefit_discount"),
        rule.alias("benefit_rule"), iso_time(F.col("create_time")).alias("create_time"),
        F.col("range_type").alias("range_type_code"), "range_type_name",
        F.col("limit_num").cast("bigint").alias("limit_num"),
        F.col("taken_count").cast("bigint").alias("taken_count"),
        *[iso_time(F.col(c)).alias(c)
          for c in ("start_time", "end_time", "operate_time", "expire_time")])


def activity(rules: DataFrame, info: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One row per rule, with the activity it belongs to when that is known."""
    known = info.select(
        F.col("id").alias("known_id"), "activity_name", "activity_desc",
        *[iso_time(F.col(c)).alias(c) for c in ("start_time", "end_time", "create_time")])
    joined = rules.join(known, F.col("activity_id") == F.col("known_id"), "left")
    named = decode(joined, "activity_type", dictionary, codes.ACTIVITY_TYPE, "activity_type_name")
    need, pieces = money(F.col("condition_amount")), F.col("condition_num")
    off, rate = money(F.col("benefit_amount")), money(F.col("benefit_discount"))
    kind = F.col("activity_type")
    rule = (F.when(kind == "3101", _fill(OFF_AMOUNT, need, off))
            .when(kind == "3102", _fill(OFF_PIECES, pieces, rate))
            .when(kind == "3103", _fill(OFF_RATE, rate)))
    return named.select(
        F.col("id").alias("activity_rule_id"), F.col("known_id").alias("activity_id"),
        "activity_name", kind.alias("activity_type_code"), "activity_type_name", "activity_desc",
        "start_time", "end_time", "create_time", need.alias("condition_amount"),
        pieces.cast("bigint").alias("condition_num"), off.alias("benefit_amount"),
        rate.alias("benefit_discount"), rule.alias("benefit_rule"),
        F.col("benefit_level").cast("string").alias("benefit_level"))


def province(provinces: DataFrame, regions: DataFrame) -> DataFrame:
    named = regions.select(F.col("id").alias("region_id"), "region_name")
    return (provinces.join(named, "region_id", "left")
            .select("id", F.col("name").alias("province_name"), "area_code", "iso_code",
                    "iso_3166_2", "region_id", "region_name"))


def promotion_position(rows: DataFrame) -> DataFrame:
    return rows.select("id", "pos_location", "pos_type", "promotion_type",
                       iso_time(F.col("create_time")).alias("create_time"),
                       iso_time(F.col("operate_time")).alias("operate_time"))


def promotion_channel(rows: DataFrame) -> DataFrame:
    return rows.select("id", "refer_name", iso_time(F.col("create_time")).alias("create_time"),
                       iso_time(F.col("operate_time")).alias("operate_time"))


CALENDAR_COLUMNS = ("date_id string, week_id string, week_day string, day string, month string,"
                    " quarter string, year string, is_workday string, holiday_id string")


def calendar(days: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Calendar rows for a column `day` of dates.

    ISO weeks and weekdays (Monday is 1). `holidays(date_id, holiday_id)` marks days off.
    """
    d = F.col("d")
    base = days.select(F.col("day").cast("date").alias("d")).distinct()
    weekday = F.weekday(d) + 1
    if holidays is None:
        named = base.withColumn("holiday_id", F.lit(None).cast("string"))
    else:
        named = base.join(holidays.select(F.to_date("date_id").alias("d"), "holiday_id"),
                          "d", "left")
    workday = F.when((weekday >= 6) | F.col("holiday_id").isNotNull(), "0").otherwise("1")
    columns = [d, F.weekofyear(d), weekday, F.dayofmonth(d), F.month(d), F.quarter(d), F.year(d),
               workday, F.col("holiday_id")]
    names = [c.split()[0] for c in CALENDAR_COLUMNS.split(", ")]
    return named.select(*[c.cast("string").alias(n) for c, n in zip(columns, names)])


USER_ATTRIBUTES = ["name", "phone_num", "email", "user_level", "birthday", "gender",
                   "create_time", "operate_time"]


def user_masked(users: DataFrame) -> DataFrame:
    """Users without readable personal data."""
    return users.select(
        "id", mask_name(F.col("name")).alias("name"),
        mask_phone(F.col("phone_num")).alias("phone_num"),
        mask_email(F.col("email")).alias("email"), "user_level",
        F.col("birthday").cast("string").alias("birthday"), "gender",
        iso_time(F.col("create_time")).alias("create_time"),
        iso_time(F.col("operate_time")).alias("operate_time"))


def user_open(users: DataFrame, day: str) -> DataFrame:
    """First load of the user dimension: every row is valid from the load day on."""
    return user_masked(users).select(
        "*", F.lit(day).alias("start_date"), F.lit(FAR_DAY).alias("end_date"),
        F.lit(FAR_DAY).alias("ds"))


def user_history(open_rows: DataFrame, changed: DataFrame, day: str) -> DataFrame:
    """Daily step: close the open rows of changed users and open their new ones."""
    return merge_validity(open_rows.drop("ds", "end_date"), user_masked(changed), "id", day)
