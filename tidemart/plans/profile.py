"""User profile labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.days import day_part, in_range, iso_day, iso_time, shop_time
from tidemart.functions.text import product_name_parts
from tidemart.sources.readers import TIME, parse_log

DAY_PARTS = ("night", "morning", "afternoon", "evening")


def user_activity(log: DataFrame) -> DataFrame:
    """Log lines of known users as (user_id, day, part of the day, what was done).

    A visit to the payment page is a purchase, displays belong to a search, everything else is
    browsing.
    """
    schema = ("common struct<uid: string>, page struct<page_id: string>,"
              f" displays array<struct<item: string>>, {TIME}")
    user = F.col("common.uid").try_cast("bigint")
    rows = parse_log(log, schema=schema).where(
        in_range(F.col("ts")).isNotNull() & user.isNotNull())
    at = shop_time(F.col("ts"))
    return rows.select(
        user.alias("user_id"), iso_day(at).alias("ds"),
        day_part(at).alias("part"), (F.col("page.page_id") == "payment").alias("bought"),
        F.col("displays").isNotNull().alias("searched"))


def user_profile(activity: DataFrame) -> DataFrame:
    """One row per user: days seen, what was done, parts of the day, and the same as JSON.

    Rows are reduced to user and day before the days are listed, so a list is as long as the
    number of days, however busy the user is.
    """
    days = activity.groupBy("user_id", "ds").agg(
        F.max("bought").alias("bought"), F.max("searched").alias("searched"),
        *[F.max(F.col("part") == p).alias(p) for p in DAY_PARTS])
    users = days.groupBy("user_id").agg(
        F.count("*").cast("bigint").alias("login_days"),
        F.concat_ws(",", F.sort_array(F.collect_list("ds"))).alias("login_dates"),
        F.max("bought").alias("bought"), F.max("searched").alias("searched"),
        *[F.max(p).alias(p) for p in DAY_PARTS])
    parts = F.concat_ws(",", *[F.when(F.col(p), p) for p in DAY_PARTS])
    row = users.select("user_id", "login_days", "login_dates", "bought", "searched",
                       parts.alias("day_parts"))
    return row.withColumn("profile", F.to_json(F.struct(*row.columns)))


def age_label(scores: DataFrame, weights: DataFrame) -> DataFrame:
    """The age band with the largest weighted score per user; the later band wins a tie.

    `scores(user_id, dimension, label, score)`, `weights(dimension, weight)`. Scores are added up
    per dimension before the weights are looked up. Dimensions without a weight do not count.
    """
    sums = scores.groupBy("user_id", "dimension", "label").agg(F.sum("score").alias("score"))
    total = F.sum((F.col("score") * F.col("weight")).cast("decimal(30,4)")).cast("decimal(30,4)")
    by_label = (sums.join(weights, "dimension").groupBy("user_id", "label")
                .agg(total.alias("total")))
    best = by_label.groupBy("user_id").agg(F.max(F.struct("total", "label")).alias("b"))
    return best.select("user_id", F.col("b.label").alias("age_label"),
                       F.col("b.total").alias("score"))


def gender_label(scores: DataFrame) -> DataFrame:
    """female, male or family from `scores(user_id, side, score)`.

    With f, m and c the sums of the sides `female`, `male` and `family` and t their total: female
    if f - m exceeds a tenth of t, male if m - f does, otherwise family if c is at least 30 % of
    t; else there is no label.
    """
    def side(name) -> Column:
        return F.sum(F.when(F.col("side") == name, F.col("score")).otherwise(
            F.lit(0).cast("decimal(16,2)"))).cast("decimal(26,2)").alias(name)

    sums = scores.groupBy("user_id").agg(side("female"), side("male"), side("family"))
    female, male, family = F.col("female"), F.col("male"), F.col("family")
    total = female + male + family
    gap = (female - male) * 10
    label = (F.when(gap > total, "female").when(-gap > total, "male")
             .when((total > 0) & (family * 10 >= total * 3), "family"))
    return sums.select("user_id", "female", "male", "family", label.alias("gender_label"))


# Month and day on which each sign begins.
ZODIAC_STARTS = (
    ("0120", "Aquarius"), ("0219", "Pisces"), ("0321", "Aries"), ("0420", "Taurus"),
    ("0521", "Gemini"), ("0622", "Cancer"), ("0723", "Leo"), ("0823", "Virgo"),
    ("0923", "Libra"), ("1024", "Scorpio"), ("1123", "Sagittarius"), ("1222", "Capricorn"),
)


def zodiac(users: DataFrame) -> DataFrame:
    """Star sign from the birthday; null without one."""
    day = F.date_format("birthday", "MMdd")
    label = F.when(day.isNull(), F.lit(None).cast("string"))
    for start, sign in reversed(ZODIAC_STARTS):
        label = label.when(day >= start, sign)
    return users.select(F.col("id").alias("user_id"),
                        label.otherwise(ZODIAC_STARTS[-1][1]).alias("constellation"))


def label_table(users: DataFrame, ages: DataFrame, genders: DataFrame, signs: DataFrame,
                measures: DataFrame) -> DataFrame:
    """One row per user with all labels: age, gender, height, weight, sign and time of the update.

    `measures(user_id, height_cm, weight_kg)` are what users told; a user without a label has null.
    """
    rows = users.select(F.col("id").alias("user_id"),
                        F.coalesce("operate_time", "create_time").alias("update_time"))
    for labels, columns in ((ages, ["age_label"]), (genders, ["gender_label"]),
                            (measures, ["height_cm", "weight_kg"]), (signs, ["constellation"])):
        rows = rows.join(labels.select("user_id", *columns), "user_id", "left")
    return rows.select("user_id", "age_label", "gender_label",
                       F.col("height_cm").cast("int").alias("height_cm"),
                       F.col("weight_kg").cast("decimal(5,1)").alias("weight_kg"), "constellation",
                       iso_time(F.col("update_time")).alias("update_time"))


def split_product_names(products: DataFrame, name: str) -> DataFrame:
    return products.select("*", product_name_parts(F.col(name)).alias("__p")).select(
        *products.columns, "__p.*")
