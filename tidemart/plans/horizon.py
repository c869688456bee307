"""Rolling 7/30-day and since-the-beginning aggregates, built on the one-day tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.days import horizon_start, last_days, shift
from tidemart.functions.money import money_sum, money_sum_if, sum_if
from tidemart.operators.horizons import by_horizon
from tidemart.plans.daily import AMOUNTS, PROVINCE_KEYS
from tidemart.plans.dims import PRODUCT_KEYS

COUNTS = ["order_count", "order_num"]


def _rolling(counts: list[str], day: str) -> list[Column]:
    """Seven days inside thirty, from one scan."""
    week = F.col("ds") >= horizon_start(day, 7)
    return ([sum_if(week, F.col(f"{c}_1d")).alias(f"{c}_7d") for c in counts]
            + [money_sum_if(week, F.col(f"{a}_1d")).alias(f"{a}_7d") for a in AMOUNTS]
            + [F.sum(f"{c}_1d").cast("bigint").alias(f"{c}_30d") for c in counts]
            + [money_sum(F.col(f"{a}_1d")).alias(f"{a}_30d") for a in AMOUNTS])


def user_product_order(daily: DataFrame, day: str) -> DataFrame:
    return (daily.where(last_days(F.col("ds"), day, 30))
            .groupBy("user_id", "sku_id", *PRODUCT_KEYS).agg(*_rolling(COUNTS, day))
            .withColumn("ds", F.lit(day)))


def province_order(daily: DataFrame, day: str) -> DataFrame:
    return (daily.where(last_days(F.col("ds"), day, 30))
            .groupBy("province_id", *PROVINCE_KEYS).agg(*_rolling(["order_count"], day))
            .withColumn("ds", F.lit(day)))


def user_product_state(daily: DataFrame, day: str) -> DataFrame:
    """`user_product_order` with `days_30d`, the daily rows in the window: what `slide` goes on from."""
    return (daily.where(last_days(F.col("ds"), day, 30))
            .groupBy("user_id", "sku_id", *PRODUCT_KEYS).agg(
                *_rolling(COUNTS, day), F.count(F.lit(1)).alias("days_30d"))
            .withColumn("ds", F.lit(day)))


def slide(previous: DataFrame, daily: DataFrame, corrections: DataFrame, keys: list[str], counts: list[str],
          day: str) -> DataFrame:
    """The 7/30-day state of `day` from that of the day before.

    `daily` is the table of one-day rows; of its 30 days only three partitions are read: `day` enters both windows, the
    days that fall out of them leave. `corrections` are signed rows of earlier days, in the columns of `daily` and
    `days` (1 for a row that is new there, -1 for one that goes, 0 for a change of amounts), delivered since the
    last step and not part of it; those outside a window do not count for it. A day that leaves is read as corrected. Amounts are exact
    decimals, so a key whose rows are all gone has zeros and is dropped by `days_30d`.
    """
    week_out, month_out = shift(day, -7), shift(day, -30)
    measures = {**{c: "bigint" for c in counts}, **{a: "decimal(26,2)" for a in AMOUNTS}}
    none = {name: F.lit(0).cast(kind) for name, kind in measures.items()}

    def signed(rows: DataFrame, days: Column, week: Column, month: Column) -> DataFrame:
        return rows.select(*keys, *[(F.col(f"{m}_1d") * sign).alias(f"{m}_{n}d")
                                    for n, sign in ((7, week), (30, month)) for m in measures], days.alias("days_30d"))

    one, zero = F.lit(1), F.lit(0)
    moved = daily.where(F.col("ds").isin(day, week_out, month_out))
    entering = F.col("ds") == day
    rows = signed(moved, F.when(entering, 1).when(F.col("ds") == month_out, -1).otherwise(0),
                  F.when(entering, 1).when(F.col("ds") == week_out, -1).otherwise(0),
                  F.when(entering, 1).when(F.col("ds") == month_out, -1).otherwise(0))
    # A correction of a day that leaves in this step was never in the state, but the day leaves as corrected.
    late = corrections.where(F.col("ds").between(month_out, shift(day, -1)))
    fixes = signed(late, F.col("days"), F.when(F.col("ds") >= week_out, one).otherwise(zero), one)
    kept = previous.select(*keys, *[f"{m}_{n}d" for n in (7, 30) for m in measures], "days_30d")
    total = kept.unionByName(rows).unionByName(fixes).groupBy(*keys).agg(*[
        F.coalesce(F.sum(f"{m}_{n}d"), none[m]).cast(kind).alias(f"{m}_{n}d")
        for n in (7, 30) for m, kind in measures.items()], F.sum("days_30d").cast("bigint").alias("days_30d"))
    return total.where("days_30d > 0").withColumn("ds", F.lit(day))


# Registers of a sketch are 2^14: a relative standard error of 0.8 %.
SKETCH_BITS = 14


def visitor_sketches(views: DataFrame) -> DataFrame:
    """Per page and day a mergeable sketch of its visitors, next to nothing else: stored once a day."""
    return (views.groupBy("page_id", "ds").agg(
        F.hll_sketch_agg("mid_id", F.lit(SKETCH_BITS)).alias("visitors")).select("page_id", "visitors", "ds"))


def visitor_counts(views: DataFrame, day: str, horizons: tuple[int, ...] = (1, 7, 30)) -> DataFrame:
    """The exact count, which reads the details: a visitor counts for all horizons that reach their last visit."""
    last = (views.where(last_days(F.col("ds"), day, max(horizons)) & F.col("mid_id").isNotNull())
            .groupBy("page_id", "mid_id").agg(F.max(F.to_date("ds")).alias("last")))
    return by_horizon(
        last.groupBy("page_id").agg(*[F.count_if(F.col("last") >= horizon_start(day, h)).alias(f"n{h}")
                                      for h in horizons]),
        ["page_id"], {h: {"visitor_count": F.col(f"n{h}")} for h in horizons}).withColumn("ds", F.lit(day))


def visitor_estimates(sketches: DataFrame, day: str, horizons: tuple[int, ...] = (1, 7, 30)) -> DataFrame:
    """Different visitors of each page over several horizons, from one small row per page and day.

    Sketches merge without loss: the estimate is that of a sketch over all detail rows. Its standard error is 1.04 /
    sqrt(2^SKETCH_BITS), 0.8 %; counts up to some thousand come out exact. A page without visits in a horizon has 0.
    """
    return by_horizon(
        sketches.where(last_days(F.col("ds"), day, max(horizons))).groupBy("page_id").agg(*[
            F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(F.when(
                F.col("ds") >= horizon_start(day, h), F.col("visitors")))), F.lit(0)).cast("bigint").alias(f"n{h}")
            for h in horizons]),
        ["page_id"], {h: {"visitor_estimate": F.col(f"n{h}")} for h in horizons}).withColumn("ds", F.lit(day))


# Total column -> one-day column it adds up.
TOTALS = {
    "order_count_td": "order_count_1d",
    "order_num_td": "order_num_1d",
    "original_amount_td": "order_original_amount_1d",
    "activity_reduce_amount_td": "activity_reduce_amount_1d",
    "coupon_reduce_amount_td": "coupon_reduce_amount_1d",
    "total_amount_td": "order_total_amount_1d",
}


def _first_day(column: str) -> Column:
    """Earliest ISO day. As dates the values fit a hash aggregate; texts would have to be sorted."""
    return F.min(F.to_date(column)).cast("string")


def _last_day(column: str) -> Column:
    return F.max(F.to_date(column)).cast("string")


def _total(name: str, col: Column) -> Column:
    kind = "decimal(26,2)" if "amount" in name else "bigint"
    return col.cast(kind).alias(name)


def user_order_total(daily: DataFrame, day: str) -> DataFrame:
    """Full build from all days up to `day`."""
    return (daily.where(F.col("ds") <= day).groupBy("user_id").agg(
        _first_day("ds").alias("order_date_first"), _last_day("ds").alias("order_date_last"),
        *[_total(t, F.sum(d)) for t, d in TOTALS.items()])
        .withColumn("ds", F.lit(day)))


def user_order_total_by_join(previous: DataFrame, daily: DataFrame, day: str) -> DataFrame:
    """Yesterday's totals and today's rows, matched by a full outer join."""
    old = previous.select(F.col("user_id").alias("old_user"), "order_date_first",
                          "order_date_last", *TOTALS)
    new = (daily.where(F.col("ds") == day)
           .select(F.col("user_id").alias("new_user"), *TOTALS.values()))
    both = old.join(new, F.col("old_user") == F.col("new_user"), "full_outer")
    zero = F.lit(0)
    return both.select(
        F.coalesce("old_user", "new_user").alias("user_id"),
        F.coalesce("order_date_first", F.lit(day)).alias("order_date_first"),
        F.when(F.col("new_user").isNotNull(), day).otherwise(F.col("order_date_last"))
        .alias("order_date_last"),
        *[_total(t, F.coalesce(t, zero) + F.coalesce(d, zero)) for t, d in TOTALS.items()],
        F.lit(day).alias("ds"))


def user_order_total_by_union(previous: DataFrame, daily: DataFrame, day: str) -> DataFrame:
    """The same totals by adding today's rows to yesterday's and aggregating again.

    The partial sums are combined before the shuffle, and no row has to meet a partner.
    """
    today = daily.where(F.col("ds") == day).select(
        "user_id", F.lit(day).alias("order_date_first"), F.lit(day).alias("order_date_last"),
        *[F.col(d).alias(t) for t, d in TOTALS.items()])
    rows = previous.select(*today.columns).unionByName(today)
    return (rows.groupBy("user_id").agg(
        _first_day("order_date_first").alias("order_date_first"),
        _last_day("order_date_last").alias("order_date_last"),
        *[_total(t, F.sum(t)) for t in TOTALS])
        .withColumn("ds", F.lit(day)))


def login_seen(logins: DataFrame, day: str) -> DataFrame:
    """Last login day and number of logins per user, from all logins up to `day`."""
    return (logins.where(F.col("ds") <= day).groupBy("user_id")
            .agg(_last_day("ds").alias("last_day"), F.count("*").cast("bigint").alias("logins"))
            .withColumn("ds", F.lit(day)))


def login_seen_next(previous: DataFrame, logins: DataFrame, day: str) -> DataFrame:
    """The same from the result of the day before and the day's logins only."""
    today = login_seen(logins.where(F.col("ds") == day), day)
    rows = previous.select("user_id", "last_day", "logins").unionByName(today.drop("ds"))
    return (rows.groupBy("user_id").agg(_last_day("last_day").alias("last_day"),
                                        F.sum("logins").cast("bigint").alias("logins"))
            .withColumn("ds", F.lit(day)))


def user_login_total(users: DataFrame, seen: DataFrame, day: str) -> DataFrame:
    """Every registered user with last login, registration day and number of logins.

    Someone who never logged in counts as having done so once, on the registration day.
    """
    registered = users.select(
        F.col("id").alias("user_id"),
        F.substring(F.col("create_time").cast("string"), 1, 10).alias("first"))
    return (registered.where(F.col("first") <= day)
            .join(seen.select("user_id", "last_day", "logins"), "user_id", "left").select(
                "user_id", F.coalesce("last_day", "first").alias("login_date_last"),
                F.col("first").alias("login_date_first"),
                F.coalesce("logins", F.lit(1)).cast("bigint").alias("login_count_td"),
                F.lit(day).alias("ds")))
