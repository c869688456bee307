"""Report tables. `day` is the report day; stored reports have a partition per day,
which a rerun replaces.

Figures per horizon come from conditional sums in one aggregate, spread over rows at the end, so
the detail rows are neither repeated per horizon nor read more than once. People are counted by
grouping on the person first; no distinct set is gathered per report row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.days import FAR_DAY, HORIZONS, horizon_start, last_days, shift
from tidemart.functions.money import mean_floor, money_sum_if, ratio, sum_if
from tidemart.operators.horizons import by_horizon
from tidemart.operators.merging import sum_branches
from tidemart.operators.ranking import top_ranks
from tidemart.plans.daily import PROVINCE_KEYS
from tidemart.plans.dims import product_labels

CATEGORY_KEYS = ["category1_id", "category1_name", "category2_id", "category2_name",
                 "category3_id", "category3_name"]
BRAND_KEYS = ["tm_id", "tm_name"]


def _on(day: str) -> Column:
    return F.lit(day).alias("ds")


def channel_traffic(sessions: DataFrame, day: str) -> DataFrame:
    """Visitors, mean stay, mean pages, sessions and bounce rate per channel and horizon."""
    recent = sessions.where(last_days(F.col("ds"), day, max(HORIZONS)))

    def inside(n):
        return F.col("ds") >= horizon_start(day, n)

    visitors = recent.groupBy("channel", "mid_id").agg(*[
        agg for n in HORIZONS for agg in (
            sum_if(inside(n), F.lit(1)).alias(f"sessions_{n}"),
            sum_if(inside(n), F.col("during_time_1d")).alias(f"stay_{n}"),
            sum_if(inside(n), F.col("page_count_1d")).alias(f"pages_{n}"),
            sum_if(inside(n) & (F.col("page_count_1d") == 1), F.lit(1)).alias(f"bounced_{n}"))])
    totals = visitors.groupBy("channel").agg(*[
        agg for n in HORIZONS for agg in (
            sum_if((F.col(f"sessions_{n}") > 0) & F.col("mid_id").isNotNull(), F.lit(1))
            .alias(f"uv_{n}"),
            *[F.sum(f"{c}_{n}").alias(f"{c}_{n}")
              for c in ("sessions", "stay", "pages", "bounced")])])
    rows = by_horizon(totals, ["channel"], {
        n: {"uv_count": F.col(f"uv_{n}"),
            "avg_duration_sec": mean_floor(F.col(f"stay_{n}"), F.col(f"sessions_{n}"), 1000),
            "avg_page_count": mean_floor(F.col(f"pages_{n}"), F.col(f"sessions_{n}")),
            "sv_count": F.col(f"sessions_{n}"),
            "bounce_rate": ratio(F.col(f"bounced_{n}"), F.col(f"sessions_{n}"))}
        for n in HORIZONS})
    return (rows.where(F.col("sv_count") > 0)
            .select(_on(day), "recent_days", "channel", "uv_count", "avg_duration_sec",
                    "avg_page_count", "sv_count", "bounce_rate"))


def user_churn_return(logins_today: DataFrame, logins_yesterday: DataFrame,
                      day: str) -> DataFrame:
    """Users who left (last seen exactly seven days ago) and users who came back.

    The inputs are the login totals as of the day and as of the day before.
    """
    churned = (logins_today.where(F.col("login_date_last") == shift(day, -7))
               .agg(F.count("*").alias("user_churn_count")))
    before = logins_yesterday.select("user_id", F.col("login_date_last").alias("seen_before"))
    returned = (logins_today.where(F.col("login_date_last") == day)
                .join(before, "user_id")
                .where(F.datediff(F.to_date("login_date_last"), F.to_date("seen_before")) >= 8)
                .agg(F.count("*").alias("user_back_count")))
    return (sum_branches([churned, returned], ["user_churn_count", "user_back_count"])
            .select(_on(day), "user_churn_count", "user_back_count"))


def user_retention(logins: DataFrame, day: str) -> DataFrame:
    """Registration cohorts of the seven days before `day`: how many were seen on `day`."""
    first = F.col("login_date_first")
    cohorts = (logins.where((first >= shift(day, -7)) & (first < day))
               .groupBy("login_date_first").agg(
                   sum_if(F.col("login_date_last") == day, F.lit(1)).alias("retention_count"),
                   F.count("*").cast("bigint").alias("new_user_count")))
    return cohorts.select(
        _on(day), first.alias("create_date"),
        F.datediff(F.to_date(F.lit(day)), F.to_date(first)).alias("retention_day"),
        "retention_count", "new_user_count",
        ratio(F.col("retention_count") * 100, F.col("new_user_count")).alias("retention_rate"))


def user_new_active(logins: DataFrame, day: str) -> DataFrame:
    """New and active users per horizon."""
    def since(column, n):
        return F.col(column) >= horizon_start(day, n)

    totals = logins.agg(*[agg for n in HORIZONS for agg in (
        sum_if(since("login_date_last", n) & since("login_date_first", n), F.lit(1))
        .alias(f"new_{n}"),
        sum_if(since("login_date_last", n), F.lit(1)).alias(f"active_{n}"))])
    rows = by_horizon(totals, [], {n: {"new_user_count": F.col(f"new_{n}"),
                                       "active_user_count": F.col(f"active_{n}")}
                                   for n in HORIZONS})
    return (rows.where(F.col("active_user_count") > 0)
            .select(_on(day), "recent_days", "new_user_count", "active_user_count"))


def user_funnel(page_visitors: DataFrame, cart_users: DataFrame, order_users: DataFrame,
                payment_users: DataFrame, day: str) -> DataFrame:
    """Visitors of the home and product pages, then users who put in the cart, ordered, paid.

    All inputs are one-day tables with one row per visitor and page, or per user.
    """
    columns = ["home_count", "good_detail_count", "cart_count", "order_count", "payment_count"]
    pages = (page_visitors.where((F.col("ds") == day)
                                 & F.col("page_id").isin("home", "good_detail"))
             .agg(sum_if(F.col("page_id") == "home", F.lit(1)).alias("home_count"),
                  sum_if(F.col("page_id") == "good_detail", F.lit(1)).alias("good_detail_count")))

    def users(table, name):
        return table.where(F.col("ds") == day).agg(F.count("*").alias(name))

    return sum_branches([pages, users(cart_users, "cart_count"),
                         users(order_users, "order_count"),
                         users(payment_users, "payment_count")], columns
                        ).select(_on(day), *columns)


def new_order_users(totals: DataFrame, day: str) -> DataFrame:
    """Users whose first order falls into the horizon."""
    counts = totals.agg(*[sum_if(F.col("order_date_first") >= horizon_start(day, n), F.lit(1))
                          .alias(f"n_{n}") for n in HORIZONS])
    rows = by_horizon(counts, [], {n: {"new_order_user_count": F.col(f"n_{n}")}
                                   for n in HORIZONS})
    return (rows.where(F.col("new_order_user_count") > 0)
            .select(_on(day), "recent_days", "new_order_user_count"))


def consecutive_order_users(user_days: DataFrame, day: str, span: int = 7) -> DataFrame:
    """Users active on three days in a row within the last seven.

    Each user's days become the bits of one number, which partial aggregation combines; three
    adjacent bits are three days in a row. `user_days` needs columns `user_id` and `ds`; `span` is
    at most 63 days.
    """
    if not 1 <= span <= 63:
        raise ValueError("span must be 1 to 63 days, the bits of one number")
    start = horizon_start(day, span)
    # The functions module shifts by a constant only; the SQL function takes a column.
    bit = F.expr(f"shiftleft(1L, datediff(to_date(ds), date'{start}'))")
    days = (user_days.where(last_days(F.col("ds"), day, span)).groupBy("user_id")
            .agg(F.bit_or(bit).alias("bits")))
    bits = F.col("bits")
    run = bits.bitwiseAND(F.shiftright(bits, 1)).bitwiseAND(F.shiftright(bits, 2)) != 0
    return (days.agg(sum_if(run, F.lit(1)).alias("n"))
            .select(_on(day), F.lit(span).cast("bigint").alias("recent_days"),
                    F.coalesce("n", F.lit(0)).cast("bigint")
                    .alias("order_continuously_user_count")))


def brand_repeat_rate(recent: DataFrame, day: str) -> DataFrame:
    """Share of a brand's buyers of the last 30 days who ordered it at least twice."""
    buyers = (recent.where(F.col("ds") == day).groupBy("user_id", *BRAND_KEYS)
              .agg(F.sum("order_count_30d").alias("orders")))
    return (buyers.groupBy(*BRAND_KEYS).agg(
        sum_if(F.col("orders") >= 2, F.lit(1)).alias("again"),
        sum_if(F.col("orders") >= 1, F.lit(1)).alias("once"))
        .select(_on(day), F.lit(30).cast("bigint").alias("recent_days"), *BRAND_KEYS,
                ratio(F.col("again"), F.col("once")).alias("order_repeat_rate")))


def _within(day: str, length: int) -> Column:
    """Rows already bounded to the longest horizon: those of its last `length` days."""
    return F.col("ds") >= horizon_start(day, length)


def _order_stats(daily: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Orders and buyers per horizon, all three from one aggregate over the last thirty days."""
    buyers = (daily.where(last_days(F.col("ds"), day, max(HORIZONS))).groupBy(*keys, "user_id")
              .agg(*[sum_if(_within(day, n), F.col("order_count_1d")).alias(f"n_{n}")
                     for n in HORIZONS]))
    totals = buyers.groupBy(*keys).agg(*[agg for n in HORIZONS for agg in (
        F.sum(f"n_{n}").cast("bigint").alias(f"orders_{n}"),
        F.count(F.when(F.col(f"n_{n}") > 0, F.col("user_id"))).cast("bigint")
        .alias(f"users_{n}"))])
    rows = by_horizon(totals, keys, {n: {"order_count": F.col(f"orders_{n}"),
                                         "order_user_count": F.col(f"users_{n}")}
                                     for n in HORIZONS})
    return _sold(rows).select(_on(day), "recent_days", *keys, "order_count", "order_user_count")


def _sold(rows: DataFrame) -> DataFrame:
    """The day itself has a row only where something was ordered."""
    return rows.where((F.col("recent_days") > 1) | (F.col("order_count") > 0))


def brand_order_stats(daily: DataFrame, day: str) -> DataFrame:
    return _order_stats(daily, BRAND_KEYS, day)


def category_order_stats(daily: DataFrame, day: str) -> DataFrame:
    return _order_stats(daily, CATEGORY_KEYS, day)


def cart_top3_by_category(cart: DataFrame, products: DataFrame, day: str) -> DataFrame:
    """Products with the largest cart stock per category; equal stock shares a place."""
    stock = (cart.where(F.col("ds") == day).groupBy("sku_id")
             .agg(F.sum("sku_num").cast("bigint").alias("cart_num")))
    labels = product_labels(products).select("sku_id", "sku_name", *CATEGORY_KEYS)
    ranked = top_ranks(stock.join(labels, "sku_id", "left"),
                       ["category1_id", "category2_id", "category3_id"], "cart_num", 3)
    return ranked.select(_on(day), *CATEGORY_KEYS, "sku_id", "sku_name", "cart_num", "rk")


def favorite_top3_by_brand(favorites: DataFrame, day: str) -> DataFrame:
    """Products added most often to the favourites per brand; equal counts share a place."""
    rows = favorites.where(F.col("ds") == day).select(
        *BRAND_KEYS, "sku_id", "sku_name", F.col("favor_add_count_1d").alias("favor_count"))
    ranked = top_ranks(rows, ["tm_id"], "favor_count", 3)
    return ranked.select(_on(day), *BRAND_KEYS, "sku_id", "sku_name", "favor_count", "rk")


def order_to_pay_seconds(flow: DataFrame, day: str) -> DataFrame:
    """Mean time from order to payment for orders paid on the day, finished or not."""
    seconds = (F.unix_timestamp(F.to_timestamp("payment_time"))
               - F.unix_timestamp(F.to_timestamp("order_time")))
    paid = flow.where(F.col("ds").isin(FAR_DAY, day) & (F.col("payment_date_id") == day))
    return (paid.agg(F.sum(seconds).alias("total"), F.count("*").alias("n"))
            .select(_on(day), mean_floor(F.col("total"), F.col("n"))
                    .alias("order_to_pay_interval_avg")))


def province_order_stats(daily: DataFrame, day: str) -> DataFrame:
    """Orders and amount per province for one, seven and thirty days, from one aggregate."""
    labels = [F.col(c).alias("iso_code_3166_2") if c == "iso_3166_2" else F.col(c)
              for c in PROVINCE_KEYS]
    keys = ["province_id", *PROVINCE_KEYS]
    totals = daily.where(last_days(F.col("ds"), day, max(HORIZONS))).groupBy(*keys).agg(
        *[agg for n in HORIZONS for agg in (
            sum_if(_within(day, n), F.col("order_count_1d")).alias(f"orders_{n}"),
            money_sum_if(_within(day, n), F.col("order_total_amount_1d")).alias(f"amount_{n}"))])
    rows = by_horizon(totals, keys, {n: {"order_count": F.col(f"orders_{n}"),
                                         "order_total_amount": F.col(f"amount_{n}")}
                                     for n in HORIZONS})
    return _sold(rows).select(_on(day), "recent_days", "province_id", *labels, "order_count",
                              "order_total_amount")


def coupon_stats(uses: DataFrame, day: str) -> DataFrame:
    """Uses and users per coupon; `uses` has one row per user, coupon and day."""
    return (uses.where(F.col("ds") == day).groupBy("coupon_id", "coupon_name").agg(
        F.sum("used_count_1d").cast("bigint").alias("used_count"),
        F.count("*").cast("bigint").alias("used_user_count"))
        .select(_on(day), "coupon_id", "coupon_name", "used_count", "used_user_count"))
