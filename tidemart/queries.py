"""Every job and operator as a query over the given tables: name -> function(spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import codes, keys, text
from tidemart.functions.days import (
    FAR_DAY, day_bucket, day_numbers, horizon_start, in_range, iso_day, shift)
from tidemart.functions.money import money
from tidemart.operators import (
    cells, exact, history, horizons, lookup, merging, ranking, sessions, substrings)
from tidemart.operators.placing import stored
from tidemart.plans import (
    behaviour, daily, dims, facts, horizon, moderation, profile, reports)
from tidemart.session import prepare, scratch_path
from tidemart.sources import readers, tables, writers
from tidemart.sources.shop import Shop, log_lines
from tidemart.streaming import changes, event_time, logs, sinks, windows

ORDER_DAY = "1998-06-30"
LOG_DAY = "2024-01-30"
FIRST_MONTH = "1995-01-31"
PAYMENT_DAY = "1998-07-03"
WATERMARK_SPLIT, WATERMARK_LATE = "2024-01-20", "2024-01-04"
# Seconds: lateness that windows wait for, pause that ends a session.
DELAY, SESSION_GAP = 60, 6 * 3600

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    """Register under the function's name; the function gets the shop."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(Shop(prepare(spark), folder, sized=True))
    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return function


# ---- dimensions -----------------------------------------------------------------------------

def _products(shop: Shop) -> DataFrame:
    return dims.product(shop.sku_info(), shop.spu_info(), shop.base_category3(),
                        shop.base_category2(), shop.base_category1(), shop.base_trademark(),
                        shop.sku_attr_value(), shop.sku_sale_attr_value())


def _labels(shop: Shop) -> DataFrame:
    """Names and categories only, for the aggregates and reports."""
    return dims.product_named(shop.sku_info(), shop.base_category3(), shop.base_category2(),
                              shop.base_category1(), shop.base_trademark())


def _coupons(shop: Shop) -> DataFrame:
    return dims.coupon(shop.coupon_info(), shop.base_dic())


def _provinces(shop: Shop) -> DataFrame:
    return dims.province(shop.base_province(), shop.base_region())


@query
def dim_product(shop):
    """Arrays are shown as JSON text."""
    return (_products(shop)
            .withColumn("sku_attr_values", F.to_json("sku_attr_values"))
            .withColumn("sku_sale_attr_values", F.to_json("sku_sale_attr_values")))


@query
def attr_lists(shop):
    lists = dims.attribute_lists(shop.sku_attr_value(), "sku_id", "attrs")
    return lists.withColumn("attrs", F.to_json("attrs"))


@query
def dim_coupon(shop):
    return _coupons(shop)


@query
def dim_activity(shop):
    return dims.activity(shop.activity_rule(), shop.activity_info(), shop.base_dic())


@query
def dim_province(shop):
    return _provinces(shop)


@query
def dim_promotion(shop):
    """Advert positions and channels in one result."""
    positions = dims.promotion_position(shop.promotion_pos()).select(
        F.lit("position").alias("kind"), "id", F.col("pos_location").alias("name"), "pos_type",
        "promotion_type", "create_time", "operate_time")
    channels = dims.promotion_channel(shop.promotion_refer()).select(
        F.lit("channel").alias("kind"), "id", F.col("refer_name").alias("name"), "create_time",
        "operate_time")
    return positions.unionByName(channels, allowMissingColumns=True)


@query
def dim_calendar(shop):
    """Calendar of all days with orders, through tab-separated staging text."""
    days = shop.table("orders").select(F.col("o_orderdate").cast("date").alias("day"))
    path = scratch_path(shop.spark, "calendar")
    writers.write_tsv(dims.calendar(days), path)
    return readers.read_tsv(shop.spark, path, dims.CALENDAR_COLUMNS)


@query
def dim_user_masked(shop):
    return dims.user_open(shop.user_info(), LOG_DAY)


@query
def dim_user_scd2(shop):
    """Users with a non-negative balance are known since January 1st; on the report day the
    machinery segment reaches another level, new users of that segment included."""
    users = shop.user_info()
    old_rows = dims.user_open(users.where(F.col("operate_time").isNull()), "2024-01-01")
    changed = users.where(F.col("user_level") == "M").withColumn("user_level", F.lit("VIP"))
    return dims.user_history(old_rows, changed, LOG_DAY)


@query
def user_history_rebuilt(shop):
    """Daily states of users from their events, every second event delivered after the others."""
    log = shop.table("events").select("user_id", "event_type", iso_day(F.col("ts")).alias("start_date"), "event_id")
    first, late = log.where("event_id % 2 = 1"), log.where("event_id % 2 = 0")
    kept = history.history_of(first, "user_id", ["event_type"], "event_id")
    return history.revise_history(kept, first, late, "user_id", ["event_type"], "event_id")


@query
def purchase_as_of_signup(shop):
    """Purchases with the value of their user's last signup up to then."""
    events = shop.table("events")
    signups = events.where("event_type = 'signup'").select("user_id", F.col("ts").alias("since"), "event_id",
                                                           F.col("value").alias("signup_value"))
    return history.as_of(events.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), signups,
                         "user_id", "ts", ["since", "event_id"], ["signup_value"]).drop("ts")


@query
def snapshot_diff(shop):
    """New, changed and deleted customers between two snapshots."""
    rows = shop.table("customer")
    part = F.col("c_custkey") % 50
    new = rows.where(part != 2).withColumn("c_mktsegment", F.when(part == 3, "VIP").otherwise(F.col("c_mktsegment")))
    return history.snapshot_changes(rows.where(part != 1), new, ["c_custkey"])


@query
def dict_decode(shop):
    """Coupon types and ranges by code: the same dictionary under two parents."""
    rows = shop.coupon_info().select("id", "coupon_type", "range_type")
    named = lookup.decode(rows, "coupon_type", shop.base_dic(), codes.COUPON_TYPE, "type_name")
    return lookup.decode(named, "range_type", shop.base_dic(), codes.COUPON_RANGE, "range_name")


# ---- facts ----------------------------------------------------------------------------------

@query
def fact_cart_add(shop):
    return facts.cart_add(shop.cart_info())


@query
def fact_cart_snapshot(shop):
    return _cart_snapshot(shop)


def _cart_snapshot(shop: Shop) -> DataFrame:
    return facts.cart_snapshot(shop.cart_info().where(F.col("ds") <= LOG_DAY), LOG_DAY)


@query
def line_amounts(shop):
    return facts.line_amounts(shop.order_detail()).drop("create_time")


@query
def fact_order_line(shop):
    return facts.order_line(shop.order_detail(), shop.order_info(), shop.order_detail_activity(),
                            shop.order_detail_coupon())


@query
def fact_order_line_daily(shop):
    """Orders and links are looked up for the orders of the day's lines only."""
    lines = shop.order_detail(ORDER_DAY, ORDER_DAY)
    ids = lines.select("order_id")
    return facts.order_line(lines, shop.order_info(ids), shop.order_detail_activity(ids),
                            shop.order_detail_coupon(ids))


@query
def order_totals_bucketed(shop):
    """Lines and orders stored in buckets of the order, then totals per order without a shuffle."""
    def put(name: str, rows: DataFrame, key: str) -> DataFrame:
        path = scratch_path(shop.spark, name)
        buckets = tables.buckets_for(shop.spark, f"{shop.folder}/lineitem.parquet")
        return tables.store_bucketed(rows, path.rsplit("/", 1)[-1].replace("-", "_"), path, [key], buckets)

    return facts.order_totals(put("bucketed_lines", shop.order_detail(), "order_id"),
                              put("bucketed_orders", shop.order_info(), "id"))


@query
def scan_lookback(shop):
    """Lines of the report day and of the day before."""
    lines = shop.order_detail(shift(ORDER_DAY, -1), ORDER_DAY)
    return readers.scan_days(lines, ORDER_DAY).select("id", "order_id", "sku_id", "sku_num", "ds")


@query
def fact_payment_line(shop):
    return facts.payment_line(shop.order_detail(), shop.payment_info(), shop.order_info(),
                              shop.order_detail_activity(), shop.order_detail_coupon(),
                              shop.base_dic())


def _paid_on(payments: DataFrame, day: str) -> DataFrame:
    start = F.lit(day).cast("timestamp")
    at = F.col("callback_time")
    return payments.where((at >= start) & (at < start + F.make_dt_interval(F.lit(1))))


@query
def fact_payment_line_daily(shop):
    """The day's payments with lines of the day or the day before, dated like their orders. Payments,
    orders and links are looked up for the orders of these days."""
    first = shift(PAYMENT_DAY, -1)
    ids = shop.order_days(first, PAYMENT_DAY).select("order_id")
    return facts.payment_line_daily(
        shop.order_detail_by_order_day(first, PAYMENT_DAY),
        _paid_on(shop.payment_info(ids), PAYMENT_DAY), shop.order_info(ids),
        shop.order_detail_activity(ids), shop.order_detail_coupon(ids), shop.base_dic(),
        PAYMENT_DAY)


@query
def payment_unmatched_daily(shop):
    """The day's payments of orders from before the look-back."""
    lines = shop.order_detail_by_order_day(shift(PAYMENT_DAY, -1), PAYMENT_DAY)
    return facts.unmatched_payments(_paid_on(shop.payment_info(), PAYMENT_DAY), lines, PAYMENT_DAY)


def _flow(shop: Shop) -> DataFrame:
    return facts.order_flow(shop.order_info(), shop.payment_info(), shop.order_status_log())


@query
def fact_order_flow(shop):
    return _flow(shop)


@query
def fact_order_flow_daily(shop):
    """Snapshot as of the day before the report day, then one daily step."""
    start = F.lit(ORDER_DAY).cast("timestamp")
    end = start + F.make_dt_interval(F.lit(1))

    def before(df, column):
        return df.where(F.col(column) < start)

    def during(df, column):
        return df.where((F.col(column) >= start) & (F.col(column) < end))

    orders, payments, log = shop.order_info(), shop.payment_info(), shop.order_status_log()
    flow = facts.order_flow(before(orders, "create_time"), before(payments, "callback_time"),
                            before(log, "create_time"))
    return facts.order_flow_daily(flow, during(orders, "create_time"),
                                  during(payments, "callback_time"), during(log, "create_time"),
                                  ORDER_DAY)


@query
def fact_coupon_used(shop):
    return facts.coupon_used(shop.coupon_use())


@query
def fact_favorite_add(shop):
    return facts.favorite_add(shop.favor_info())


@query
def fact_page_view(shop):
    return facts.page_view(shop.z_log())


@query
def log_rejects(shop):
    return facts.log_rejects(shop.z_log())


def _logins(shop: Shop) -> DataFrame:
    return facts.login(shop.z_log())


@query
def fact_login(shop):
    return _logins(shop)


@query
def first_event_per_session(shop):
    """First log line of every session, known user or not."""
    schema = f"common struct<sid: string>, page struct<page_id: string>, {readers.TIME}"
    rows = readers.parse_log(shop.z_log(), schema=schema).where(in_range(F.col("ts")).isNotNull()).select(
        F.col("common.sid").alias("session_id"), "ts", "id", "page.page_id")
    return ranking.first_rows(rows, ["session_id"], ["ts", "id"])


# ---- one-day aggregates ---------------------------------------------------------------------

def _lines(shop: Shop, first: str | None = None, last: str | None = None,
           owner: str = "user_id") -> DataFrame:
    """Lines with the buyer or the buyer's province. A few days of lines meet the customers after
    the orders, so that not all orders have to; the whole history meets orders with provinces."""
    lines = shop.order_detail(first, last)
    if owner == "user_id":
        return facts.order_line_measures(lines, shop.order_buyer(), owner)
    if first is None:
        return facts.order_line_measures(lines, shop.order_info(), owner)
    return facts.order_line_measures(lines, shop.order_buyer(), "user_id").join(
        shop.buyer_province(), "user_id", "left").drop("user_id")


def _user_product_1d(shop, first=None, last=None):
    return daily.user_product_order(_lines(shop, first, last), _labels(shop))


@query
def user_product_order_1d(shop):
    return _user_product_1d(shop)


@query
def user_order_1d(shop):
    return daily.user_order(_lines(shop))


@query
def user_cart_add_1d(shop):
    return daily.user_cart_add(facts.cart_add(shop.cart_info()))


@query
def user_payment_1d(shop):
    return daily.user_payment(facts.payment_line_measures(shop.order_detail(),
                                                          shop.payment_info()))


@query
def province_order_1d(shop):
    return daily.province_order(_lines(shop, owner="province_id"), _provinces(shop))


@query
def user_coupon_used_1d(shop):
    return daily.user_coupon_used(facts.coupon_used(shop.coupon_use()), _coupons(shop))


@query
def product_favorite_1d(shop):
    return daily.product_favorite(facts.favorite_add(shop.favor_info()), _labels(shop))


def _sessions(shop: Shop) -> DataFrame:
    return daily.session_page_view(facts.page_view(shop.z_log()))


@query
def session_page_view_1d(shop):
    return _sessions(shop)


@query
def visitor_page_view_1d(shop):
    return daily.visitor_page_view(facts.page_view(shop.z_log()))


# ---- horizons and totals --------------------------------------------------------------------

def _user_product_nd(shop: Shop) -> DataFrame:
    rows = _user_product_1d(shop, horizon_start(ORDER_DAY, 30), ORDER_DAY)
    return horizon.user_product_order(rows, ORDER_DAY)


@query
def user_product_order_nd(shop):
    return _user_product_nd(shop)


@query
def user_product_order_sliding(shop):
    """Two daily steps from the state of two days before; rows of an earlier day come with the second step."""
    rows = stored(_user_product_1d(shop, shift(ORDER_DAY, -32), ORDER_DAY), "daily")
    late = (F.col("ds") == shift(ORDER_DAY, -3)) & (F.col("user_id") % 3 == 0)
    known, corrections = rows.where(~late), rows.where(late).withColumn("days", F.lit(1))
    keys = ["user_id", "sku_id", *dims.PRODUCT_KEYS]
    state = horizon.user_product_state(known, shift(ORDER_DAY, -2))
    state = horizon.slide(state, known, corrections.limit(0), keys, horizon.COUNTS, shift(ORDER_DAY, -1))
    state = horizon.slide(state, rows, corrections, keys, horizon.COUNTS, ORDER_DAY)
    return state.drop("days_30d")


@query
def visitor_count_nd(shop):
    """Different visitors of each page, exact and from daily sketches."""
    views = facts.page_view(shop.z_log())
    sketches = stored(horizon.visitor_sketches(views), "sketches")
    return horizon.visitor_counts(views, LOG_DAY).join(
        horizon.visitor_estimates(sketches, LOG_DAY), ["page_id", "recent_days", "ds"])


def _province_1d(shop: Shop, length: int) -> DataFrame:
    lines = _lines(shop, horizon_start(ORDER_DAY, length), ORDER_DAY, owner="province_id")
    return daily.province_order(lines, _provinces(shop))


@query
def province_order_nd(shop):
    return horizon.province_order(_province_1d(shop, 30), ORDER_DAY)


def _user_days(shop: Shop) -> DataFrame:
    return daily.user_order(_lines(shop, None, ORDER_DAY))


@query
def user_order_td(shop):
    return horizon.user_order_total(_user_days(shop), ORDER_DAY)


def _totals_before(shop: Shop) -> tuple[DataFrame, DataFrame]:
    """Totals as of the day before, and the rows of the day; each scan has its own bounds."""
    yesterday = shift(ORDER_DAY, -1)
    previous = horizon.user_order_total(daily.user_order(_lines(shop, None, yesterday)), yesterday)
    return previous, daily.user_order(_lines(shop, ORDER_DAY, ORDER_DAY))


@query
def user_order_td_merge_join(shop):
    return horizon.user_order_total_by_join(*_totals_before(shop), ORDER_DAY)


@query
def user_order_td_merge_union(shop):
    return horizon.user_order_total_by_union(*_totals_before(shop), ORDER_DAY)


def _login_totals(shop: Shop, *days: str):
    """Login totals as of each day."""
    users, logins = dims.user_masked(shop.user_info()), _logins(shop)
    totals = [horizon.user_login_total(users, horizon.login_seen(logins, day), day)
              for day in days]
    return totals[0] if len(days) == 1 else totals


@query
def user_login_td(shop):
    return _login_totals(shop, LOG_DAY)


@query
def horizon_fanout(shop):
    """Active user-days per horizon: the row of each day once per horizon it falls into."""
    days = shop.events().groupBy(iso_day(F.col("ts")).alias("ds")).agg(
        F.count("*").alias("n"))
    spread = horizons.fan_out(days, (1, 7, 30))
    start = F.date_add(F.lit(LOG_DAY).cast("date"), (1 - F.col("recent_days")).cast("int"))
    return (spread.where((F.to_date("ds") >= start) & (F.col("ds") <= LOG_DAY))
            .groupBy("recent_days").agg(F.sum("n").cast("bigint").alias("event_count"),
                                        F.count("*").cast("bigint").alias("day_count")))


@query
def lead_gap(shop):
    """Days until a user's next-but-one active day; the far day where there is none."""
    days = shop.events().select("user_id", iso_day(F.col("ts")).alias("ds")).distinct()
    rows = ranking.lead_within(days, ["user_id"], ["ds"], "ds", 2, FAR_DAY, "second_next")
    return rows.withColumn("gap", F.datediff(F.to_date("second_next"), F.to_date("ds")))


# ---- reports --------------------------------------------------------------------------------

@query
def channel_traffic(shop):
    return reports.channel_traffic(_sessions(shop), LOG_DAY)


@query
def user_churn_return(shop):
    today, before = _login_totals(shop, LOG_DAY, shift(LOG_DAY, -1))
    return reports.user_churn_return(today, before, LOG_DAY)


@query
def user_retention(shop):
    return reports.user_retention(_login_totals(shop, LOG_DAY), LOG_DAY)


@query
def user_new_active(shop):
    return reports.user_new_active(_login_totals(shop, LOG_DAY), LOG_DAY)


@query
def user_funnel(shop):
    """Orders and payments come from purchase events, whose times match the log's days."""
    bought = shop.events().where(F.col("event_type") == "purchase").select(
        "user_id", iso_day(F.col("ts")).alias("ds"), "value")
    ordered = bought.groupBy("user_id", "ds").agg(F.count("*").alias("order_count_1d"))
    paid = (bought.where(F.col("value") >= 20).groupBy("user_id", "ds")
            .agg(F.count("*").alias("payment_count_1d")))
    return reports.user_funnel(daily.visitor_page_view(facts.page_view(shop.z_log())),
                               daily.user_cart_add(facts.cart_add(shop.cart_info())),
                               ordered, paid, LOG_DAY)


@query
def new_order_users(shop):
    """At the end of the shop's first month: later hardly anybody orders for the first time."""
    days = daily.user_order(_lines(shop, None, FIRST_MONTH))
    return reports.new_order_users(horizon.user_order_total(days, FIRST_MONTH), FIRST_MONTH)


@query
def consecutive_order_users(shop):
    """On active days of the event stream: orders of one user are too sparse for runs."""
    days = shop.events().select("user_id", iso_day(F.col("ts")).alias("ds")).distinct()
    return reports.consecutive_order_users(days, LOG_DAY)


@query
def brand_repeat_rate(shop):
    return reports.brand_repeat_rate(_user_product_nd(shop), ORDER_DAY)


@query
def brand_order_stats(shop):
    rows = _user_product_1d(shop, horizon_start(ORDER_DAY, 30), ORDER_DAY)
    return reports.brand_order_stats(rows, ORDER_DAY)


@query
def category_order_stats(shop):
    rows = _user_product_1d(shop, horizon_start(ORDER_DAY, 30), ORDER_DAY)
    return reports.category_order_stats(rows, ORDER_DAY)


@query
def cart_top3_by_category(shop):
    return reports.cart_top3_by_category(_cart_snapshot(shop), _labels(shop), LOG_DAY)


@query
def favorite_top3_by_brand(shop):
    rows = daily.product_favorite(facts.favorite_add(shop.favor_info()), _labels(shop))
    return reports.favorite_top3_by_brand(rows, LOG_DAY)


@query
def order_to_pay_seconds(shop):
    return reports.order_to_pay_seconds(_flow(shop), ORDER_DAY)


@query
def province_order_stats(shop):
    """All horizons from one scan of the last 30 days."""
    return reports.province_order_stats(_province_1d(shop, 30), ORDER_DAY)


@query
def coupon_stats(shop):
    uses = daily.user_coupon_used(facts.coupon_used(shop.coupon_use()), _coupons(shop))
    return reports.coupon_stats(uses, ORDER_DAY)


# ---- behaviour and profile ------------------------------------------------------------------

@query
def page_visits(shop):
    return behaviour.page_visits(facts.page_view(shop.z_log()))


@query
def search_top10(shop):
    return behaviour.search_top(shop.searches(), 10)


@query
def login_region_heat(shop):
    return behaviour.login_region_heat(_logins(shop), _provinces(shop))


@query
def page_path_edges(shop):
    return behaviour.page_path_edges(shop.z_log())


@query
def page_paths(shop):
    return behaviour.page_paths(shop.z_log())


@query
def frequent_page_paths(shop):
    """Paths that one in a hundred sessions takes, of any length."""
    return behaviour.frequent_paths(shop.z_log())


@query
def device_rollup(shop):
    return behaviour.device_rollup(facts.page_view(shop.z_log()))


@query
def category_rollup(shop):
    return behaviour.category_rollup(_user_product_1d(shop))


@query
def user_profile_json(shop):
    return profile.user_profile(profile.user_activity(shop.z_log()))


@query
def profile_age_label(shop):
    """Event types stand for dimensions, ranges of the key for age bands; errors have no weight."""
    return _age_labels(shop)


def _age_labels(shop: Shop) -> DataFrame:
    k = F.col("k")
    band = (F.when(k < 20, "18-24").when(k < 40, "25-29").when(k < 60, "30-34")
            .when(k < 80, "35-39").otherwise("40+"))
    scores = shop.events().select(
        "user_id", F.col("event_type").alias("dimension"), band.alias("label"),
        money(F.col("value")).alias("score"))
    weights = readers.literal_rows(
        shop.spark, [("click", "0.30"), ("purchase", "0.40"), ("view", "0.20"),
                     ("signup", "0.10")], "dimension string, weight string")
    return profile.age_label(scores, weights.withColumn(
        "weight", F.col("weight").cast("decimal(4,2)")))


@query
def profile_gender_label(shop):
    return _gender_labels(shop)


def _gender_labels(shop: Shop) -> DataFrame:
    k = F.col("k")
    side = F.when(k < 34, "female").when(k < 67, "male").otherwise("family")
    return profile.gender_label(shop.events().select(
        "user_id", side.alias("side"), money(F.col("value")).alias("score")))


@query
def profile_labels(shop):
    """All labels per user; height and weight follow from the customer's number."""
    key = F.col("c_custkey")
    measures = shop.table("customer").where(key % 3 != 0).select(
        key.alias("user_id"), (key % 50 + 150).alias("height_cm"),
        ((key % 400 + 450) / F.lit(10)).cast("decimal(5,1)").alias("weight_kg"))
    return profile.label_table(shop.user_info(), _age_labels(shop), _gender_labels(shop),
                               profile.zodiac(shop.user_info()), measures)


@query
def profile_zodiac(shop):
    return profile.zodiac(shop.user_info())


@query
def product_name_split(shop):
    full = F.concat("p_brand", F.when(F.col("p_size") > 10, text.NAME_SEPARATOR).otherwise(" "),
                    "p_name", F.lit(" 套装 "), "p_type")
    rows = shop.table("part").select(F.col("p_partkey").alias("sku_id"), full.alias("full_name"))
    return profile.split_product_names(rows, "full_name")


# ---- moderation -----------------------------------------------------------------------------

def _words(shop: Shop) -> DataFrame:
    return readers.literal_rows(shop.spark, moderation.SAMPLE_WORDS, "word string, grade string")


@query
def comment_grade(shop):
    graded = moderation.grade_by_text(shop.documents(), moderation.SAMPLE_WORDS)
    return graded.select("comment_id", "user_id", "grade")


@query
def comment_grade_lookup(shop):
    """Whole words against the dictionary table."""
    return moderation.grade_by_lookup(shop.documents(), _words(shop))


def _stems(shop: Shop) -> DataFrame:
    """The words of seven letters or more of the benchmark texts as a list of stems; ten letters and twelve are stronger."""
    word = F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")
    n = F.length("word")
    return shop.table("benchmark").select(word).where(n >= 7).distinct().withColumn(
        "grade", F.when(n >= 12, "P0").when(n >= 10, "P1").otherwise("P2"))


@query
def comment_words_inside(shop):
    """Words of a list found anywhere in the comments, also inside longer words: how many comments hold each."""
    found = substrings.words_inside(shop.documents(), _stems(shop), "comment_id", "review_text")
    return found.groupBy("word").agg(F.count("*").cast("bigint").alias("comment_count"))


@query
def comment_grade_inside(shop):
    """Strongest grade per comment by a list of any size, matching inside words."""
    return moderation.grade_inside(shop.documents(), _stems(shop))


@query
def ban_periods(shop):
    """Uninterrupted bans; errors stand for offences, their value for the grade, a day of the log for fifty."""
    return _ban_rows(windows.ban_periods(_offences(shop.table("events"))))


def _ban_rows(bans: DataFrame) -> DataFrame:
    return bans.select("user_id", _moment("banned_from"), _moment("expires"), "worst_grade", "offences")


def _offences(events: DataFrame) -> DataFrame:
    time = F.timestamp_micros((F.unix_micros(F.col("ts").cast("timestamp")) - 1_704_067_200_000_000) * 50
                              + 1_704_067_200_000_000)
    return events.where(F.col("event_type") == "error").select(
        "event_id", "user_id", time.alias("offended_at"),
        F.when(F.col("value") < 5, "P0").when(F.col("value") < 30, "P1").otherwise("P2").alias("grade"))


@query
def comment_blacklist(shop):
    """Sources stand for users; the length of a text decides on the day of the comment."""
    comments = shop.table("documents").select(
        F.col("source").alias("user_id"), F.col("text").alias("review_text"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n_chars") % 30).cast("int"))
        .cast("string").alias("ds"))
    graded = moderation.grade_by_text(comments, moderation.SAMPLE_WORDS)
    return moderation.blacklist(graded, "2024-03-20")


@query
def comment_totals(shop):
    graded = moderation.grade_by_text(shop.documents(), moderation.SAMPLE_WORDS)
    return moderation.totals(graded)


@query
def word_membership(shop):
    """Every distinct word of the comments with a flag whether it is in the dictionary."""
    words = moderation.tokens(shop.documents()).select("word").distinct()
    return lookup.member_flags(words, "word", _words(shop), "word")


@query
def word_semi_join(shop):
    """Dictionary words per comment."""
    words = moderation.tokens(shop.documents()).select("comment_id", "word")
    return (lookup.only_members(words, "word", _words(shop), "word")
            .groupBy("comment_id").agg(F.count("*").cast("bigint").alias("word_count")))


@query
def charset_filter(shop):
    label = (F.when(F.col("p_size") > 25, F.col("p_name")).when(F.col("p_size") > 20, F.concat(
        "p_brand", F.lit("\n"))).otherwise(F.col("p_brand")))
    return (shop.table("part").select(F.col("p_partkey").alias("sku_id"), label.alias("label"))
            .withColumn("is_permitted", text.is_permitted(F.col("label"))))


@query
def blank_filter(shop):
    """Events whose label is not blank; labels are made null, empty or blank by value."""
    value = F.col("value")
    label = (F.when(value < 5, F.lit(None).cast("string")).when(value < 10, "")
             .when(value < 15, " \t ").otherwise(F.col("event_type")))
    rows = shop.table("events").select("event_id", label.alias("label"))
    return rows.where(~text.is_blank(F.col("label")))


# ---- input and output -----------------------------------------------------------------------

@query
def tsv_roundtrip(shop):
    rows = shop.table("orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderstatus")).alias("status"))
    path = scratch_path(shop.spark, "orders-tsv")
    writers.write_tsv(rows, path)
    return readers.read_tsv(shop.spark, path, "o_orderkey bigint, o_custkey bigint,"
                                              " priority string, status string")


@query
def json_lines(shop):
    rows = shop.table("events").select("event_id", "user_id", "event_type", "props")
    path = scratch_path(shop.spark, "events-json")
    writers.write_json_lines(rows, path)
    return readers.read_json_lines(
        shop.spark, path, "event_id bigint, user_id bigint, event_type string, props string")


@query
def camel_columns(shop):
    rows = shop.table("customer").withColumn("c_acctbal", money(F.col("c_acctbal")))
    return text.camel_columns(rows)


@query
def snapshot_load(shop):
    """Full copy of a source table into a day partition, read back with its day."""
    path = scratch_path(shop.spark, "ods-orders")
    rows = shop.order_info().withColumn("create_time", F.col("create_time").cast("string"))
    writers.write_partition(rows, path, ORDER_DAY)
    return readers.scan_day(readers.read_table(shop.spark, path), ORDER_DAY)


@query
def incremental_load(shop):
    """Users created or changed since a day."""
    changed = readers.changed_since(shop.user_info(), "2024-01-25")
    path = scratch_path(shop.spark, "ods-user")
    rows = dims.user_masked(changed).select("id", "name", "create_time", "operate_time")
    writers.write_partition(rows, path, "2024-01-25")
    return readers.scan_day(readers.read_table(shop.spark, path), "2024-01-25")


@query
def partition_overwrite(shop):
    """Two day partitions are written, then one of them again with other rows."""
    path = scratch_path(shop.spark, "favourites")
    rows = facts.favorite_add(shop.favor_info()).drop("ds")
    writers.write_partition(rows, path, "2024-01-01")
    writers.write_partition(rows, path, "2024-01-02")
    writers.write_partition(rows.where(F.col("sku_id") >= 50), path, "2024-01-02")
    return readers.read_table(shop.spark, path)


@query
def dynamic_partition_write(shop):
    """All days by their own value, then some days again; the others stay."""
    path = scratch_path(shop.spark, "carts")
    rows = facts.cart_add(shop.cart_info())
    writers.write_by_day(rows, path)
    again = rows.where(F.col("ds") >= "2024-01-20").withColumn("sku_num", F.col("sku_num") + 1)
    writers.write_by_day(again, path)
    return readers.read_table(shop.spark, path)


@query
def append_distinct(shop):
    """A report appended three times: history, an overlapping rerun, the same rerun again."""
    path = scratch_path(shop.spark, "visits")
    visits = behaviour.page_visits(facts.page_view(shop.z_log()))
    writers.append_distinct(visits.where(F.col("ds") <= "2024-01-20"), path)
    late = visits.where(F.col("ds") >= "2024-01-10")
    writers.append_distinct(late, path)
    writers.append_distinct(late, path)
    return readers.read_table(shop.spark, path)


@query
def to_json_rows(shop):
    rows = shop.table("events").select("event_id", "user_id", "event_type")
    return writers.json_messages(rows)


@query
def null_safe_values(shop):
    """Message bytes as text; errors are tombstones without a value."""
    value = F.when(F.col("event_type") != "error", F.col("props").cast("binary"))
    return readers.message_text(shop.table("events").select("event_id", value.alias("value")))


def _customer_cells(shop: Shop) -> DataFrame:
    rows = shop.table("customer").select(
        "c_custkey", "c_name", "c_mktsegment", money(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_nationkey") > 4, F.col("c_nationkey")).alias("c_nationkey"))
    key = keys.row_key(["c_mktsegment", "c_custkey"], "_")
    return cells.rows_to_cells(rows, key, skip=("c_custkey",))


@query
def rows_to_cells(shop):
    return _customer_cells(shop)


@query
def cells_to_rows(shop):
    return cells.cells_to_rows(_customer_cells(shop))


@query
def cells_scan_limit(shop):
    """The first hundred rows in key order."""
    return cells.cells_to_rows(_customer_cells(shop), limit=100)


@query
def cell_point_read(shop):
    """The cells of one row, by its key."""
    return cells.one_row(_customer_cells(shop), "BUILDING_82")


@query
def cell_row_count(shop):
    return cells.count_rows(_customer_cells(shop))


@query
def delete_by_keys(shop):
    """Orders without those that have a returned line."""
    returned = (shop.table("lineitem").where(F.col("l_returnflag") == "R")
                .select(F.col("l_orderkey").alias("o_orderkey")))
    orders = shop.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return merging.without_keys(orders, returned, ["o_orderkey"])


@query
def row_key(shop):
    """Plain, field-digested and whole-digested keys."""
    return shop.table("orders").select(
        "o_orderkey", keys.row_key(["o_custkey", "o_orderkey"], "_").alias("plain"),
        keys.row_key([("o_custkey", True), "o_orderkey"], "-").alias("field_digest"),
        keys.row_key(["o_custkey", "o_orderkey"], "", digest=True).alias("whole_digest"))


# ---- streams --------------------------------------------------------------------------------

def _stream(shop: Shop, name: str) -> DataFrame:
    """A given table read as a stream of files, a gigabyte per core and micro-batch."""
    schema = shop.table(name).schema
    size = shop.spark.sparkContext.defaultParallelism << 30
    # As a pattern the path may be a single file as well as a folder of files.
    pattern = f"{shop.folder}/{name}.parque[t]"
    return shop.spark.readStream.schema(schema).option("maxBytesPerTrigger", size).parquet(pattern)


def _log_stream(shop: Shop) -> DataFrame:
    return log_lines(_stream(shop, "events")).withColumnRenamed("log", "value")


def _to_files(shop: Shop, name: str, stream: DataFrame, partition_by: str | None = None):
    """Run a stream over all available input and read its output."""
    path, mark = scratch_path(shop.spark, name), scratch_path(shop.spark, f"{name}-checkpoint")
    sinks.run_to_end(sinks.to_files(stream, path, mark, partition_by=partition_by, once=True))
    return shop.spark.read.schema(stream.schema).parquet(path)


def _timed(shop: Shop, name: str, rows: DataFrame, time, delay: int) -> DataFrame:
    """Messages counted per event day under a watermark, and the rejects.

    The messages arrive in two deliveries: the first days, then the others together with the messages
    of some early days again, which are late by then. One query routes a delivery, a second counts
    what is usable; both go on from their checkpoints with the second delivery.
    """
    spark = shop.spark
    source, routes, counts, *marks = (scratch_path(spark, f"{name}-{x}") for x in (
        "input", "routes", "counts", "mark", "count-mark"))
    rows = rows.select("id", "value", "day")
    first = rows.where(F.col("day") < WATERMARK_SPLIT)
    second = rows.where(F.col("day") >= WATERMARK_SPLIT).unionByName(
        rows.where(F.col("day") < WATERMARK_LATE))
    for part in (first, second):
        part.drop("day").write.mode("append").parquet(source)
        stream = spark.readStream.schema("id bigint, value string").parquet(source)
        sinks.run_to_end(sinks.to_files(event_time.routed(stream, time), routes, marks[0],
                                        partition_by="route", once=True))
        usable = (spark.readStream.schema("id bigint, value string, event_time timestamp, route string")
                  .parquet(routes).where(F.col("route") == "ok"))
        sinks.run_to_end(sinks.to_files(event_time.daily_counts(usable, delay), counts, marks[1],
                                        once=True))
    days = spark.read.schema("day timestamp, message_count bigint").parquet(counts)
    lost = spark.read.parquet(routes).where(F.col("route") == "reject")
    return days.select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.lit("ok").alias("route"),
                       "message_count").unionByName(
        lost.groupBy("route").agg(F.count("*").cast("bigint").alias("message_count")).select(
            F.lit(None).cast("string").alias("day"), "route", "message_count"))


def _with_day(events: DataFrame) -> DataFrame:
    return events.withColumn("day", iso_day(F.col("ts")))


@query
def stream_watermark(shop):
    events = shop.table("events")
    days = events.select(F.col("event_id").alias("id"), iso_day(F.col("ts")).alias("day"))
    rows = log_lines(events).withColumnRenamed("log", "value").join(days, "id")
    return _timed(shop, "watermark", rows, event_time.field_millis(F.col("value"), "ts"), 5)


@query
def stream_watermark_fallback(shop):
    """Views carry only the second time field, errors none."""
    e = _with_day(shop.table("events"))
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    value = F.to_json(F.struct(
        F.when(F.col("event_type").isin("click", "signup"), seconds).alias("block_timestamp"),
        F.when(F.col("event_type") != "error", seconds + 60).alias("timestamp")))
    rows = e.select(F.col("event_id").alias("id"), value.alias("value"), "day")
    return _timed(shop, "fallback", rows,
                  event_time.field_seconds(F.col("value"), "block_timestamp", "timestamp"), 10)


@query
def stream_watermark_list(shop):
    """Messages are lists of windows; errors send an empty list."""
    e = _with_day(shop.table("events"))
    start = F.unix_millis(F.col("ts").cast("timestamp"))
    item = F.struct(start.alias("window_start_time"))
    later = F.struct((start + 60_000).alias("window_start_time"))
    value = F.when(F.col("event_type") == "error", F.lit("[]")).otherwise(
        F.to_json(F.array(item, later)))
    rows = e.select(F.col("event_id").alias("id"), value.alias("value"), "day")
    return _timed(shop, "list", rows, event_time.first_window_start(F.col("value")), 10)


def _delivered(shop: Shop, name: str, rows: DataFrame, time: str, day, give: Callable[[DataFrame], DataFrame]):
    """What `give` makes of the usable rows of a stream, and the rows per route that are not usable.

    Rows arrive half a minute after their time, in two deliveries; the second brings early rows once more, twenty days
    late. Routing and windows are two queries that go on from their checkpoints with the second delivery.
    """
    spark = shop.spark
    source, routes, result, *marks = (scratch_path(spark, f"{name}-{x}") for x in (
        "input", "routes", "result", "mark", "result-mark"))

    def arriving(part: DataFrame, after: str) -> DataFrame:
        return part.withColumn("arrival", F.col(time) + F.expr(f"INTERVAL {after}"))

    first = arriving(rows.where(day < WATERMARK_SPLIT), "30 SECONDS")
    second = arriving(rows.where(day >= WATERMARK_SPLIT), "30 SECONDS").unionByName(
        arriving(rows.where(day < WATERMARK_LATE), "20 DAYS"))
    for part in (first, second):
        part.write.mode("append").parquet(source)
        routed = windows.by_lateness(spark.readStream.schema(part.schema).parquet(source), time, "arrival", DELAY)
        sinks.run_to_end(sinks.to_files(routed, routes, marks[0], partition_by="route", once=True))
        usable = spark.readStream.schema(routed.schema).parquet(routes).where(F.col("route") == "ok")
        windowed = give(usable)
        sinks.run_to_end(sinks.to_files(windowed, result, marks[1], once=True))
    lost = spark.read.schema(routed.schema).parquet(routes).where(F.col("route") != "ok")
    return (spark.read.schema(windowed.schema).parquet(result),
            lost.groupBy("route").agg(F.count("*").cast("bigint").alias("row_count")))


def _moment(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def _timed_events(shop: Shop) -> DataFrame:
    return shop.table("events").withColumn("ts", F.col("ts").cast("timestamp"))


def _event_measures() -> list:
    return [F.count("*").cast("bigint").alias("event_count"), F.max("event_id").alias("last_event")]


@query
def event_sessions(shop):
    """Events of a user no more than six hours apart."""
    found = sessions.gap_sessions(_timed_events(shop), "user_id", "ts", SESSION_GAP, _event_measures())
    return found.select("user_id", _moment("session_start"), _moment("session_end"), "event_count", "last_event")


@query
def stream_sessions(shop):
    """The sessions that the watermark has closed; late rows are counted on their route, without a user."""
    events = _timed_events(shop)
    closed, lost = _delivered(
        shop, "sessions", events, "ts", iso_day(F.col("ts")),
        lambda rows: windows.sessions(rows, "user_id", "ts", SESSION_GAP, _event_measures(), DELAY))
    return closed.select("user_id", F.lit("ok").alias("route"), _moment("session_start"), _moment("session_end"),
                         "event_count", "last_event").unionByName(
        lost.select("route", F.col("row_count").alias("event_count")), allowMissingColumns=True)


@query
def stream_minute_counts(shop):
    """Events per type and minute, of the minutes the watermark has passed."""
    events = _timed_events(shop)
    counts, _ = _delivered(shop, "minutes", events, "ts", iso_day(F.col("ts")),
                           lambda rows: windows.window_counts(rows, ["event_type"], "ts", "1 minute", DELAY))
    return counts.select("event_type", _moment("window_start"), "row_count")


@query
def stream_bans(shop):
    """Bans that have expired by the watermark."""
    rows = _offences(shop.table("events"))
    expired, _ = _delivered(shop, "bans", rows, "offended_at", iso_day(F.col("offended_at")),
                            lambda part: windows.ban_periods(part, DELAY))
    return _ban_rows(expired)


@query
def epoch_day_bucket(shop):
    """Folder names for seconds (clicks), milliseconds and missing times (errors)."""
    millis = F.unix_millis("ts")
    epoch = (F.when(F.col("event_type") == "click", F.floor(millis / 1000))
             .when(F.col("event_type") != "error", millis))
    return shop.events().select("event_id", day_bucket(epoch).alias("bucket"))


@query
def epoch_day(shop):
    return shop.events().select(
        "event_id", F.date_format(F.timestamp_millis(F.unix_millis("ts")), "yyyyMMdd").alias("day"))


@query
def stream_day_bucket(shop):
    """Log lines in one folder per day; garbled lines in the error folder."""
    stream = _log_stream(shop)
    path, mark = (scratch_path(shop.spark, n) for n in ("buckets", "buckets-checkpoint"))
    sinks.run_to_end(sinks.to_day_buckets(stream, "ts", path, mark, once=True))
    return shop.spark.read.parquet(path).select("id", F.col("day").cast("string").alias("day"))


@query
def stream_exactly_once(shop):
    """The same query started twice on one checkpoint writes every line once."""
    path, mark = (scratch_path(shop.spark, n) for n in ("once", "once-checkpoint"))
    for _ in range(2):
        stream = _log_stream(shop).select("id", F.length("value").cast("bigint").alias("size"))
        sinks.run_to_end(sinks.to_files(stream, path, mark, once=True))
    return shop.spark.read.parquet(path).select("id")


@query
def stream_log_split(shop):
    routed = logs.split_log(_log_stream(shop))
    return _to_files(shop, "split", routed, partition_by="route").select("id", "route")


def _graded_stream(shop: Shop) -> DataFrame:
    comments = _stream(shop, "documents").select(
        F.col("doc_id").alias("comment_id"), F.col("text").alias("review_text"))
    return moderation.grade_by_text(comments, moderation.SAMPLE_WORDS).select(
        "comment_id", "grade")


@query
def stream_comment_grade(shop):
    return _to_files(shop, "grades", _graded_stream(shop))


@query
def stream_comment_totals(shop):
    """Running totals; the last state of the stream."""
    path, mark = (scratch_path(shop.spark, n) for n in ("totals", "totals-checkpoint"))
    sinks.run_to_end(sinks.per_batch(moderation.totals(_graded_stream(shop)),
                                     sinks.keep_latest_result(path), mark,
                                     mode="complete", once=True))
    return sinks.latest_result(shop.spark, path)


@query
def cdc_apply(shop):
    """Events as changes of a user table: errors delete the user's row, others replace it."""
    e = _stream(shop, "events")
    row = F.struct("user_id", "event_type", money(F.col("value")).cast("string").alias("value"))
    deleted = F.col("event_type") == "error"
    envelope = F.to_json(F.struct(
        F.when(deleted, row).alias("before"), F.when(~deleted, row).alias("after"),
        F.when(deleted, "d").otherwise("u").alias("op"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"), F.col("event_id").alias("pos")))
    stream = changes.parse_changes(
        e.select(envelope.alias("value")),
        "struct<user_id: bigint, event_type: string, value: string>", "user_id")
    path, mark = (scratch_path(shop.spark, n) for n in ("users", "users-checkpoint"))
    sinks.run_to_end(sinks.per_batch(stream, changes.apply_batch(path, "user_id"), mark,
                                     once=True))
    return changes.current_rows(shop.spark, path, "user_id")


# ---- keys -----------------------------------------------------------------------------------

@query
def hash_bucket(shop):
    bucket = keys.hash_bucket(F.col("o_custkey"))
    return shop.table("orders").groupBy(bucket.alias("bucket")).agg(
        F.count("*").cast("bigint").alias("order_count"))


@query
def hot_key_bucket(shop):
    """Users as addresses; two of them have a bucket of their own."""
    address = F.concat(F.lit("0x"), F.lpad(F.col("user_id").cast("string"), 40, "0"))
    return shop.table("events").groupBy(keys.spread_bucket(address).alias("bucket")).agg(
        F.count("*").cast("bigint").alias("event_count"))


@query
def token_amount_daily(shop):
    """Daily sums of amounts in padded 32-byte words (views), texts above 38 digits and fractions (clicks),
    damaged and wide hex (signups), missing text (errors) and plain hex; rejects are counted."""
    number, k = F.lower(F.hex("event_id")), F.col("user_id") % 3
    kind = F.col("event_type")
    amount = (F.when(kind == "view", F.concat(F.lit("0x"), F.lpad(number, 64, "0")))
              .when((kind == "click") & (k == 0), F.concat(F.col("event_id").cast("string"), F.lit(".5")))
              .when(kind == "click", F.concat(F.col("event_id").cast("string"), F.lit("0" * 40)))
              .when((kind == "signup") & (k == 0), F.lit("0xzz"))
              .when(kind == "signup", F.concat(F.lit("0x"), number, F.lit("0" * 16)))
              .when(kind != "error", F.concat(F.lit("0x"), number)))
    rows = shop.events().select(iso_day(F.col("ts")).alias("ds"),
                                keys.token_amount(amount).alias("amount"))
    return exact.sum_texts(rows, ["ds"], "amount", F.count("*").cast("bigint").alias("transfer_count"),
                           F.count_if(F.col("amount").isNull()).cast("bigint").alias("reject_count"))


@query
def log_words(shop):
    """The bytes of every text as log data, cut into 32-byte words."""
    data = F.concat(F.lit("0x"), F.hex("text"))
    rows = shop.table("documents").select("doc_id", keys.log_words(data).alias("words"))
    return (rows.select("doc_id", F.posexplode_outer("words").alias("word_no", "word"))
            .where(F.col("word").isNotNull()))


@query
def day_range(shop):
    """Days from an event's day to a fixed day, counted by day; later events give no days."""
    days = shop.events().groupBy(F.to_date("ts").alias("first")).agg(F.count("*").alias("n"))
    spread = days.select("n", F.explode(day_numbers(
        F.col("first"), F.lit("2024-01-15").cast("date"))).alias("day"))
    return spread.groupBy("day").agg(F.sum("n").cast("bigint").alias("event_count"))


@query
def history_append(shop):
    """Add the digest of each event to its history; views have none yet, a signup's list is cut short
    and gives null."""
    user = F.col("user_id").cast("string")
    history = (F.when(F.col("event_type") == "signup", F.concat(F.lit('["'), user, F.lit('"')))
               .when(F.col("event_type") != "view", F.concat(F.lit('["'), user, F.lit('"]'))))
    return shop.table("events").select(
        "event_id", keys.history_append(
            history, F.md5(F.col("event_id").cast("string"))).alias("history"))
