"""Restaurant orders, redemptions, preference and priority."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom import settings as fixed
from tagloom.functions.exprs import drop_missing, exact, mean
from tagloom.operators.base import (
    BY_ITEM,
    BY_USER,
    Tables,
    per_key,
    rows,
    tallied,
    total,
)
from tagloom.operators.services import order_users
from tagloom.operators.skew import hot_keys, spread_join


def local_restaurants(tables: Tables) -> DataFrame:
    """Restaurant rows in the counted language that have a location."""
    restaurants = tables("itd_restaurant").select("fd_code", "fd_lg", "fd_inspection")
    counted = restaurants.filter(F.col("fd_lg") == fixed.RESTAURANT_LANGUAGE)
    return drop_missing(counted, "fd_inspection").select(F.col("fd_code").alias("item_code"))


#: Bytes that a broadcast row takes besides its text.
ROW_BYTES = 40

_sizes: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()


def measured_restaurants(tables: Tables) -> DataFrame:
    """``local_restaurants``, broadcast where their measured size is under the session's limit for that.

    Catalyst's estimate of a table that is itself a join is the product of both sides, and AQE measures only
    after every order line has been shuffled to its restaurant. Measured once for all the queries of a resolver.
    """
    table, codes = tables("itd_restaurant"), local_restaurants(tables)
    if table not in _sizes:
        size = F.sum(F.octet_length(F.col("item_code").cast("string")) + ROW_BYTES)
        _sizes[table] = codes.agg(size).first()[0] or 0
    return F.broadcast(codes) if _sizes[table] < broadcast_limit(codes) else codes


def broadcast_limit(df: DataFrame) -> int:
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.startswith("-"):
        return 0
    return df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)


def order_lines(
    tables: Tables, *prices: str, require: tuple[str, ...] | None = None
) -> DataFrame:
    """Order details at known restaurants: order_no, item_code, order_day, prices.

    ``require`` names the prices that must be present (default: all of them). Code, order
    time and class must be present too, although no metric reads the class. The restaurants
    are broadcast while their size allows it.
    """
    details = tables("restaurant_order_detail2").select(
        F.col("fd_code").alias("order_no"),
        F.col("fd_restaurant_code").alias("item_code"),
        "ordertime",
        "fd_class",
        *prices,
    )
    needed = prices if require is None else require
    details = drop_missing(details, "order_no", "item_code", "ordertime", "fd_class", *needed)
    return details.join(measured_restaurants(tables), "item_code").select(
        "order_no", "item_code", F.to_date("ordertime").alias("order_day"), *prices
    )


def user_lines(tables: Tables, lines: DataFrame) -> DataFrame:
    """``lines`` with the user of their order; an order with very many lines is spread."""
    hot = hot_keys(tables, "restaurant_order_detail2", "fd_code")
    return spread_join(lines, order_users(tables), "order_no", hot)


def user_orders(
    tables: Tables, lines: DataFrame, by: tuple[str, ...], /, **values: Column
) -> DataFrame:
    """``values`` of the lines with the user of their order.

    Per user alone they are added up per order first, which uses the join's own shuffle; with an
    item that would be a shuffle more, so the lines themselves are joined.
    """
    if by == BY_USER:
        sums = {name: F.sum(value) for name, value in values.items()}
        return tallied(lines, "order_no", **sums).join(order_users(tables), "order_no")
    columns = [value.alias(name) for name, value in values.items()]
    return user_lines(tables, lines.select("order_no", *by[1:], *columns))


def consumption(tables: Tables, by: tuple[str, ...], name: str) -> DataFrame:
    """Number of orders."""
    orders = user_orders(tables, order_lines(tables, "cprice"), by, lines=F.lit(1))
    return per_key(orders, by, **{name: total()})


def payments(tables: Tables, by: tuple[str, ...]) -> DataFrame:
    """Paid prices and their number, per order or line."""
    lines = order_lines(tables, "xfprice")
    return user_orders(tables, lines, by, paid=exact("xfprice"), lines=F.lit(1))


def average_amount(tables: Tables) -> DataFrame:
    """Mean paid price per user and restaurant."""
    paid = payments(tables, BY_ITEM)
    return per_key(paid, BY_ITEM, average_order_amount=mean("paid", "lines"))


def average_amount_tag(tables: Tables) -> DataFrame:
    """Mean paid price per user, truncated to a whole number."""
    whole = mean("paid", "lines").cast("bigint")
    return per_key(payments(tables, BY_USER), BY_USER, rest_average_order_amount_int=whole)


def orders_per_day(tables: Tables) -> DataFrame:
    """Orders per user, restaurant and day."""
    lines = order_lines(tables, "cprice")
    orders = user_orders(tables, lines, (*BY_ITEM, "order_day"), lines=F.lit(1))
    return orders.groupBy(*BY_ITEM, "order_day").agg(total().alias("orders"))


def multitime(tables: Tables) -> DataFrame:
    """Whether a user ever ordered more than once at a restaurant on one day."""
    repeated = F.bool_or(F.col("orders") > 1)
    return per_key(orders_per_day(tables), BY_ITEM, multitime_consumption=repeated)


def multitime_tag(tables: Tables) -> DataFrame:
    """Number of (restaurant, day) pairs with more than one order; 0 when there is none."""
    repeated = F.count_if(F.col("orders") > 1)
    return per_key(orders_per_day(tables), BY_USER, rest_multitime_consumption_num=repeated)


def redeemed_orders(tables: Tables) -> DataFrame:
    """Redeemed restaurant orders: order_no, item_code."""
    return tables("td_restaurant_order").select(
        F.col("fd_code").alias("order_no"), F.col("fd_restaurant_code").alias("item_code")
    )


def redemption_lines(tables: Tables) -> DataFrame:
    """Redemptions counted per order."""
    return tallied(drop_missing(redeemed_orders(tables), "order_no"), "order_no")


def redemptions(tables: Tables) -> DataFrame:
    """Redemptions with a restaurant and the user of their order."""
    lines = drop_missing(redeemed_orders(tables), "order_no", "item_code")
    hot = hot_keys(tables, "td_restaurant_order", "fd_code")
    return spread_join(lines, order_users(tables), "order_no", hot)


def usage(tables: Tables) -> DataFrame:
    """Redemptions per user and restaurant."""
    return per_key(redemptions(tables), BY_ITEM, usage_counter=rows().cast("double"))


def usage_tag(tables: Tables) -> DataFrame:
    """Redemptions per user."""
    redeemed = redemption_lines(tables).join(order_users(tables), "order_no")
    return per_key(redeemed, BY_USER, rest_usage_counter=total())


def ordered_classes(tables: Tables) -> DataFrame:
    """Class flags of the ordered details added up per order, with the user: flags, lines.

    Flags are decimals, so their sum is the same for every order of the rows; a text that is no
    number, or has more than ten digits before the point, is no flag.
    """
    details = tables("restaurant_order_detail2").select(
        F.col("fd_code").alias("order_no"), "fd_class"
    )
    classes = tables("restaurant_class").select(
        "fd_class", F.col("fd_cls").try_cast("decimal(20,10)").alias("flag")
    )
    flagged = drop_missing(details, "order_no").join(drop_missing(classes, "flag"), "fd_class")
    return user_orders(tables, flagged, BY_USER, flags=F.col("flag"), lines=F.lit(1))


def prefers_chinese() -> Column:
    """Whether at least half of the orders belong to the Chinese cuisine: flags against lines, exactly."""
    return 2 * F.sum("flags") >= F.sum("lines")


def preference_word(chinese: Column) -> Column:
    return F.when(chinese, fixed.PREFERENCE_CHINESE).otherwise(fixed.PREFERENCE_WESTERN)


def preference(tables: Tables) -> DataFrame:
    """Cuisine that at least half of a user's orders belong to."""
    word = preference_word(prefers_chinese())
    return per_key(ordered_classes(tables), BY_USER, restaurant_preferences=word)


def priority(tables: Tables) -> DataFrame:
    """Display priority of a restaurant: flash sale before coupon before discount."""
    restaurants = tables("itd_restaurant").filter(F.col("fd_lg") == fixed.RESTAURANT_LANGUAGE)
    rank = (
        F.when(F.col("fd_isflashsale") == 1, 3)
        .when(F.col("fd_iscoupon") == 1, 2)
        .when(F.col("fd_settlementdiscount") == 1, 1)
        .otherwise(0)
    )
    return restaurants.select(
        F.col("fd_code").alias("restaurant_code"), rank.cast("bigint").alias("priority")
    )


def browse_hours(tables: Tables) -> DataFrame:
    """Parsed ``(user,item,hours)`` lines; rows that do not parse are dropped.

    A third part implies the first two, so only the hours and the user are tested.
    """
    line = F.translate("line", "()", "")
    parts = tables("browse_hours").select(F.split(line, ",").alias("part"))
    parsed = parts.select(
        F.get("part", F.lit(0)).alias("user_id"),
        F.get("part", F.lit(1)).alias("item_code"),
        F.get("part", F.lit(2)).try_cast("bigint").alias("hours"),
    )
    return parsed.filter(F.col("hours").isNotNull() & (F.trim("user_id") != ""))


def browse_hour(tables: Tables) -> DataFrame:
    """Browse hours per line of the hand-off file; no aggregation."""
    return browse_hours(tables).select(
        "user_id", "item_code", F.col("hours").alias("browse_hour")
    )


def browse_hour_tag(tables: Tables) -> DataFrame:
    """Total browse hours per user."""
    return per_key(browse_hours(tables), BY_USER, rest_browse_hour=F.sum("hours"))
