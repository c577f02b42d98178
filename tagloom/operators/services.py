"""Service orders (CIP, VVIP, parking, car): all of them find their user through the orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.exprs import drop_missing, mean, truncated_mean, valid_users, whole_amount
from tagloom.operators.base import BY_ITEM, BY_USER, Tables, per_key, rows, tallied, total, usages
from tagloom.operators.skew import hot_keys, spread_join


def order_users(tables: Tables, *columns: str) -> DataFrame:
    """Orders with a usable user: order_no, user_id and the asked columns."""
    orders = tables("tb_order").select("order_no", "user_id", *columns)
    return valid_users(drop_missing(orders, "order_no"))


def service_lines(tables: Tables, table: str, require: str | None = None) -> DataFrame:
    """Rows of a service order table, counted per order: order_no, lines.

    ``require`` names the item code column when only rows that have one count.
    """
    columns = ["order_no"] if require is None else ["order_no", require]
    return tallied(drop_missing(tables(table).select(*columns), *columns), "order_no")


def item_lines(tables: Tables, table: str, item: str, orders: DataFrame) -> DataFrame:
    """Rows of a service order table with their item code and what ``orders`` has of their order."""
    lines = drop_missing(tables(table).select("order_no", item), "order_no", item)
    hot = hot_keys(tables, table, "order_no")
    return spread_join(lines.withColumnRenamed(item, "item_code"), orders, "order_no", hot)


def paid_orders(tables: Tables) -> DataFrame:
    """Orders with a usable user and the whole part of the amount paid, NULL if unknown."""
    orders = order_users(tables, "actual_amount")
    return orders.select("order_no", "user_id", whole_amount("actual_amount").alias("amount"))


def payments(tables: Tables, lines: DataFrame) -> DataFrame:
    """Counted lines of paid orders with their user and the amount of all the lines."""
    joined = lines.join(drop_missing(paid_orders(tables), "amount"), "order_no")
    return joined.withColumn("paid", F.col("amount") * F.col("lines"))


def consumption(tables: Tables, table: str, item: str) -> DataFrame:
    """Orders per user and item."""
    orders = item_lines(tables, table, item, order_users(tables))
    return per_key(orders, BY_ITEM, consumption_num=rows())


def average_amount(tables: Tables, table: str, item: str) -> DataFrame:
    """Mean whole amount per user and item."""
    paid = item_lines(tables, table, item, drop_missing(paid_orders(tables), "amount"))
    return per_key(paid.withColumn("lines", F.lit(1)), BY_ITEM, average_order_amount=mean("amount", "lines"))


def consumption_tag(tables: Tables, table: str, name: str, require: str | None = None) -> DataFrame:
    """Orders per user."""
    orders = service_lines(tables, table, require).join(order_users(tables), "order_no")
    return per_key(orders, BY_USER, **{name: total()})


def average_amount_tag(
    tables: Tables, table: str, name: str, require: str | None = None
) -> DataFrame:
    """Integer mean of the whole amounts per user."""
    paid = payments(tables, service_lines(tables, table, require))
    return per_key(paid, BY_USER, **{name: truncated_mean("paid", "lines")})


def cip_use_lines(tables: Tables) -> DataFrame:
    """Uses per CIP order: order_no, lines.

    A use is a pair of a record and an order line, so the two counts are multiplied.
    """
    records = cip_records(tables)
    uses = records.join(service_lines(tables, "tb_order_cip", "pro_code"), "order_no")
    return uses.withColumn("lines", F.col("records") * F.col("lines")).drop("records")


def cip_records(tables: Tables) -> DataFrame:
    """Records per CIP order: order_no, records."""
    return service_lines(tables, "tb_order_cip_record").withColumnRenamed("lines", "records")


def cip_uses(tables: Tables) -> DataFrame:
    """Order lines with their product, user and the records of their order: each record is a use."""
    orders = cip_records(tables).join(order_users(tables), "order_no")
    return item_lines(tables, "tb_order_cip", "pro_code", orders)


def cip_usage(tables: Tables) -> DataFrame:
    """Uses per user and CIP product."""
    return per_key(cip_uses(tables), BY_ITEM, usage_counter=usages("records"))


def cip_usage_tag(tables: Tables) -> DataFrame:
    """Uses of CIP orders per user."""
    uses = cip_use_lines(tables).join(order_users(tables), "order_no")
    return per_key(uses, BY_USER, cip_usage_counter=total())
