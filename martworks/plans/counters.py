"""Orders per user and product, and per user and category."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.functions.nested import explode_records

COMPACT = ("id bigint, user string, products array<struct<product_uuid: string, product_name: string, "
           "category_uuid: string, category_name: string>>")
PRODUCT = ["user", "product_uuid", "product_name"]
CATEGORY = ["user", "category_uuid", "category_name"]


def order_lines(messages: DataFrame) -> DataFrame:
    """Product lines of the compact messages, with order and user."""
    return explode_records(messages, "products", ["id", "user"])


def order_counters(lines: DataFrame, by: list[str]) -> DataFrame:
    """Distinct orders per key."""
    return lines.groupBy(*by).agg(F.countDistinct("id").alias("order_cnt"))
