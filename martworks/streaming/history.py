"""Purchase history per customer, one list per batch, and customer rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.operators.groups import LIST_ROWS, collect_parts
from martworks.streaming import core
from martworks.streaming.windows import parse_value

# The sample sends Quantity as quoted text, so it is read as text and cast.
RETAIL = ("InvoiceNo string, StockCode string, Description string, Quantity string, InvoiceDate string, "
          "UnitPrice string, CustomerID string, Country string")
CUSTOMER = "CustomerID string, Address string, Birthdate string, Email string, Name string, Username string"


def purchases(topic: DataFrame) -> DataFrame:
    return parse_value(topic, RETAIL, "offset").withColumn("Quantity", F.col("Quantity").try_cast("int"))


def histories(rows: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """List of purchases per customer, country and part, in the order of the message offsets."""
    item = F.struct("Description", "Quantity", "InvoiceDate")
    return collect_parts(rows, ["CustomerID", "Country"], item, "PurchaseDescription", "offset", list_rows)


def run_purchases(topic: DataFrame, out: str, checkpoint: str, every: str | None = None):
    sink = core.batch_folder(out, lambda batch: histories(purchases(batch)))
    return core.start(topic.select("value", "offset"), core.fan_out(sink), checkpoint, every=every)


def run_customers(topic: DataFrame, out: str, checkpoint: str, every: str | None = None):
    """Customer documents as they come."""
    return core.start_files(parse_value(topic.select("value"), CUSTOMER), out, checkpoint, every=every)
