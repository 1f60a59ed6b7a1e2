"""One topic with two message types, split into two typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.streaming import core
from martworks.streaming.windows import parse_value

ENVELOPE = "object_id string, object_type string, sent_dttm timestamp, payload struct<{}>"
PAYLOADS = {
    "TRANSACTION": "operation_id: string, account_number_from: int, account_number_to: int, currency_code: int, "
                   "country: string, status: string, transaction_type: string, amount: int, transaction_dt: timestamp",
    "CURRENCY": "date_update: timestamp, currency_code: int, currency_code_with: int, currency_with_div: double",
}


def typed(topic: DataFrame, object_type: str) -> DataFrame:
    """Messages of one type as flat rows. The type is read first, so other messages are not parsed in full."""
    own = topic.where(F.get_json_object(F.col("value").cast("string"), "$.object_type") == object_type)
    return parse_value(own, ENVELOPE.format(PAYLOADS[object_type])).select(
        "object_id", "object_type", "sent_dttm", "payload.*"
    )


def run(topic: DataFrame, out: str, checkpoint: str, every: str | None = None):
    """Both tables from each batch of the topic."""
    sink = core.fan_out(*[
        core.batch_folder(f"{out}/{name.lower()}", lambda batch, name=name: typed(batch, name)) for name in PAYLOADS
    ])
    return core.start(topic.select("value"), sink, checkpoint, every=every)
