"""Purchase paths and simple extracts from page events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martworks.operators.joins import absent
from martworks.operators.windows import funnel


def purchase_paths(events: DataFrame, loaded: DataFrame | None = None, user: str = "user_custom_id",
                   ts: str = "event_timestamp", page: str = "page_url_path", tiebreak: str | None = None,
                   first: Column | None = None,
                   then: tuple[str, ...] = ("/cart", "/payment", "/confirmation")) -> DataFrame:
    """Product pages followed at once by cart, payment and confirmation; rows already loaded are left out.

    Events of one moment are taken in the order of ``tiebreak``, by default of their pages.
    """
    start = F.col(page).startswith("/product") if first is None else first
    order = [ts, tiebreak or page]
    found = funnel(events.select(*dict.fromkeys([user, *order, page])), user, order, page, start, list(then)).select(user, ts, page)
    return found if loaded is None else absent(found, loaded, [user, ts, page])


def event_hours(events: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    return events.select("event_type", ts, F.hour(ts).alias("hour"))


def confirmed_payments(events: DataFrame, step: str, confirmed: str) -> DataFrame:
    return events.where(F.col(step) == confirmed)
