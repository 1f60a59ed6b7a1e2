"""Every registered query of the library against its SQL on small tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import oracle
from driver_queries import all_queries

FOLDER = "/root/testdata/sf0.001"
# Nothing qualifies in the smallest tables; these are compared on larger ones.
LARGER = {"path_funnel", "sorted_limit", "nearby_contacts", "friend_recs", "anti_not_in", "anti_not_exists",
          "dq_fk", "tag_candidates", "anti_keys", "user_geo", "keyword_counts"}


@pytest.fixture(scope="module")
def duck():
    return {folder: oracle.connect(folder) for folder in (FOLDER, "/root/testdata/sf0.01")}


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, duck, name):
    folder = "/root/testdata/sf0.01" if name in LARGER else FOLDER
    assert oracle.compare(spark, duck[folder], folder, name) == ""


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
