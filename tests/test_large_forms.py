"""Queries that join or number, in the forms meant for large tables: no broadcast, many buckets, hot keys spread.

TEST_LARGE=all takes every registered query.
"""

import os

import pytest
from oracle import compare, duck

import __spark_entry__ as registered
from stratalake.operators import joins as J, sequence as Q

FOLDER = f"/root/testdata/sf{os.environ.get('TEST_SF', '0.001')}"
SETTINGS = {J.BROADCAST_SETTING: "0", Q.BUCKET_SETTING: "40", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
NAMES = sorted(registered.queries()) if os.environ.get("TEST_LARGE") == "all" else [
    "build_fact_sample", "build_review_sample", "conditional_lookup", "cumulative_bounds", "fk_orphans", "global_seq",
    "index_in_group", "kpi_by_channel", "kpi_by_site", "kpi_demography", "kpi_productivity", "kpi_region_code",
    "lexicon_join", "load_per_capacity", "pick_in_group", "pool_index", "pool_lookup", "range_join_bands", "range_join_dates",
    "report_by_channel", "review_360", "score_vs_label", "semi_finished", "star_360", "static_dim", "weighted_draw"]


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.fixture(scope="module")
def large(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    share, J._share_limit = J._share_limit, lambda df: 0.002  # small tables have no key above the real limit
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    J._share_limit = share
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_query(large, con, name):
    assert compare(registered.queries()[name](large, FOLDER), con, registered.oracle_sql()[name]) is None
