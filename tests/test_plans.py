"""Filters, columns and exchanges in the plans of registered queries."""

import re

import pytest
from conftest import plan_of

import __spark_entry__ as registered

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name,pushed", [
    ("band_filter", "GreaterThanOrEqual(l_quantity,10.0)"),
    ("segment_filter", "EqualTo(c_mktsegment,BUILDING)"),
    ("first_n_finished", "EqualTo(o_orderstatus,F)"),
    ("global_seq", "EqualTo(o_orderstatus,F)"),
])
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan_of(registered.queries()[name](spark, FOLDER))


@pytest.mark.parametrize("name,columns", [
    ("kpi_by_site", "l_orderkey:bigint,l_suppkey:bigint,l_quantity:double"),
    ("tele_ratio", "l_partkey:bigint,l_returnflag:string"),
    ("top_channel", "lang:string,source:string"),
    ("rate_gap", "doc_id:bigint,toxic:int"),
    ("pii_scan", "doc_id:bigint,text:string"),
])
def test_scans_read_only_what_is_used(spark, name, columns):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>\n", plan_of(registered.queries()[name](spark, FOLDER)))
    assert columns in schemas


@pytest.mark.parametrize("name", ["gen_person_attrs", "gen_identifiers", "lexicon_score", "tag_documents", "classify_text",
                                  "pii_scan", "pii_mask", "silver_clean", "nested_case_bias"])
def test_row_work_moves_nothing(spark, name):
    assert "Exchange" not in plan_of(registered.queries()[name](spark, FOLDER))
