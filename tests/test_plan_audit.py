"""Executed plans of registry queries: no nested-loop joins, pruned scans."""

import importlib.util
import os

import pytest

import __spark_entry__ as entry
from conftest import SMOKE_DIR

_spec = importlib.util.spec_from_file_location(
    "plan_audit", os.path.join(os.path.dirname(__file__), "..", "tools", "plan_audit.py"))
plan_audit = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(plan_audit)


@pytest.mark.parametrize("key", ["fact_sales", "kpi_star", "kpi_segment", "checks_summary",
                                 "reconcile_detail", "health_counts"])
def test_no_nested_loop_or_cartesian_join(spark, key):
    assert plan_audit.audit(entry.queries()[key](spark, SMOKE_DIR))["nested_loop"] == 0


def test_label_counts_read_only_the_columns_they_need(spark):
    a = plan_audit.audit(entry.queries()["label_sales"](spark, SMOKE_DIR))
    assert sorted(a["scans"]) == ["lineitem(2)", "orders(2)"]
