"""Plan shape checks: no cartesian products or nested-loop joins anywhere, pruned and
filtered scans, and a broadcast store dimension."""

import contextlib
import io
import re

import pytest

from conftest import SF_SMALL

def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _names():
    from shelfcast.queries import QUERIES
    return sorted(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_no_cartesian_or_nested_loop(spark, name):
    from shelfcast.queries import QUERIES
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_promo_lift_scan_is_pruned_and_filtered(spark):
    from shelfcast.queries import QUERIES
    plan = _plan(QUERIES["promo_lift"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_discount:double,l_shipdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<s_suppkey:bigint>" in plan          # the store side keeps only its key
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_series_windows_share_one_store_exchange(spark):
    from shelfcast.queries import QUERIES
    plan = _plan(QUERIES["acf"](spark, SF_SMALL))
    tree = plan.split("\n\n")[0]
    shuffles = [ln for ln in tree.splitlines() if "+- Exchange" in ln]
    # daily aggregate shuffle + one store shuffle for all windows (lead, lag columns, band)
    assert len(shuffles) == 2


def test_horizon_and_history_cutoffs_reach_the_scan(spark):
    from shelfcast.sources.fixture import load_panel
    p = load_panel(spark, SF_SMALL)
    assert "GreaterThanOrEqual(l_shipdate," in _plan(p.horizon) and "LessThan(l_shipdate," in _plan(p.fact)


@pytest.mark.parametrize("name", ["rf_metrics", "submission", "impute_median", "engineered_features", "qq_points", "spend_median"])
def test_facts_are_read_once(spark, name):
    """Queries that use the facts several times read the written facts, not the line items."""
    from shelfcast.queries import QUERIES
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "lineitem.parquet" not in plan


def test_row_numbers_order_no_table_in_one_task(spark):
    """The windows of the horizon ids are partitioned: by store, and by bucket of the per-store counts."""
    from shelfcast.sources.fixture import load_panel
    plan = _plan(load_panel(spark, SF_SMALL).horizon)
    specs = re.findall(r"Arguments: \[(?:row_number\(\)|sum\()[^\n]*windowspecdefinition\((\w+)#", plan)
    assert set(specs) == {"store", "_bk"}
