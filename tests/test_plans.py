"""The physical plans of registered queries have the shape that was meant."""

import pytest
from support_core import plan

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def text(spark, name, mode="formatted"):
    return plan(entry.queries()[name](spark, SF), mode)


@pytest.mark.parametrize(
    "name,column",
    [
        ("flt_compare", "GreaterThan(o_totalprice,100000.0)"),
        ("flt_in", "In(o_orderpriority, [1-URGENT,5-LOW])"),
        ("flt_relative_time", "GreaterThan(ts,"),
        ("mon_run_history", "GreaterThan(ts,"),
        ("join_anti", "GreaterThan(o_totalprice,450000.0)"),
    ],
)
def test_filters_reach_the_scan(spark, name, column):
    assert f"{column}" in text(spark, name)


@pytest.mark.parametrize(
    "name,schema",
    [
        ("agg_distinct", "ReadSchema: struct<l_partkey:bigint,l_returnflag:string>"),
        ("agg_range", "ReadSchema: struct<user_id:bigint,value:double>"),
        ("join_aggs", "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>"),
        ("gov_mask_email", "ReadSchema: struct<c_custkey:bigint,c_nationkey:int,c_mktsegment:string>"),
    ],
)
def test_only_needed_columns_are_read(spark, name, schema):
    assert schema in text(spark, name)


@pytest.mark.parametrize("name", ["slv_customers_sql", "flt_qualify", "cdc_scd1", "set_drop_duplicates", "pipe_orders_silver"])
def test_top_row_per_key_is_limited_before_the_shuffle(spark, name):
    simple = text(spark, name, "simple")
    assert simple.count("WindowGroupLimit") == 2  # before and after the exchange


@pytest.mark.parametrize("name", ["ord_topk", "cost_by_cluster_day", "mon_recent_failures", "skew_top_keys"])
def test_top_k_is_not_a_full_sort(spark, name):
    assert "TakeOrderedAndProject" in text(spark, name, "simple")


def test_no_python_in_the_plans(spark):
    for name in ("agg_daily_metrics", "feat_order_store", "dq_clean_sales", "join_salted_selective", "win_surrogate_dense"):
        simple = text(spark, name, "simple")
        assert "Python" not in simple and "Pandas" not in simple and "CartesianProduct" not in simple


def test_global_numbering_has_no_one_task_window_over_rows(spark):
    """The only unpartitioned window runs over the counts per range."""
    simple = text(spark, "win_surrogate_dense", "simple")
    single = [line for line in simple.splitlines() if "SinglePartition" in line]
    assert len(single) == 1
    assert "dense_rank(" in simple and "windowspecdefinition(__range" in simple


def test_category_metrics_do_not_expand_rows(spark):
    assert "Expand" not in text(spark, "agg_category_perf", "simple")
