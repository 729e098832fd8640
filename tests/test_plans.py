"""Plan-shape checks: the properties the operators rely on at scale."""

from conftest import SF_SMALL

from tablekit.plans.bindings import BINDINGS


def plan(spark, name):
    df = BINDINGS[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_n_per_key_is_limited_map_side(spark):
    for name in ("first_purchase", "dedup_keep_first", "top_customers_per_month", "top_n_dense_rank"):
        p = plan(spark, name)
        assert "WindowGroupLimit" in p and "Partial" in p, name


def test_partition_pruning_and_pushdown(spark):
    p = plan(spark, "read_table")
    assert "PartitionFilters: [isnotnull(o_orderpriority" in p and "1-URGENT" in p
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,100000.0)]" in p
    f = plan(spark, "purchase_funnel")
    assert "EqualTo(event_type,purchase)" in f  # the stage filters reach the parquet scan


def test_column_pruning(spark):
    p = plan(spark, "churn_risk")
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_churn_is_one_aggregate_without_window(spark):
    p = plan(spark, "churn_risk")
    assert "Window" not in p and "partial_count" in p


def test_aggregate_before_join(spark):
    p = plan(spark, "top_products_by_category")
    # the lineitem aggregate sits below the join with part
    agg_pos = p.rfind("partial_sum(l_quantity")
    join_pos = p.find("Join")
    assert agg_pos > join_pos > -1


def test_segmented_scan_shuffles_rows_once(spark):
    # no hot key at this scale: segments are constant and the border fix-ups
    # are pruned while planning, leaving one row shuffle and the window
    p = plan(spark, "scd2_intervals")
    big = [l for l in p.split("\n") if "Exchange hashpartitioning(_tk_kv0" in l]
    assert len(big) == 1 and "BroadcastExchange" not in p


def test_segmented_scan_with_hot_keys_shuffles_rows_once(spark):
    from tablekit.operators import scd2 as S
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    df = S.scd2_intervals(o, "o_custkey", "o_orderpriority", "o_orderdate", tie_break=["o_orderkey"],
                          rows_per_segment=3)
    p = df._jdf.queryExecution().executedPlan().toString()
    rows_shuffles = {l.split("[plan_id")[0].strip(" :+-") for l in p.split("\n")
                     if "Exchange hashpartitioning(_tk_kv0" in l and "_tk_seg" in l and "_tk_fs" not in l}
    # the row shuffle on (key, segment) plus the hot-key-only summary on the same keys
    assert 1 <= len(rows_shuffles) <= 2


def test_burst_without_hot_users_is_one_window(spark):
    p = plan(spark, "burst_events")
    assert "Union" not in p and "BroadcastExchange" not in p
    assert sum("Exchange hashpartitioning(user_id" in l for l in p.split("\n")) == 1
