"""Physical-plan properties that matter at scale: no window without a
partition key, partition filters and column pruning reach the scans."""
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _nodes(plan):
    out, stack = [], [plan]
    while stack:
        n = stack.pop()
        out.append(n)
        ch = n.children()
        stack.extend(ch.apply(i) for i in range(ch.size()))
        if n.nodeName() in ("InputAdapter", "WholeStageCodegen"):
            continue
    return out


def _spark_plan(df):
    return df._jdf.queryExecution().sparkPlan()


@pytest.mark.parametrize("name", ["flagship_hourly_features", "features_full_chain", "features_keyed_series_halo",
                                  "clean_full_chain", "stats_acf_hourly", "stats_kpss_daily", "scale_robust",
                                  "eda_describe", "windows_row_index", "extras_ewma_shifted", "profile_variants"])
def test_no_unpartitioned_window(spark, name):
    df = E.queries()[name](spark, SF)
    wins = [n for n in _nodes(_spark_plan(df)) if n.nodeName() == "Window"]
    for w in wins:
        if w.partitionSpec().size() > 0:
            continue
        # a single series' key folds away; then the only allowed unkeyed windows
        # run over block-summary tables (one row per block), ordered by the block key
        order = w.orderSpec().toString()
        assert any(k in order for k in ("_fb#", "_cb#", "_blk#")), f"{name}: window without partition key: {order}"


def test_split_read_prunes_partitions(spark):
    df = E.queries()["source_split_partitioned"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "(split#" in plan and "= val)" in plan


def test_scan_reads_only_needed_columns(spark):
    df = E.queries()["stats_ks_drift"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "ReadSchema" in line or "FileScan parquet" in line]
    assert scans and all("user_id" not in s and "event_id" not in s for s in scans)


def test_time_lags_take_the_same_exchanges_for_any_number_of_lags(spark, hourly_fixture):
    from hourcast.operators import windows as W
    h, _ = hourly_fixture

    def exchanges(ks):
        plan = W.lags(h, "cnt", ks, mode="time")._jdf.queryExecution().sparkPlan().toString()
        executed = W.lags(h, "cnt", ks, mode="time")._jdf.queryExecution().executedPlan().toString()
        return executed.count("Exchange hashpartitioning"), plan.count("Join")
    assert exchanges((1, 2, 3, 24, 168)) == exchanges((1,))
    assert exchanges((1, 2, 3, 24, 168))[1] == 1
