"""Plan-shape tests: pushdown, pruning, no Cartesian products, no Python in
core operators, no single-task window over data rows."""

import pytest

import __spark_entry__ as E
from sf_paths import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


CORE = ["customer_history_features", "agg_multi_spec", "filtered_subset_agg", "two_level_agg", "last_k_agg",
        "nth_latest_agg", "lagged_diff_mean", "trend_fit", "join_extreme_back", "join_last_entity_rows",
        "group_recipes", "onehot_share_agg", "features_bureau_two_level", "features_installments", "target_encode",
        "label_encode", "quantile_bin", "rank_min_blend", "auc_per_fold", "assemble_training_table"]


@pytest.mark.parametrize("name", CORE)
def test_no_cartesian_no_python(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "FlatMapGroupsInPandas" not in p


@pytest.mark.parametrize("name", ["customer_history_features", "agg_multi_spec", "last_k_agg", "lagged_diff_mean",
                                  "features_previous_history", "sort_desc_topk_per_group"])
def test_no_single_partition_exchange(spark, name):
    assert "SinglePartition" not in plan(E.queries()[name](spark, SF_SMALL))


def test_rank_single_partition_only_over_bucket_totals(spark):
    df = E.queries()["rank_min_blend"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().treeString()
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            child = "\n".join(lines[i:i + 4])
            assert "__b" in child  # the (groups × buckets) totals table, not data rows


def test_projection_and_filter_pushdown(spark):
    p = plan(E.queries()["scan_projected"](spark, SF_SMALL))
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in p
    p = plan(E.queries()["filter_category"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in p


def test_dimension_broadcast_is_checked(spark):
    p = plan(E.queries()["scan_table"](spark, SF_SMALL))
    assert "Scan parquet" in p
    p = plan(E.queries()["customer_history_features"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p  # the 25-row nation dimension, below its row bound


def test_no_forced_broadcast():
    """Joins are broadcast by the planner's size in bytes only."""
    import pathlib
    root = pathlib.Path(__file__).resolve().parents[1] / "featherstack"
    for f in root.rglob("*.py"):
        if f.parent.name != "llm":
            assert "F.broadcast(" not in f.read_text(), f


@pytest.mark.parametrize(("name", "table", "most"), [
    ("features_installments", "lineitem", 2), ("features_pos_cash", "events", 1), ("features_previous_rejects", "orders", 1),
    ("lagged_diff_mean", "events", 4), ("features_credit_card", "events", 5)])
def test_scans_of_the_big_table(spark, name, table, most):
    import re
    assert len(re.findall(rf"FileScan parquet.*?{table}\.parquet", plan(E.queries()[name](spark, SF_SMALL)))) <= most


def test_svd_stays_in_the_jvm(spark):
    import inspect

    from featherstack.operators import scale
    assert ".rdd" not in inspect.getsource(scale)
    assert "Python" not in plan(E.queries()["svd_reduce"](spark, SF_SMALL))


def test_no_local_checkpoint_anywhere():
    import pathlib
    root = pathlib.Path(__file__).resolve().parents[1] / "featherstack"
    for f in root.rglob("*.py"):
        assert "localCheckpoint(" not in f.read_text(), f
