"""Plan shape: one big exchange for the feature matrix, hash aggregates on
the event side, no unpartitioned window on rows, no cartesian products."""

from faultline.plans import catalog
from tests_support import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_matrix_single_row_exchange(spark):
    import re
    spark.catalog.clearCache()
    df = catalog.QUERIES["feature_matrix"](spark, SF_SMALL)
    ex = _plan(df)
    # exactly one exchange moves the rows: the one on (TAG, bucket) feeding the window;
    # the others are keyed by aggregate grouping expressions (carry-in tables)
    assert len(re.findall(r"Exchange hashpartitioning\(TAG#\d+, _bk#\d+L", ex)) == 1
    p = df._jdf.queryExecution().sparkPlan().toString()
    # the rows are shuffled once, on (TAG, bucket); other exchanges carry
    # per-(TAG, bucket) aggregates only
    assert p.count("Window [") >= 1
    assert "SortMergeJoin" not in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "Generate explode(sequence" in p


def test_event_carry_is_hash_aggregate(spark):
    """No sort- or object-based aggregate: the events' carry buffers are fixed-width."""
    df = catalog.QUERIES["time_since_critical"](spark, SF_SMALL)
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert p.count("HashAggregate(") >= 2 and "SortAggregate" not in p and "ObjectHashAggregate" not in p


def test_no_cartesian_anywhere(spark):
    skip = {"gbt_metrics", "rf_metrics", "gbt_threshold_sweep", "horizon_pick", "model_comparison",
            "gbt_error_analysis", "feature_importance", "permutation_importance"}
    for name, fn in catalog.QUERIES.items():
        if name in skip:
            continue
        p = _plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_ranking_row_windows_are_partitioned(spark):
    """The per-score window is partitioned by score bucket; the only
    unpartitioned window runs over the bucket-total table (bounded)."""
    from faultline.operators import metrics as M
    from faultline.sources import adapters as A
    st = M.score_table(A.scored(spark, SF_SMALL))
    p = M.cumulative_by_score(st, part_rows=16)._jdf.queryExecution().executedPlan().toString()
    windows = [ln for ln in p.splitlines() if "Window [" in ln]
    # two windows: bucket totals (no partition keys) and rows (partitioned by _b)
    assert any("], [_b" in ln for ln in windows)
