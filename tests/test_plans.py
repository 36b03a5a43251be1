"""Plan shape: filters reach the scan, projections prune columns, the merge
target is never shuffled."""

import __spark_entry__ as E
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_and_type_filters_reach_the_scan(spark):
    plan = _plan(E.queries()["events_typed_since"](spark, SF_SMALL))
    pushed = plan.split("PushedFilters: [", 1)[1].split("ReadSchema", 1)[0]
    assert "GreaterThan(ts" in pushed and "In(event_type" in pushed
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,props:string>" in plan


def test_row_count_board_reads_no_columns(spark):
    plan = _plan(E.queries()["row_counts"](spark, SF_SMALL))
    assert "ReadSchema: struct<>" in plan


def test_merge_streams_target_through_broadcast_join(spark):
    plan = _plan(E.queries()["merge_flags"](spark, SF_SMALL))
    assert "BroadcastHashJoin [s_suppkey" in plan and "LeftOuter" in plan
    assert "Exchange hashpartitioning(s_suppkey" not in plan.split("LeftOuter")[0]


def test_latest_per_key_is_a_partial_aggregate(spark):
    plan = _plan(E.queries()["currently_failed"](spark, SF_SMALL))
    assert "partial_max_by" in plan and "Window" not in plan


def test_volume_scans_once(spark):
    plan = _plan(E.queries()["volume_hour"](spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 1 and "Generate explode" in plan


def test_json_documents_are_parsed_once(spark):
    for name in ("events_typed_since", "staged_json_events", "transmission_out_of_order"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert plan.count("parseJson(") == 1, plan


def test_keyed_lookups_gather_no_rows_in_one_task(spark):
    for name in ("merge_flags", "upsert", "tombstones"):
        assert "SinglePartition" not in _plan(E.queries()[name](spark, SF_SMALL))
