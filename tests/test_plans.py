"""What the physical plans must and must not contain."""

import re

import pytest

from tonearm.plans.registry import QUERIES

# Runs jobs of its own while it is built; the plan left is a plain scan.
BATCH = sorted(set(QUERIES) - {"dwd_trade_cancel_stored"})


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonEvalExec", "BatchEvalPython",
                "ArrowEvalPython", "MapInPandas", "RoundRobinPartitioning"):
        assert bad not in text


@pytest.mark.parametrize("name,columns,pushed", [
    ("dwd_play", "event_id,ts,user_id,event_type,props", "EqualTo(event_type,view)"),
    ("dws_province_active_1h", "event_id,ts,user_id,event_type", "EqualTo(event_type,signup)"),
    ("dwd_trade_cancel", None, "EqualTo(o_orderstatus,P)"),
])
def test_scan_is_pruned_and_filtered(spark, sf_dir, name, columns, pushed):
    text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert pushed in text
    if columns:
        scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan(QUERIES[name](spark, sf_dir)))
        assert columns in [re.sub(r"#\d+L?", "", s) for s in scans]


@pytest.mark.parametrize("name,most", [
    ("dwd_play", 0), ("dwd_search", 0), ("dwd_dirty_records", 0), ("dwd_trade_vip", 0),
    ("ads_song_online_top10", 2), ("dws_song_search_24h", 2), ("dws_province_active_1h", 3),
    ("dws_album_sales", 1), ("dws_vip_renewal_rate", 1), ("dws_dirty_1h", 3),
    ("dim_user_current", 1),
])
def test_number_of_shuffles(spark, sf_dir, name, most):
    text = plan(QUERIES[name](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") <= most
    assert "Exchange SinglePartition" not in text


@pytest.mark.parametrize("name", ["dwd_dirty_records", "ods_log_parsed"])
def test_each_record_is_made_once(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert text.count("get_json_object") <= 1
    assert text.count("from_json") <= 1
