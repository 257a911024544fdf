"""Plan shapes that must hold at any scale."""

import re

import pytest
from conftest import SF_DIR

from realmwatch.functions.enctypes import enctype_dim
from realmwatch.operators import joins, last_seen, slices
from realmwatch.plans.catalog import QUERIES
from realmwatch.plans.folders import scratch_dir
from realmwatch.sources import bridge, parser

FOLDS = [
    "client_last_seen", "princ_client_success", "princ_server_success", "princ_client_fail",
    "princ_server_fail", "princ_last_seen", "ccs_last_seen", "client_slices", "princ_slices",
    "client_slice_rates", "princ_slice_rates", "ccs_slices", "ext_fail_slices", "ext_ticket_slices",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.mark.parametrize("name", FOLDS)
def test_a_fold_is_one_shuffle_after_a_partial_aggregate(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert exchanges(text) == 1
    assert "partial_" in text and "Join" not in text


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", text)


def test_parsing_matches_each_line_once(spark, log):
    text = plan(parser.successes(parser.parse_events(bridge.raw_lines(log))))
    assert text.count("(?s)^") == 1 and exchanges(text) == 0


def test_role_dimension_is_broadcast_by_its_known_size(spark, success):
    text = plan(joins.join_roles(success, enctype_dim(spark)))
    assert text.count("BroadcastHashJoin") == 3 and exchanges(text) == 0


def test_outcome_and_time_filters_reach_the_scan(spark, success):
    text = plan(slices.client_slices(bridge.older(success)))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "event_type" in pushed and "LessThan(ts" in pushed


def test_only_needed_columns_are_read(spark, tmp_path, success):
    path = str(tmp_path / "success")
    success.write.parquet(path)
    text = plan(last_seen.client_last_seen(spark.read.parquet(path)))
    assert re.search(r"ReadSchema: struct<(.*?)>", text).group(1) == (
        "log_time:bigint,ip:string,req_type:int,req_enctypes:string"
    )


class Cluster:
    """As much of a session as scratch_dir looks at."""

    def __init__(self, folder=None, master="spark://host"):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_folder_is_the_one_the_cluster_names(tmp_path):
    assert scratch_dir(Cluster("/shared/folder/"), "x").startswith("/shared/folder/x-")
    with pytest.raises(RuntimeError):
        scratch_dir(Cluster(), "x")
    assert scratch_dir(Cluster(master="local[8]"), "x")
