"""The physical plans have the shape that large inputs need."""

import pytest

from lynxrisk.plans import silver as S
from lynxrisk.queries import QUERIES
from lynxrisk.queries.feeds import Feeds
from tests.conftest import CTX

FOLDER = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["q01_resolve_inner", "q05_latest_register_join", "q07_dual_path", "q08_text_concat_tags", "q15_rolling_7d",
             "q16_peer_zscore", "q24_grid_fill", "q29b_percentile_ties", "q37_composite"]
)
def test_no_cross_join_and_no_python(spark, name):
    plan = physical(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "InPandas" not in plan


def test_one_scan_and_one_join_to_resolve(spark):
    f = Feeds(spark, FOLDER)
    plan = physical(S.conform_all(S.FEEDS["pacs"], S.tag_feed(S.FEEDS["pacs"], f.pacs, f.badges), CTX))
    assert plan.count("FileScan parquet") == 2
    assert plan.count("Join") == 1


def test_scans_read_only_needed_columns(spark):
    plan = physical(QUERIES["q29b_percentile_ties"](spark, FOLDER))
    assert "l_extendedprice" not in plan and "l_comment" not in plan


def test_filters_reach_the_scan(spark):
    plan = physical(QUERIES["q01_resolve_inner"](spark, FOLDER))
    assert "EqualTo(event_type,click)" in plan and "GreaterThanOrEqual(c_acctbal,0.0)" in plan


def test_no_exact_set_of_texts_is_shuffled(spark):
    """Texts are tested before the shuffle; only their short ends move."""
    plan = physical(QUERIES["q08_text_concat_tags"](spark, FOLDER))
    for line in plan.splitlines():
        if "Exchange" in line:
            assert "text" not in line
