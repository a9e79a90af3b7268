"""Every query against its SQL on the smallest tables, and the ordered ones again
with every series cut into ranges."""

import os

import pytest

from workload import ORACLE, QUERIES
from workload.check import connect, differences

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

CUT = [
    "roll_flow", "roll_advanced", "roll_segment", "tick_features", "ffill", "sequences_20", "asof_backward",
    "asof_forward", "asof_nearest", "asof_chain", "signal_fill_interval", "label_train", "segments", "split_segment",
    "split_rows", "split_time", "systematic", "scale_robust", "spearman", "auc", "quality_report", "bars_twap",
    "book_dataset", "unified_training",
]


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_is_named():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) > 100


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_agrees(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) == []


@pytest.mark.parametrize("name", CUT)
def test_agrees_when_cut(spark, duck, small_ranges, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) == []
