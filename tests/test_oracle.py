"""Every registered query runs, and equals its SQL form in DuckDB where it has one."""

import __spark_entry__ as entry
import pytest

from workload.compare import compare, duck
from workload.registry import QUERIES

SF = "/root/testdata/sf0.001"
# full runs over both strategies take minutes; the comparison tool covers them
SLOW = {"w02_second_strategy_week", "w03_training_rows", "w04_rank_blend_submit", "w05_two_strategy_run"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, con, name):
    status, detail = compare(spark, con, name, SF)
    assert status in ("ok", "rows", "EMPTY"), detail


def test_entry(spark):
    assert entry.entry(spark).count() == 1


def test_every_sql_form_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
