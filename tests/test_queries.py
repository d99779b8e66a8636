import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare  # noqa: E402

from newsloom.plans import library as plans  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_query_equals_sql(spark, name):
    compare(spark, name, plans.queries()[name], plans.oracle_sql()[name], SF)


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(plans.oracle_sql())))
def test_query_runs(spark, name):
    assert plans.queries()[name](spark, SF).count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
