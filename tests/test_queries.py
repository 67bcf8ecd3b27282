"""All queries with SQL, over the smallest tables."""

import pytest
from compare import same

from runloom.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_as_in_sql(spark, sf_dir, name):
    same(spark, sf_dir, QUERIES[name], ORACLES[name])


def test_every_query_has_sql_or_is_a_grouping():
    without = {"g01_group_all_lanes", "g01_group_barcodes", "g01_group_by_matches", "g02_seeded_groups", "g03_analyse_grouped", "g03_analysis_summary"}
    assert {n for n in QUERIES if n not in ORACLES} == without
