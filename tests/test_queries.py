"""A cross-section of registered queries against their SQL at the smallest scale."""

import pytest

import oracle

NAMES = [
    "p11_flag_comments", "j06_semi_or_latest", "j14_asof_backward", "j17_wildcard_member", "j20_count_within_radius", "a14_stacked_groups",
    "a22_quantile_trim", "w02_boolean_partition", "w06_lag", "w16_repeat_within_year", "t16_values_match", "t21_rollup", "s09_partition_writer",
    "s11_publish_delta", "e01_declarations", "e23_district_ids",
]


@pytest.fixture(scope="module")
def con(root):
    return oracle.connect(root)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, root, name):
    assert oracle.compare(spark, con, root, name) is None


def test_every_sql_has_its_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
