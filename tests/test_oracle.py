"""DuckDB oracle on the smallest scale for a cross-section of the registered queries."""

import pytest

from lake_helpers import SF_SMALL
from lakeworks.plans.queries import QUERIES, run_query
from lakeworks.plans.registry import Lake
from oracle.harness import compare, duck
from oracle.queries import FINAL, oracle

KEYS = ["team_position", "bronze_position", "bronze_security", "security_dim", "contract_dim", "silver_position",
        "position_monthend", "contract_details", "consolidated_contracts", "aum_daily", "portfolio_kpi",
        "portfolio_book", "position_external_keys", "resolve_as_of", "mapping_supersede", "scd2_apply",
        "hash_delta", "anchor_chain", "gate_scd2_overlap", "incremental_aum", "json_techniques"]


@pytest.fixture(scope="module")
def shared(spark):
    return Lake(spark, SF_SMALL), duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(shared, key):
    lake, con = shared
    res = compare(run_query(lake, key), con, oracle(key))
    assert res["match"], res


def test_every_query_has_oracle_or_is_documented():
    assert set(QUERIES) == set(FINAL)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
