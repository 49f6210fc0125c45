import datetime as dt

from lake_helpers import SF_SMALL
from lakeworks.plans import gates
from lakeworks.plans.registry import Lake

D = dt.date
SCHEMA = ("security_sk long, enterprise_key string, effective_start_date date, effective_end_date date, "
          "is_current boolean, preceding_record_sk long, succeeding_record_sk long")


def _lake_with(spark, name, rows, schema=SCHEMA):
    lake = Lake(spark, SF_SMALL)
    lake._memo[name] = spark.createDataFrame(rows, schema)
    return lake


def _status(df, subject):
    return {r.subject: r.status for r in df.collect()}[subject]


def test_scd2_gates_pass_on_built_dims(spark):
    lake = Lake(spark, SF_SMALL)
    for gate in (gates.gate_scd2_current, gates.gate_scd2_overlap, gates.gate_scd2_dates, gates.gate_scd2_links,
                 gates.gate_duplicates):
        assert {r.status for r in gate(lake).collect()} == {"PASS"}, gate.__name__


def test_scd2_gates_fail_on_bad_dim(spark):
    bad = [
        (1, "k", D(2000, 1, 1), D(2000, 12, 31), False, None, 2),
        (2, "k", D(2000, 6, 1), D(9999, 12, 31), True, 1, None),       # overlaps sk 1
        (3, "j", D(2001, 1, 1), D(2000, 1, 1), True, 99, None),        # start > end, dangling link
        (4, "j", D(2001, 1, 1), D(2002, 1, 1), True, None, None),      # second current row, duplicate start
    ]
    lake = _lake_with(spark, "silver.security_dim", bad)
    assert _status(gates.gate_scd2_overlap(lake), "security_dim") == "FAIL"
    assert _status(gates.gate_scd2_dates(lake), "security_dim") == "FAIL"
    assert _status(gates.gate_scd2_links(lake), "security_dim") == "FAIL"
    assert _status(gates.gate_scd2_current(lake), "security_dim") == "FAIL"
    assert _status(gates.gate_duplicates(lake), "security_dim") == "FAIL"
