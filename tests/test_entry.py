import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_entry_runs_on_smoke_data(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["disposition_desc", "n", "rate", "share"]


def test_every_query_has_a_callable_and_oracles_are_subset():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) > 100


def test_oracles_round_double_columns():
    import __spark_entry__ as E
    from riskframe.plans.doubles import DOUBLE_COLUMNS
    o = E.oracle_sql()
    for name, cols in DOUBLE_COLUMNS.items():
        assert name in o and all(f'round("{c}", 6)' in o[name] for c in cols)
