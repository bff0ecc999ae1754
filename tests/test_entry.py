import __spark_entry__ as E
from tabforge.plans.catalogue import QUERIES

ROWS_ONLY = {"gbt_cv", "search_trials", "stack_final", "gbt_importance", "gbt_published", "gbt_chosen",
             "nested_stack", "switches"}


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert (set(q) - set(o)) & set(QUERIES) == ROWS_ONLY


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["id", "fold", "pred_log", "predicted_spend"]
