"""The driver's correctness gate, run locally at sf0.001 for every query
that has an oracle (model-fitting queries are covered by test_models)."""

import pytest

import __spark_entry__ as E
from lendscore.plans.catalog import QUERIES
from lendscore.plans.oracle import ORACLE
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck

@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "Saving_accounts_ordinal_enc" in df.columns


def test_every_query_has_oracle_or_reason():
    rows_only = set(QUERIES) - set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
    assert rows_only == {"train_baseline", "train_boosted", "batch_score", "profile_sketch"}


# The whole study takes minutes; tests/test_boosting.py runs small ones.
@pytest.mark.parametrize("name", sorted(set(ORACLE) - {"tune_trials"}))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(E.queries()[name](spark, SF_SMALL), con, E.oracle_sql()[name])
    assert ok, msg
