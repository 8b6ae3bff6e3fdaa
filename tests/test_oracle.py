"""Every registered query with an SQL equivalent gives the same rows as DuckDB."""

import pytest
from conftest import SF

import __spark_entry__ as entry
from compare import differences, duck
from lexigate.plans import registered

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF), connection, SQL[name]) == []


def test_comparison_notices_a_difference(spark, connection):
    wrong = SQL["class_balance"].replace("min(n)", "max(n)")
    assert differences(QUERIES["class_balance"](spark, SF), connection, wrong)


def test_only_fitted_models_lack_sql():
    assert set(registered.QUERIES) - set(SQL) == {
        "train_lr", "train_rf", "train_svm", "train_svm_rbf", "cv_scores", "training_metrics",
        "batch_scoring", "run_summary", "stream_scoring",
    }
