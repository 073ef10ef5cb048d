"""Every registered query against its SQL; those without SQL must return rows."""

import pytest

import __spark_entry__ as entry
import check_queries

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, database, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    cursor = database.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert check_queries.compare(df.collect(), df.columns, cursor.fetchall(), names) is None


WITHOUT_SQL = ["pca_variance", "pca_summary", "density_sample", "kmeans_sample", "svm_binary", "svm_multiclass", "mlp_binary_cv", "mlp_multiclass_cv", "mlp_binary_test", "mlp_multiclass_test"]


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_returns_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_sql_is_for_registered_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert {r["target"] for r in entry.entry(spark).collect()} == {"l_returnflag", "l_linestatus"}
