"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def canonical(rows, columns):
    order = sorted(columns)
    place = [columns.index(c) for c in order]
    return sorted(repr([(type(r[i]).__name__, r[i]) for i in place]) for r in rows)


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, folder, name):
    found = QUERIES[name](spark, folder)
    rows = [tuple(r) for r in found.collect()]
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(found.columns) == sorted(columns)
    assert canonical(rows, found.columns) == canonical(cursor.fetchall(), columns)


# Long training runs have their own tests; these have no SQL form and must give rows.
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"experiment_matrix"}))
def test_query_without_sql_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0
