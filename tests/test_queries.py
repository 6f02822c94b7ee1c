"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import database, differences

import __spark_entry__ as entry
from tidemart.plans.oracles import ORACLES as SQL
from tidemart.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con(small):
    return database(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_same_as_sql(name, spark, small, con):
    assert differences(QUERIES[name](spark, small), con, SQL[name]) == []


def test_entry_has_them_all():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_dictionary_counts_only_words_reach_the_count(spark):
    """Han candidates that are no dictionary word are dropped before the count per text; single characters stay."""
    from tidemart.plans.registry import dictionary_counts

    docs = spark.createDataFrame([(1, "的一是 的一"), (2, "的一是在 abc"), (3, None)], "doc_id long, text string")
    dictionary = spark.createDataFrame([("的一",), ("一是在",), ("abc",)], "word string")
    got = {(r["word"], r["n"], r["n_docs"]) for r in dictionary_counts(docs, dictionary).collect() if r["word"] is not None}
    assert ("的一", 3, 2) in got and ("一是在", 1, 1) in got and ("abc", 1, 1) in got
    assert ("的一是", 2, 2) not in got and all(len(w) == 1 for w, _, _ in got - {("的一", 3, 2), ("一是在", 1, 1), ("abc", 1, 1)})
