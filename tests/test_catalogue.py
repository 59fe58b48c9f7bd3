"""Every query of the catalogue, against its SQL where it has some."""

import pytest
from conftest import same_rows

import __spark_entry__ as entry
from skein.plans.catalogue import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, duck, name):
    same_rows(QUERIES[name](spark, sf_dir), duck.execute(ORACLES[name]))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_places_do_not_depend_on_partitions(spark, sf_dir):
    def places(n):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        return sorted(map(tuple, QUERIES["hash_shuffle"](spark, sf_dir).collect()))

    try:
        assert places("1") == places("7") == places("4")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_token_labels_are_cut_at_the_configured_length(spark, sf_dir):
    rows = QUERIES["token_labels"](spark, sf_dir).collect()
    assert max(r.n_tokens for r in rows) > 256
    assert all(len(r.tokens) == len(r.labels) == min(r.n_tokens, 8192) and r.over_cap == (r.n_tokens > 8192) for r in rows)
