"""Every registered query against its SQL; those without SQL must run and return rows."""

import pytest

import oracle
from newsgrid.plans import ORACLE, QUERIES

# The clustering queries without SQL are compared with the sequential rules in test_cluster.
SLOW = {"time_band_similarity_join", "merge_story", "stateful_archive", "consolidate", "leader_cluster"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.duck(sf_dir)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(name, spark, sf_dir, con):
    if name in ORACLE:
        assert oracle.compare(spark, con, QUERIES[name], ORACLE[name], sf_dir) in (None, "no rows")
    else:
        assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
