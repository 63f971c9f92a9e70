"""Every query against its oracle SQL on the test tables."""

import os

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from evenkeel.plans.oracles import SQL
from evenkeel.plans.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, db, name):
    count, problems = compare(QUERIES[name](spark, SF_DIR), db, SQL[name])
    assert not problems
    assert count > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_times_are_utc_in_any_session(spark, db):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    _, problems = compare(QUERIES["crawl_rates"](spark, SF_DIR), db, SQL["crawl_rates"])
    assert not problems
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
