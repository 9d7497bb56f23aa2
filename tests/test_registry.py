"""Every registered query against its SQL, on the smallest data set."""

import os

import pytest
from oracle_check import compare, duck
from pyspark.sql import functions as F

import __spark_entry__ as registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def db():
    return duck(SF_DIR)


def test_every_sql_has_a_query():
    assert registry.oracle_sql().keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    assert compare(spark, db, SF_DIR, registry.queries()[name], registry.oracle_sql()[name]) is None


def test_entry(spark):
    assert registry.entry(spark).count() > 0


def test_cycles_read_their_tables_on_each_call(spark, tmp_path):
    folder, events = f"{tmp_path}/tables", spark.read.parquet(f"{SF_DIR}/events.parquet")
    # The folder is made anew: a copy of it would be as read-only as the data may be.
    os.makedirs(folder)
    for name in set(os.listdir(SF_DIR)) - {"events.parquet"}:
        os.symlink(f"{SF_DIR}/{name}", f"{folder}/{name}")
    last = events.agg(F.max(F.to_date("ts"))).first()[0]
    events.write.parquet(f"{folder}/events.parquet")
    before = registry.queries()["cycle_dates"](spark, folder).count()
    events.where(F.to_date("ts") < F.lit(last)).write.mode("overwrite").parquet(f"{folder}/events.parquet")
    assert registry.queries()["cycle_dates"](spark, folder).count() == before - 1
