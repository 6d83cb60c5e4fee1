"""A selection of the registered queries against their SQL; tools/check_queries.py runs all."""

import duckdb
import pytest

import __spark_entry__
from stayloom.driver.views import TABLES
from tools.check_queries import rows_of

DATA = "/root/testdata/sf0.001"
NAMES = [
    "scan_folder", "link_table", "header_detail_join", "image_index", "cohort_select", "outcomes", "frac_hours",
    "ffill_bfill", "global_median", "one_hot", "notes_sep_join_parts", "prompt_text", "bootstrap_ci", "fairness_report",
]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{DATA}/{table}.parquet')")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    got = __spark_entry__.queries()[name](spark, DATA).toArrow()
    want = con.sql(__spark_entry__.oracle_sql()[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert rows_of(got) == rows_of(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
