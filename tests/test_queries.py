"""Registered queries against their SQL. A spread of them here; all with STATIONQC_ALL=1."""

import os

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from stationqc.catalog.queries import QUERIES, TWO_LEVEL

FEW = [
    "dedup_rows",
    "qod_window",
    "unsent_rows",
    "write_scores",
    "model_params",
    "select_raw_columns",
    "resample_grid",
    "constancy",
    "wind_coupling",
    "packages_per_hour",
    "bin_jumps",
    "bin_annotation_update",
    "hour_annotation_tokens",
    "hourly_json",
    "hour_path",
    "quality_scores",
]
NAMES = list(QUERIES) if os.environ.get("STATIONQC_ALL") else FEW
#: The smallest table has less than a day of the 16-second model, all of it warm-up: queries of that model alone take the next one.
LARGER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf_dir, name):
    sf_dir = LARGER if name in TWO_LEVEL else sf_dir
    con = connect(sf_dir)
    ours = queries()[name](spark, sf_dir).toArrow()
    assert ours.num_rows > 0
    if name in oracle_sql():
        assert differences(ours, con.sql(oracle_sql()[name]).to_arrow_table()) == []


def test_every_query_of_the_engine_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
