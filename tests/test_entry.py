"""Queries against their SQL twins. PATHLARK_ALL=1 runs every one, else a cross-section."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from checks.compare import TABLES, rows_of
from checks.oracle import ORACLE
from checks.queries import QUERIES

SOME = [
    "clean_valid", "clean_reject_reasons", "user_features", "item_features_orders", "behavior_funnel", "join_user_features_salted",
    "agg_training_samples", "hot_items_two_phase", "win_sliding_features_day", "topk_per_user", "topk_per_user_orders",
    "serving_top50", "ctr_cvr_after_rec", "join_before_after", "evaluate_offline", "downsample_negatives", "train_test_split",
    "sink_upsert_recommendations", "ctr_cvr_trend", "stream_score", "late_data",
]
NAMES = sorted(ORACLE) if os.environ.get("PATHLARK_ALL") else SOME
NO_TWIN: set[str] = set()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES.split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def test_every_query_has_a_twin():
    assert set(QUERIES) - set(ORACLE) == NO_TWIN
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    want = rows_of(rel.columns, rel.fetchall())
    assert rows_of(df.columns, df.collect()) == want
