"""Registered queries against their SQL, on the usual and on the hot-group route."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, close, rows_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")

USUAL = (
    "merge_sources", "load_all_matches", "dedup_lineitem", "clean_events", "cleaning_audit", "event_state", "over_level",
    "player_level", "match_context", "pressure_profile", "derive_pressure_features", "silhouette", "davies_bouldin",
    "name_archetypes_counts", "similar_players", "rank_for_situation", "transitions", "policy", "nearest_state_batch", "nearest_q_key", "recommend_by_score",
    "rank_candidates_context", "batch_q_iteration", "counterfactual", "excitement_density_extended", "ad_tiers_by_season", "peak_detect",
    "revenue_resample", "hot_zones", "user_features_src", "kaplan_meier_by_streak", "segment_4", "revenue_impact_net",
)
HOT = ("event_state", "cap_wickets", "pressure_profile", "transitions", "clv_quartile", "concordance_continuous", "ad_tiers", "rank_candidates_context", "recommend_by_policy", "nearest_state_batch")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def compare(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(oracle_sql()[name])
    want = rows_of([c[0] for c in res.description], res.fetchall())
    assert close(got, want) == ""


@pytest.mark.parametrize("name", USUAL)
def test_query_matches_sql(spark, duck, name):
    compare(spark, duck, name)


@pytest.mark.parametrize("name", HOT)
def test_hot_route_matches_sql(spark, duck, hot, name):
    hot(60)
    compare(spark, duck, name)


def test_every_sql_text_parses(duck):
    for name, sql in oracle_sql().items():
        duck.execute("EXPLAIN " + sql)
        assert sql, name


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
