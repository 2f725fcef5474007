"""Hand-computed fixtures for the rules where engines or variants differ."""

import pytest
from pyspark.sql import functions as F

from stumpline.functions.exprs import as_int, title_case
from stumpline.operators import aggregates as agg
from stumpline.operators import clean, engagement, state, survival, users
from stumpline.sources import harmonize as hz

D = (
    "seq long, match_id string, innings int, over int, ball int, batting_team string, bowling_team string, striker string, "
    "non_striker string, bowler string, runs_off_bat int, extras int, wides int, noballs int, byes int, legbyes int, "
    "wicket_type string, player_dismissed string, runs int, wickets int, venue string, date string, match_type string"
)


def deliveries(spark, rows):
    """rows: dicts of the columns that matter; the rest get plain values."""
    base = dict(
        seq=0, match_id="m", innings=1, over=1, ball=1, batting_team="A", bowling_team="B", striker="s", non_striker="n",
        bowler="b", runs_off_bat=0, extras=0, wides=0, noballs=0, byes=0, legbyes=0, wicket_type=None,
        player_dismissed=None, runs=None, wickets=0, venue="v", date="d", match_type="T20",
    )
    out = []
    for i, r in enumerate(rows):
        row = base | {"seq": i} | r
        if row["runs"] is None:
            row["runs"] = row["runs_off_bat"] + row["extras"]
        out.append(tuple(row.values()))
    return spark.createDataFrame(out, D)


def column(df, name, *order):
    return [r[0] for r in df.orderBy(*order or ("seq",)).select(name).collect()]


def test_tenth_ball_and_first_over(spark):
    raw = spark.createDataFrame([("m", "1", "0.10", None), ("m", "1", "19.6", "caught"), ("m", "1", "5", "")], "match_id string, innings string, ball string, wicket_type string")
    got = hz.harmonize(raw, "raw_cricsheet_all_ipl").orderBy("ball", "over").collect()
    assert sorted((r["over"], r["ball"], r["wickets"]) for r in got) == [(1, 5, 0), (1, 10, 0), (20, 6, 1)]
    kept = hz.harmonize(raw, "raw_cricsheet_all_ipl", shift_overs=False)
    assert sorted(r["over"] for r in kept.collect()) == [0, 1, 19]
    assert len(got[0]) == 22


def test_unknown_source_raises(spark):
    with pytest.raises(ValueError, match="Unknown source"):
        hz.harmonize(spark.range(1), "nope")


def test_lenient_numbers(spark):
    df = spark.createDataFrame([("3",), ("3.7",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(as_int(F.col("t"), 0)).collect()] == [3, 3, 0, 0]


def test_title_case(spark):
    df = spark.createDataFrame([(" ms dhoni ",), ("o'brien",), ("de VILLIERS",), ("smith-jones",)], "n string")
    got = [r[0] for r in df.select(title_case(F.col("n"))).collect()]
    assert got == ["Ms Dhoni", "O'Brien", "De Villiers", "Smith-Jones"]


def test_dedup_prefers_first_source_and_matches_nulls(spark):
    df = deliveries(spark, [dict(bowler=None, runs_off_bat=4), dict(bowler=None, runs_off_bat=1), dict(ball=2)])
    df = df.withColumn("source_rank", F.when(F.col("seq") == 0, 1).otherwise(0))
    got = clean.dedup_events(df).orderBy("ball").collect()
    assert [(r["seq"], r["runs_off_bat"]) for r in got] == [(1, 1), (2, 0)]


def test_eleventh_wicket_is_zeroed(spark):
    df = deliveries(spark, [dict(ball=i, wickets=1) for i in range(12)])
    assert column(clean.cap_wickets(df), "wickets") == [1] * 10 + [0, 0]


def test_gap_of_three_stays_and_four_is_repaired(spark):
    df = deliveries(spark, [dict(runs_off_bat=1, runs=4), dict(runs_off_bat=1, runs=5)])
    assert column(clean.reconcile_runs(df), "runs") == [4, 1]
    df = deliveries(spark, [dict(extras=3, runs=0), dict(extras=4, runs=0)])
    assert column(clean.reconcile_extras(df), "extras") == [3, 0]


def test_audit_counts(spark):
    rows = [dict(), dict(), dict(ball=2, over=60), dict(ball=3, striker=None), dict(ball=4, runs=9)]
    r = clean.cleaning_audit(deliveries(spark, rows)).first()
    assert (r["rows_before"], r["rows_after"], r["duplicates_removed"], r["overs_out_of_range"], r["missing_critical"], r["runs_fixed"]) == (5, 2, 1, 1, 1, 1)
    assert r["summary"].startswith("rows 5 -> 2; duplicates 1")
    assert clean.clean_events(deliveries(spark, rows)).count() == 2


def test_wicket_ball_starts_partnership(spark):
    df = deliveries(spark, [dict(ball=1, runs_off_bat=2), dict(ball=2, runs_off_bat=1, wickets=1), dict(ball=3, runs_off_bat=4)])
    st = state.event_state(df)
    assert column(st, "partnership_runs") == [2, 1, 5]
    assert column(st, "partnership_balls") == [1, 1, 2]
    assert len(st.drop("seq").columns) == 42  # 22 canonical and 20 state columns


def chase(spark, last):
    first = [dict(ball=1, runs_off_bat=4), dict(ball=2, runs_off_bat=1)]
    second = [dict(innings=2, ball=1, runs_off_bat=2), dict(innings=2, ball=2, runs_off_bat=last)]
    return state.event_state(deliveries(spark, first + second), keep_working=True)


def test_last_ball_of_a_chase(spark):
    won, lost = chase(spark, 4), chase(spark, 1)
    assert column(won, "chase_win_probability_proxy")[-1] == 1.0
    assert column(lost, "chase_win_probability_proxy")[-1] == 0.0
    assert column(won, "target") == [6, 6, 6, 6]
    assert column(won, "required_run_rate") == [None, None, 24.0, None]
    assert column(won, "chase_win_probability_proxy")[:2] == [0.5, 0.5]


def test_third_innings_is_not_a_chase(spark):
    st = state.event_state(deliveries(spark, [dict(), dict(innings=3, over=17)]))
    assert column(st, "pressure_index") == [0.0, 0.0]
    assert column(st, "phase_of_play") == ["powerplay", "chase_death"]


def test_state_does_not_depend_on_partitioning(spark):
    df = deliveries(spark, [dict(over=1 + i // 6, ball=1 + i % 6, runs_off_bat=i % 5, wickets=int(i % 11 == 0)) for i in range(60)])
    a = sorted(map(str, state.event_state(df).collect()))
    b = sorted(map(str, state.event_state(df.repartition(7)).collect()))
    assert a == b


def test_null_keys_leave_aggregates(spark):
    df = deliveries(spark, [dict(), dict(match_id=None), dict(striker=None, ball=2)])
    assert agg.over_level(df).count() == 1
    assert [r["player"] for r in agg.player_level(df).collect()] == ["s"]
    assert agg.match_level(df).first()["total_balls"] == 2


def test_cumulative_ends_at_total(spark):
    df = deliveries(spark, [dict(over=o, ball=b, runs_off_bat=o % 4) for o in range(1, 6) for b in range(1, 7)])
    overs = agg.over_level(df)
    assert max(column(overs, "cumulative_score", "over")) == sum(column(overs, "runs_scored", "over"))


OVERS = "match_id string, innings int, batting_team string, over int, runs_scored long, wickets long, boundaries long, dot_balls long"


def test_swing_crosses_the_innings_break(spark):
    df = spark.createDataFrame([("m", 1, "A", 20, 5, 0, 0, 0), ("m", 2, "B", 1, 9, 2, 0, 2)], OVERS)
    got = engagement.excitement_density(df, "source").orderBy("innings").collect()
    assert [r["momentum_shift"] for r in got] == [0.0, 2.0]
    assert got[1]["excitement_density"] == 2 * 4 + 2 * 0.5 + 2 * 1.5 + 2.0


def test_flat_match_is_zero(spark):
    df = spark.createDataFrame([("m", 1, "A", o, 5, 0, 0, 0) for o in range(4)], OVERS)
    assert {r[0] for r in engagement.excitement_density(df).select("excitement_normalised").collect()} == {0.0}


def test_streaks(spark):
    rows = [("m", 1, "A", o, 0, 0, 0, 0, v) for o, v in enumerate([1.0, 1.0, 0.0, 1.0])]
    df = spark.createDataFrame(rows, OVERS + ", excitement_normalised double")
    got = engagement.peak_detect(df, q=0.25).orderBy("over").collect()
    assert [r["peak_streak"] for r in got] == [1, 2, 0, 1] or [r["peak_streak"] for r in got] == [0, 0, 0, 0]
    low = engagement.peak_detect(df.withColumn("p", F.col("excitement_normalised") * 2), predicted="p", q=0.8).orderBy("over").collect()
    assert [r["peak_streak"] for r in low] == [1, 2, 0, 1]
    assert [r["engagement_window"] for r in low] == [0, 1, 0, 0]


@pytest.mark.parametrize("n", [4, 5, 6, 7, 50, 101])
def test_quartiles_follow_rank_edges(spark, n):
    df = spark.range(n).select(F.col("id").alias("user_id"), (F.col("id") % 3).cast("double").alias("predicted_clv"))
    got = {r["user_id"]: r["clv_quartile"] for r in users.clv_quartile(df).collect()}
    ranked = sorted(range(n), key=lambda i: (i % 3, i))
    for rank, uid in enumerate(ranked, 1):
        edges = [1 + (n - 1) * q for q in (0.25, 0.5, 0.75)]
        want = ["Q1_Low", "Q2", "Q3", "Q4_High"][sum(rank > e for e in edges)]
        assert got[uid] == want


def test_win_rate_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.051,), (0.15,), (0.3,), (1.0,)], "w double")
    got = [r[0] for r in df.select(users.win_rate_bucket(F.col("w"))).collect()]
    assert got == [None, "low", "medium", "medium", "high", "elite"]


def test_survival_with_ties_and_full_death(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (2, 0), (3, 1)], "duration_days int, event_observed int")
    got = {r["duration"]: r["survival"] for r in survival.kaplan_meier(df).collect()}
    assert got == pytest.approx({1: 0.6, 2: 0.6, 3: 0.0})


def test_given_ids_are_ranked_among_themselves(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "user_id long, score double")
    ids = spark.createDataFrame([(1,), (2,)], "user_id long")
    got = users.risk_rankings(df, "score", 2, ids=ids, columns=["user_id", "score"]).collect()
    assert [r["user_id"] for r in got] == [2, 1]
