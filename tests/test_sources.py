import pytest
from pyspark.sql import functions as F

from stumpline.operators import decision as de
from stumpline.sources import harmonize as hz
from stumpline.sources import readers, store

HEADER = "match_id,season,start_date,venue,innings,ball,batting_team,bowling_team,striker,non_striker,bowler,runs_off_bat,extras,wides,noballs,byes,legbyes,wicket_type,player_dismissed"


@pytest.fixture
def folder(tmp_path):
    lines = [HEADER]
    for innings in (1, 2):
        for over in range(20):
            for ball in range(1, 7):
                out = "caught,s one" if ball == 6 and over % 5 == 0 else ","
                lines.append(f"1001,2025,2025-05-18,V,{innings},{over}.{ball},team a,team b,s one,,b two,{(over + ball) % 3},0,,,,,{out}")
    (tmp_path / "raw_cricsheet_all_ipl.csv").write_text("\n".join(lines))
    return str(tmp_path)


def test_reads_what_exists(spark, folder):
    frames = readers.read_all_sources(spark, folder)
    assert list(frames) == ["raw_cricsheet_all_ipl"]
    with pytest.raises(FileNotFoundError):
        readers.read_source(spark, "raw_ipl_2025", folder)
    with pytest.raises(ValueError, match="Unknown"):
        readers.read_source(spark, "other", folder)
    canon = hz.merge_sources(frames)
    assert canon.count() == 240
    assert canon.agg(F.min("over"), F.max("over")).first() == (1, 20)


def test_feature_store_is_reused_and_rebuilt(spark, folder, tmp_path):
    out = str(tmp_path / "store")
    first = store.build_feature_store(spark, out, raw_folder=folder)
    assert {k: df.count() for k, df in first.items()} == {
        "full_canonical": 240, "match_state": 240, "over_level": 40, "player_level": 1, "match_level": 2,
    }
    files = lambda: sorted(p.name for p in (tmp_path / "store" / "match_level.parquet").iterdir() if p.suffix == ".parquet")
    before = files()
    store.build_feature_store(spark, out, raw_folder=folder)
    assert files() == before
    store.build_feature_store(spark, out, raw_folder=folder, force=True)
    assert files() != before
    ready = store.store_inventory(spark, out).collect()
    assert all(r["present"] and r["all_ready"] and r["bytes"] > 0 for r in ready)
    assert store.load_feature_store(spark, out, "over_level").count() == 40
    with pytest.raises(ValueError, match="Unknown"):
        store.load_feature_store(spark, out, "nope")
    with pytest.raises(FileNotFoundError):
        store.load_feature_store(spark, out + "x", "over_level")


def test_policy_round_trip(spark, tmp_path):
    q = spark.createDataFrame([("0_1", 0, 0.5), ("0_1", 1, 0.7)], "state_key string, action int, q double")
    store.export_results(str(tmp_path), {}, {"q_table": q})
    again = store.read_policy(spark, f"{tmp_path}/q_table.json")
    assert [r["action"] for r in de.policy(again).collect()] == [1]


def test_user_file_is_checked(spark, tmp_path):
    (tmp_path / "u.csv").write_text("user_id,win_rate\n1,0.5\n")
    with pytest.raises(ValueError, match="lacks columns"):
        readers.read_users(spark, str(tmp_path / "u.csv"))
    with pytest.raises(FileNotFoundError):
        readers.read_users(spark, str(tmp_path / "none.csv"))


def test_no_source_raises():
    with pytest.raises(FileNotFoundError):
        hz.merge_sources({})


def test_stored_state_keeps_the_order_of_arrival(spark, tmp_path):
    late = [("z bowler", 4), ("a bowler", 0), ("m bowler", 6)]
    lines = [HEADER]
    for ball in range(1, 5):
        for bowler, runs in late:
            lines.append(f"1001,2025,2025-05-18,V,1,3.{ball},team a,team b,s one,,{bowler},{runs},0,,,,,,")
    (tmp_path / "raw_cricsheet_all_ipl.csv").write_text("\n".join(lines))
    stored = store.build_feature_store(spark, str(tmp_path / "store"), raw_folder=str(tmp_path))["match_state"]
    rows = stored.orderBy("over", "ball", "seq").select("bowler", "total_runs").collect()
    want, total = [], 0
    for _ in range(4):
        for bowler, runs in late:
            total += runs
            want.append((bowler.title(), total))
    assert [tuple(r) for r in rows] == want
