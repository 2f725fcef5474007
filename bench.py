"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from stumpline.plans.catalog import QUERIES
from stumpline.session import local_session

HEADLINE = (
    "merge_sources", "dedup_lineitem", "clean_events", "cleaning_audit", "event_state", "over_level", "player_level",
    "match_level", "pressure_profile", "derive_pressure_features", "rank_for_situation", "similar_players", "silhouette",
    "discretise_state", "transitions", "policy", "rank_candidates_context", "counterfactual", "excitement_normalised",
    "series_tension", "ad_tiers", "peak_detect", "revenue_resample", "hot_zones", "user_features_ext", "kaplan_meier_by_age",
    "concordance_continuous", "segment_4", "segment_5", "revenue_impact_net", "describe_by_flag",
)
# Fitted models: run once, cold.
MODELS = ("batch_q_iteration", "recommend_by_policy", "compatibility_score", "cox_ph")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name].build(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in HEADLINE:
        cold[name] = round(seconds(name), 3)
        times[name] = round(statistics.median([seconds(name) for _ in range(runs)]), 3)
    models = {name: round(seconds(name), 3) for name in MODELS}
    print(
        json.dumps(
            {
                "metric": "total warm seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "cold": cold,
                "models": models,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
