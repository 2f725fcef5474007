"""Map raw delivery tables of several dialects onto the canonical columns."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stumpline.functions.exprs import as_int
from stumpline.sources.schema import CANONICAL, DIALECTS, INT_DEFAULT_ONE, INT_DEFAULT_ZERO

Rule = str | None


def dialect_rules(source: str) -> dict[str, Rule]:
    if source not in DIALECTS:
        raise ValueError(f"Unknown source '{source}'. Known: {sorted(DIALECTS)}")
    return {c: DIALECTS[source].get(c, c) for c in CANONICAL}


def over_ball(text: Column, part: int) -> Column:
    """Half of an "over.ball" text; the tenth ball "0.10" stays ten."""
    return F.when(F.contains(text, F.lit(".")), F.split_part(text, F.lit("."), F.lit(part)))


def _raw(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def rule_column(df: DataFrame, rule: Rule, shift_overs: bool = True) -> Column:
    """Evaluate one mapping rule, before type coercion."""
    if rule is None:
        return F.lit(None).cast("string")
    if rule.startswith("="):
        return F.lit(rule[1:])
    if rule == "runs()":
        number = lambda c: F.coalesce(_raw(df, c).cast("string").try_cast("double"), F.lit(0.0))
        return number("runs_off_bat") + number("extras")
    if rule == "wickets()":
        kind = _raw(df, "wicket_type")
        return F.when(kind.isNotNull() & (F.trim(kind) != ""), 1).otherwise(0)
    if rule == "over()":
        over = over_ball(_raw(df, "ball").cast("string"), 1).try_cast("int")
        return over + 1 if shift_overs else over
    if rule == "ball()":
        text = _raw(df, "ball").cast("string")
        return F.coalesce(over_ball(text, 2), text)
    return _raw(df, rule)


def harmonize(
    df: DataFrame, source: str, shift_overs: bool = True, rules: Mapping[str, Rule] | None = None
) -> DataFrame:
    """Exactly the canonical columns, plus ``seq`` when the input carries it.

    Overs parsed from "over.ball" text count from 0. They are shifted to count from 1 so that the
    first over survives the over filter and the phase limits hold; ``shift_overs=False`` keeps them.
    """
    rules = dict(rules) if rules is not None else dialect_rules(source)
    out = []
    for c in CANONICAL:
        col = rule_column(df, rules.get(c), shift_overs)
        if c in INT_DEFAULT_ONE:
            col = as_int(col, 1)
        elif c in INT_DEFAULT_ZERO:
            col = as_int(col, 0)
        else:
            col = col.cast("string")
        out.append(col.alias(c))
    if "seq" in df.columns:
        out.append(F.col("seq"))
    return df.select(*out)


def harmonize_report(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Per source: rows, canonical columns without a raw column, and null cells after mapping."""
    parts = []
    for source, df in frames.items():
        rules = dialect_rules(source)
        special = {"runs()", "wickets()", "over()", "ball()"}
        absent = [
            c
            for c, r in rules.items()
            if r is None or (r not in special and not r.startswith("=") and r not in df.columns)
        ]
        canon = harmonize(df, source)
        nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("long") for c in CANONICAL])
        parts.append(
            canon.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(nulls), F.lit(0)).alias("null_cells"))
            .select(
                F.lit(source).alias("source"),
                "rows",
                F.lit(len(absent)).cast("long").alias("absent_columns"),
                F.lit(",".join(absent)).alias("absent_names"),
                "null_cells",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def merge_sources(
    frames: Mapping[str, DataFrame],
    shift_overs: bool = True,
    rules: Mapping[str, Mapping[str, Rule]] | None = None,
) -> DataFrame:
    """Harmonise every source, tag it, and concatenate. ``source_rank`` keeps the given order."""
    if not frames:
        raise FileNotFoundError("No raw source available")
    parts = [
        harmonize(df, name, shift_overs, (rules or {}).get(name)).withColumns(
            {"_source": F.lit(name), "source_rank": F.lit(i)}
        )
        for i, (name, df) in enumerate(frames.items())
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# --- second internal schema (batter, runs = off the bat, flags) ---------------------------------

# How each dialect of the second schema names its columns.
STANDARD_RENAMES = {
    "ashwin": {"striker": "batter", "runs_off_bat": "runs"},
    "enriched": {"striker": "batter", "date": "start_date"},
    "ipl_2025": {"striker": "batter", "runs_of_bat": "runs", "date_x": "start_date", "venue_x": "venue"},
    "kaggle": {"striker": "batter", "runs_off_bat": "runs"},
}
STANDARD_MATCH_TYPE = {"ashwin": "T20", "ipl_2025": "IPL"}


def standardise(df: DataFrame, source: str) -> DataFrame:
    """Second internal schema: batter, runs, over, ball_in_over, wicket and extra flags, teams."""
    if source not in STANDARD_RENAMES:
        raise ValueError(f"Unknown source '{source}'. Known: {sorted(STANDARD_RENAMES)}")
    names = STANDARD_RENAMES[source]
    clash = [new for old, new in names.items() if old in df.columns and new in df.columns]
    out = df.drop(*clash).withColumnsRenamed({o: n for o, n in names.items() if o in df.columns})
    have = set(out.columns)

    def positive(name: str) -> Column:
        return (as_int(F.col(name), 0) > 0).cast("int") if name in have else F.lit(0)

    def kept(name: str, default: object) -> Column:
        return F.col(name) if name in have else F.lit(default)

    text = kept("ball", None).cast("string")
    dismissal = (
        (F.col("wicket_type").isNotNull() & (F.trim("wicket_type") != "")).cast("int")
        if "wicket_type" in have
        else F.lit(0)
    )
    cols: dict[str, Column] = {
        "is_wide": positive("wide" if source == "ipl_2025" else "wides"),
        "is_noball": as_int(kept("noballs", None), 0) if source == "ipl_2025" else positive("noballs"),
        "is_wicket": dismissal,
        "runs": as_int(F.col("runs_off_bat" if source == "enriched" else "runs"), 0),
        "match_type": F.lit(STANDARD_MATCH_TYPE.get(source, "T20")),
        "city": F.lit(""),
    }
    if source in ("enriched", "kaggle"):
        if "is_wicket" in have:
            cols["is_wicket"] = as_int(F.col("is_wicket"), 0)
        cols["match_type"] = kept("match_type", "T20")
        cols["city"] = kept("city", "")
    if source == "ashwin" or (source == "enriched" and "over" not in have):
        cols["over"] = F.coalesce(F.split_part(text, F.lit("."), F.lit(1)).try_cast("int"), F.lit(0))
    else:
        cols["over"] = as_int(F.col("over"), 0)
    if source == "ipl_2025":
        cols["ball_in_over"] = F.lit(1)
    elif source == "kaggle":
        cols["ball_in_over"] = as_int(text, 1)
    else:
        cols["ball_in_over"] = F.coalesce(F.element_at(F.split(text, r"\."), -1).try_cast("int"), F.lit(1))
    if source in ("ipl_2025", "kaggle"):
        cols["innings"] = F.col("innings").cast("int")
    sides = ("batting_team", "bowling_team") if source == "ashwin" else ("team1", "team2")
    if source == "enriched" and "team1" not in have:
        sides = ("batting_team", "bowling_team")
    cols["teams"] = F.concat(F.lit("["), F.col(sides[0]), F.lit(", "), F.col(sides[1]), F.lit("]"))
    for name in ("toss_winner", "toss_decision"):
        cols[name] = kept(name, "")
    if source == "ipl_2025" and "first_ings_score" in have:
        cols["target"] = F.col("first_ings_score").cast("string")
    else:
        cols["target"] = kept("target", "" if source in ("ashwin", "enriched") else "0").cast("string")
    return out.withColumns(cols)


def load_all_matches(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Union of the standardised sources, filling columns a source lacks with null."""
    if not frames:
        raise FileNotFoundError("No delivery file available")
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [standardise(df, name) for name, df in frames.items()],
    )
