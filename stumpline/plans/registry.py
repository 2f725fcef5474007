"""Named queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stumpline.plans import bridge

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    spec: str
    inner: str | None
    needs: str

    @property
    def sql(self) -> str | None:
        return None if self.inner is None else _with(self.needs) + _duck_shape(self.inner, self.spec)


QUERIES: dict[str, Query] = {}
CTES: dict[str, tuple[tuple[str, ...], str]] = {}

_SPARK_TYPE = {"l": "long", "i": "int", "d": "double", "s": "string", "b": "boolean"}
_DUCK_TYPE = {"l": "BIGINT", "i": "INTEGER", "d": "DOUBLE", "s": "VARCHAR", "b": "BOOLEAN"}


def columns(spec: str) -> list[tuple[str, str]]:
    """"match_id:s over:i x:d" -> [("match_id", "s"), ...]"""
    return [(p.split(":")[0], p.split(":")[1]) for p in spec.split()]


def shape(df: DataFrame, spec: str) -> DataFrame:
    """Select and type the result; doubles to six places so that engines can be compared."""

    def one(name: str, kind: str) -> Column:
        col = F.col(f"`{name}`").cast(_SPARK_TYPE[kind])
        return (F.round(col, 6) + F.lit(0.0) if kind == "d" else col).alias(name)

    return df.select(*[one(n, k) for n, k in columns(spec)])


def _duck_shape(sql: str, spec: str) -> str:
    def one(name: str, kind: str) -> str:
        source = "over_no" if name == "over" else f'"{name}"'
        cast = f"CAST({source} AS {_DUCK_TYPE[kind]})"
        return f'{f"ROUND({cast}, 6) + 0.0" if kind == "d" else cast} AS "{name}"'

    return f"SELECT {', '.join(one(n, k) for n, k in columns(spec))} FROM ({sql}) AS q"


def cte(name: str, needs: str, body: str) -> None:
    CTES[name] = (tuple(needs.split()), body)


def _with(needs: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in CTES[name][0]:
            visit(dep)
        if name not in order:
            order.append(name)

    for name in needs.split():
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" if order else ""


def query(name: str, spec: str, sql: str | None = None, needs: str = "") -> Callable[[Build], Build]:
    """Register a query. ``sql`` reads the shared CTEs listed in ``needs``."""

    def add(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = Query(lambda spark, folder: shape(build(spark, folder), spec), spec, sql, needs)
        return build

    return add


_DUCK = {
    "div": "//",
    "sec": "date_diff('second', TIMESTAMP '2024-01-01 00:00:00', ts)",
    "days": "date_diff('day', last_day, DATE '2024-01-31')",
}


def _list(cols: dict[str, str], rename: dict[str, str] | None = None) -> str:
    names = rename or {}
    return ", ".join(f'{e.format(**_DUCK)} AS {names.get(n, n)}' for n, e in cols.items())


cte("base", "", f"SELECT {_list(bridge.DELIVERY_COLUMNS)} FROM events")
cte(
    "d",
    "base",
    "SELECT *, wides + noballs + legbyes AS extras, runs_off_bat + wides + noballs + legbyes AS runs, "
    "CASE WHEN wickets > 0 THEN striker END AS player_dismissed, "
    "CASE WHEN runs_off_bat >= 4 AND wides = 0 THEN 1 ELSE 0 END AS bnd, "
    "CASE WHEN runs_off_bat = 0 AND wides = 0 AND noballs = 0 THEN 1 ELSE 0 END AS dot, "
    "CASE WHEN wides = 0 AND noballs = 0 THEN 1 ELSE 0 END AS legal FROM base",
)
cte("rawtext", "base", f"SELECT {_list(bridge.TEXT_COLUMNS)} FROM base")
cte("rawwide", "base", f"SELECT {_list(bridge.WIDE_COLUMNS, {'over': 'over_no'})} FROM base")
cte("u_runs", "", """
SELECT user_id, MAX(n) AS streak FROM (
  SELECT user_id, grp, COUNT(*) AS n FROM (
    SELECT user_id, rn - ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY rn) AS grp FROM (
      SELECT user_id, event_type, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events
    ) WHERE event_type = 'error') GROUP BY user_id, grp) GROUP BY user_id""")
cte("u_tot", "", f"SELECT user_id, {_list(bridge.USER_AGGREGATES)} FROM events GROUP BY user_id")
cte(
    "u",
    "u_runs u_tot",
    f"SELECT {_list(bridge.USER_COLUMNS)} FROM (SELECT t.*, r.streak FROM u_tot t LEFT JOIN u_runs r USING (user_id))",
)
