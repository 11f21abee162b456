"""Registry of queries and their SQL counterparts.

SQL texts name their inputs as ``{table}``; inputs that are views over the test tables become
common table expressions. Columns listed in ``fix`` are put on a decimal grid on both sides.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.functions.exprs import fixed
from lumenframe.plans.views import BASE_TABLES, VIEWS

_NAME = re.compile(r"\{(\w+)\}")
_SEQ = re.compile(r"SEQ\[([^,\]]+),([^,\]]+),([^\]]+)\]")

CUBE = ["cube_id"]  # what tells cubes apart in the voxel view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SHARED: dict[str, str] = {}


class Tables:
    """Test tables and views as attributes; a view is planned once per query."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._known: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._known:
            if name in BASE_TABLES:
                self._known[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                self._known[name] = self.sql(VIEWS[name][0])
        return self._known[name]

    def sql(self, text: str) -> DataFrame:
        text = _SEQ.sub(r"explode(sequence(\1,\2,\3))", text)
        return self.spark.sql(text, **{n: getattr(self, n) for n in set(_NAME.findall(text))})


def _expand(sql: str, done: dict[str, str]) -> str:
    for name in _NAME.findall(sql):
        if name in BASE_TABLES or name in done:
            continue
        text = SHARED[name] if name in SHARED else VIEWS[name][-1]
        body = _expand(text, done)
        done[name] = _SEQ.sub(r"unnest(range(\1,\2+1,\3))", body)
    return _NAME.sub(r"\1", sql)


def duck_sql(sql: str, fix: Mapping[str, int], fill: list[str]) -> str:
    views: dict[str, str] = {}
    body = _SEQ.sub(r"unnest(range(\1,\2+1,\3))", _expand(sql, views))
    head = ""
    if views:
        head = "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({t})" for n, t in views.items()) + "\n"
    parts = [f"floor(CAST({c} AS DOUBLE) * 1e{d} + 0.50001) / 1e{d} AS {c}" for c, d in fix.items()]
    swap = ", ".join(parts + [f"COALESCE({c}, -1) AS {c}" for c in fill])
    return f"{head}SELECT *{f' REPLACE ({swap})' if swap else ''} FROM (\n{body}\n) AS result"


def shared(name: str, sql: str) -> None:
    """A SQL text used by several counterparts."""
    SHARED[name] = sql


def query(name: str, *, fix: str = "", fill: str = "", digits: int = 6, sql: str | None = None):
    """Register ``f(tables) -> DataFrame``; ``fix`` lists float columns as ``name`` or
    ``name:digits``, ``fill`` whole-number columns whose missing values become -1."""
    grid = {}
    for item in fix.split():
        col, _, d = item.partition(":")
        grid[col] = int(d or digits)

    def register(f):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            out = f(Tables(spark, folder))
            swap = {c: fixed(F.col(c).cast("double"), d) for c, d in grid.items()}
            swap.update({c: F.coalesce(F.col(c), F.lit(-1)) for c in fill.split()})
            return out.withColumns(swap) if swap else out

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = duck_sql(sql, grid, fill.split())
        return f

    return register
