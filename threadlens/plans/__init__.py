"""Registered queries (Spark) and their SQL oracles (DuckDB).

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver's tables;
each oracle is the same result written as SQL over the pre-registered
views. Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _json_as_text(sql: str) -> str:
    """DuckDB's to_json returns a JSON type; Spark's returns a string."""
    out, i, key = [], 0, "to_json("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _json_as_text(sql[j + len(key):k])
        out.append(sql[i:j] + f"CAST(to_json({inner}) AS VARCHAR)")
        i = k + 1


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = _json_as_text(sql)
        return fn
    return deco


def load_all() -> None:
    from threadlens.plans import (  # noqa: F401
        q_text, q_unify, q_threads, q_decisions, q_ingest, q_models, q_streaming, q_opinions,
    )
