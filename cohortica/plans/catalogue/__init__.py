"""Registered queries, each with the SQL it is checked against where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, negative zero made positive."""
    return df.select(*[
        (F.round(F.col(f"`{c}`"), digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(f"`{c}`")
        for c, t in df.dtypes
    ])


def load() -> None:
    from cohortica.plans.catalogue import learning, profiles, tables  # noqa: F401
