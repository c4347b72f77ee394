"""Registered queries: a Spark function and, next to it, the SQL an independent engine checks it with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airsight.catalog.adapters import ADAPTERS

QueryFunction = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFunction] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    def register(fn: QueryFunction) -> QueryFunction:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def sql(select: str, *parts: str) -> str:
    """WITH clause from adapter names and further ``name AS (...)`` parts, then the final SELECT."""
    ctes = [f"{p} AS ({ADAPTERS[p]})" if p in ADAPTERS else p for p in parts]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + select


def dec(expr: str, digits: int) -> str:
    """Oracle-side rounding: half up in decimal arithmetic, like Spark's ``round`` on doubles."""
    return f"CAST(round(CAST({expr} AS DECIMAL(30, 9)), {digits}) AS DOUBLE)"


def snap(c: Column | str, digits: int) -> Column:
    """Round a computed double after removing the noise of summation order."""
    return F.round(F.round(c, 9), digits)
