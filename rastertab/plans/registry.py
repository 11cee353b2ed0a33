"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame``
and, where the operator is SQL-expressible, an equivalent DuckDB SQL text over
the same tables (the correctness oracle)."""

from __future__ import annotations

import functools
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class RegisteredQuery:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    operators: tuple[str, ...]


REGISTRY: dict[str, RegisteredQuery] = {}


def prepare_session(spark: SparkSession) -> None:
    """Civil times are UTC in this engine (DATETIME = UTC TIMESTAMP)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def register(name: str, operators: tuple[str, ...] | list[str], oracle: str | None = None):
    def wrap(fn):
        @functools.wraps(fn)
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare_session(spark)
            return fn(spark, sf_dir)

        REGISTRY[name] = RegisteredQuery(name, build, oracle, tuple(operators))
        return fn
    return wrap
