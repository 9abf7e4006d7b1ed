"""Registered queries: a Spark function per name and, where SQL can say the same, its text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..config import tune_session
from ..sources.transit_views import BLOCKS, TransitTables, plain_tables, with_blocks

Query = Callable[[TransitTables], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
# SQL that is too slow on whole tables: the tests run it on the smallest set.
SLOW_ORACLES: dict[str, str] = {}
# SQL-only blocks of the oracles, next to the shared views.
ORACLE_BLOCKS: dict[str, str] = {}


def query(name: str, sql: str | None = None, slow: bool = False) -> Callable[[Query], Query]:
    def keep(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = build
        if sql:
            (SLOW_ORACLES if slow else ORACLES)[name] = sql
        return build
    return keep


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: build(TransitTables(tune_session(spark), folder))
    return {name: bind(build) for name, build in QUERIES.items()}


def oracle_texts(slow: bool = False) -> dict[str, str]:
    blocks = {**BLOCKS, **ORACLE_BLOCKS}
    texts = {**ORACLES, **SLOW_ORACLES} if slow else ORACLES
    return {name: plain_tables(with_blocks(text, blocks, "AS MATERIALIZED")) for name, text in texts.items()}
