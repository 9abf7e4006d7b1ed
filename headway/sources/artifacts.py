"""Prepared tables on disk: write once, read back, rebuild when missing."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..config import NetworkConfig

log = logging.getLogger(__name__)

CORE = ("stops", "walking_edges", "stop_times", "connections")
OPTIONAL = ("actuals", "delay_training", "delay_features", "delay_levels")


@dataclass(frozen=True)
class PreparedNetwork:
    stops: DataFrame
    walking_edges: DataFrame
    stop_times: DataFrame
    connections: DataFrame
    actuals: DataFrame | None = None
    delay_training: DataFrame | None = None
    delay_features: DataFrame | None = None
    delay_levels: DataFrame | None = None


def write_and_read(df: DataFrame, cfg: NetworkConfig, name: str) -> DataFrame:
    path = f"{cfg.artifact_path()}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def mark(spark: SparkSession, cfg: NetworkConfig, names: tuple[str, ...]) -> None:
    """Names the tables that are complete: none before a preparation writes, all of them after its last table."""
    spark.createDataFrame([(n,) for n in names], "name string").coalesce(1).write.mode("overwrite").parquet(f"{cfg.artifact_path()}/complete")


def write_prepared(prepared: PreparedNetwork, cfg: NetworkConfig) -> None:
    present = [f.name for f in fields(prepared) if getattr(prepared, f.name) is not None]
    spark = prepared.stops.sparkSession
    mark(spark, cfg, ())
    for name in present:
        write_and_read(getattr(prepared, name), cfg, name)
    mark(spark, cfg, tuple(present))


def complete_tables(spark: SparkSession, cfg: NetworkConfig) -> set[str]:
    """Names that the marker holds; none if there is no marker. Other errors are not taken for a missing one."""
    try:
        marker = spark.read.schema("name string").parquet(f"{cfg.artifact_path()}/complete")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    return {r["name"] for r in marker.collect()}


def read_prepared(spark: SparkSession, cfg: NetworkConfig) -> PreparedNetwork:
    base, names = cfg.artifact_path(), complete_tables(spark, cfg)
    if not set(CORE) <= names:
        raise RuntimeError(f"no prepared tables under {base}: run the preparation first")
    return PreparedNetwork(**{name: spark.read.parquet(f"{base}/{name}") for name in CORE + OPTIONAL if name in names})


def prepare_or_load(spark: SparkSession, cfg: NetworkConfig, build: Callable[[], PreparedNetwork],
                    force: bool = False) -> PreparedNetwork:
    """Prepared tables from disk if their marker says that all were written, else those that ``build`` has written."""
    if not force and set(CORE) <= complete_tables(spark, cfg):
        return read_prepared(spark, cfg)
    log.info("no complete tables under %s, building them", cfg.artifact_path())
    build()
    return read_prepared(spark, cfg)
