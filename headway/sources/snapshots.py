"""Reading published snapshots, recorded arrivals, station files and region shapes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import NetworkConfig


def latest_value(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias(column))


def latest_snapshot(df: DataFrame, pub_date: str | None = None) -> DataFrame:
    """Rows of one publication: the named one, else the latest (a scalar subquery, no driver round trip)."""
    wanted = F.lit(pub_date).cast("date") if pub_date else latest_value(df, "pub_date").scalar()
    return df.where(F.col("pub_date") == wanted)


def with_resolved_date(spark: SparkSession, catalog: str, cfg: NetworkConfig, table: str = "stops") -> NetworkConfig:
    """``cfg`` with the latest publication's date where it names none, so that prepared tables carry that date."""
    if cfg.pub_date:
        return cfg
    latest = latest_value(spark.table(f"{catalog}.{table}"), "pub_date").first()[0]
    return replace(cfg, pub_date=None if latest is None else str(latest))


def load_snapshot(spark: SparkSession, catalog: str, table: str, cfg: NetworkConfig) -> DataFrame:
    """One of stops, stop_times, trips, routes, calendar, calendar_dates; each picks its own latest date."""
    return latest_snapshot(spark.table(f"{catalog}.{table}"), cfg.pub_date)


def latest_operating_day(actuals: DataFrame) -> DataFrame:
    return latest_value(actuals, "operating_day")


def actuals_between(actuals: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Recorded arrivals of a closed range of days; either end may be open."""
    if start:
        actuals = actuals.where(F.col("operating_day") >= F.lit(start).cast("date"))
    if end:
        actuals = actuals.where(F.col("operating_day") <= F.lit(end).cast("date"))
    return actuals


def weather_stations(spark: SparkSession, path: str) -> DataFrame:
    """Station file with a header; unreadable coordinates become NULL."""
    raw = spark.read.option("header", True).csv(path)
    return raw.withColumns({c: F.col(c).try_cast("double") for c in ("lat", "lon")})


def shapes_by_uuid(shapes: DataFrame, uuids: Sequence[str]) -> DataFrame:
    if not uuids:
        raise ValueError("at least one region uuid is needed")
    return shapes.where(F.col("uuid").isin(*uuids))


def shapes_by_name(shapes: DataFrame, pattern: str = "(?i)^Z.rich$", level: str = "district") -> DataFrame:
    return shapes.where(F.col("name").rlike(pattern) & (F.col("level") == level))


def split_by_day(df: DataFrame, split: str) -> tuple[DataFrame, DataFrame]:
    """(train, holdout): before the split day, and from it on."""
    day = F.lit(split).cast("date")
    return df.where(F.col("operating_day") < day), df.where(F.col("operating_day") >= day)


def split_day_counts(df: DataFrame, split: str) -> DataFrame:
    day, cut = F.col("operating_day"), F.lit(split).cast("date")
    return df.agg(F.count_distinct(F.when(day < cut, day)).alias("n_train_days"),
                  F.count_distinct(F.when(day >= cut, day)).alias("n_holdout_days"),
                  F.count(F.when(day < cut, 1)).alias("n_train_rows"),
                  F.count(F.when(day >= cut, 1)).alias("n_holdout_rows"))


SLOTS = 1_000_000


def _slot(keys: Sequence[str], seed: int) -> Column:
    """Slot of a row by the md5 of its key values as text, which any engine can compute."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % SLOTS


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """Reproducible sample: a row is in or out by the hash of its key, whatever the partitioning."""
    return df.where(_slot(keys, seed) < int(round(fraction * SLOTS)))


def capped_sample(df: DataFrame, keys: Sequence[str], fraction: float, max_rows: int, seed: int = 42) -> DataFrame:
    """:func:`hash_sample` with at most ``max_rows`` rows: as many whole slots of another hash as fit, lowest first.

    Only counts per slot are gathered, a million at the most; the rows are filtered where they are.
    """
    sample, slot = hash_sample(df, keys, fraction, seed), _slot(keys, seed + 1)
    up_to = F.sum("count").over(Window.orderBy("slot"))
    counts = sample.groupBy(slot.alias("slot")).count().withColumn("up_to", up_to)
    last = counts.where(F.col("up_to") <= max_rows).agg(F.max("slot")).first()[0]
    return sample.where(slot <= F.lit(-1 if last is None else last))
