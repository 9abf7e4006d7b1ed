"""The preparation of one network: every table is written once and feeds the next from disk; all of them, or those asked for."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..config import NetworkConfig
from ..sources import artifacts, geometry, snapshots
from . import actuals as ac
from . import distributions as ds
from . import places, timetable


@dataclass(frozen=True)
class RawTables:
    """Published tables of one snapshot; ``shapes(uuid, wkb_geometry)``."""

    stops: DataFrame
    stop_times: DataFrame
    trips: DataFrame
    calendar: DataFrame
    routes: DataFrame
    shapes: DataFrame
    actuals: DataFrame | None = None

    @staticmethod
    def from_catalog(spark: SparkSession, catalog: str, shapes_table: str, cfg: NetworkConfig) -> RawTables:
        def snapshot(name: str) -> DataFrame:
            return snapshots.load_snapshot(spark, catalog, name, cfg)

        return RawTables(*[snapshot(n) for n in ("stops", "stop_times", "trips", "calendar", "routes")],
                         spark.table(shapes_table), spark.table(f"{catalog}.actuals"))


Get = Callable[[str], DataFrame]


def table_recipes(raw: RawTables, cfg: NetworkConfig) -> dict[str, Callable[[Get], DataFrame]]:
    """How each table is made, by name; its argument gives the tables that it is made of.

    Recorded arrivals only when ``cfg`` names a date window. With ``split_day`` the distribution levels are trained on
    the days before it.
    """
    if not cfg.region_uuids:
        raise ValueError("region_uuids must name at least one region")

    def region_actuals(get: Get) -> DataFrame:
        rows = snapshots.actuals_between(raw.actuals, cfg.start_date, cfg.end_date)
        return ac.clean_actuals(ac.actuals_in_region(rows, get("stops")) if cfg.region_actuals_only else rows, raw.routes)

    def past_levels(get: Get) -> DataFrame:
        past = snapshots.split_by_day(get("delay_training"), cfg.split_day)[0] if cfg.split_day else get("delay_training")
        return ds.trusted_levels(ds.delay_levels(past), cfg.min_observations)

    recipes = {
        "stops": lambda get: places.stops_in_regions(
            raw.stops, geometry.ring_edges(snapshots.shapes_by_uuid(raw.shapes, cfg.region_uuids))),
        "walking_edges": lambda get: places.walking_edges(get("stops"), cfg.max_walk_m, cfg.walk_speed_m_per_min),
        "stop_times": lambda get: timetable.region_stop_times(raw.stop_times, raw.trips, raw.calendar, raw.routes, get("stops")),
        "connections": lambda get: timetable.connections(get("stop_times")),
    }
    if raw.actuals is not None and (cfg.start_date or cfg.end_date):
        recipes |= {
            "actuals": region_actuals,
            "delay_training": lambda get: ac.delay_training(get("actuals")),
            "delay_features": lambda get: ac.hist_delay_features(get("delay_training")),
            "delay_levels": past_levels,
        }
    return recipes


def prepare_network(raw: RawTables, cfg: NetworkConfig) -> artifacts.PreparedNetwork:
    """Write all tables of ``cfg``. They count as prepared only when the last one is written."""
    recipes = table_recipes(raw, cfg)
    artifacts.mark(raw.stops.sparkSession, cfg, ())
    made: dict[str, DataFrame] = {}
    for name, recipe in recipes.items():
        made[name] = artifacts.write_and_read(recipe(made.__getitem__), cfg, name)
    artifacts.mark(raw.stops.sparkSession, cfg, tuple(made))
    return artifacts.PreparedNetwork(**made)


class NetworkOnDemand:
    """The attributes of a :class:`PreparedNetwork`, each written when it is first asked for and read from disk afterwards.

    A table that is asked for brings those that it is made of and no others: walking edges, whose number grows with the
    square of the stops of an area, are not made for a question about delays. The marker names the tables written so far.
    """

    def __init__(self, spark: SparkSession, cfg: NetworkConfig, raw: Callable[[], RawTables]):
        self._spark, self._cfg, self._raw = spark, cfg, raw

    def __getattr__(self, name: str) -> DataFrame | None:
        if name.startswith("_"):
            raise AttributeError(name)
        done = artifacts.complete_tables(self._spark, self._cfg)
        if name not in done:
            recipes = table_recipes(self._raw(), self._cfg)
            if name not in recipes:
                if name in artifacts.OPTIONAL:
                    return None
                raise AttributeError(name)
            artifacts.write_and_read(recipes[name](self.__getattr__), self._cfg, name)
            done = artifacts.complete_tables(self._spark, self._cfg) | {name}
            artifacts.mark(self._spark, self._cfg, tuple(sorted(done)))
        return self._spark.read.parquet(f"{self._cfg.artifact_path()}/{name}")
