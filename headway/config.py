"""Settings passed to operators; the caller owns the SparkSession, and ``tune_session`` sets six options of it."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .functions.fixed_values import MIN_OBSERVATIONS


@dataclass(frozen=True)
class NetworkConfig:
    """What to prepare: which regions, which snapshot, which walking rules."""

    region_uuids: tuple[str, ...] = ()
    pub_date: str | None = None
    start_date: str | None = None
    end_date: str | None = None
    max_walk_m: float = 500.0
    walk_speed_m_per_min: float = 50.0
    min_transfer_secs: int = 120
    artifact_root: str | None = None
    split_day: str | None = None
    min_observations: int = MIN_OBSERVATIONS
    region_actuals_only: bool = True

    def artifact_path(self) -> str:
        """Folder of the prepared tables; every setting that changes them is in the name.

        Without ``pub_date`` the name can't tell one publication from the next: take the configuration from
        ``snapshots.with_resolved_date`` where new ones may appear.
        """
        if not self.artifact_root:
            raise ValueError("artifact_root is not set")
        parts = (sorted(self.region_uuids), self.pub_date, self.start_date, self.end_date,
                 float(self.max_walk_m), float(self.walk_speed_m_per_min), self.split_day, self.min_observations,
                 self.region_actuals_only)
        tag = hashlib.sha256(repr(parts).encode()).hexdigest()[:16]
        return f"{self.artifact_root.rstrip('/')}/prepared-{tag}"


def shared_folder(spark: SparkSession) -> str:
    """The reliable folder named by spark.checkpoint.dir; a local session may use its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile

    folder = tempfile.mkdtemp(prefix="headway-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder so that later steps neither replan nor recompute it."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def tune_session(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators are measured with; none of them changes a result.

    Generated methods above 8,000 bytes are never compiled by the JVM's optimiser, so stages that outgrow it run
    faster with one generated class per operator. Skewed join partitions are split by adaptive execution.

    Shuffles start with many small partitions, which adaptive execution puts together to its advisory size. A task then
    sorts so many bytes and no share of the input; with few partitions its memory would grow with the tables.
    """
    for key, value in {
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1024",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
        "spark.sql.session.timeZone": "UTC",
    }.items():
        spark.conf.set(key, value)
    return spark
