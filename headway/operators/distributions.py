"""Delay distributions by level of detail, their lookup, and connection probabilities."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import cut_lineage
from ..functions import fixed_values as fv
from ..functions import probability as pr
from ..functions import scalars as sc

KEYS = ("bpuic", "hour_of_day", "dow_bucket", "line_text", "product_id_clean")

LEVEL_KEYS = {
    "bpuic_hour_dow": ("bpuic", "hour_of_day", "dow_bucket"),
    "bpuic_hour": ("bpuic", "hour_of_day"),
    "bpuic": ("bpuic",),
    "line_hour_dow": ("line_text", "hour_of_day", "dow_bucket"),
    "line": ("line_text",),
    "prod_hour_dow": ("product_id_clean", "hour_of_day", "dow_bucket"),
    "prod": ("product_id_clean",),
    "global": (),
}

# Copies of each row of the few-row levels, so that the many requests for one line or mode meet in many tasks: one for
# so many distinct requests, and so many at least.
REQUESTS_PER_COPY = 100_000
LEAST_COPIES = 16

DIST_COLS = ("n", "mean", "std", *fv.QUANTILE_COLS, "ln_offset", "ln_sigma", "ln_mu")


def value_counts(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """How often each whole-second value occurs per key: combines before the shuffle, so a hot key costs little."""
    return rows.groupBy(*keys, value).agg(F.count("*").alias("n"))


def distribution_by(counts: DataFrame, keys: Sequence[str], value: str, percents: Sequence[int]) -> DataFrame:
    """n, mean, sample standard deviation (0 for one row) and discrete quantiles from value counts."""
    running = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    v, n = F.col(value), F.col("n")
    ranked = counts.withColumns({"upto": F.sum("n").over(running), "total": F.sum("n").over(whole)})
    aggs = [F.sum("n").alias("n"), F.sum(v * n).alias("s1"), F.sum((v * v * n).cast("double")).alias("s2")]
    aggs += [F.min(F.when(F.col("upto") * 100 >= F.col("total") * p, v)).alias(f"q{p:02d}") for p in percents]
    out = ranked.groupBy(*keys).agg(*aggs)
    mean = F.col("s1") / F.col("n")
    spread = F.greatest(F.col("s2") - F.col("s1") * mean, F.lit(0.0)) / F.nullif(F.col("n") - 1, F.lit(0))
    std = F.coalesce(F.sqrt(spread), F.lit(0.0))
    return out.select(*keys, "n", mean.alias("mean"), std.alias("std"), *[f"q{p:02d}" for p in percents])


def with_lognormal_fit(stats: DataFrame) -> DataFrame:
    """Method-of-moments fit of delay + 10 minutes; ``mean`` and ``std`` in minutes."""
    shifted = F.col("mean") + fv.LN_OFFSET
    ratio = F.greatest(1.0 + F.col("std") * F.col("std") / (shifted * shifted), F.lit(fv.MIN_VARIANCE_RATIO))
    variance = F.log(ratio)
    return stats.withColumns({"ln_offset": F.lit(fv.LN_OFFSET), "ln_sigma": F.sqrt(variance),
                              "ln_mu": F.log(shifted) - variance / 2})


def delay_levels(training: DataFrame) -> DataFrame:
    """The distribution tables of all levels in one: ``level``, the five keys (NULL where unused), and statistics.

    Arrivals are counted once per (keys, delay second); the levels are grouping sets over those counts.
    """
    rows = training.withColumn("dow_bucket", sc.dow_bucket(F.col("day_of_week"))).select(*KEYS, "arr_delay_sec")
    counts = value_counts(rows, KEYS, "arr_delay_sec")
    sets = [[F.col(k) for k in LEVEL_KEYS[name]] + [F.col("arr_delay_sec")] for name in fv.LEVELS]
    rolled = counts.groupingSets(sets, *KEYS, "arr_delay_sec").agg(
        F.sum("n").alias("n"), *[F.grouping(k).alias(f"no_{k}") for k in KEYS])

    def is_level(name: str) -> Column:
        used = LEVEL_KEYS[name]
        return reduce(lambda a, b: a & b, [F.col(f"no_{k}") == (0 if k in used else 1) for k in KEYS])

    level = F
    for name in fv.LEVELS:
        level = level.when(is_level(name), name)
    rolled = rolled.select(level.alias("level"), *KEYS, "arr_delay_sec", "n").where(
        ~F.col("level").startswith("line") | F.col("line_text").isNotNull())
    stats = distribution_by(rolled, ("level", *KEYS), "arr_delay_sec", fv.QUANTILE_PERCENTS)
    minutes = {c: F.col(c) / 60.0 for c in ("mean", "std", *fv.QUANTILE_COLS)}
    return with_lognormal_fit(stats.withColumns(minutes))


def trusted_levels(levels: DataFrame, min_observations: int = fv.MIN_OBSERVATIONS) -> DataFrame:
    return levels.where(F.col("n") >= min_observations)


def resolve_distributions(requests: DataFrame, levels: DataFrame) -> DataFrame:
    """Distinct requests (the five keys) with the most specific trusted distribution; none found: NULL level.

    Every request names its candidate keys, one per level; one equi join finds those that exist and the smallest
    level number wins. Rows of the line and mode levels are kept in several copies and requests pick one by hash, so
    that the many requests for one line or mode meet in many tasks.
    """
    asked = cut_lineage(requests.select(*KEYS).distinct())
    n_copies = max(LEAST_COPIES, -(-asked.count() // REQUESTS_PER_COPY))
    key_types = [asked.schema[k].dataType for k in KEYS]
    spread = F.xxhash64(*KEYS)
    salt = F.pmod(spread, F.lit(n_copies))

    def candidate(number: int, name: str) -> Column:
        used = LEVEL_KEYS.get(name, ())
        fields = [F.lit(number).alias("rank"), F.lit(name).alias("level")]
        fields += [(F.col(k) if k in used else F.lit(None).cast(t)).alias(f"k_{k}") for k, t in zip(KEYS, key_types)]
        copy = salt if name.startswith(("line", "prod")) else F.lit(0).cast("long")
        return F.struct(*fields, (spread if name == "none" else copy).alias("salt"))

    def optional(number: int, name: str) -> Column:
        present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in LEVEL_KEYS[name]])
        return F.when(present, candidate(number, name))

    specific = [n for n in fv.LEVELS if n != "global"]
    # The last candidate matches nothing: it keeps the request itself.
    choices = [optional(i, n) for i, n in enumerate(specific)] + [candidate(len(specific), "none")]
    candidates = asked.select(*KEYS, F.explode(F.array_compact(F.array(*choices))).alias("c")).select(*KEYS, "c.*")
    copies = F.when(F.col("level").rlike("^(line|prod)"), F.sequence(F.lit(0), F.lit(n_copies - 1))).otherwise(
        F.array(F.lit(0)))
    known = levels.where(F.col("level") != "global").select(
        F.col("level").alias("d_level"), *[F.col(k).alias(f"d_{k}") for k in KEYS],
        F.struct(*DIST_COLS).alias("dist"), F.explode(copies).alias("d_salt"))
    same = [F.col("level") == F.col("d_level"), F.col("salt") == F.col("d_salt").cast("long")]
    same += [F.col(f"k_{k}").eqNullSafe(F.col(f"d_{k}")) for k in KEYS]
    hit = F.struct("level", "dist")
    best = candidates.join(known, reduce(lambda a, b: a & b, same), "left").groupBy(*KEYS).agg(
        F.min_by(hit, F.when(F.col("dist").isNotNull(), F.col("rank"))).alias("hit"))
    # The global row is one value: a scalar subquery, so that requests without any other level meet no hot key.
    overall = levels.where(F.col("level") == "global").select(
        F.struct("level", F.struct(*DIST_COLS).alias("dist")).alias("hit")).scalar()
    found = best.select(*KEYS, F.coalesce(F.when(F.col("hit.dist").isNotNull(), F.col("hit")), overall).alias("hit"))
    return found.select(*KEYS, F.col("hit.level").alias("source_level"), "hit.dist.*")


def attach_distribution(rows: DataFrame, resolved: DataFrame, prefix: str, keys: dict[str, str]) -> DataFrame:
    """``rows`` with the columns of ``resolved`` renamed by prefix; ``keys`` maps the five keys to columns of rows."""
    right = resolved.select(*[F.col(c).alias(f"{prefix}{c}") for c in resolved.columns])
    on = reduce(lambda a, b: a & b, [F.col(keys[k]).eqNullSafe(F.col(f"{prefix}{k}")) for k in KEYS])
    return rows.join(right, on, "left").drop(*[f"{prefix}{k}" for k in KEYS])


def connection_success(transfers: DataFrame, levels: DataFrame) -> DataFrame:
    """P(catching the connection) for transfers(transfer_id, arr_bpuic, arr_hour, arr_line, arr_product, dep_..., dow_bucket,
    slack_sec)."""
    def names(side: str) -> dict[str, str]:
        return {"bpuic": f"{side}_bpuic", "hour_of_day": f"{side}_hour", "dow_bucket": "dow_bucket",
                "line_text": f"{side}_line", "product_id_clean": f"{side}_product"}

    def asked(side: str) -> DataFrame:
        return transfers.select(*[F.col(c).alias(k) for k, c in names(side).items()])

    resolved = cut_lineage(resolve_distributions(asked("arr").unionByName(asked("dep")), levels))
    both = attach_distribution(transfers, resolved, "a_", names("arr"))
    both = attach_distribution(both, resolved, "d_", names("dep"))
    both = pr.with_p_connection(both, "p_success", F.col("slack_sec"), "a_", "d_")
    return both.select(*transfers.columns, F.col("a_source_level").alias("arr_level"),
                       F.col("d_source_level").alias("dep_level"), "p_success")


def fallback_breakdown(resolved_rows: DataFrame, weight: str | None = None) -> DataFrame:
    """How many rows each level answered, with its share."""
    count = F.sum(weight) if weight else F.count("*")
    per_level = resolved_rows.groupBy("source_level").agg(count.alias("n"))
    # At most nine rows reach this window.
    return per_level.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy())).orderBy(
        F.desc("n"), "source_level")
