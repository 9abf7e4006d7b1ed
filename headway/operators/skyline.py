"""Undominated labels: later time, higher confidence, fewer boardings, less walking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def undominated(labels: DataFrame, keys: Sequence[str] = ("query_id", "stop_id"), max_boardings: int | None = None,
                class_column: str | None = None, older: DataFrame | None = None) -> DataFrame:
    """The Pareto set of ``labels`` per key in (t up, conf up, boardings down, walk_m down); of equals the first trail.

    Sorted by time, a label is dominated if an earlier row has at least its confidence and no more walking and
    boardings. "No more walking" is answered by binary digits: rows whose walking ranks share all higher digits meet in
    one window, those with digit 0 as possible winners and those with digit 1 as possible losers. So the work is
    n log n sorted rows; no two labels are ever paired.

    ``max_boardings``: the largest count that occurs, if counts differ; without it every new label must have the same
    count and ``older`` labels (which only dominate) a smaller one. ``class_column``: a label with a class is only
    dominated by its own class, a label without one by any.
    """
    columns = labels.columns
    rows = labels.withColumn("_new", F.lit(True))
    if older is not None:
        rows = rows.unionByName(older.select(*columns).withColumn("_new", F.lit(False)))
    best_first = Window.partitionBy(*keys).orderBy(F.desc("t"), F.desc("conf"), "boardings", "walk_m", "trail")
    rows = rows.withColumn("_pos", F.row_number().over(best_first))
    if max_boardings is None:
        # Most losers lose to a label without walking: drop those before the finer comparison.
        no_walk = F.max(F.when(F.col("walk_m") == 0, F.col("conf"))).over(
            best_first.rowsBetween(Window.unboundedPreceding, -1))
        any_class = F.col(class_column).isNull() if class_column else F.lit(True)
        beaten = F.coalesce(no_walk >= F.col("conf"), F.lit(False)) & any_class & F.col("_new")
        rows = rows.withColumn("_lost", beaten).where(~F.col("_lost")).drop("_lost")
    rows = rows.withColumn("_rank", F.dense_rank().over(Window.partitionBy(*keys).orderBy("walk_m")) - 1)
    rows = rows.withColumn("_top", F.max("_rank").over(Window.partitionBy(*keys)))
    digits = F.length(F.bin(F.col("_top")))
    rank = F.col("_rank")
    same = F.array(F.struct(F.lit(-1).alias("digit"), rank.alias("node"), F.lit(True).alias("wins"), F.lit(True).alias("loses")))

    def at(digit):
        shifted = F.call_function("shiftright", rank, digit)
        zero = shifted % 2 == 0
        return F.struct(digit.alias("digit"), F.floor(shifted / 2).cast("int").alias("node"), zero.alias("wins"),
                        (~zero).alias("loses"))

    meetings = F.when(F.col("_top") == 0, same).otherwise(
        F.concat(same, F.transform(F.sequence(F.lit(0), digits - 1), at)))
    # What only the result needs rides on one of a label's copies, and on none of an older label.
    payload = [c for c in columns if c not in keys]
    needed = [*keys, "_pos", "_new", "conf", "boardings"]
    rows = rows.withColumn("_payload", F.when(F.col("_new"), F.struct(*payload)))
    if class_column:
        own = F.struct(F.coalesce(F.col(class_column), F.lit("")).alias("group"), F.lit(True).alias("asks"))
        shared = F.struct(F.lit("").alias("group"), F.lit(False).alias("asks"))
        groups = F.when(F.col(class_column).isNull(), F.array(own)).otherwise(F.array(own, shared))
    else:
        groups = F.array(F.struct(F.lit("").alias("group"), F.lit(True).alias("asks")))
    rows = rows.select(*needed, "_payload", F.explode(meetings).alias("_m"), groups.alias("_gs"))
    rows = rows.select(*needed, "_payload", "_m.*", F.explode("_gs").alias("_g")).select(
        *needed, "_payload", "digit", "node", "wins", "loses", "_g.*")
    # A copy that neither asks nor can win is of no use to anyone.
    rows = rows.where(F.col("asks") | F.col("wins")).withColumn(
        "_payload", F.when((F.col("digit") == -1) & F.col("asks"), F.col("_payload")))
    before = Window.partitionBy(*keys, "group", "digit", "node").orderBy("_pos").rowsBetween(
        Window.unboundedPreceding, -1)
    if max_boardings is None:
        best = F.max(F.when(F.col("wins"), F.col("conf"))).over(before)
    else:
        per_count = [F.max(F.when(F.col("wins") & (F.col("boardings") <= b), F.col("conf"))).over(before)
                     for b in range(max_boardings + 1)]
        best = F.get(F.array(*per_count), F.col("boardings"))
    beaten = F.col("asks") & F.col("loses") & F.coalesce(best >= F.col("conf"), F.lit(False))
    kept = rows.withColumn("_beaten", beaten).where(F.col("_new") & F.col("asks")).groupBy(*keys, "_pos").agg(
        F.max("_beaten").alias("_beaten"), F.first("_payload", ignorenulls=True).alias("_row"))
    return kept.where(~F.col("_beaten")).select(*keys, "_row.*").select(*columns)
