"""Line dedup over levelled sorted runs of line hashes.

Batches of documents come one after the other. A batch groups its line keys, loses those that an earlier run holds (a
merge anti-join per run, bucketed and sorted on the hash so that runs are not shuffled again), and what is left becomes
a run of level 0. Two runs of a level are merged into one of the next when another batch comes, so n batches leave about
log2(n) runs. A key's run row names the document that keeps the line; every other document loses it.

A line is told by 128 bits of hash of its key. The verdicts join on hash and document together, so a line that a third
of all documents hold is spread like any other.

Defined results: null or empty text is one empty line. Keys shorter than ``min_chars`` code points are left alone. Rows
without an id count as one document after all others. Rows that share an id are one document for counting; each is cut
by its own text, and equal rows stay as many as they were. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import shared_folder
from .shared import BLANKS, lower_ascii, stored, text_mark

MIN_CHARS = 10
BATCHES = 4
KEYS = ["h1", "h2"]
NO_ID = 2**63 - 1


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, mark, place, h1, h2) of every line whose key is long enough."""
    lines = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), text_mark(F.col(text_col)).alias("mark"),
                        F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).alias("place", "line"))
    keys = lines.select("doc", "mark", "place", lower_ascii(F.btrim("line", F.lit(BLANKS))).alias("key")).where(F.char_length("key") >= min_chars)
    return keys.select("doc", "mark", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))


class LineRuns:
    """The sorted runs so far, by level."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_folder(spark).rstrip('/')}/line-runs-{uuid.uuid4().hex}"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, keys: DataFrame) -> DataFrame:
        """Lines of the batch that go: (doc, mark, place)."""
        self._compact()
        fresh = keys.groupBy(*KEYS).agg(F.min("doc").alias("keeper"))
        for run in self.runs():
            fresh = fresh.join(run.hint("merge"), KEYS, "left_anti")
        run = self._write(fresh)
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(run)
        keepers = run.withColumnRenamed("keeper", "doc")
        return keys.join(keepers, [*KEYS, "doc"], "left_anti").select("doc", "mark", "place")

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= 2:
                merged = self.levels[level][0]
                for run in self.levels[level][1:]:
                    merged = merged.unionByName(run)
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._write(merged.repartition(self.buckets, *KEYS)))
                self.levels[level] = []
            level += 1

    def _write(self, rows: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.write.format("parquet").bucketBy(self.buckets, *KEYS).sortBy(*KEYS).option("path", f"{self.root}/{name}")
         .saveAsTable(name))
        return self.spark.table(name)


def find_repeated_lines(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """(doc, mark, place) of the lines to drop; documents come in ascending ids, in ``batches`` ranges of about equal size."""
    spark = docs.sparkSession
    cuts = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), [k / batches for k in range(1, batches)], 1000)).first()[0] or []
    cuts = sorted(set(cuts))
    keys, runs = stored(line_keys(docs, min_chars, id_col, text_col), "line-keys"), LineRuns(spark)
    gone = None
    for low, high in zip([None, *cuts], [*cuts, None]):
        batch = keys
        if low is not None:
            batch = batch.where(F.col("doc") > low)
        if high is not None:
            batch = batch.where(F.col("doc") <= high)
        dropped = runs.add(batch)
        gone = dropped if gone is None else gone.unionByName(dropped)
    return gone


def dedup_lines(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with the text that is left, n_lines before and n_dropped; all other columns stay, but for those of these names."""
    gone = find_repeated_lines(docs, batches, min_chars, id_col, text_col)
    per_doc = gone.groupBy("doc", "mark").agg(F.collect_set("place").alias("__gone_places")).withColumnsRenamed({"doc": "__gone_doc", "mark": "__gone_mark"})
    cut = docs.select(*(c for c in docs.columns if c != text_col), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("__own_doc"),
                      text_mark(F.col(text_col)).alias("__own_mark"), F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1).alias("__own_lines"))
    both = cut.join(per_doc, (F.col("__own_doc") == F.col("__gone_doc")) & (F.col("__own_mark") == F.col("__gone_mark")), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("__own_lines") - 1), F.col("__gone_places"))
    text = F.when(F.col("__gone_places").isNull(), F.array_join("__own_lines", "\n")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("__own_lines", i)), "\n"))
    result = both.withColumns({text_col: text, "n_lines": F.size("__own_lines").cast("long"),
                               "n_dropped": F.when(F.col("__gone_places").isNull(), 0).otherwise(F.size("__gone_places")).cast("long")})
    return result.select(*(c for c in docs.columns if c not in ("n_lines", "n_dropped")), "n_lines", "n_dropped")
