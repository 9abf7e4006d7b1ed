"""Native word expressions and table helpers that several operators use."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import shared_folder

# What separates words in lower-cased text, and the white space that ends a word or pads a line.
WORD_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other letter stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def plain_words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and non-ASCII characters; null text has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), WORD_BREAKS, -1), "")


def text_mark(text: Column) -> Column:
    """Tells rows apart that share an id but not a text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def with_window_hashes(df: DataFrame, words: str, lengths: tuple[int, ...]) -> DataFrame:
    """Adds ``w<n>`` for each length: the hash of the n words from each position on.

    A length is put together from powers of two, so a window of ten words costs five hashes of two numbers and not
    one of ten strings.
    """
    have = {1}
    df = df.withColumn("w1", F.transform(words, lambda w: F.xxhash64(w)))

    def add(frame: DataFrame, a: int, b: int) -> DataFrame:
        n = F.greatest(F.size("w1") - (a + b - 1), F.lit(0))
        return frame.withColumn(f"w{a + b}", F.zip_with(F.slice(f"w{a}", F.lit(1), n), F.slice(f"w{b}", F.lit(a + 1), n),
                                                        lambda x, y: F.xxhash64(x, y)))

    for n in sorted(set(lengths)):
        done = 0
        for bit in (8, 4, 2, 1):
            if n - done >= bit:
                for half in (1, 2, 4):
                    if half * 2 <= bit and half * 2 not in have:
                        df, have = add(df, half, half), have | {half * 2}
                while n - done >= bit:
                    if done and done + bit not in have:
                        df, have = add(df, done, bit), have | {done + bit}
                    done += bit
    return df


# Bytes and rows of the batches that go to Python workers: with long texts the session's defaults take much of an executor.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 2_000


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after the session's limits on Arrow batches are set to these."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: later steps neither recompute it nor lose it with an executor."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def repeated(df: DataFrame, copies: str) -> DataFrame:
    """Each row as many times as ``copies`` says; the column goes."""
    return df.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).drop(copies)
