"""Secret scans: fixed patterns, and windows of high Shannon entropy inside candidate strings.

A candidate is a run of one character class (hex digits, the base64 alphabet, small letters and digits, capitals and
digits) of 20 characters or more; it may be a candidate of several classes. A window of 20 characters slides over it; its
entropy is kept up by the change that the entering and the leaving character make to sum(c * log2(c)), where c is how
often a character stands in the window. The counts are window functions per character and the entropy is a running sum,
in whole 10^-9 bits, so the order of additions doesn't matter. Neighbouring windows above the class's threshold make one
span of the kind of that class.

What is suppressed: windows that share a character with a string of the allow list (the rest of the run stays), and the
class of hex digits for runs of digits only, whose random windows reach its threshold; such numbers are still candidates
of the wider classes. Nothing else is left out: letters only, or one case only, count as any other run.

Defined results: null or empty text has no spans. Rows that share an id are scanned each by its own text; equal rows
stay as many as they were. Very long texts are scanned whole. An empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import repeated, text_mark

SLIDE = 20
UNIT = 10**9

# The patterns of the kinds, in their order. The group is what must be long enough; the least lengths.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]{32,})"
RUN_HEX = r"([0-9A-Fa-f]{20,})"
RUN_BASE64 = r"([A-Za-z0-9+/_-]{20,})"
RUN_BASE36 = r"([0-9a-z]{20,})"
RUN_BASE32 = r"([0-9A-Z]{20,})"
CLASSES = {"entropy_hex": RUN_HEX, "entropy_base64": RUN_BASE64, "entropy_base36": RUN_BASE36, "entropy_base32": RUN_BASE32}
KINDS = ("assign", "access", "hex", *CLASSES)
# Bits a character that a window must reach: of 4.0 possible for hex and 4.32 in 20 characters of the others. Random keys of
# 32 characters have such a window in about 98 of 100 cases; words of one case seldom do.
THRESHOLDS = {"entropy_hex": 3.0, "entropy_base64": 3.9, "entropy_base36": 3.65, "entropy_base32": 3.6}
# Strings of public documentation and plain alphabets; a window that touches one is no secret.
ALLOWED = ("EXAMPLE", "example", "0123456789", "abcdefghijkl", "ABCDEFGHIJKL", "00000000", "ffffffff")


def _matches(kind: str, text: Column, pattern: str, group: int, least: int, maybe: Column) -> Column:
    """(kind, gap before the match, its length, long enough, its text for candidates), in the order of the text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    run = found if kind.startswith("entropy") else F.transform(found, lambda m: F.lit(None).cast("string"))
    parts = F.arrays_zip(found.alias("found"), value.alias("value"), run.alias("run"), F.slice(F.split(text, pattern, -1), 1, F.size(found)).alias("gap"))
    return F.when(maybe, F.transform(parts, lambda m, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("nth"), F.char_length(m["gap"]).alias("gap"), F.char_length(m["found"]).alias("length"),
        (F.char_length(m["value"]) >= least).alias("kept"), m["run"].alias("run"))))


def _scaled(c: Column) -> Column:
    """c * log2(c) in whole units; 0 for 0 and 1."""
    return F.when(c <= 1, F.lit(0)).otherwise(F.round(c * F.log2(c) * UNIT)).cast("long")


def _without_listed(run: Column, allowed: tuple[str, ...]) -> Column:
    """The run with a * for each character that is part of a listed string, overlapping ones included."""
    each = "|".join(f"(?<={w[:k]}){w[k]}(?={w[k + 1:]})" for w in map(re.escape, allowed) for k in range(len(w)))
    holds = F.lit(False)
    for word in allowed:
        holds = holds | run.contains(word)
    return F.when(holds, F.regexp_replace(run, each, "*")).otherwise(run) if allowed else run


def with_entropy_spans(rows: DataFrame, keys: list[str], slide: int = SLIDE, thresholds: dict[str, float] = THRESHOLDS) -> DataFrame:
    """(keys, kind, copies, start, length): for a row with a run its joined windows above the threshold, others as they are.

    ``rows`` has keys, kind, start, length, copies and run (the string, * for suppressed characters; null for no candidate).
    Rows of both sorts go the same way, so what makes them is computed once.
    """
    each = [*keys, "kind", "start"]
    chars = rows.select(*each, "length", "copies", F.col("run").isNull().alias("fixed"),
                        F.posexplode(F.when(F.col("run").isNull(), F.array(F.lit("*"))).otherwise(F.split("run", ""))).alias("at", "ch")).where("ch <> ''")
    per_char = Window.partitionBy(*each, "ch").orderBy("at")
    entering = F.count("*").over(per_char.rangeBetween(-(slide - 1), 0))
    leaving = F.count("*").over(per_char.rangeBetween(0, slide - 1))
    changed = chars.withColumns({"c_in": entering, "c_out": leaving})
    changed = changed.withColumns({"gain": _scaled(F.col("c_in")) - _scaled(F.col("c_in") - 1), "loss": _scaled(F.col("c_out")) - _scaled(F.col("c_out") - 1)})
    along = Window.partitionBy(*each).orderBy("at")
    total = F.sum("gain").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.coalesce(
        F.sum("loss").over(along.rowsBetween(Window.unboundedPreceding, -slide)), F.lit(0))
    entropy = F.log2(F.lit(float(slide))) - total / (F.lit(float(slide)) * UNIT)
    listed = F.sum((F.col("ch") == "*").cast("int")).over(along.rowsBetween(-(slide - 1), 0))
    limit = F.element_at(F.create_map(*(F.lit(x) for pair in thresholds.items() for x in pair)), F.col("kind"))
    high = changed.withColumns({"entropy": entropy, "listed": listed}).where(
        F.col("fixed") | (F.col("at") >= slide - 1) & (F.col("listed") == 0) & (F.col("entropy") >= limit))
    # The end of a window is ``at``; windows that touch make one span.
    apart = (F.col("at") - F.lag("at").over(along) > slide).cast("int")
    grouped = high.withColumn("apart", F.coalesce(apart, F.lit(0))).withColumn("island", F.sum("apart").over(along))
    spans = grouped.groupBy(*each, "island").agg(F.min("at").alias("lo"), F.max("at").alias("hi"), *(F.first(c).alias(c) for c in ("length", "copies", "fixed")))
    return spans.select(*keys, "kind", "copies", (F.col("start") + F.when(F.col("fixed"), 0).otherwise(F.col("lo") - (slide - 1))).alias("start"),
                        F.when(F.col("fixed"), F.col("length")).otherwise(F.col("hi") - F.col("lo") + slide).alias("length"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slide: int = SLIDE,
                 thresholds: dict[str, float] = THRESHOLDS, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """One row per document: id and spans (start, kind_no, kind, end) in code points, end exclusive, in order."""
    text = F.col("text")
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), text_mark(F.col(text_col)).alias("mark"))
    itself = F.array(F.struct(F.lit("").alias("kind"), F.lit(0).alias("nth"), F.lit(0).alias("gap"), F.lit(0).alias("length"),
                              F.lit(False).alias("kept"), F.lit(None).cast("string").alias("run")))
    none = F.slice(itself, 1, 0)
    found = F.concat(itself, *(F.coalesce(m, none) for m in (
        _matches("assign", text, ASSIGN, 2, 8, text.rlike(ASSIGN)),
        _matches("access", text, ACCESS, 1, 16, text.contains("AKIA")),
        _matches("hex", text, HEX, 1, 32, text.rlike(HEX)),
        *(_matches(kind, text, pattern, 1, slide, text.rlike(RUN_BASE64) & text.rlike(pattern)) for kind, pattern in CLASSES.items()))))
    rows = own.select("id", "mark", F.inline(found)).repartition("id", "mark")
    # Equal rows give equal matches: they are counted and handled once.
    once = rows.groupBy("id", "mark", "kind", "nth").agg(F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("gap", "length", "kept", "run")))
    order = Window.partitionBy("id", "mark", "kind").orderBy("nth")
    placed = once.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(order)).withColumn("start", F.col("end") - F.col("length"))
    is_run = F.col("kind").startswith("entropy")
    number_only = (F.col("kind") == "entropy_hex") & ~F.col("run").rlike("[A-Fa-f]")
    wanted = placed.where(F.when(is_run, ~number_only).otherwise(F.col("kept") | (F.col("kind") == "")))
    every = with_entropy_spans(wanted.withColumn("run", _without_listed(F.col("run"), allowed)), ["id", "mark"], slide, thresholds)
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct(F.col("start").cast("long").alias("start"), number.alias("kind_no"), "kind", (F.col("start") + F.col("length")).cast("long").alias("end"))
    per_doc = every.groupBy("id", "mark").agg(F.max(F.when(F.col("kind") == "", F.col("copies"))).alias("copies"),
                                              F.array_sort(F.collect_list(F.when(F.col("kind") != "", span))).alias("spans"))
    return repeated(per_doc, "copies").select(F.col("id").alias(id_col), "spans")
