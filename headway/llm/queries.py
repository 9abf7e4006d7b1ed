"""The registered queries of this subpackage and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, html_text, jaccard_join, language_id, licenses, line_dedup, periodic_runs, quality_classifier, quality_rules,
               secret_scan, sentencepiece_dropout, token_alignment, url_filters)
from .shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build
    return keep


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@query("op1_sentencepiece_dropout")
def sentencepiece_dropout_query(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of every document, and whether they decode to the document."""
    vocabulary = sentencepiece_dropout.read_vocabulary()
    docs = table(spark, folder, "documents").select("doc_id", "text")
    made = sentencepiece_dropout.encode(docs, vocabulary, check_col="lossless")
    return made.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.char_length("text").cast("long").alias("n_chars"), "lossless", "ids")


# SQL blocks: the words of documents and benchmark items, and a hit for every window found.
OP2_SQL = r"""
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents),
items AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS win
  FROM (SELECT item_id, words, unnest(generate_series(1, len(words) - least(len(words), 10) + 1)) AS i FROM items WHERE len(words) > 0) s),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i FROM docs, lengths WHERE len(words) >= n) s),
hits AS (SELECT d.doc_id, d.i, d.n, w.item_id FROM doc_windows d JOIN item_windows w ON w.n = d.n AND w.win = d.win),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) s GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
          FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(p.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN places p USING (doc_id) LEFT JOIN found f USING (doc_id)"""


@query("op2_decontamination", OP2_SQL)
def decontamination_query(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark words in every document."""
    found = decontaminate.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        sha256(F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


OP3_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
dup AS (
  SELECT doc_id, CAST(sum(n - 1) AS BIGINT) AS n_dup_lines
  FROM (SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs) s
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line) t GROUP BY doc_id),
wins AS (
  SELECT doc_id, i, words[i:i + 2] AS win FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS i FROM docs WHERE len(words) >= 3) s),
twice AS (SELECT doc_id, unnest(list(i)) AS i FROM wins GROUP BY doc_id, win HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) s GROUP BY doc_id),
base AS (
  SELECT d.doc_id, d.text, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM docs d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (100 * n_symbols > 30 * n_words) AND NOT (word_chars < 2 * n_words OR word_chars > 20 * n_words)
       AND NOT (100 * n_dup_lines > 50 * n_words) AND NOT (10 * ((length(text) - length(replace(text, '!!', ''))) // 2) > 3 * n_words)
       AND NOT (100 * length(regexp_replace(text, '[^0-9]', '', 'g')) > 50 * word_chars) AS kept
FROM judged"""


@query("op3_quality_rules", OP3_SQL)
def quality_rules_query(spark: SparkSession, folder: str) -> DataFrame:
    """Base figures and the cascade's verdict for every document."""
    return quality_rules.judge_quality(table(spark, folder, "documents"))


@query("op4_quality_classifier")
def quality_classifier_query(spark: SparkSession, folder: str) -> DataFrame:
    """Importance weight, sampling key and verdict for every document."""
    judged = quality_classifier.resample(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", "n_grams", "weight", "key", "kept")


@query("op5_html_extraction")
def html_extraction_query(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract_text(table(spark, folder, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


@query("op6_url_filters")
def url_filters_query(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return url_filters.judge_urls(table(spark, folder, "pages"))


OP7_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, lines[i] AS line, translate(trim(lines[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents) d) s),
keys AS (SELECT key, min(doc_id) AS keeper FROM lines WHERE length(key) >= 10 GROUP BY key),
judged AS (SELECT l.doc_id, l.i, l.line, k.keeper IS NOT NULL AND k.keeper <> l.doc_id AS gone
           FROM lines l LEFT JOIN keys k ON k.key = l.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


@query("op7_line_dedup", OP7_SQL)
def line_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    """What line dedup leaves of every document."""
    left = line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped", sha256(F.col("text")).alias("kept_sha256"))


OP8_SQL = r"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + least(len(words), 4) - 1], ' ') AS s
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - least(len(words), 4) + 1)) AS i FROM docs WHERE len(words) > 0) t),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)"""


@query("op8_jaccard_join", OP8_SQL)
def jaccard_join_query(spark: SparkSession, folder: str) -> DataFrame:
    """Component of near copies of every document."""
    return jaccard_join.jaccard_components(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(repr(x) for x in row) + ")" for row in rows)


OP9_SQL = r"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents),
phrases AS (SELECT phrase, label, len(string_split(phrase, ' ')) AS n FROM (VALUES {phrases}) p(phrase, label)),
places AS MATERIALIZED (
  SELECT doc_id, i, label FROM (SELECT doc_id, words, phrase, label, n, unnest(generate_series(0, len(words) - n)) AS i FROM docs, phrases WHERE len(words) >= n) s
  WHERE words[i + 1] = split_part(phrase, ' ', 1) AND array_to_string(words[i + 1:i + n], ' ') = phrase),
templates AS (SELECT template, label, string_split(text, ' ') AS w FROM (VALUES {templates}) t(template, text, label)),
template_grams AS (SELECT template, label, len(w) AS m, j AS loc, array_to_string(w[j + 1:j + 3], ' ') AS gram
                   FROM (SELECT *, unnest(generate_series(0, len(w) - 3)) AS j FROM templates) s),
doc_grams AS (SELECT doc_id, i, array_to_string(words[i + 1:i + 3], ' ') AS gram
              FROM (SELECT doc_id, words, unnest(generate_series(0, len(words) - 3)) AS i FROM docs WHERE len(words) >= 3) s),
votes AS MATERIALIZED (SELECT doc_id, template, label, m, loc, i - loc AS diagonal FROM doc_grams JOIN template_grams USING (gram)),
bands AS (
  SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS band
  FROM (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {neighbour} THEN 1 ELSE 0 END AS apart
        FROM (SELECT DISTINCT doc_id, template, diagonal FROM votes) d) e),
spans AS MATERIALIZED (
  SELECT doc_id, label, count(DISTINCT p) / m AS cover
  FROM (SELECT doc_id, template, band, label, m, unnest([loc, loc + 1, loc + 2]) AS p FROM votes JOIN bands USING (doc_id, template, diagonal)) s
  GROUP BY doc_id, template, band, label, m HAVING count(DISTINCT p) / m >= {cover}),
base AS (SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY doc_id),
every AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
          FROM (SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM spans) u GROUP BY doc_id),
best AS (SELECT doc_id, max(cover) AS cover FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base, CAST(b.lo AS BIGINT) AS first_word,
       CAST(b.hi AS BIGINT) AS last_word, coalesce(b.labels, '') AS base_labels, coalesce(e.labels, '') AS labels, coalesce(s.cover, 0e0) AS score
FROM docs d LEFT JOIN base b USING (doc_id) LEFT JOIN every e USING (doc_id) LEFT JOIN best s USING (doc_id)""".replace(
    "{phrases}", _values(list(licenses.PHRASES.items()))).replace(
    "{templates}", _values([(i, text, label) for i, (text, label) in enumerate(licenses.TEMPLATES)])).replace(
    "{neighbour}", str(licenses.NEIGHBOUR)).replace("{cover}", f"{licenses.MIN_COVER}e0")


@query("op9_license_scan", OP9_SQL)
def license_scan_query(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and template spans of every document."""
    found = licenses.scan_licenses(table(spark, folder, "documents"))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    base, own = F.col("places.label"), F.col("spans.label")
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places.at").alias("first_word"),
                        F.array_max("places.at").alias("last_word"), joined(base).alias("base_labels"), joined(F.array_union(base, own)).alias("labels"),
                        F.coalesce(F.array_max("spans.cover"), F.lit(0.0)).alias("score"))


def _kind_sql(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    pattern = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {number} AS kind_no, '{kind}' AS kind, n, length(gaps[n]) AS gap, length(found[n]) AS size, length(vals[n]) >= {least} AS kept, found[n] AS run
  FROM (SELECT doc_id, found, vals, gaps, unnest(generate_series(1, len(found))) AS n
        FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS found, regexp_extract_all(text, '{pattern}', {group}) AS vals,
                     string_split_regex(text, '{pattern}') AS gaps FROM docs) a) b"""


# The same pattern with both cases written out: case folding of engines differs outside of ASCII.
_ASSIGN_SQL = secret_scan.ASSIGN.replace("(?i:password|passwd|secret|token|api_?key)", "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token", "api_?key")))
_SCALED = "CASE WHEN {0} <= 1 THEN 0 ELSE CAST(round({0} * log2({0}) * 1e9) AS BIGINT) END"
OP10_SQL = f"""
WITH docs AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS text FROM documents),
matches AS MATERIALIZED ({" UNION ALL ".join((
    _kind_sql(1, "assign", _ASSIGN_SQL, 2, 8), _kind_sql(2, "access", secret_scan.ACCESS, 1, 16), _kind_sql(3, "hex", secret_scan.HEX, 1, 32),
    *(_kind_sql(4 + i, kind, pattern, 1, secret_scan.SLIDE) for i, (kind, pattern) in enumerate(secret_scan.CLASSES.items()))))}),
placed AS MATERIALIZED (
  SELECT *, CAST(stop_at - size AS BIGINT) AS start FROM (
    SELECT *, CAST(sum(gap + size) OVER (PARTITION BY doc_id, kind_no ORDER BY n) AS BIGINT) AS stop_at FROM matches) m),
runs AS (
  SELECT doc_id, kind_no, kind, start, run FROM placed
  WHERE kind_no >= 4 AND (kind_no > 4 OR regexp_matches(run, '[A-Fa-f]'))),
chars AS (SELECT doc_id, kind_no, kind, start, loc, substr(run, loc + 1, 1) AS ch, {", ".join(
    f"CAST(substr(run, loc + 1, {len(word)}) = '{word}' AS INT) AS begins_{i}" for i, word in enumerate(secret_scan.ALLOWED))}
          FROM (SELECT *, unnest(generate_series(0, length(run) - 1)) AS loc FROM runs) r),
counted AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, kind_no, start, ch ORDER BY loc RANGE BETWEEN {secret_scan.SLIDE - 1} PRECEDING AND CURRENT ROW) AS c_in,
         count(*) OVER (PARTITION BY doc_id, kind_no, start, ch ORDER BY loc RANGE BETWEEN CURRENT ROW AND {secret_scan.SLIDE - 1} FOLLOWING) AS c_out
  FROM chars),
changed AS (SELECT *, {_SCALED.format("c_in")} - {_SCALED.format("(c_in - 1)")} AS gain, {_SCALED.format("c_out")} - {_SCALED.format("(c_out - 1)")} AS loss FROM counted),
summed AS (
  SELECT *, sum(gain) OVER (PARTITION BY doc_id, kind_no, start ORDER BY loc)
         - coalesce(sum(loss) OVER (PARTITION BY doc_id, kind_no, start ORDER BY loc ROWS BETWEEN UNBOUNDED PRECEDING AND {secret_scan.SLIDE} PRECEDING), 0) AS total,
         greatest({", ".join(f"max(begins_{i}) OVER (PARTITION BY doc_id, kind_no, start ORDER BY loc ROWS BETWEEN "
                             f"{secret_scan.SLIDE + len(word) - 2} PRECEDING AND CURRENT ROW)" for i, word in enumerate(secret_scan.ALLOWED))}) AS listed
  FROM changed),
high AS (
  SELECT doc_id, kind_no, kind, start, loc FROM summed
  WHERE loc >= {secret_scan.SLIDE - 1} AND listed = 0 AND log2({secret_scan.SLIDE}e0) - CAST(total AS DOUBLE) / {secret_scan.SLIDE}e9
        >= CASE kind {" ".join(f"WHEN '{kind}' THEN {bits}e0" for kind, bits in secret_scan.THRESHOLDS.items())} END),
islands AS (
  SELECT *, sum(apart) OVER (PARTITION BY doc_id, kind_no, start ORDER BY loc) AS island
  FROM (SELECT *, CASE WHEN loc - lag(loc) OVER (PARTITION BY doc_id, kind_no, start ORDER BY loc) > {secret_scan.SLIDE} THEN 1 ELSE 0 END AS apart FROM high) h),
spans AS MATERIALIZED (
  SELECT doc_id, kind_no, kind, start, stop_at FROM placed WHERE kind_no <= 3 AND kept
  UNION ALL SELECT doc_id, kind_no, kind, start + min(loc) - {secret_scan.SLIDE - 1}, start + max(loc) + 1 FROM islands GROUP BY doc_id, kind_no, kind, start, island),
listed AS (
  SELECT doc_id, count(*) FILTER (kind_no = 1) AS n_assign, count(*) FILTER (kind_no = 2) AS n_access, count(*) FILTER (kind_no = 3) AS n_hex,
         string_agg(kind || ':' || start || ':' || stop_at, ',' ORDER BY start, kind_no) FILTER (kind_no <= 3) AS base,
         string_agg(kind || ':' || start || ':' || stop_at, ',' ORDER BY start, kind_no) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN listed l USING (doc_id)"""


@query("op10_secret_scan", OP10_SQL)
def secret_scan_query(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document."""
    found = secret_scan.scan_secrets(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind_no"] <= 3)

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select("doc_id", number("assign"), number("access"), number("hex"), sha256(joined(base)).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query("op11_token_alignment")
def token_alignment_query(spark: SparkSession, folder: str) -> DataFrame:
    """How the tokens of a byte-level and a piece model cover every document."""
    made = token_alignment.align(table(spark, folder, "documents"), token_alignment.read_tokenizers())
    return made.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                       F.when(F.col("alignment") == "", "").otherwise(sha256(F.col("alignment"))).alias("groups_sha256"))


def id_crc(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


@query("op12_language_id")
def language_id_query(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document by a model of those that are not held out."""
    docs = table(spark, folder, "documents")
    model = language_id.fit(docs.where(id_crc() % 5 != 0))
    asked = docs.select("doc_id", "text", F.coalesce(id_crc() % 5 == 0, F.lit(False)).alias("held_out"))
    return language_id.predict(asked, model).select("doc_id", "held_out", "lang_pred", "score")


def with_planted_period(docs: DataFrame) -> DataFrame:
    """The documents of op13: those that the contract picks by their id have their words repeated with a period from some place on."""
    split = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+", -1), "")
    rows = docs.select("doc_id", "text", id_crc().alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, split))
    rows = rows.withColumns({"n": F.size("words").cast("long"), "g": F.expr("h div 10")}).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    planted = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("words", place(i))), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def periodic_runs_query(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in every document, and what is left without their repeats."""
    found = periodic_runs.collapse_runs(with_planted_period(table(spark, folder, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    rows = found.withColumns({"longest": longest, "lines": F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")})
    return rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"), (-F.col("longest.length")).alias("length"),
                       F.col("longest.period").alias("period"), F.expr("(1000 * -longest.length) div longest.period").alias("exponent_milli"),
                       sha256(F.col("lines")).alias("runs_sha256"), sha256(F.col("collapsed")).alias("collapsed_sha256"))
