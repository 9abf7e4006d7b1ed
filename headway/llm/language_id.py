"""Language identification by hierarchical discrimination: the family first, then the languages of that family.

Texts become weights of hashed byte trigrams (A-Z lower-cased, other ASCII that is no letter taken as a space). A linear
support vector machine for each pair of families votes on the family; one for each pair of languages of the chosen
family votes on the language. So the machines that tell close relatives apart are fitted on these two languages alone.
Votes that tie go to the larger sum of probabilities, then to the smaller name.

Machines are fitted on a sample: about ``per_class`` labelled rows of each side, picked by a hash of the key, so that a
language with a third of all rows costs no more than another. Each machine is one task, with a bounded number of rows;
the objective is the squared hinge with both sides of equal weight. Models are bounded by the number of machines, and
more than ``MAX_LANGUAGES`` languages raise an error rather than being cut.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is everything where nothing was
learned; with one language every other text gets it. Labels that are null are not learned from. Equal texts get equal
results. Texts of any length are taken whole. Columns named like the added ones are replaced, all others stay. An empty
table gives an empty result. The score is the product of the mean probabilities of both steps, from 0 to 1.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import small_batches
from .text_arrays import LOWER, Texts, slices

UNKNOWN = "und"
WIDTH = 1 << 12
PER_CLASS = 1_200
MAX_LANGUAGES = 256
SEED = 17
# Fit of one machine: weight of the norm, steps, and how margins become probabilities.
NORM, STEPS, SLOPE = 1e-4, 200, 4.0

# Families of languages by their two-letter codes. A language that is not here is a family of its own.
FAMILIES = {
    "germanic": ("da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "af", "yi", "fo"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro", "an", "co"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tk", "tt", "ug", "uz"),
    "indic": ("as", "bn", "gu", "hi", "mr", "ne", "or", "pa", "sd", "si", "ur"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "semitic": ("am", "ar", "he", "mt"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "malayic": ("id", "ms", "jv", "su"),
}


def family_of(language: str, families: Mapping[str, tuple[str, ...]] = FAMILIES) -> str:
    for name, members in families.items():
        if language in members:
            return name
    return language


_LETTERS = np.zeros(256, bool)
_LETTERS[128:] = _LETTERS[97:123] = True
_TO = np.where(_LETTERS[LOWER], LOWER, 32).astype(np.uint8)
# Cell of each trigram by a multiplicative hash of its three bytes.
_STEP = np.uint32(0x9E3779B1)
_SHIFT = np.uint32(32 - (WIDTH - 1).bit_length())


def trigram_counts(texts: Texts) -> np.ndarray:
    """How often each cell occurs in each text: one row a text."""
    letters = _TO[texts.bytes].astype(np.uint32)
    if len(letters) < 3:
        return np.zeros((texts.n, WIDTH), np.int64)
    code = letters[:-2] | letters[1:-1] << np.uint32(8) | letters[2:] << np.uint32(16)
    owner = np.repeat(np.arange(texts.n), np.diff(texts.offsets))
    whole = (owner[:-2] == owner[2:]) & (code != 0x202020)
    cell = (code[whole] * _STEP >> _SHIFT).astype(np.int64)
    return np.bincount(owner[:-2][whole] * WIDTH + cell, minlength=texts.n * WIDTH).reshape(texts.n, WIDTH)


def weighted(counts: np.ndarray) -> np.ndarray:
    """Square roots of counts, each row of length one."""
    rows = np.sqrt(counts.astype(np.float32))
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-12)


def fit_machine(rows: np.ndarray, sign: np.ndarray, norm: float = NORM, steps: int = STEPS) -> np.ndarray:
    """Weights and offset of the linear machine with the squared hinge, by accelerated gradient steps from zero.

    ``sign`` is 1 or -1; both sides weigh the same. Rows have length one, so the gradient is 4-Lipschitz beside the norm.
    """
    rows = np.concatenate([rows, np.ones((len(rows), 1), rows.dtype)], axis=1)
    share = np.where(sign > 0, 0.5 / max((sign > 0).sum(), 1), 0.5 / max((sign < 0).sum(), 1)).astype(np.float32)
    rate = np.float32(1 / (4 + norm))
    here = ahead = np.zeros(rows.shape[1], np.float32)
    pace = 1.0
    for _ in range(steps):
        short = np.maximum(0, 1 - sign * (rows @ ahead))
        there = ahead - rate * (norm * ahead - rows.T @ (2 * share * sign * short))
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = there + np.float32((pace - 1) / faster) * (there - here)
        here, pace = there, faster
    return here


@dataclass(frozen=True)
class LanguageModel:
    """Machines by their two sides: of families, and of the languages of each family. The first side is the positive one."""

    members: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    machines: Mapping[tuple[str, str, str], np.ndarray] = field(default_factory=dict)


def _vote(rows: np.ndarray, names: tuple[str, ...], machines: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Winner of each row by pairwise votes, as its place in ``names``, and the mean of its probabilities."""
    n = len(names)
    if n == 1:
        return np.zeros(len(rows), np.int64), np.ones(len(rows))
    votes, sums = np.zeros((len(rows), n)), np.zeros((len(rows), n))
    margins = rows @ np.stack([w[:-1] for w in machines], axis=1) + np.array([w[-1] for w in machines], np.float32)
    for (i, j), margin in zip(combinations(range(n), 2), margins.T.astype(np.float64)):
        p = 1 / (1 + np.exp(-SLOPE * np.clip(margin, -50, 50)))
        votes[:, i] += margin >= 0
        votes[:, j] += margin < 0
        sums[:, i] += p
        sums[:, j] += 1 - p
    won = np.argmax(votes * (n + 1) + sums, axis=1)
    return won, sums[np.arange(len(rows)), won] / (n - 1)


def predict_rows(rows: np.ndarray, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each row of weights."""
    families = tuple(sorted(model.members))
    if not families:
        return np.full(len(rows), UNKNOWN, object), np.zeros(len(rows))
    family, score = _vote(rows, families, [model.machines["", a, b] for a, b in combinations(families, 2)])
    language = np.empty(len(rows), object)
    for k, name in enumerate(families):
        mine = np.flatnonzero(family == k)
        if len(mine):
            inside = model.members[name]
            won, p = _vote(rows[mine], inside, [model.machines[name, a, b] for a, b in combinations(inside, 2)])
            language[mine] = np.array(inside, object)[won]
            score[mine] *= p
    return language, score


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(labelled: DataFrame, key_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_class: int = PER_CLASS,
        families: Mapping[str, tuple[str, ...]] = FAMILIES, seed: int = SEED) -> LanguageModel:
    """A model from the labelled rows, about ``per_class`` of each side of each machine; fewer where there are fewer.

    One pass counts the labels, one makes the weights of the sample; then each machine is fitted in a task of its own.
    """
    labelled = labelled.select(F.col(key_col).alias("key"), F.col(text_col).alias("text"), F.col(label_col).alias("label")).where(F.col("label").isNotNull())
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    members = defaultdict(list)
    for language in sorted(counts):
        members[family_of(language, families)].append(language)
    groups = {name: tuple(inside) for name, inside in members.items()}
    # Machines that each language helps to fit: number of the machine, side, and the share of its rows that go there.
    keys, uses = [], defaultdict(list)
    for a, b in combinations(sorted(groups), 2):
        for side, name in ((1, a), (-1, b)):
            for language in groups[name]:
                uses[language].append((len(keys), side, per_class / len(groups[name]) / counts[language]))
        keys.append(("", a, b))
    for name, inside in groups.items():
        for a, b in combinations(inside, 2):
            for side, language in ((1, a), (-1, b)):
                uses[language].append((len(keys), side, per_class / counts[language]))
            keys.append((name, a, b))
    if not keys:
        return LanguageModel(groups, {})
    draw = (F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 30)) / (1 << 30)).alias("draw")
    plan = F.create_map(*chain_literals({c: F.array(*[F.struct(F.lit(m).alias("machine"), F.lit(s).alias("sign"), F.lit(float(share)).alias("share"))
                                                      for m, s, share in rows]) for c, rows in uses.items()}))
    sample = labelled.select("text", draw, plan[F.col("label")].alias("uses"))
    sample = sample.select("text", F.filter("uses", lambda u: F.col("draw") < u["share"]).alias("uses"))
    sample = sample.where((F.size("uses") > 0) & has_letter(F.col("text")))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            counted = trigram_counts(texts)
            cells, values = [], []
            for row in counted:
                at = np.flatnonzero(row)
                cells.append(at.astype(np.uint16).tobytes())
                values.append(row[at].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([part.column("uses"), pa.array(cells, pa.binary()), pa.array(values, pa.binary())], names=["uses", "cells", "counts"])

    made = small_batches(sample).mapInArrow(features, f"uses {sample.schema['uses'].dataType.simpleString()}, cells binary, counts binary")
    made = made.select(F.explode("uses").alias("u"), "cells", "counts").select("u.machine", "u.sign", "cells", "counts")

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        # In an order that no shuffle changes, so that sums of floats repeat.
        rows = rows.sort_values(["sign", "cells", "counts"], kind="stable")
        dense = np.zeros((len(rows), WIDTH), np.uint32)
        for line, cells, counted in zip(dense, rows["cells"], rows["counts"]):
            line[np.frombuffer(cells, np.uint16)] = np.frombuffer(counted, np.uint32)
        weights = fit_machine(weighted(dense), rows["sign"].to_numpy().astype(np.float32))
        return pd.DataFrame({"machine": [int(rows["machine"].iloc[0])], "weights": [weights.tobytes()]})

    fitted = {r["machine"]: np.frombuffer(r["weights"], np.float32) for r in made.groupBy("machine").applyInPandas(train, "machine int, weights binary").collect()}
    # A machine none of whose rows has a letter decides nothing.
    return LanguageModel(groups, {key: fitted.get(k, np.zeros(WIDTH + 1, np.float32)) for k, key in enumerate(keys)})


def chain_literals(values: Mapping[str, Column]) -> list[Column]:
    return [x for key, value in values.items() for x in (F.lit(key), value)]


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", out_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score; only the text is looked at."""
    added = [out_col, score_col]
    kept = [f for f in docs.schema if f.name not in added]
    flagged = small_batches(docs).select(*(f.name for f in kept), has_letter(F.col(text_col)).alias("_letters"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, text_col):
            language, score = predict_rows(weighted(trigram_counts(texts)), model)
            blank = ~part.column("_letters").to_numpy(zero_copy_only=False).astype(bool)
            language[blank], score[blank] = UNKNOWN, 0.0
            yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), pa.array(language, pa.string()), pa.array(np.clip(score, 0, 1))],
                                             names=[*(f.name for f in kept), *added])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{out_col}` string", f"`{score_col}` double"])
    return flagged.mapInArrow(work, schema)
