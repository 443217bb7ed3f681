"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the distinct hashed character n-grams of its lower-cased form. On labelled
text each feature gets the log ratio of its smoothed shares among toxic and other texts, and a
logistic regression is fitted to features scaled by these ratios. A score is then the sum of one
table entry per distinct n-gram.

Fitting takes a bounded sample: at most `Settings.toxic_rows` and `Settings.other_rows` labelled
rows, those with the smallest hash of their id. Their feature ids are stored in `Settings.parts` parts.
Tasks count them and sum the gradients of a round over their parts; the driver gets one table of
at most 2**bits sums per part, however long the texts are: of a round, those of features that have a
ratio, and what a round sends out goes when it ends. Scoring reads every whole text, in chunks.

Defined cases: a null or empty text has no n-gram and gets the score of the intercept; repeated
rows get equal scores; rows without any label are scored like others; without labelled rows of both
classes every score is 0.5; an empty table gives an empty result; only the id and the text of the
input are used, whatever else it holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.llm.tables import one_text, python_ready
from crewlens.session import stored

CHUNK = 1 << 17


@dataclass(frozen=True)
class Settings:
    sizes: tuple[int, ...] = (3, 4)
    bits: int = 18
    toxic_rows: int = 1500
    other_rows: int = 2500
    smoothing: float = 1.0
    penalty: float = 1.0
    rounds: int = 60
    step: float = 0.1
    parts: int = 6


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of each feature id, ratio and regression weight multiplied
    intercept: float


def _chunk_ids(codes: np.ndarray, settings: Settings) -> np.ndarray:
    shift = np.uint64(64 - settings.bits)
    rolled = np.zeros(len(codes), np.uint64)
    found = []
    for size in range(1, max(settings.sizes) + 1):
        if size > len(codes):
            break
        rolled = rolled[: len(codes) - size + 1] * np.uint64(0x100000001B3) + codes[size - 1:]
        if size in settings.sizes:
            mixed = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
            found.append((mixed >> shift).astype(np.uint32))
    return _distinct(found) if found else np.empty(0, np.uint32)


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    ids = np.sort(np.concatenate(parts))
    first = np.ones(len(ids), bool)
    np.not_equal(ids[1:], ids[:-1], out=first[1:])
    return ids[first]


def feature_ids(text: str | None, settings: Settings) -> np.ndarray:
    """Distinct feature ids of the n-grams of one text; white space counts as one kind of space."""
    if not text:
        return np.empty(0, np.uint32)
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(codes < 33, 32, codes).astype(np.uint64)
    overlap = max(settings.sizes) - 1
    parts = [_chunk_ids(codes[at: at + CHUNK + overlap], settings)
             for at in range(0, max(1, len(codes) - overlap), CHUNK)]
    return parts[0] if len(parts) == 1 else _distinct(parts)


def _summed(features: DataFrame, sums: Callable[[np.ndarray, list[np.ndarray]], np.ndarray], kind: str = "float64") -> np.ndarray:
    """sums(labels, feature ids) of some rows, of this kind, added up over all: in tasks, and over the parts here."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, total = None, None
        for frame in frames:
            if len(frame):
                found = sums(frame["label"].to_numpy(float), [np.frombuffer(b, np.uint32) for b in frame["ids"]])
                part, total = int(frame["part"].iloc[0]), found if total is None else total + found
        if total is not None:
            yield pd.DataFrame({"part": [part], "sums": [total.tobytes()]})

    rows = features.mapInPandas(run, "part int, sums binary").collect()
    # In the order of the parts, so that sums do not depend on which task ends first.
    return sum(np.frombuffer(r["sums"], kind) for r in sorted(rows, key=lambda r: (r["part"], bytes(r["sums"]))))


def fit_features(features: DataFrame, settings: Settings) -> Model:
    """features: part, label, ids, stored. Ratios from document counts, then logistic regression by
    Adam over all rows at once."""
    size = 1 << settings.bits

    def counted(labels: np.ndarray, ids: list[np.ndarray]) -> np.ndarray:
        toxic, other = ([i for i, x in zip(ids, labels, strict=True) if (x == 1) == kind] for kind in (True, False))
        return np.concatenate([*(np.bincount(np.concatenate(some or [np.empty(0, np.uint32)]), minlength=size)
                                 for some in (toxic, other)), [len(toxic), len(other)]]).astype(np.int32)

    counts = _summed(features, counted, "int32")
    if isinstance(counts, int) or not counts[-2:].all():
        return Model(np.zeros(size, np.float32), 0.0)
    counts = counts.astype(float)
    own, other, rows = counts[:size] + settings.smoothing, counts[size: 2 * size] + settings.smoothing, counts[-2:]
    ratio = np.log(own / own.sum()) - np.log(other / other.sum())
    ratio[(own + other) <= 2 * settings.smoothing + 2] = 0  # seen at most twice: no evidence
    seen = own + other - 2 * settings.smoothing
    scale = 1 / np.sqrt(max(1.0, float((seen * ratio**2).sum() / rows.sum())))
    # Only features with a ratio have a weight; no others travel.
    live, used = np.flatnonzero(ratio).astype(np.uint32), int((seen > 0).sum())
    values, sc = (ratio * scale)[live], features.sparkSession.sparkContext
    places = sc.broadcast(live)

    def errors(told: Broadcast) -> Callable:
        def summed(labels: np.ndarray, ids: list[np.ndarray]) -> np.ndarray:
            table, (weights, intercept) = np.zeros(size, np.float32), told.value
            table[places.value] = weights
            margin = np.array([table[i].sum(dtype=float) for i in ids]) + intercept
            # Both classes weigh alike, however rare toxic rows are.
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) * np.where(labels == 1, 0.5 / rows[0], 0.5 / rows[1])
            found = np.bincount(np.concatenate(ids), np.repeat(error, [len(i) for i in ids]), size)
            return np.append(found[places.value], error.sum())
        return summed

    weights, intercept = np.zeros(len(live)), 0.0
    first, second = np.zeros(len(live) + 1), np.zeros(len(live) + 1)
    for turn in range(1, settings.rounds + 1):
        told = sc.broadcast(((weights * values).astype(np.float32), intercept))
        found = _summed(features, errors(told))
        told.destroy()
        slope = np.append(found[:-1] * values + settings.penalty * weights / used, found[-1])
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        move = settings.step * first / (1 - 0.9**turn) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
        weights -= move[:-1]
        intercept -= move[-1]
    places.destroy()
    table = np.zeros(size, np.float32)
    table[live] = weights * values
    return Model(table, float(intercept))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    """docs: doc_id, text; labels: doc_id, label (0 or 1). Only the ids picked are broadcast:
    `Settings.toxic_rows` and `Settings.other_rows` of them, each learnt with one of its texts."""
    settings = settings or Settings()
    python_ready(docs.sparkSession)
    known = labels.filter(F.col("doc_id").isNotNull()).select("doc_id", F.col("label").cast("int").alias("label")).distinct()
    picked = [
        known.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        for label, rows in ((1, settings.toxic_rows), (0, settings.other_rows))
    ]
    sample = one_text(docs.select("doc_id", "text").join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id"))

    def ids(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({
                "label": frame["label"],
                "ids": [feature_ids(t, settings).tobytes() for t in frame["text"]],
            })

    made = sample.select("text", "label").mapInPandas(ids, "label int, ids binary")
    part = F.pmod(F.xxhash64("ids", "label"), F.lit(settings.parts)).cast("int")
    dealt = made.withColumn("part", part).repartition(settings.parts, "part").sortWithinPartitions("part", "label", "ids")
    features = stored(dealt, "features")
    return fit_features(features, settings)


def score(docs: DataFrame, model: Model, settings: Settings | None = None) -> DataFrame:
    """doc_id, score: one row per input row."""
    settings = settings or Settings()
    python_ready(docs.sparkSession)
    table = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, intercept = table.value
        for frame in frames:
            margin = np.array([weights[feature_ids(t, settings)].sum(dtype=np.float64) for t in frame["text"]])
            yield pd.DataFrame({
                "doc_id": frame["doc_id"],
                "score": 1 / (1 + np.exp(-np.clip(margin + intercept, -700, 700))),
            })

    return docs.select("doc_id", "text").mapInPandas(scored, "doc_id bigint, score double")
