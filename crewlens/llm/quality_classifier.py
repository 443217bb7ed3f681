"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

A text is cut into runs of letters and digits and runs of other signs; a run equal to the one before
it is replaced by one mark for all repetitions. Its features are the hashed
single runs and pairs of neighbours, valued 1 + log of their count and scaled to a fixed length. The
model is trained by FTRL-proximal updates, one labelled text after the other, whose L1 part keeps
the weights sparse. A score is a sparse dot product through a sigmoid.

Fitting takes a bounded sample: at most `Settings.rows` labelled rows, those with the smallest hash
of their id. Executors turn them into feature ids, which are stored; the driver, which updates the
model by one text after the other, holds the rows of one sorted part at a time. Scoring reads every
whole text.

Defined cases: a null or empty text has no feature and gets the score of the intercept; repeated
rows get equal scores; without labelled rows of both classes every score is 0.5; an empty table
gives an empty result; only the id and the text of the input are used, whatever else it holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.llm.tables import one_text, python_ready
from crewlens.session import stored

SPACE, WORD, SIGN = 0, 1, 2
REPEATED = np.uint64(1)


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    rows: int = 8000
    passes: int = 4
    length: float = 8.0
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.5
    l2: float = 0.5


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    intercept: float


@cache
def _kinds() -> np.ndarray:
    """The kind of every code point."""
    return np.array([SPACE if chr(c).isspace() else WORD if chr(c).isalnum() else SIGN
                     for c in range(0x110000)], np.uint8)


def features(text: str | None, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids and their values."""
    none = np.empty(0, np.uint32), np.empty(0, np.float32)
    if not text:
        return none
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _kinds()[codes]
    starts = np.flatnonzero(np.append(True, kinds[1:] != kinds[:-1]))
    ends = np.append(starts[1:], len(codes))
    place = np.arange(len(codes)) - np.repeat(starts, ends - starts)
    mixed = (codes.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(21))) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    runs = np.add.reduceat(mixed, starts)[kinds[starts] != SPACE]
    if not len(runs):
        return none
    runs[1:][runs[1:] == runs[:-1]] = REPEATED
    pairs = runs[:-1] * np.uint64(0x100000001B3) + runs[1:]
    hashed = np.concatenate([runs, pairs]) * np.uint64(0x9E3779B97F4A7C15)
    ids = np.sort((hashed >> np.uint64(64 - settings.bits)).astype(np.uint32))
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    values = 1 + np.log(np.diff(np.append(first, len(ids))))
    return ids[first], (values * settings.length / np.sqrt((values**2).sum())).astype(np.float32)


def _in_order(rows: DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for r in rows.orderBy("place", "label", "ids").toLocalIterator():
        yield r["label"], np.frombuffer(r["ids"], np.uint32), np.frombuffer(r["values"], np.float32)


def fit_features(rows: DataFrame, settings: Settings) -> Model:
    """rows: place (in training order), label, ids, values, stored. The last slot is the intercept."""
    size = (1 << settings.bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    if rows.select("label").distinct().count() < 2:
        return Model(np.zeros(size - 1, np.float32), 0.0)

    def weights(z: np.ndarray, n: np.ndarray, l1: np.ndarray) -> np.ndarray:
        raw = -(z - np.sign(z) * l1) / ((settings.beta + np.sqrt(n)) / settings.alpha + settings.l2)
        return np.where(np.abs(z) > l1, raw, 0.0)

    penalty = np.full(size, settings.l1)
    penalty[-1] = 0
    for _ in range(settings.passes):
        for label, ids, values in _in_order(rows):
            at, x = np.append(ids, size - 1), np.append(values, 1.0)
            w = weights(z[at], n[at], penalty[at])
            slope = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            z[at] += slope - (np.sqrt(n[at] + slope**2) - np.sqrt(n[at])) / settings.alpha * w
            n[at] += slope**2
    final = weights(z, n, penalty)
    return Model(final[:-1].astype(np.float32), float(final[-1]))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    """docs: doc_id, text; labels: doc_id, label (0 or 1). Texts are learnt in the order of their
    id's hash. Only the ids picked are broadcast: `Settings.rows` of them, each learnt with one of its
    texts."""
    settings = settings or Settings()
    python_ready(docs.sparkSession)
    picked = (
        labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "label")
        .distinct().withColumn("place", F.xxhash64("doc_id"))
        .orderBy("place", "doc_id", "label").limit(settings.rows)
    )
    sample = one_text(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")).drop("doc_id")

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [features(t, settings) for t in frame["text"]]
            yield pd.DataFrame({
                "place": frame["place"], "label": frame["label"].astype("int32"),
                "ids": [i.tobytes() for i, _ in made], "values": [v.tobytes() for _, v in made],
            })

    rows = sample.mapInPandas(found, "place bigint, label int, ids binary, values binary")
    return fit_features(stored(rows, "features"), settings)


def score(docs: DataFrame, model: Model, settings: Settings | None = None) -> DataFrame:
    """doc_id, score: one row per input row."""
    settings = settings or Settings()
    python_ready(docs.sparkSession)
    table = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, intercept = table.value
        for frame in frames:
            margins = []
            for text in frame["text"]:
                ids, values = features(text, settings)
                margins.append(float(weights[ids].astype(np.float64) @ values))
            yield pd.DataFrame({
                "doc_id": frame["doc_id"],
                "score": 1 / (1 + np.exp(-np.clip(np.array(margins) + intercept, -700, 700))),
            })

    return docs.select("doc_id", "text").mapInPandas(scored, "doc_id bigint, score double")
