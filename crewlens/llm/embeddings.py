"""Embedding near-dedup by Euclidean p-stable hashing.

A normalised vector is projected on random Gaussian directions; `WIDTH`-wide quantised values of
several projections, the draws, make the key of one of several tables. The number of different vectors
gives both (`settings`): more draws keep unrelated vectors apart, and more tables make up for the
links that these tear. The tables are as many as it takes to miss two vectors at cosine 0.9 with a
chance of `MISS` (at 0.95 it is far below 1e-6); of the numbers of draws the one with the least work
per vector is taken, a row per table and a comparison per unrelated vector of equal key. Draws grow
with the logarithm of the number of vectors, and the work per vector as a power of it of 0.3. Vectors
that share a key are then compared by their exact cosine in double precision, each pair only in the
first table it shares.

1. Equal vectors are one class with a count, known by its smallest id.
2. Keys of several classes are counted first. A key with more than `BLOCK` classes is salted into
   blocks, and every two of its blocks form a group: no task meets more than 2 * BLOCK rows of one
   key. Only counts and, per class, one link to its local component leave a group, never its pairs.
3. Random-hyperplane sketches of 128 bits travel with the keys, and only classes that have a
   partner within `FAR_BITS` bits of it (a true pair is further with a chance of 1e-8) get their
   vectors and their exact check.

Counting links costs, for a group of g different vectors close to each other, g * g / BLOCK rows
moved, as every link of it is asked for.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component link with
nothing, as do vectors of different lengths; rows with equal ids are one vector, the smallest by its
bytes, and each gets its row; a null id is returned without links, with a null component, and kept;
an empty table gives an empty result; columns besides vec_id and embedding are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.llm.components import components, own_exchange
from crewlens.llm.grouped import group_numbers, local_components, map_groups, neighbours
from crewlens.llm.tables import python_ready
from crewlens.session import stored

WIDTH, SEED, MISS, MOST_DRAWS = 1.5, 11, 0.002, 40
#: Comparisons of sketches that cost as much as a row of a table.
ROW_COST = 100
SKETCH_BITS, FAR_BITS = 128, 42
BLOCK = 512
LEAST_COSINE = 0.9


def _same_cell(cosine: float) -> float:
    """Chance that one projection puts two vectors in one cell."""
    r = WIDTH / math.sqrt(2 - 2 * cosine)
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def settings(vectors: int) -> tuple[int, int]:
    """Tables and draws for so many different vectors."""
    near, far = _same_cell(LEAST_COSINE), _same_cell(0)

    def tables(draws: int) -> int:
        return math.ceil(math.log(MISS) / math.log1p(-(near**draws)))

    draws = min(range(1, MOST_DRAWS + 1), key=lambda d: tables(d) * (ROW_COST + vectors * far**d))
    return tables(draws), draws


class Hashes:
    """The random directions for vectors of one length."""

    def __init__(self, length: int, tables: int, draws: int):
        drawn = np.random.Generator(np.random.PCG64([SEED, length]))
        self.shape = (tables, draws)
        self.directions = drawn.normal(size=(length, tables * draws))
        self.offsets = drawn.uniform(0, WIDTH, tables * draws)
        self.planes = drawn.normal(size=(length, SKETCH_BITS))
        self.factors = drawn.integers(0, 1 << 63, self.shape, np.uint64) * np.uint64(2) + np.uint64(1)
        self.tables = drawn.integers(0, 1 << 63, tables, np.uint64)

    def keys(self, units: np.ndarray) -> np.ndarray:
        cells = np.floor((units @ self.directions + self.offsets) / WIDTH).astype(np.int64).astype(np.uint64)
        mixed = (cells.reshape(-1, *self.shape) * self.factors).sum(axis=2, dtype=np.uint64) + self.tables
        mixed ^= mixed >> np.uint64(32)
        return (mixed * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64)

    def sketches(self, units: np.ndarray) -> np.ndarray:
        return np.packbits(units @ self.planes > 0, axis=1)


def _usable(vector) -> np.ndarray | None:
    if vector is None:
        return None
    values = np.array([np.nan if x is None else x for x in vector] if not isinstance(vector, np.ndarray) else vector, np.float64)
    return values if len(values) and np.isfinite(values).all() and values.any() else None


def hashed(embeddings: DataFrame, tables: int, draws: int) -> DataFrame:
    """vec_id, vector (null if it links with nothing), keys, sketch."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, Hashes] = {}
        for frame in frames:
            vectors = [_usable(v) for v in frame["embedding"]]
            found: list[tuple] = [(None, None, None)] * len(vectors)
            for length in {len(v) for v in vectors if v is not None}:
                at = [k for k, v in enumerate(vectors) if v is not None and len(v) == length]
                own = np.stack([vectors[k] for k in at])
                scaled = own / np.abs(own).max(axis=1, keepdims=True)  # no overflow or underflow of squares
                units = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
                made = known.get(length) or known.setdefault(length, Hashes(length, tables, draws))
                for k, unit, keys, sketch in zip(at, units, made.keys(units), made.sketches(units), strict=True):
                    found[k] = (unit.astype("<f8").tobytes(), keys, sketch.tobytes())
            columns = list(zip(*found, strict=True)) if found else [[], [], []]
            yield pd.DataFrame({"vec_id": frame["vec_id"].to_numpy(), "vector": list(columns[0]),
                                "keys": list(columns[1]), "sketch": list(columns[2])})

    return embeddings.select("vec_id", "embedding").mapInPandas(
        rows, "vec_id bigint, vector binary, keys array<bigint>, sketch binary")


def _near(frame: pd.DataFrame) -> pd.DataFrame:
    """The rows that have a partner near by their sketches."""
    bits = np.frombuffer(b"".join(frame["sketch"]), np.uint64).reshape(len(frame), -1)
    near = np.zeros(len(frame), bool)
    for a, b in neighbours(frame):
        close = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1) <= FAR_BITS
        near[a[close]] = near[b[close]] = True
    return frame.loc[near, ["key", "i", "j", "own", "t", "id"]]


def _linked(frame: pd.DataFrame) -> pd.DataFrame:
    """Per row with a link: links counted here, and the smallest id of its component here."""
    group = group_numbers(frame)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    out = []
    for start, end in zip(starts, np.append(starts[1:], len(frame)), strict=True):
        rows = frame.iloc[start:end]
        vectors = np.frombuffer(b"".join(rows["vector"]), "<f8")
        if end - start < 2 or rows["vector"].map(len).nunique() > 1:
            continue
        vectors = vectors.reshape(end - start, -1)
        norms = np.linalg.norm(vectors, axis=1)
        close = np.triu(vectors @ vectors.T / np.outer(norms, norms) >= LEAST_COSINE, 1)
        own = rows["own"].to_numpy()
        if rows["i"].iloc[0] != rows["j"].iloc[0]:
            close &= own[:, None] != own[None, :]
        a, b = np.nonzero(close)
        if not len(a):
            continue
        # Every link joins, but it counts in the first table that its two vectors share.
        label = local_components(rows["id"].to_numpy(), a, b)
        keys, t = np.stack(rows["keys"].to_numpy()), int(rows["t"].iloc[0])
        first = np.ones(len(a), bool)
        for table in range(t):
            same = keys[:, table]
            first &= same[a] != same[b]
            if not first.any():
                break
        copies = rows["copies"].to_numpy()
        links = np.bincount(a[first], copies[b[first]], end - start) + np.bincount(b[first], copies[a[first]], end - start)
        touched = np.unique(np.concatenate([a, b]))
        out.append(pd.DataFrame({"id": rows["id"].to_numpy()[touched], "links": links[touched].astype(np.int64),
                                 "least": label[touched]}))
    return pd.concat(out) if out else pd.DataFrame({"id": [], "links": [], "least": []}).astype("int64")


def groups(embeddings: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row."""
    python_ready(embeddings.sparkSession)
    count = embeddings.agg(F.approx_count_distinct("embedding")).first()[0]
    all_rows = stored(hashed(embeddings, *settings(count)), "hashed")
    usable = all_rows.filter("vec_id IS NOT NULL AND vector IS NOT NULL")
    vectors = usable.groupBy("vec_id").agg(F.min(F.struct("vector", "keys", "sketch")).alias("x")).select("vec_id", "x.*")
    vectors = stored(vectors, "vectors")
    classes = stored(vectors.groupBy("vector").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.min("keys").alias("keys"),
        F.min("sketch").alias("sketch")), "classes")

    in_tables = classes.select("id", "sketch", F.posexplode("keys").alias("t", "key"))
    crowded = in_tables.groupBy("key").count().filter("count > 1").select(
        "key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = in_tables.join(own_exchange(crowded, "key"), "key").select(
        "key", "t", "id", "sketch", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    paired = placed.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                           "own", "t", "id", "sketch")
    near = map_groups(paired, _near, "key bigint, i int, j int, own int, t int, id bigint")
    joined = near.join(classes.select("id", "vector", "keys", "copies"), "id")
    linked = stored(map_groups(joined, _linked, "id bigint, links bigint, least bigint"), "linked")

    links = linked.groupBy("id").agg(F.sum("links").alias("links"))
    found = components(linked.filter("id <> least").select(F.col("id").alias("u"), F.col("least").alias("v")))
    per_class = classes.select("vector", "id", "copies").join(links, "id", "left").join(
        found.withColumnRenamed("u", "id"), "id", "left").select(
        "vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
        F.coalesce("component", "id").alias("component"))
    per_vector = vectors.select("vec_id", "vector").join(per_class, "vector").drop("vector")
    out = all_rows.select("vec_id").join(per_vector, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
