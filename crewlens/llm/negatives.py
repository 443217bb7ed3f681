"""Hard negatives: lists of candidates shared by clusters of anchors, walked until certified.

Every vector becomes integers x = floor(256 * c); a score is the inner product of two of them. An
anchor's positives are its best rows of the same label, and a positive's hard negatives are the best
rows of other labels that score 80 to 100 % of what the positive scores.

1. Anchors are clustered by direction. A cluster's cap is the widest angle of a member to its centre.
2. No member u of a cluster scores a candidate i higher than |u| * |i| * cos(angle of i to the centre
   - cap). One pass over the candidates sorts them, per cluster, into LEVELS levels of |i| * cos(...),
   and the levels from the top make the cluster's list. It is cut into pages; a page is PAGE_GROWTH
   times as long as those before it.
3. All members of a cluster walk its list page by page, first for positives, then for negatives. In a
   page, blocks of members meet blocks of candidates in one matrix product, and only each member's
   best few rows leave. A member stops once its last kept score is above the bound of all that is left
   (or, for negatives, once that bound is below 80 %); rows that tie with it lie above the bound. At
   the end of the list everything was met, so nothing depends on how well the bound does.

Work grows with anchors times the part of the list they walk. On vectors without structure that is
the whole list: a query set against all rows, in blocks. Of rows that share vector and label only the
POSITIVES + 1 or NEGATIVES + 1 smallest ids can be among the best few of any anchor, so copies do not
multiply. What the driver holds (centres, caps, pages) is bounded by MOST_CLUSTERS and LEVELS; centres
come from at most SAMPLE anchors, those with the least hash of their id.

Defined cases: rows with a null id, a null label, a null or empty vector, null or non-finite entries,
or a vector whose integers have a length of 2^31 or more (its scores would leave 64 bits) take no
part, nor do vectors of another length than the most frequent one (of equally frequent ones the
greatest counts). Rows with equal ids are one row, the least by vector and label. Zero vectors score 0.
An anchor without positives, and a positive without negatives, give no rows; an empty table gives an
empty result. Columns besides vec_id, embedding and label are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crewlens.llm.tables import python_ready
from crewlens.session import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
MEMBERS_A_CLUSTER, MOST_CLUSTERS, SAMPLE, STEPS = 256, 512, 4096, 10
LEVELS = 1024
FIRST_PAGE, PAGE_GROWTH = 16_384, 8
MEMBER_BLOCK, CANDIDATE_BLOCK = 512, 2048
ANGLE_SLACK, SLACK = 1e-6, 1e-9


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length 1 (0 for 0) and their lengths before."""
    x = x.astype(float)
    norms = np.linalg.norm(x, axis=1)
    return x / np.where(norms > 0, norms, 1)[:, None], norms


def integer_rows(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """vec_id, label (as text), x, anchor of the rows that take part, one per id."""
    scaled = F.transform("embedding", lambda c: c.cast("double") * SCALE)
    whole = F.forall("embedding", lambda c: F.coalesce(F.abs(c.cast("double") * SCALE) < 2.0**31, F.lit(False)))
    x = F.when((F.size("embedding") > 0) & whole, F.transform(scaled, lambda c: F.floor(c).cast("int")))
    length = F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    usable = rows.select("vec_id", F.col("label").cast("string").alias("label"), x.alias("x"),
                         F.coalesce(is_anchor, F.lit(False)).alias("anchor")).filter(
        "vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").filter(length < 2.0**62)
    lengths = usable.groupBy(F.size("x").alias("length")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    usable = usable.filter(F.size("x") == (common["length"] if common else 0))
    return usable.groupBy("vec_id").agg(F.min(F.struct("x", "label", "anchor")).alias("least")).select("vec_id", "least.*")


def centres(anchors: DataFrame) -> np.ndarray:
    """Unit vectors of the clusters' centres, from a bounded sample of anchors."""
    count = anchors.count()
    sample = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("x").collect()
    units, norms = _units(np.array([r.x for r in sample]))
    units = units[norms > 0]
    clusters = max(1, min(MOST_CLUSTERS, len(units), -(-count // MEMBERS_A_CLUSTER)))
    if not len(units):
        return np.eye(1, len(sample[0].x))
    found = units[:clusters]
    for _ in range(STEPS):
        nearest = np.argmax(units @ found.T, axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, units)
        new, norms = _units(sums)
        found = np.where(norms[:, None] > 0, new, found)
    return found


def clustered(anchors: DataFrame, centre: np.ndarray) -> DataFrame:
    """vec_id, label, x, cluster, angle to its centre, norm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                units, norms = _units(_matrix(batch.column(2)))
                cosines = units @ centre.T
                nearest = np.argmax(cosines, axis=1)
                angles = np.arccos(np.clip(cosines[np.arange(len(units)), nearest], -1, 1))
                angles[norms == 0] = 0  # all its scores are 0, as its bounds are
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(nearest, pa.int32()), pa.array(angles), pa.array(norms)],
                    names=["vec_id", "label", "x", "cluster", "angle", "norm"])

    return anchors.select("vec_id", "label", "x").mapInArrow(
        run, "vec_id bigint, label string, x array<int>, cluster int, angle double, norm double")


@dataclass
class Bounds:
    """Centres and caps of the clusters, and the length of the longest candidate."""

    centre: np.ndarray
    caps: np.ndarray
    longest: float

    def levels(self, x: np.ndarray) -> np.ndarray:
        """Level of each candidate in each cluster's list; level 0 has the highest bounds."""
        units, norms = _units(x)
        angles = np.arccos(np.clip(units @ self.centre.T, -1, 1))
        bound = norms[:, None] * (np.cos(np.maximum(0, angles - self.caps - ANGLE_SLACK)) + SLACK)
        return np.clip((1 - bound / self.longest) * (LEVELS // 2), 0, LEVELS - 1).astype(np.int64)

    def highest(self, level: int) -> float:
        """No candidate from this level on has a higher bound."""
        return self.longest * (1 - level / (LEVELS // 2) + SLACK)


def _pages(candidates: DataFrame, bounds: Bounds) -> dict[int, list]:
    """Per cluster the pages of its list, from the top: first level, last level, candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(bounds.caps), LEVELS), np.int64)
        for batch in batches:
            if batch.num_rows:
                np.add.at(counts, (np.arange(len(counts))[None, :], bounds.levels(_matrix(batch.column(0)))), 1)
        cluster, level = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(level, pa.int32()),
                                          pa.array(counts[cluster, level])], names=["cluster", "level", "n"])

    counts = candidates.select("x").mapInArrow(run, "cluster int, level int, n bigint")
    levels = counts.groupBy("cluster", "level").agg(F.sum("n").alias("n"))
    above = F.sum("n").over(Window.partitionBy("cluster").orderBy("level")) - F.col("n")
    later = F.floor(F.log(F.greatest(above / FIRST_PAGE, F.lit(1.0))) / F.log(F.lit(float(PAGE_GROWTH)))) + 1
    page = F.when(above < FIRST_PAGE, F.lit(0)).otherwise(later)
    pages = levels.select("cluster", "level", "n", page.alias("page")).groupBy("cluster", "page").agg(
        F.min("level").alias("first"), F.max("level").alias("last"), F.sum("n").alias("n")).collect()
    found: dict[int, list] = {}
    for row in sorted(pages, key=lambda r: (r["cluster"], r["page"])):
        found.setdefault(row["cluster"], []).append((row["first"], row["last"], row["n"]))
    return found


def _turns(step: int, pages: dict[int, list], active: dict[int, int], bounds: Bounds) -> list[tuple]:
    """For each cluster with active members whose list has a page `step`: cluster, the page's first
    and last level, blocks of its candidates and of the members, and the highest bound after it."""
    found = []
    for cluster, members in sorted(active.items()):
        own = pages.get(cluster, [])
        if step < len(own):
            first, last, n = own[step]
            left = bounds.highest(own[step + 1][0]) if step + 1 < len(own) else float("-inf")
            found.append((cluster, first, last, -(-n // CANDIDATE_BLOCK), -(-members // MEMBER_BLOCK), left))
    return found


def _page(candidates: DataFrame, bounds: Bounds, turns: list[tuple]) -> DataFrame:
    """cluster, c_block, m_block, vec_id, label, x: the pages' candidates, for each block of members."""
    clusters, first, last, blocks, members = (np.array([t[k] for t in turns]) for k in range(5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            level = bounds.levels(_matrix(batch.column(2)))[:, clusters]
            row, at = np.nonzero((level >= first) & (level <= last))
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            mixed = ((ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(clusters[at], pa.int32()), pa.array(mixed[row] % blocks[at], pa.int32()),
                 pa.array(members[at], pa.int32()), *taken.columns],
                names=["cluster", "c_block", "m_blocks", "vec_id", "label", "x"])

    found = candidates.select("vec_id", "label", "x").mapInArrow(
        run, "cluster int, c_block int, m_blocks int, vec_id bigint, label string, x array<int>")
    return found.withColumn("m_block", F.explode(F.sequence(F.lit(0), F.col("m_blocks") - 1))).drop("m_blocks")


def _scores(members: pa.Table, candidates: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of members against candidates, which of these pairs share a label, the candidates' ids.
    Candidates are in the order of their ids."""
    ids = candidates.column("vec_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    u, c = _matrix(members.column("x")), _matrix(candidates.column("x"))[order]
    top = float(np.sqrt((u.astype(float) ** 2).sum(axis=1).max() * (c.astype(float) ** 2).sum(axis=1).max()))
    kind = float if top < 2**52 else np.int64  # products of both kinds are exact
    scores = (u.astype(kind) @ c.astype(kind).T).astype(np.int64)
    labels = np.array(members.column("label").to_pylist() + candidates.column("label").to_pylist(), object)
    code = np.unique(labels.astype(str), return_inverse=True)[1]
    return scores, code[: len(u)][:, None] == code[len(u):][order][None, :], ids[order]


def _best(scores: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Places of the kept scores, highest first, ties in the order they stand."""
    at = np.flatnonzero(keep)
    return at[np.argsort(-scores[at], kind="stable")]


def _block_positives(members: pa.Table, candidates: pa.Table) -> pa.Table:
    anchors, found = members.column("vec_id").to_numpy(), []
    if len(anchors) and candidates.num_rows:
        scores, same, ids = _scores(members, candidates)
        for k, anchor in enumerate(anchors.tolist()):
            best = _best(scores[k], same[k] & (ids != anchor))[:POSITIVES]
            found.append((np.full(len(best), anchor), ids[best], scores[k][best]))
    columns = [np.concatenate([f[c] for f in found]) if found else [] for c in range(3)]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["anchor_id", "vec_id", "score"])


def _least_score(positive: int) -> int:
    """The least whole score of at least 80 % of a positive's."""
    return -(-80 * positive // 100)


def _block_negatives(members: pa.Table, candidates: pa.Table) -> pa.Table:
    anchors, found = members.column("vec_id").to_numpy(), []
    if len(anchors) and candidates.num_rows:
        scores, same, ids = _scores(members, candidates)
        wanted = members.column("positives").to_pylist()
        for k, anchor in enumerate(anchors.tolist()):
            lowest, highest = _least_score(min(wanted[k])), max(wanted[k])
            best = _best(scores[k], ~same[k] & (scores[k] >= lowest) & (scores[k] <= highest))
            falling = -scores[k][best]
            for positive in wanted[k]:
                start, end = np.searchsorted(falling, -positive), np.searchsorted(falling, -_least_score(positive), "right")
                few = best[start:min(end, start + NEGATIVES)]
                found.append((np.full(len(few), anchor), np.full(len(few), positive), ids[few], scores[k][few]))
    columns = [np.concatenate([f[c] for f in found]) if found else [] for c in range(4)]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["anchor_id", "positive_score", "vec_id", "score"])


def _walk(members: DataFrame, candidates: DataFrame, bounds: Bounds, pages: dict, handle, key: list[str],
          depth: int, unsettled) -> DataFrame:
    """The members' best rows (`depth` for each key), page by page until unsettled(members, lists)
    names none whose list goes on. unsettled gets members with their bound of all that is left."""
    spark = members.sparkSession
    schema = ", ".join(f"{c} bigint" for c in [*key, "vec_id", "score"])
    best = Window.partitionBy(*key).orderBy(F.desc("score"), "vec_id")
    lists, step = spark.createDataFrame([], schema), 0
    while True:
        active = {r["cluster"]: r["count"] for r in members.groupBy("cluster").count().collect()}
        turns = _turns(step, pages, active, bounds)
        if not turns:
            return lists
        page = _page(candidates, bounds, turns)
        turn = F.broadcast(spark.createDataFrame(  # a row per cluster, MOST_CLUSTERS at most
            [(t[0], t[3], t[4], t[5]) for t in turns], "cluster int, c_blocks int, m_blocks int, bound double"))
        here = members.join(turn, "cluster")
        slack = F.lit(SLACK * bounds.longest)
        dealt = here.withColumn("c_block", F.explode(F.sequence(F.lit(0), F.col("c_blocks") - 1))).withColumn(
            "m_block", F.pmod(F.xxhash64("vec_id"), F.col("m_blocks")).cast("int"))
        blocks = ["cluster", "c_block", "m_block"]
        found = dealt.groupBy(*blocks).cogroup(page.groupBy(*blocks)).applyInArrow(handle, schema)
        ranked = lists.unionByName(found).withColumn("rank", F.row_number().over(best))
        lists = stored(ranked.filter(F.col("rank") <= depth).drop("rank"), "lists")
        open_members = here.withColumn("left", (F.col("bound") + slack) * F.col("norm"))
        members = stored(unsettled(open_members, lists).select(*members.columns), "members")
        step += 1


def _without_positives(members: DataFrame, lists: DataFrame) -> DataFrame:
    """Members whose best rows may still change."""
    kept = lists.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.count("*").alias("n"), F.min("score").alias("last"))
    done = (F.col("n") >= POSITIVES) & (F.col("last") > F.col("left"))
    return members.join(kept, "vec_id", "left").filter(~F.coalesce(done, F.lit(False)) & (F.col("bound") > float("-inf")))


def _without_negatives(members: DataFrame, lists: DataFrame) -> DataFrame:
    kept = lists.groupBy(F.col("anchor_id").alias("vec_id"), "positive_score").agg(
        F.count("*").alias("n"), F.min("score").alias("last"))
    each = members.select("vec_id", "left", F.explode("positives").alias("positive_score"))
    full = F.coalesce((F.col("n") >= NEGATIVES) & (F.col("last") > F.col("left")), F.lit(False))
    low = F.col("left") < F.col("positive_score") * 0.8 * (1 - SLACK)
    going = each.join(kept, ["vec_id", "positive_score"], "left").filter(~full & ~low)
    return members.join(going.select("vec_id").distinct(), "vec_id", "left_semi").filter(F.col("bound") > float("-inf"))


OUTPUT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def mine(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. rows: vec_id,
    embedding, label; is_anchor says which of them are anchors."""
    spark = rows.sparkSession
    python_ready(spark)
    rows = stored(integer_rows(rows, is_anchor), "integers")
    copies = Window.partitionBy("label", "x").orderBy("vec_id")
    most = max(POSITIVES, NEGATIVES) + 1
    candidates = stored(rows.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= most).drop(
        "copy", "anchor"), "candidates")
    anchors = rows.filter("anchor")
    if anchors.isEmpty():
        return spark.createDataFrame([], OUTPUT)
    centre = centres(anchors)
    members = stored(clustered(anchors, centre), "anchors")
    caps = np.zeros(len(centre))
    for row in members.groupBy("cluster").agg(F.max("angle").alias("cap")).collect():
        caps[row["cluster"]] = row["cap"]
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))
    bounds = Bounds(centre, caps, max(1.0, candidates.select(F.max(length)).first()[0]))
    pages = _pages(candidates, bounds)

    positives = _walk(members.select("vec_id", "label", "x", "cluster", "norm"), candidates, bounds, pages,
                      _block_positives, ["anchor_id"], POSITIVES, _without_positives)
    # No score lies between 80 and 100 % of a negative one.
    wanted = positives.filter("score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_set("score").alias("positives"))  # POSITIVES at most
    seeking = stored(members.select("vec_id", "label", "x", "cluster", "norm").join(wanted, "vec_id"), "seeking")
    found = _walk(seeking, candidates, bounds, pages, _block_negatives, ["anchor_id", "positive_score"], NEGATIVES,
                  _without_negatives)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    pairs = positives.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    negatives = found.select("anchor_id", "positive_score", F.col("vec_id").alias("negative_id"),
                             F.col("score").alias("negative_score"))
    return pairs.join(negatives, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", rank.alias("rank"), "negative_id", "positive_score", "negative_score")
