"""Mixing sources to target weights by Pfair scheduling.

Documents of a source are put in a fixed pseudo-random order and cut into blocks of `BLOCK`. Time
is counted in slots of one block. A source of weight w releases its block j (from 0) at slot
floor(j / w) and must get a slot before its deadline ceil((j + 1) / w); of the released blocks the
one with the earliest deadline takes the slot. As the weights add up to one, every deadline is
met, so after any number of slots each source is within one block of its target.

Weights are taken exactly, as the decimal number that is given, and releases and deadlines follow from
them over the whole schedule. It is cut into segments that are scheduled apart, each in a Spark task:
which blocks come before a cut follows from the weights alone (`begun`), so a segment knows the
blocks it has to place. The blocks of all documents are placed by a join with the slots and never meet
in one task.

A source that ends early starts again, as often as its weight asks, until the source that needs
most slots has ended for the first time: so the mixture has the target weights and every document is
in it at least once. Without weights, targets are the sources' sizes to the power `TEMPER`, which
raises the share of small sources.

Defined cases: documents without a source are a source of their own; a source without a given weight
gets the smallest given one; weights that are not positive are an error; repeated rows are separate
documents; null or empty texts are documents as others; an empty table gives an empty result; the
input's columns are returned as they were.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction
from math import ceil, lcm

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crewlens.llm.tables import python_ready
from crewlens.session import passing, stored

BLOCK = 8
CYCLE = 1000
TEMPER = 0.75
#: Documents that are numbered in one task, about, and appearances of one document that one task gets.
TASK_ROWS, CHUNK = 2_000, 1_000
#: Rows of the schedule that are handed over at once, and segments of the least length in one task, about.
BATCH, TASK_SEGMENTS = 10_000, 4


def whole_weights(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the proportion of the weights."""
    if any(not 0 < w < float("inf") for w in weights.values()):
        raise ValueError("Weights have to be positive.")
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    unit = lcm(*(x.denominator for x in exact.values()))
    return {s: int(x * unit) for s, x in exact.items()}


def begun(weights: list[int], upto: int) -> list[int]:
    """How many blocks of each source come before the slot `upto`, so that all blocks before and after
    it can meet their releases and deadlines.

    Blocks that are due by then come before it. The slots left go to blocks whose time has begun, by
    earliest deadline, except where more blocks would come after some release than there are slots
    up to `upto`. These exceptions are nested sets, so the choice holds as many blocks due by any
    later slot as any choice that fits can hold, which is enough for the slots after it."""
    total = sum(weights)
    counts = [upto * w // total for w in weights]
    left = upto - sum(counts)
    if not left:
        return counts
    open_ = [(-(-(n + 1) * total // w), s, n * total // w)  # deadline, source, release
             for s, (n, w) in enumerate(zip(counts, weights, strict=True)) if upto * w % total]
    releases = sorted({r for _, _, r in open_})
    # Slots from a release on, less the due blocks that are released from there on; least in each range.
    due = [0] * (upto - releases[0])  # by the distance of their release
    for n, w in zip(counts, weights, strict=True):
        while n and (r := (n - 1) * total // w) > releases[0]:
            due[upto - r] += 1
            n -= 1
    room, taken, k = [upto] * len(releases), 0, len(releases) - 1
    for back in range(1, len(due)):
        taken += due[back]
        while k > 0 and upto - back <= releases[k - 1]:
            k -= 1
        if upto - back <= releases[-1]:
            room[k] = min(room[k], back - taken)
    for _, s, release in sorted(open_):
        at = bisect_left(releases, release)
        if left and min(room[1: at + 1], default=1) > 0:
            for k in range(1, at + 1):
                room[k] -= 1
            counts[s] += 1
            left -= 1
    return counts


def segment(weights: list[int], start: int, end: int) -> Iterator[tuple[int, int, int, int, int]]:
    """slot, source, block, release, deadline of the slots of a segment: the earliest deadline first
    among the released blocks, each not later than the segment's end."""
    total, done, last = sum(weights), begun(weights, start), begun(weights, end)
    waiting = [(n * total // w, s) for s, (n, w) in enumerate(zip(done, weights, strict=True)) if n < last[s]]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int, int]] = []  # deadline in the segment, deadline, source, release
    for slot in range(start, end):
        while waiting and waiting[0][0] <= slot:
            release, s = heapq.heappop(waiting)
            deadline = -(-(done[s] + 1) * total // weights[s])
            heapq.heappush(ready, (min(deadline, end), deadline, s, release))
        _, deadline, s, release = heapq.heappop(ready)
        yield slot, s, done[s], release, deadline
        done[s] += 1
        if done[s] < last[s]:
            heapq.heappush(waiting, (done[s] * total // weights[s], s))


def _source(name: str = "source"):
    return F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit(""))


def _order():
    return F.xxhash64("doc_id", "text")


def _part(order, ranges: int):
    return F.pmod(F.shiftright(order, 20), F.lit(ranges)).cast("int")


def _range(ranges: int):
    """The range a document is numbered in; documents of one id, or of none, are in many."""
    return _part(_order(), ranges)


def _slots(spark, weights: dict[str, int], blocks: dict[str, int], cycle: int) -> DataFrame:
    """s, own, epoch, block, slot, release, deadline: the slots until every source has ended once."""
    names = sorted(weights)
    given, total = [weights[s] for s in names], sum(weights.values())
    needed = max(-(-blocks[s] * total // weights[s]) for s in names)
    # A segment is about as long as the longest time between a release and its deadline, at least.
    length = min(needed, max(cycle, 10 * len(names), -(-total // min(given))))
    count = -(-needed // length)
    sizes = [blocks[s] for s in names]

    def timed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["slot", "s", "block", "release", "deadline"]
        for frame in frames:
            rows = []
            for k in frame["id"]:
                for row in segment(given, int(k) * length, min(needed, (int(k) + 1) * length)):
                    rows.append(row)
                    if len(rows) == BATCH:
                        yield named(pd.DataFrame(rows, columns=columns))
                        rows = []
            if rows:
                yield named(pd.DataFrame(rows, columns=columns))

    def named(rows: pd.DataFrame) -> pd.DataFrame:
        size = rows["s"].map(dict(enumerate(sizes)))
        return rows.assign(own=rows["block"] % size, epoch=rows["block"] // size, s=rows["s"].map(dict(enumerate(names))))[
            ["s", "own", "epoch", "block", "slot", "release", "deadline"]]

    python_ready(spark)
    tasks = min(count, max(1, needed // (TASK_SEGMENTS * CYCLE)))
    made = stored(spark.range(0, count, 1, tasks).mapInPandas(
        timed, "s string, own bigint, epoch bigint, block bigint, slot bigint, release bigint, deadline bigint"), "slots")
    first = made.filter("epoch = 0").groupBy("s").agg(F.max("slot").alias("slot"))
    end = first.agg(F.max("slot")).first()[0]
    return made.filter(F.col("slot") <= end)


def _numbered(classes: DataFrame, ranges: int) -> DataFrame:
    """classes: s, h, h2, n. Adds start: how many documents of the source come before."""
    parted = classes.withColumn("part", _part(F.col("h"), ranges))
    before = Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parted.groupBy("s", "part").agg(F.sum("n").alias("n")).select(
        "s", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("s", "part").orderBy("h", "h2").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("n").over(inside)
    return parted.withColumn("start", upto - F.col("n")).join(offsets, ["s", "part"]).select(
        "s", "h", "h2", "n", (F.col("before") + F.col("start")).alias("start"))


def _placed(classes: DataFrame, weights: dict[str | None, float] | None, block: int, cycle: int) -> DataFrame:
    """classes: s, h, h2, n. One row per appearance: the class, its slot, place and chunk of appearances."""
    sizes = {r["s"]: r["n"] for r in classes.groupBy("s").agg(F.sum("n").alias("n")).collect()}
    if weights is None:
        targets = {s: n**TEMPER for s, n in sizes.items()}
    else:
        whole_weights(weights)
        given = {"" if s is None else f"={s}": w for s, w in weights.items()}
        targets = {s: given.get(s, min(given.values())) for s in sizes}
    if not sizes:  # an empty table has one source without documents
        sizes = targets = {"": 1}
    blocks = {s: ceil(n / block) for s, n in sizes.items()}
    slots = _slots(classes.sparkSession, whole_weights(targets), blocks, cycle)

    numbered = _numbered(classes, max(1, ceil(max(sizes.values()) / TASK_ROWS)))
    last = F.col("start") + F.col("n") - 1
    own = F.sequence(F.floor(F.col("start") / block), F.floor(last / block))
    timed = numbered.withColumn("own", F.explode(own)).join(slots, ["s", "own"])
    first = F.col("own") * block
    places = F.sequence(F.greatest(F.col("start") - first, F.lit(0)), F.least(last - first, F.lit(block - 1)))
    return timed.withColumn("place", F.explode(places)).withColumn(
        "chunk", F.floor((F.col("own") * block + F.col("place") - F.col("start")) / CHUNK)).drop("n", "start", "own")


def schedule(docs: DataFrame, weights: dict[str | None, float] | None = None, block: int = BLOCK,
             cycle: int = CYCLE) -> DataFrame:
    """One row per appearance of a document: row (its columns), epoch (from 0), block (of its source,
    over all epochs), slot, place (in its block), release and deadline. `cycle` is the least length of
    a segment."""
    spark = docs.sparkSession
    keyed = docs.select(F.struct(*docs.columns).alias("row"), _source().alias("s"), _order().alias("h"),
                        F.xxhash64(F.lit("row"), *docs.columns).alias("h2"))
    with passing(spark) as keep:
        classes = stored(keyed.groupBy("s", "h", "h2").agg(F.count("*").alias("n")), "classes")
        placed = keep(stored(_placed(classes, weights, block, cycle), "placed"))
        large = keep(stored(classes.filter(F.col("n") > CHUNK), "large"))
    # One text per class meets its first chunk of places as the fold left it. Classes with more, which
    # are few, get a row per further chunk.
    one = keyed.groupBy("s", "h", "h2").agg(F.first("row").alias("row"))
    found = placed.filter("chunk = 0").drop("chunk").join(one, ["s", "h", "h2"])
    if not large.isEmpty():
        of_large = keyed.join(large.drop("n"), ["s", "h", "h2"], "left_semi").groupBy("s", "h", "h2").agg(F.first("row").alias("row"))
        chunks = F.sequence(F.lit(1).cast("bigint"), F.floor((F.col("n") - 1) / CHUNK))
        texts = of_large.join(large, ["s", "h", "h2"]).withColumn("chunk", F.explode(chunks)).drop("n")
        found = found.unionByName(placed.filter("chunk > 0").join(texts, ["s", "h", "h2", "chunk"]).drop("chunk"))
    return found.select("row", "epoch", "block", "slot", "place", "release", "deadline")


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None) -> DataFrame:
    """The mixture, with the columns of the documents, its files and their rows in the order of the
    schedule."""
    timed = schedule(docs, weights)
    return timed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select("row.*")
