"""MinHash near-dedup with tensored banding.

A document's set are its distinct two-word shingles. Two small collections of `SIDE` half-keys each
are made of `HALF` min-hashes apiece; every pair of a half-key of the first and one of the second
collection is the key of one table. SIDE**2 tables so need 2 * SIDE * HALF min-hashes only. Two
sets of similarity s miss each other in all tables with a chance of about
2 * (1 - s**HALF)**SIDE: 2e-4 at 0.8, 1e-5 at 0.85.

Steps, all of them joins and folds:

1. Equal sets are one class, known by its smallest id. From here on classes stand for documents.
2. Half-keys that one class alone has belong to no shared key. Classes get the keys of their other
   half-keys only; most get none.
3. Per table key, the smallest id is the hub; other classes of the key are compared with it. This
   emits one row per class and table, never the pairs of a group.
4. Pairs whose sizes rule the similarity out, or whose min-hashes agree far too rarely, are left
   out; the others are confirmed on their full sets, which are made once.
5. Confirmed links give components. Classes of keys that still hold several components are looked at
   once more. First by prefixes: with the shingles of a class in the order of how many of these classes
   have them, rarest first, two sets of similarity 0.8 share one of the first n - ceil(0.8 n) + 1.
   Only classes that share such a shingle with another component go on; what most texts share, as
   templates do, stands last in the order and brings none together. Then, by the half-keys of the first
   collection, every class is compared with every class of another component, in blocks of `BLOCK`
   classes, by sizes and min-hashes, and, if one is plausible, by the full sets. Only one link to its
   local component leaves a block per class, never the pairs. So a link is lost only if no table has
   it: within a component no link can change the result.

Every step that groups folds before it shuffles; a hot key is a skewed plain join at most, and the
blocks of a key's largest component meet only the classes outside of it.

Defined cases: a null, empty or wordless text has the empty set and is linked with nothing; rows
with equal ids are one document that holds all their texts, and each gets its row; a null id is
returned with its size and a null component, and kept; an empty table gives an empty result;
columns besides doc_id and text are ignored by `groups` and returned as they were by `keep_one`, to
which rows of different texts are different documents, whatever their ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crewlens.llm.components import components, own_exchange
from crewlens.llm.grouped import group_numbers, local_components, map_groups, neighbours
from crewlens.llm.shingles import MinHash, shingle_set
from crewlens.llm.tables import NOT_SPACES, python_ready
from crewlens.session import CODEC, passing, stored

SIDE = 9
HALF = 2
#: Min-hashes of which a byte each is the sketch; the half-keys are made of the first ones.
HASHES = 128
#: A pair of similarity 0.8 agrees in fewer of them with a chance of 3e-5.
LEAST_AGREEING = 84
BLOCK = 256
COLUMNS = 4096
SHARED, OF = 80, 100  # linked if OF * intersection >= SHARED * union


def sign(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, fingerprint of the set (null if empty), sketch (a byte of each min-hash),
    halves (the half-keys of both collections)."""
    hashes = MinHash(HASHES)

    def signed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text in frame["text"]:
                elements = shingle_set(text)
                if not len(elements):
                    rows.append((0, None, None, None))
                    continue
                least = hashes.signature(elements)
                halves = least[: 2 * SIDE * HALF].reshape(-1, HALF).astype(np.uint64)
                joined = halves[:, 0] << np.uint64(32) | halves[:, 1]
                rows.append((len(elements), xxhash.xxh3_128_digest(elements.tobytes()),
                             least.astype(np.uint8).tobytes(), joined.astype(np.int64)))
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "n_shingles": list(columns[0]), "fingerprint": list(columns[1]),
                                "sketch": list(columns[2]), "halves": list(columns[3])})

    schema = "doc_id bigint, n_shingles bigint, fingerprint binary, sketch binary, halves array<bigint>"
    return docs.select("doc_id", "text").mapInPandas(signed, schema)


def table_keys(classes: DataFrame) -> DataFrame:
    """id, key: one row per class and table, of half-keys that several classes have."""
    each = classes.select("id", F.posexplode("halves").alias("place", "half"))
    rows = stored(each.select("id", "place", "half", F.xxhash64("place", "half").alias("h")), "halves")
    shared = rows.groupBy("h").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b").select("h")
    own = F.struct("place", "half")
    both = rows.join(own_exchange(shared, "h"), "h").groupBy("id").agg(  # 2 * SIDE at most
        F.collect_list(F.when(F.col("place") < SIDE, own)).alias("first"),
        F.collect_list(F.when(F.col("place") >= SIDE, own)).alias("second"))
    paired = both.select("id", F.explode("first").alias("f"), "second").select("id", "f", F.explode("second").alias("s"))
    table = F.col("f.place") * SIDE + F.col("s.place") - SIDE
    return paired.select("id", F.xxhash64(table, "f.half", "s.half").alias("key"))


def plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and min-hashes do not rule out."""
    known = classes.select("id", "n_shingles", "sketch")
    side = lambda name: known.toDF(name, f"n_{name}", f"sketch_{name}")
    sized = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        OF * F.least("n_a", "n_b") >= SHARED * F.greatest("n_a", "n_b"))

    def agreeing(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                left, right = (np.frombuffer(b"".join(frame[c]), np.uint8).reshape(-1, HASHES)
                               for c in ("sketch_a", "sketch_b"))
                yield frame.loc[(left == right).sum(axis=1) >= LEAST_AGREEING, ["a", "b"]]

    return sized.select("a", "b", "sketch_a", "sketch_b").mapInPandas(agreeing, "a bigint, b bigint")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    side = lambda name: sets.select("id", "elements").toDF(name, f"set_{name}")

    def similar(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            linked = []
            for a, b in zip(frame["set_a"], frame["set_b"], strict=True):
                both = np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)])
                both.sort(kind="stable")  # two sorted runs
                shared = int((both[1:] == both[:-1]).sum())
                linked.append(OF * shared >= SHARED * (len(both) - shared))
            yield frame.loc[np.array(linked, bool), ["a", "b"]]

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "set_a", "set_b").mapInPandas(similar, "a bigint, b bigint").distinct()


def _sizes_fit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return OF * np.minimum(a, b) >= SHARED * np.maximum(a, b)


def _has_plausible(frame: pd.DataFrame) -> pd.DataFrame:
    """The rows with a plausible partner in another component."""
    sketches = np.frombuffer(b"".join(frame["sketch"]), np.uint8).reshape(len(frame), HASHES)
    component, size = frame["component"].to_numpy(), frame["n_shingles"].to_numpy()
    found = np.zeros(len(frame), bool)
    for a, b in neighbours(frame):
        fit = (component[a] != component[b]) & _sizes_fit(size[a], size[b])
        a, b = a[fit], b[fit]
        close = (sketches[a] == sketches[b]).sum(axis=1) >= LEAST_AGREEING
        found[a[close]] = found[b[close]] = True
    return frame.loc[found, ["key", "i", "j", "own", "id", "component"]]


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements every two sets share."""
    elements, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    common = np.cumsum(count > 1) - 1
    row, column = row[count[place] > 1], common[place[count[place] > 1]]
    total = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for low in range(0, int(common[-1]) + 1 if len(common) else 0, COLUMNS):
        some = slice(*np.searchsorted(column, [low, low + COLUMNS]))
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[row[some], column[some] - low] = 1
        total += held @ held.T
    return total.astype(np.int64)


def _links_across(frame: pd.DataFrame) -> pd.DataFrame:
    """Per row with a link to another component, the smallest id that it reaches here."""
    group = group_numbers(frame)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    out = [pd.DataFrame({"u": [], "v": []}).astype("int64")]
    for start, end in zip(starts, np.append(starts[1:], len(frame)), strict=True):
        rows = frame.iloc[start:end]
        sets = [np.frombuffer(s, np.uint64) for s in rows["elements"]]
        size, shared = np.array([len(s) for s in sets]), _shared(sets)
        linked = np.triu(OF * shared >= SHARED * (size[:, None] + size[None, :] - shared), 1)
        component = rows["component"].to_numpy()
        linked &= component[:, None] != component[None, :]
        a, b = np.nonzero(linked)
        if len(a):
            ids = rows["id"].to_numpy()
            least = local_components(ids, a, b)
            moved = least != ids
            out.append(pd.DataFrame({"u": ids[moved], "v": least[moved]}))
    return pd.concat(out)


def element_sets(texts: DataFrame) -> DataFrame:
    """id, fingerprint, elements: the sets of the rows' texts; an id with several texts has several."""
    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingle_set(t).tobytes() for t in frame["text"]]
            yield pd.DataFrame({"id": frame["doc_id"], "fingerprint": list(map(xxhash.xxh3_128_digest, sets)), "elements": sets})

    return texts.select("doc_id", "text").mapInPandas(made, "id bigint, fingerprint binary, elements binary")


def _exploded(sets: DataFrame) -> DataFrame:
    """id, set, component, key: a row per element, as a whole number."""
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sizes = frame["elements"].map(len) // 8
            keys = np.frombuffer(b"".join(frame["elements"]), np.int64)
            yield frame.drop(columns="elements").loc[np.repeat(frame.index, sizes)].assign(key=keys)

    schema = "id bigint, set bigint, component bigint, n_shingles bigint, key bigint"
    return sets.select("id", "set", "component", "n_shingles", "elements").mapInPandas(rows, schema)


def prefixes(sets: DataFrame) -> DataFrame:
    """id, set, key: of each set the elements of its prefix that classes of another component have,
    too. Elements are ordered by how many of the sets have them, then by value."""
    elements = stored(_exploded(sets), "elements")
    seen = stored(elements.groupBy("key").agg(
        F.count("*").alias("n"), F.min("component").alias("a"), F.max("component").alias("b")).filter("n > 1").select(
        "key", "n", (F.col("a") < F.col("b")).alias("across")), "seen")
    common = elements.join(own_exchange(seen, "key"), "key")
    of_set, size = Window.partitionBy("id", "set"), F.col("n_shingles")
    # Elements that no other set has come first in the order and use up places of the prefix.
    places = size - F.ceil(size * SHARED / OF) + 1 - (size - F.count("*").over(of_set))
    rank = F.row_number().over(of_set.orderBy("n", "key"))
    return common.select("id", "set", "key", "across", (places - rank).alias("left")).filter(
        (F.col("left") >= 0) & F.col("across")).select("id", "set", "key")


def links_across(members: DataFrame, found: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v: links that join components, of classes that share a table key."""
    placed = members.join(found.withColumnRenamed("u", "id"), "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("l"), F.max("component").alias("h")).filter("l < h")
    open_ids = placed.join(own_exchange(mixed.select("key"), "key"), "key").select("id", "component").distinct()
    known = open_ids.join(classes.select("id", "fingerprint", "n_shingles", "sketch", "halves"), "id")
    open_sets = stored(known.join(sets, ["id", "fingerprint"]).withColumn("set", F.xxhash64("fingerprint")).dropDuplicates(
        ["id", "set"]), "open")
    half = F.posexplode(F.slice("halves", 1, SIDE)).alias("place", "half")
    with passing(members.sparkSession) as keep:
        hopes = prefixes(open_sets).select("id", "set").distinct()
        met = open_sets.join(hopes, ["id", "set"], "left_semi").select("id", "component", "n_shingles", "sketch", half)
        rows = keep(stored(met.select("id", "component", "n_shingles", "sketch", F.xxhash64("place", "half").alias("key")), "met"))

    sizes = rows.groupBy("key", "component").count().groupBy("key").agg(
        F.max(F.struct("count", "component")).alias("main"), F.sum("count").alias("n"), F.count("*").alias("components"))
    blocks = sizes.filter("components > 1").select(
        "key", F.col("main.component").alias("main"),
        F.ceil(F.col("main.count") / BLOCK).cast("int").alias("p"),
        F.ceil((F.col("n") - F.col("main.count")) / BLOCK).cast("int").alias("q"))
    cut = rows.join(own_exchange(blocks, "key"), "key")
    is_main = F.col("component") == F.col("main")
    salt = F.xxhash64("id")
    # The largest component's blocks are -p to -1, the others' 0 to q - 1.
    own = F.when(is_main, F.pmod(salt, F.col("p")) - F.col("p")).otherwise(F.pmod(salt, F.col("q"))).cast("int")
    others = F.sequence(F.lit(0), F.col("q") - 1)
    partners = F.when(is_main, others).otherwise(F.concat(others, F.sequence(-F.col("p"), F.lit(-1))))
    paired = cut.select("key", "id", "component", "n_shingles", "sketch", own.alias("own"), F.explode(partners).alias("with")).select(
        "key", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "id", "component", "n_shingles", "sketch")
    hopeful = stored(map_groups(paired, _has_plausible, "key bigint, i int, j int, own int, id bigint, component bigint"), "hopeful")
    return stored(map_groups(hopeful.join(sets.drop("fingerprint"), "id"), _links_across, "u bigint, v bigint").distinct(), "links")


def _components(docs: DataFrame, signed: DataFrame) -> DataFrame:
    """u, component: the smallest id that each document reaches, for all but those smallest ones."""
    known = signed.filter("doc_id IS NOT NULL AND fingerprint IS NOT NULL")
    least = F.min(F.struct(F.col("doc_id").alias("id"), "n_shingles", "sketch", "halves")).alias("least")
    classes = stored(known.groupBy("fingerprint").agg(least).select("fingerprint", "least.*"), "classes")

    with passing(docs.sparkSession) as keep:
        keys = table_keys(classes)
        hubs = keys.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("top")).filter("hub < top").drop("top")
        members = keep(stored(keys.join(own_exchange(hubs, "key"), "key").select("key", "id", "hub"), "members"))
    needed = members.select(F.col("id").alias("doc_id")).distinct()
    texts = docs.select("doc_id", "text").join(needed, "doc_id", "left_semi")
    sets = stored(element_sets(texts), "sets")

    tried = members.filter("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    links = stored(confirmed(plausible(tried, classes), sets), "links").toDF("u", "v")
    copies = known.join(classes.select("fingerprint", "id"), "fingerprint").filter("doc_id <> id").select(
        F.col("doc_id").alias("u"), F.col("id").alias("v")).distinct()
    found = components(links.unionAll(copies))
    more = links_across(members, found, classes, sets)
    if not more.isEmpty():
        found = components(found.toDF("u", "v").unionAll(more))
    return found


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per input row."""
    python_ready(docs.sparkSession)
    with passing(docs.sparkSession) as keep:
        signed = keep(stored(sign(docs), "signed"))
        found = keep(_components(docs, signed))

    placed = signed.join(found.withColumnRenamed("u", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return placed.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _without_repeats(docs: DataFrame) -> DataFrame:
    """A column `own` that is the id, or where that is none or stands for several texts a hash of id
    and text; and of rows that repeat id and text one, the least by a hash of all columns. Rows
    without id and words all stay, with a null `own`."""
    th, has_words = F.xxhash64("text"), F.coalesce(F.col("text").rlike(NOT_SPACES), F.lit(False))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id"), th.alias("th"), has_words.alias("words"))
    texts = stored(rows.groupBy("doc_id", "th").agg(F.count("*").alias("n")), "texts_of_ids")
    # Stored, as only then their size is known before whole rows are shuffled to them.
    several = stored(texts.groupBy(F.col("doc_id").alias("d")).agg(F.count("*").alias("n")).filter(
        "d IS NOT NULL AND n > 1").select("d"), "ids_of_texts")
    own = F.when(F.col("doc_id").isNotNull() & F.col("d").isNull(), F.col("doc_id")).when(
        F.col("doc_id").isNotNull() | F.col("words"), F.shiftrightunsigned(F.xxhash64("doc_id", "th"), 1))
    named = rows.join(several, F.col("doc_id") == F.col("d"), "left").select("row", "doc_id", "th", own.alias("own"))
    often = stored(texts.filter("n > 1").select(F.col("doc_id").alias("d"), F.col("th").alias("t")), "often")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))
    once = named.join(often, same, "left_anti").select("row", "own")
    repeated = named.join(often, same, "left_semi")
    one = repeated.filter("own IS NOT NULL").groupBy("own").agg(
        F.min_by("row", F.xxhash64("row")).alias("row")).select("row", "own")
    return once.unionByName(one).unionByName(repeated.filter("own IS NULL").select("row", "own"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that stay: of each group the one with the smallest id, and of rows that repeat
    an id and text one. An id with several texts is as many documents, each known by a hash; so are
    documents without an id."""
    with passing(docs.sparkSession) as keep:
        rows = keep(stored(_without_repeats(docs), "documents", CODEC))
        dropped = groups(rows.select(F.col("own").alias("doc_id"), "row.text")).filter(~F.col("kept")).select(
            F.col("doc_id").alias("own"))
        dropped = keep(stored(dropped, "dropped"))
    return rows.join(dropped, "own", "left_anti").select("row.*")
