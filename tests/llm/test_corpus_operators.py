"""Near-dedup of texts and vectors, line dedup, mixing, packing and the pipeline."""

import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from crewlens.llm import components, embeddings, line_dedup, minhash, mixing, packing, queries, quality_rules
from crewlens.llm.tokens import Tokens
from crewlens.session import passing, shared_folder, stored
from tests.llm import plain
from tests.llm.odd import documents, odd_rows

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(queries.TOKENIZER)


def near_copies(seed=5, groups=14):
    """Texts and copies with more and more words changed, around the threshold; one large group."""
    draws = np.random.default_rng(seed)
    word = lambda: "w" + str(draws.integers(4000))
    rows = []
    for g in range(groups):
        base = [word() for _ in range(int(draws.integers(30, 200)))]
        for k in range(60 if g == 0 else int(draws.integers(1, 6))):
            text = list(base)
            for _ in range(k % 10 * len(base) // 100):
                text[int(draws.integers(len(text)))] = word()
            rows.append((100 * g + k, " ".join(text) if k % 2 else " ".join(text).upper(), f"s{g % 3}"))
    return rows


def test_near_copies_equal_a_plain_version(spark):
    rows = near_copies() + [(i if i is None else i + 5000, t, s) for i, t, s in odd_rows()]
    got = minhash.groups(documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain.near_copies([r[:2] for r in rows])
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_query_on_given_documents_equals_a_plain_version(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op5_minhash_dedup"](spark, folder).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain.near_copies(rows)


def test_one_of_each_group_stays(spark):
    rows = [(1, "a b c d e f", "x"), (2, "a b c d e f", "x"), (2, "a b c d e f", "x"), (3, "other words here now", "x"),
            (3, "other words here now", "x"), (4, None, None), (None, "a b c d e f", "x"), (None, None, None)]
    docs = documents(spark, rows)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 4, None])
    assert minhash.keep_one(docs.limit(0)).count() == 0


def test_whole_rows_meet_only_the_ids_that_repeat(spark):
    rows = [(k, f"text {k}", "s") for k in range(20_000)] + [(7, "text 7", "s"), (8, "another", "s")]
    docs = stored(documents(spark, rows), "docs")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        found = minhash._without_repeats(docs)
        joins = [x for x in found._jdf.queryExecution().executedPlan().toString().split("\n") if "Join" in x]
        assert len(joins) == 6 and not any("SortMergeJoin" in x for x in joins)
        got = found.select("row.doc_id", "row.text", "own").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert Counter((r.doc_id, r.text) for r in got) == Counter({(i, t) for i, t, _ in rows})
    assert {r.doc_id for r in got if r.own != r.doc_id} == {8}


def test_texts_stay_whatever_their_ids(spark):
    """One id for several texts, and no id: every text stays once, however the rows are dealt."""
    one, two, three = (" ".join(f"{n}{k}" for k in range(20)) for n in "abc")
    rows = [(1, one, "x"), (1, two, "x"), (1, two, "x"), (2, one, "y"), (None, three, "x"), (None, three, "x"), (None, three, "y"),
            (5, three, "x"), (None, "", "x"), (None, "", "x"), (None, None, "x"), (6, "", "x"), (6, "", "x"), (6, None, "x")]
    docs = documents(spark, rows)
    results = {tuple(sorted((str(r.doc_id), str(r.text), str(r.source)) for r in minhash.keep_one(d).collect()))
               for d in (docs, docs.repartition(7, "text"), docs.orderBy(F.desc("text")))}
    assert len(results) == 1
    kept = Counter((i, t) for i, t, _ in results.pop())
    assert sorted(t for (_, t), n in kept.items() for _ in range(n)) == sorted([one, two, three, "", "", "", "None", "None"])
    assert kept["6", ""] == 1 and kept["None", ""] == 2 and kept["None", "None"] == kept["6", "None"] == 1


def test_copies_without_an_id_lose_their_lines(spark):
    long, short = "\n".join(lines_of(30, 30, name="q")), "\n".join(lines_of(10, 20, name="r"))
    rows = [(None, long, "x"), (None, long, "y"), (None, long, "x"), (5, long, "x"), (5, long, "x"), (None, short, "x"), (None, short, "x")]
    for docs in (documents(spark, rows), documents(spark, rows).repartition(5)):
        assert Counter(r.text for r in line_dedup.clean(docs).collect()) == {long: 1, short: 2}
        marked = line_dedup.marked(docs).select("row.doc_id", "row.text", "runs").collect()
        assert len(marked) == len(rows) and sum(r.text == long and r.runs is None for r in marked) == 1


def test_short_templated_texts_are_not_compared_with_each_other(spark):
    """What most texts share brings none together, so the rows that are dealt grow with the texts."""
    counts = []
    for n in (500, 1000):
        rows = [(k, f"thank you very much dear w{k} and x{k} and z{k % 50} for your kind letter", "s") for k in range(n)]
        rows += [(n + k, rows[k][1] + ".", "s") for k in range(20)]
        docs = documents(spark, rows, False)
        signed = minhash.sign(docs)
        classes = signed.groupBy("fingerprint").agg(F.min(F.struct(F.col("doc_id").alias("id"), "n_shingles")).alias("l")).select(
            "fingerprint", "l.*").withColumn("component", F.col("id"))
        sets = classes.join(minhash.element_sets(docs), ["id", "fingerprint"]).withColumn("set", F.xxhash64("fingerprint"))
        counts.append(minhash.prefixes(sets).count())
        got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in minhash.groups(docs).collect())
        assert got == plain.near_copies([r[:2] for r in rows])
    assert counts[1] < 2.5 * counts[0]


def test_a_link_that_no_hub_sees_is_found(spark):
    """b and c are alike; the smallest id of their keys, a, is like neither."""
    words = [f"w{k}" for k in range(100)]
    a = words[:100]
    b = words[12:] + [f"x{k}" for k in range(12)]
    c = words[12:] + [f"x{k}" for k in range(8)] + [f"y{k}" for k in range(4)]
    rows = [(i, " ".join(t), "s") for i, t in ((1, a), (2, b), (3, c))]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in minhash.groups(documents(spark, rows)).collect())
    assert got == plain.near_copies([r[:2] for r in rows])
    assert {c for _, _, c in got} == {1, 2}


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(1, 200)] + [(2000, 2000)]
    found = components.components(spark.createDataFrame(edges, "u bigint, v bigint"))
    assert {tuple(r) for r in found.collect()} == {(k, 0) for k in range(1, 61)} | {(1000 + k, 1000) for k in range(1, 200)}


def test_vectors_equal_a_plain_version(spark):
    draws = np.random.default_rng(9)
    base = draws.normal(size=(12, 24))
    rows = [(k, (base[k % 12] + draws.normal(size=24) * 0.05 * (k % 4)).tolist()) for k in range(150)]
    rows += [(1000, rows[3][1]), (1001, rows[3][1]), (1002, (np.array(rows[4][1]) * 1e200).tolist()), (1003, [0.0] * 24),
             (1004, None), (1005, []), (1006, [1.0] + [None] * 23), (1007, [float("nan")] * 24), (1008, [float("inf")] * 24),
             (1009, rows[3][1] + [0.0]), (-5, rows[5][1]), (None, rows[5][1]), (1003, [0.0] * 24)]
    df = spark.createDataFrame([(i, v, None, "own") for i, v in rows], "vec_id bigint, embedding array<double>, label int, keys string")
    got = embeddings.groups(df).collect()
    want = plain.close_vectors(rows)
    assert Counter(r.vec_id for r in got) == Counter(i for i, _ in rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id) == want[r.vec_id], r
            assert r.kept == (r.vec_id == r.component_id)
    assert embeddings.groups(df.limit(0)).count() == 0


@pytest.mark.parametrize("count", [10, 10_000, 50_000, 10_000_000])
def test_recall_at_the_threshold(count):
    """At the settings for so many vectors, and few unrelated ones of equal key."""
    tables, number = embeddings.settings(count)
    draws, hashes = np.random.default_rng(1), embeddings.Hashes(64, tables, number)
    one, other = draws.normal(size=(2, 4000, 64))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    apart = other / np.linalg.norm(other, axis=1, keepdims=True)
    other -= (other * one).sum(axis=1, keepdims=True) * one
    other = 0.9 * one + np.sqrt(0.19) * other / np.linalg.norm(other, axis=1, keepdims=True)
    keys = hashes.keys(one)
    found = (keys == hashes.keys(other)).any(axis=1)
    near = np.bitwise_count(hashes.sketches(one) ^ hashes.sketches(other)).sum(axis=1) <= embeddings.FAR_BITS
    assert (found & near).mean() > 0.995
    met = (keys == hashes.keys(apart)).sum() / len(one)
    assert met < 5 * tables * embeddings._same_cell(0) ** number + 0.01


def test_settings_grow_slowly():
    work = []
    for count in (10**3, 10**4, 10**5, 10**6, 10**8, 10**10):
        tables, draws = embeddings.settings(count)
        work.append(tables * (embeddings.ROW_COST + count * embeddings._same_cell(0) ** draws))
    for (n, a), (m, b) in zip(zip((3, 4, 5, 6, 8), work), zip((4, 5, 6, 8, 10), work[1:]), strict=True):
        assert b / a < 10 ** (0.4 * (m - n))


def test_embedding_query_on_given_vectors_equals_a_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = queries.QUERIES["op4_embedding_dedup"](spark, "/root/testdata/sf0.01")
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    want = plain.close_vectors(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got.collect()} == want


def test_a_group_larger_than_a_block(spark, monkeypatch):
    """Tasks run this package's code as it is, so the block is set where the plan is built."""
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    draws = np.random.default_rng(2)
    one = draws.normal(size=16)
    rows = [(k, (one + draws.normal(size=16) * 0.02).tolist()) for k in range(100)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    want = plain.close_vectors([(r.vec_id, r.embedding) for r in df.collect()])
    assert {r.vec_id: (r.n_links, r.component_id) for r in embeddings.groups(df).collect()} == want


# -- line dedup ---------------------------------------------------------------------------------


def lines_of(*counts, name):
    return [" ".join(f"{name}{k}_{j}" for j in range(n)) for k, n in enumerate(counts)]


def test_repeated_runs_equal_a_plain_version(spark):
    passage, short = lines_of(20, 3, 15, 30, name="p"), lines_of(10, 12, name="s")
    one = lines_of(70, name="one")
    rows = [
        (1, lines_of(9, 40, name="a") + passage + lines_of(5, name="b")),
        (2, ["  " + x + "\t" for x in passage] + ["", " "] + lines_of(4, name="c")),
        (3, lines_of(8, name="d") + short + lines_of(6, name="e")),
        (4, short + lines_of(7, name="f")),
        (5, one + lines_of(3, name="g") + one + [""] + one + lines_of(2, name="h")),
        (6, lines_of(2, name="i") + one),
        (7, passage[1:3] + one + passage[2:]),
        (8, ["x"] * 300), (9, ["x"] * 40),
    ]
    rows = [(i, "\n".join(lines), "s") for i, lines in rows]
    docs = documents(spark, rows)
    got = {r.doc_id: {k for s in r.runs or [] for k in range(s.low, s.high)}
           for r in line_dedup.marked(docs).select("row.doc_id", "runs").collect()}
    want = plain.repeated_lines([r[:2] for r in rows])
    for i, text, _ in rows:
        lines = text.split("\n")
        assert {k for k in got[i] if lines[k].strip()} == want.get(i, set()), i
    cleaned = {r.doc_id: r for r in line_dedup.clean(docs).collect()}
    assert cleaned[2].text == rows[1][1].split("\n")[-1] and cleaned[2].n_chars == len(cleaned[2].text)
    assert cleaned[5].text.count("one0_0") == 1
    assert cleaned[4].text == rows[3][1]  # shorter than a run
    assert cleaned[1].text == rows[0][1]


def test_a_run_whose_fingerprints_stand_earlier_in_shorter_context(spark):
    """Every line is a gram of its own; whichever wins a window, its first place has no more of the run."""
    x, y, z = lines_of(30, 30, 30, name="x")
    fillers = lines_of(*[30] * 8, name="f")
    rows = [(10 * k + n - 100, [line, filler]) for k, line in enumerate((x, y, z)) for n, filler in enumerate(fillers)]
    rows += [
        (4, [x, y, z]), (5, [x, y]), (6, [y, z]), (7, [x, "own words", y, z]),
        (8, [z, x, "between", z, y, "between", z, x]),
        (9, lines_of(40, 10, 30, name="m")), (10, lines_of(40, 10, 30, name="m") + ["end"]),
    ]
    rows = [(i, "\n".join(lines), "s") for i, lines in rows]
    want = plain.repeated_lines([r[:2] for r in rows])
    for i, runs in line_dedup.marked(documents(spark, rows)).select("row.doc_id", "runs").collect():
        assert {k for s in runs or [] for k in range(s.low, s.high)} == want.get(i, set()), i
    assert want[5] == {0, 1} and want[6] == {0, 1} and want[8] == {6, 7}


def test_line_dedup_of_odd_rows(spark):
    docs = documents(spark, odd_rows())
    cleaned = line_dedup.clean(docs)
    assert cleaned.columns == docs.columns
    rows = {(r.doc_id, r.text) for r in cleaned.collect()}
    assert {(1, None), (2, ""), (3, " \t\n"), (4, "one"), (None, None)} <= rows
    assert any(i == 6 and len(t) > 300_000 for i, t in rows)
    assert line_dedup.clean(docs.limit(0)).count() == 0


def test_line_dedup_of_given_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = sorted(tuple(r) for r in docs.select("doc_id", "text").collect())
    want = plain.repeated_lines(rows)
    for r in line_dedup.marked(docs).select("row.doc_id", "row.text", "runs").collect():
        lines = r.text.split("\n")
        assert {k for s in r.runs or [] for k in range(s.low, s.high) if lines[k].strip()} == want.get(r.doc_id, set())


@pytest.mark.parametrize("stage", [line_dedup.marked, line_dedup.clean])
def test_line_dedup_needs_no_python(spark, stage):
    plan = stage(documents(spark, odd_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_texts_are_shuffled_to_few_runs_as_to_many(spark):
    docs = documents(spark, [(k, " ".join(f"w{n}" for n in range(60)) + f"\nown {k}", "s") for k in range(4)])
    for stage in (line_dedup.marked, line_dedup.clean):
        plan = stage(docs)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "LeftOuter" in plan.split("SortMergeJoin", 1)[1].split("\n")[0]
    assert sum(r.runs is not None for r in line_dedup.marked(docs).collect()) == 3


# -- mixing -------------------------------------------------------------------------------------


def test_schedule_keeps_every_source_near_its_target(spark):
    rows = [(k, f"t{k}", ["big", "big", "mid", "small", None][k % 5] if k < 400 else "big") for k in range(700)]
    weights = {"big": 0.5, "mid": 0.3, "small": 0.15, None: 0.05}
    made = mixing.schedule(documents(spark, rows), weights, block=2, cycle=100).select("row.doc_id", "row.source", "*").collect()
    assert {r.doc_id for r in made} == {r[0] for r in rows}
    owner = {}
    for r in made:
        assert owner.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
        assert r.release <= r.slot < r.deadline
    assert sorted(owner) == list(range(len(owner)))
    seen = Counter()
    for slot in range(len(owner)):
        seen[owner[slot][0]] += 1
        for source, weight in weights.items():
            assert abs(seen[source] - weight * (slot + 1)) < 1
    # Whole epochs come one after the other, and no document is left out of one before the end.
    times = defaultdict(Counter)
    for r in made:
        times[r.source][r.doc_id] += 1
    assert all(max(c.values()) - min(c.values()) <= 1 for c in times.values())


def test_schedule_keeps_unrounded_targets_over_many_segments(spark):
    """Targets that are no whole shares of a cycle, one of them far below a share."""
    rows = [(k, f"t{k}", "abcd"[min(k % 7, 3)] if k > 2 else "tiny") for k in range(9000)]
    weights = {"a": 1 / 3, "b": 0.2345678, "c": 0.0871, "d": 0.34, "tiny": 0.00037}
    made = mixing.schedule(documents(spark, rows, False), weights, block=1, cycle=100).select(
        "row.source", "slot", "release", "deadline", "row.doc_id").collect()
    assert {r.doc_id for r in made} == {r[0] for r in rows}
    assert len(made) > 10_000 and sorted(r.slot for r in made) == list(range(len(made)))
    seen, total = Counter(), sum(weights.values())
    for r in sorted(made, key=lambda r: r.slot):
        assert r.release <= r.slot < r.deadline
        seen[r.source] += 1
        assert all(abs(seen[s] - w / total * (r.slot + 1)) < 1 for s, w in weights.items())


def test_segments_meet_at_any_cut():
    draws = np.random.default_rng(4)
    for _ in range(60):
        weights = [int(w) for w in draws.integers(1, [3, 50, 10_000][int(draws.integers(3))], int(draws.integers(1, 40)))]
        weights += [w for w in weights if draws.random() < 0.5]
        total, at, seen = sum(weights), 0, [0] * len(weights)
        while at < 600:
            end = at + int(draws.integers(1, 120))
            for slot, s, block, release, deadline in mixing.segment(weights, at, end):
                assert block == seen[s] and release <= slot < deadline and slot == sum(seen)
                assert (release, deadline) == (block * total // weights[s], -(-(block + 1) * total // weights[s]))
                seen[s] += 1
            at = end


def test_copies_of_one_document_are_one_row_while_numbered(spark, monkeypatch):
    """A third of all rows are copies; each appears, in chunks."""
    monkeypatch.setattr(mixing, "TASK_ROWS", 50)
    monkeypatch.setattr(mixing, "CHUNK", 7)
    rows = [(1, "copied", "a")] * 300 + [(k, f"text {k}", "ab"[k % 2]) for k in range(2, 600)]
    docs = documents(spark, rows, False)
    made = mixing.schedule(docs, block=4).select("row.*", "epoch", "slot", "place", "block").collect()
    first = [r for r in made if r.epoch == 0]
    assert Counter((r.doc_id, r.text, r.source) for r in first) == Counter(rows)
    assert len({(r.slot, r.place) for r in made}) == len(made)
    blocks = Counter(r.block for r in first if r.source == "a")
    assert set(blocks.values()) <= {4, sum(blocks.values()) % 4}


def test_documents_of_one_id_are_numbered_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TASK_ROWS", 100)
    docs = documents(spark, [(None if k % 2 else 7, f"text {k}", "a") for k in range(2000)], False)
    assert docs.groupBy(mixing._range(20)).count().agg({"count": "max"}).first()[0] < 200
    made = mixing.schedule(docs).select("row.doc_id", "row.text", "block", "place").collect()
    assert len({r.text for r in made}) == len(made) == len({(r.block, r.place) for r in made}) == 2000
    mixed = {r.block for r in made if r.doc_id} & {r.block for r in made if r.doc_id is None}
    assert len(mixed) > 200  # 1 or none if ids are numbered one after the other
    assert max(r.block for r in made) == 2000 // mixing.BLOCK - 1


def test_mix_of_odd_rows(spark):
    rows = odd_rows()
    docs = documents(spark, rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter((r.doc_id, r.text, r.source) for r in mixed.collect())
    assert set(got) == set(rows) and all(got[r] >= n for r, n in Counter(rows).items())
    assert mixing.mix(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.schedule(docs, {"a": 0.0})


# -- packing ------------------------------------------------------------------------------------


def plain_ids(text):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_tokens_equal_the_tokenizer():
    texts = ["", None, "Hello's world's 'tis don't!! ABC123 x²½ ÀÉ ΑΣ Σ İstanbul ﬁ é क़ 한글 한", "a\x1cb\x1d c\x85d\xa0e f",
             "<|endoftext|> <|startoftext|>x", "x" * 5000, "🙂🙂 ok,", "..  ,, '' ' 's's", "ß ẞ ŒUVRE co-op www.x.com/a?b=1",
             "मराठी भाषा", "﻿bom ​zw", "a" * 1_100_000 + " b c"]
    made = Tokens(PATH).encode(texts)
    for text, ids in zip(texts[:-1], made[:-1], strict=True):
        assert ids.tolist() == plain_ids(text), text
    assert made[-1].tolist()[-2:] == plain_ids("b c")
    one = Tokens(PATH)
    one.known = {k: b"" for k in range(400_000)}  # forgets, and stays right
    assert one.encode(["the end"])[0].tolist() == plain_ids("the end")


def check_pieces(rows, pieces):
    """rows: (doc_id, text), each an own document."""
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_document[p.document].append(p)
        by_sequence[p.sequence_id].append(p)
    made = Counter()
    for own in by_document.values():
        own.sort(key=lambda p: p.start)
        assert [p.start for p in own] == list(np.cumsum([0] + [p.length for p in own])[:-1])
        made[(own[0].doc_id, b"".join(bytes(p.ids) for p in own))] += 1
        assert {p.doc_tokens for p in own} == {sum(p.length for p in own)} and {p.doc_id for p in own} == {own[0].doc_id}
    assert made == Counter((i, np.array(plain_ids(t) + [2], "<u4").tobytes()) for i, t in rows)
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == list(np.cumsum([0] + [p.length for p in own])[:-1])
        size = sum(p.length for p in own)
        assert size <= 4096 and size & (size - 1) == 0 and {p.tier for p in own} == {size}
    steps = defaultdict(set)
    for p in pieces:
        steps[p.step_id].add((p.sequence_id, p.tier))
    assert all(sum(t for _, t in s) <= packing.STEP_TOKENS and len({t for _, t in s}) == 1 for s in steps.values())


def test_pieces_hold_every_id_once(spark):
    rows = [r for r in odd_rows()] + [(100 + k, "word " * (k * 37 % 3000), "s") for k in range(60)]
    docs = documents(spark, rows).repartition(3)
    check_pieces([r[:2] for r in rows], packing.pack(docs, PATH).collect())
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_query_digests_pieces(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    ids = {i: np.array(plain_ids(t) + [2], "<u4") for i, t in docs.items()}
    for p in queries.QUERIES["op7_packing"](spark, FOLDER).collect():
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start: p.start + p.length].tobytes())
        assert p.doc_tokens == len(ids[p.doc_id])


# -- pipeline -----------------------------------------------------------------------------------


def test_every_stage_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, FOLDER).cache()
        rows, left = before.collect(), after.collect()
        if name != "packing":
            assert after.columns == columns
        if name == "quality_rules":
            judged = quality_rules.judge(quality_rules.measure(before, ["doc_id"])).select("row.doc_id", "kept").collect()
            kept = {r.doc_id for r in judged if r.kept}
            assert Counter(map(tuple, left)) == Counter(tuple(r) for r in rows if r.doc_id in kept)
        elif name == "line_dedup":
            removed = plain.repeated_lines(sorted((r.doc_id, r.text) for r in rows))
            for r in left:
                text = next(x.text for x in rows if x.doc_id == r.doc_id)
                gone = removed.get(r.doc_id, set())
                assert [x for x in r.text.split("\n") if x.strip()] == [
                    x for k, x in enumerate(text.split("\n")) if x.strip() and k not in gone]
                assert r.n_chars == len(r.text)
        elif name == "minhash_dedup":
            first = {i for i, _, c in plain.near_copies([(r.doc_id, r.text) for r in rows]) if i == c}
            assert Counter(map(tuple, left)) == Counter(tuple(r) for r in rows if r.doc_id in first)
        elif name == "mixing":
            assert set(map(tuple, left)) == set(map(tuple, rows))
        else:
            check_pieces([(r.doc_id, r.text) for r in rows], left)
        before = after


def test_stages_leave_only_what_their_results_read(spark):
    """Tables that a stage made on its way take no disk beside the next stages."""
    folder = Path(shared_folder(spark)) / "crewlens"
    there = lambda: {p.name for p in folder.iterdir()}
    docs, left, before = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}, there()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, FOLDER)
        left[name] = sorted(n.rsplit("-", 1)[0] for n in there() - before if not n.startswith("code"))
        docs, before = stored(made, name), there()
    assert left == {"quality_rules": [], "line_dedup": ["deleted", "without_id"], "minhash_dedup": ["documents", "dropped"],
                    "mixing": ["large", "placed"]}
    before = there()
    pieces = corpus_pipeline.run(spark, FOLDER)
    assert [n.rsplit("-", 1)[0] for n in there() - before if not n.startswith("code")] == ["mixing"]
    assert pieces.count() == packing.pack(docs, PATH).count()


def test_passing_keeps_what_a_frame_reads(spark):
    ids = lambda n: spark.range(n).toDF("id")
    with passing(spark) as keep:
        gone, empty = stored(ids(3), "gone"), keep(stored(ids(0), "empty"))
        with passing(spark) as keep_inner:
            inner = stored(ids(4), "inner")
            outer = keep_inner(stored(ids(5), "outer"))
            read = keep_inner(inner.filter("id > 1").join(stored(ids(3), "joined"), "id"))
        assert [r.id for r in read.collect()] == [2] and outer.count() == 5
        keep(read)
    assert read.count() == 1 and empty.count() == 0
    for frame in (gone, outer):
        assert not Path(frame.inputFiles()[0].removeprefix("file:")).exists()
    with pytest.raises(ZeroDivisionError), passing(spark):
        failed = stored(ids(2), "failed")
        1 / 0
    assert not Path(failed.inputFiles()[0].removeprefix("file:")).exists() and stored(ids(2), "after").count() == 2


def test_odd_rows_pass_every_stage(spark):
    docs = documents(spark, odd_rows())
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count()


def test_registered_queries_are_found(spark):
    import __spark_entry__ as registry

    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in registry.queries() if q.startswith("op")}
    assert "pipeline" in registry.queries()
