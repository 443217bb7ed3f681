"""Quality rules, chat formatting, HTML extraction and the two classifiers."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark import Broadcast
from pyspark.sql import functions as F

from crewlens.llm import chat, html_text, oracle, quality_classifier, quality_rules, queries, toxicity
from tests.llm.odd import SENTENCE, documents, odd_rows
from tools.check import TABLES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(oracle.QUERIES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = db.execute(oracle.QUERIES[name])
    columns = [d[0] for d in result.description]
    mine = queries.QUERIES[name](spark, FOLDER)
    assert sorted(mine.columns) == sorted(columns)
    assert Counter(map(tuple, mine.select(columns).collect())) == Counter(result.fetchall())


# -- quality rules ------------------------------------------------------------------------------


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


def test_measures_of_odd_texts(spark):
    rows = odd_rows()
    got = quality_rules.judge(quality_rules.measure(documents(spark, rows), ["doc_id"])).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    want = Counter()
    for i, text, _ in rows:
        m = plain_measures(text)
        want[(i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0])] += 1
    assert Counter(map(tuple, got)) == want


def test_rules_decide_and_columns_stay(spark):
    varied = " ".join(f"thing{k} of the place{k}" for k in range(24)) + " and so on it is with us for now"
    rows = [(1, varied, "a"), (2, varied.replace(" ", "### "), "a"), (3, varied.upper(), "a"), (4, "short text", "a")]
    docs = documents(spark, rows)
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.collect()] == [1]
    broken = quality_rules.judge(quality_rules.measure(docs, ["doc_id"])).select("row.doc_id", "broken_rules").collect()
    assert dict(map(tuple, broken))[2] == ["symbols_per_word", "stop_words_per_word"]
    assert quality_rules.keep(docs.limit(0)).count() == 0


def test_rules_need_no_python(spark):
    plan = quality_rules.keep(documents(spark, odd_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan


# -- chat ---------------------------------------------------------------------------------------


def messages(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


TRICKY = [r"\### Assistant: </turn> ok", "a\\", "\\\\#", "### x: y </turn>\n### user: z </turn>\n", "", None,
          "<|image:1|> <\\|", "c:\\c \\c: $1 \\$", " </turn>\n", "ñ 🙂\n\n"]


def test_chat_round_trip(spark):
    rows = [(k, t, ["user", "assistant", "odd: role\\c#", None][(k + t) % 4], TRICKY[(k + t * 3) % len(TRICKY)])
            for k in range(20) for t in range(7)]
    rows += [(None, 0, "assistant", "no id"), (50, None, "user", "no turn"), (50, 0, "assistant", "x" * 200_000)]
    df = messages(spark, rows).selectExpr("*", "'own' AS formatted", "1 AS turns")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chat(chat.text_messages(df))).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_control_strings_only_come_from_the_template(spark):
    rows = [(1, t, "user", text) for t, text in enumerate(TRICKY)]
    made = chat.format_chat(chat.text_messages(messages(spark, rows))).first()
    assert made.formatted.count("### ") == made.formatted.count("</turn>") == len(TRICKY)
    assert "<|" not in made.formatted
    assert chat.format_chat(chat.text_messages(messages(spark, []))).count() == 0


def test_parts_become_placeholders_and_attachments(spark):
    part = chat.PART_TYPE
    made = chat.format_chat(spark.sql(f"""
        SELECT 1L AS conv_id, 0L AS turn, 'user' AS role, array(
          cast(named_struct('type', 'text', 'text', 'see <|', 'uri', null, 'width', null, 'height', null, 'seconds', null, 'pages', null) AS {part}),
          cast(named_struct('type', 'image', 'text', null, 'uri', 'i.png', 'width', 57, 'height', 28, 'seconds', null, 'pages', null) AS {part}),
          cast(null AS {part}),
          cast(named_struct('type', 'audio', 'text', null, 'uri', 'a.wav', 'width', null, 'height', null, 'seconds', 1.5, 'pages', null) AS {part}),
          cast(named_struct('type', 'document', 'text', null, 'uri', 'd.pdf', 'width', null, 'height', null, 'seconds', null, 'pages', 2) AS {part}),
          cast(named_struct('type', 'other', 'text', 'lost', 'uri', null, 'width', null, 'height', null, 'seconds', null, 'pages', null) AS {part})
        ) AS parts""")).first()
    assert made.formatted == "### user: see <\\|<|image:2|><|audio:4|><|document:5|> </turn>\n"
    assert [(a.part, a.type, a.uri, a.tokens) for a in made.attachments] == [
        (2, "image", "i.png", 3), (4, "audio", "a.wav", 38), (5, "document", "d.pdf", 800)]
    assert made.expanded_tokens == 841


# -- pages --------------------------------------------------------------------------------------

PROSE = "This paragraph tells a part of the story, at some length and with a comma or two, as prose does."


def test_pages(spark):
    article = f"<h1>Title &amp; more</h1><p>{PROSE}</p><p>Short.</p><p>{PROSE} <a href='/x'>more</a></p>"
    want = f"Title & more\n\n{PROSE}\n\nShort.\n\n{PROSE} more"
    around = "<nav><ul><li><a href='/'>Home</a></ul></nav><script>var a='<p>no</p>';</script>"
    pages = {
        1: f"<html><head><title>t</title></head><body>{around}<article>{article}</article><footer>&copy; us</footer></body></html>",
        2: f"<body class='has-sidebar'><div id='header'>Site</div>{around}<div class='content with-sidebar'>{article}</div>"
           f"<div id='sidebar'><p>{PROSE}</div><div class='comments'><p>{PROSE}</p></div><p>All rights reserved.</p>",
        3: f"{around}<article><header><h1>Title &#38; more</h1></header><aside>{PROSE}</aside><p>{PROSE}<p>Short.<div class='ad'>"
           f"{PROSE}</div><p>{PROSE}\n <a>more</a><section class='comments'><article class='comment'>{PROSE}</article></section></article>",
        9: f"{around}<main><header><h1>Site name</h1></header><p class='notice'>{PROSE}</p><article class='post'>{article}"
           f"<span class='share'>Share</span></article></main><aside><article>{PROSE}</article></aside>",
        10: f"{around}<div role='main'>{article}</div><p>{PROSE}</p>",
        4: None, 5: "", 6: "<p", 7: "<!-- only a comment", 8: around,
    }
    df = spark.createDataFrame([(k, f"u{k}", v, "own") for k, v in pages.items()] + [(None, None, None, None)],
                               "page_id bigint, url string, html string, text string")
    got = {r.page_id: r for r in html_text.extract(df).collect()}
    for k in (1, 2, 3, 9, 10):
        assert got[k].text == want, k
        assert got[k].n_chars == len(want)
    assert all(got[k].text == "" for k in (4, 5, 6, 7, 8, None))
    assert html_text.extract(df.limit(0)).count() == 0


def test_links_in_a_marked_part_and_short_stretches_stay():
    links = "".join(f"<li><a href='/{k}'>Item {k}</a></li>" for k in range(6))
    items = [f"Item {k}" for k in range(6)]
    body = f"<h1><a href='/'>Title</a></h1><p>{PROSE}</p><ul>{links}</ul><p>{PROSE}</p><p><a href='/'>Last link</a></p>"
    want = "\n\n".join(["Title", PROSE, *items, PROSE, "Last link"])
    aside = "<aside><p>An advert</p><p>of two lines</p><p>or three</p><p>or four</p></aside>"
    for part in ("<article>{}</article>", "<main>{}</main>", "<div itemprop='articleBody'>{}</div>"):
        assert html_text.main_text(f"<nav><a href='/'>Home</a></nav>{part.format(body + aside)}<p>Away</p>") == want
    assert html_text.main_text(f"<article><p><a href='/'>{PROSE}</a></p></article>") == PROSE
    # Without such a part: what is short stays, on both sides of a notice; a long run of links goes.
    page = f"<div><h2>A heading</h2>{aside}<p>Short.</p>{aside}<p>{PROSE}</p>{aside}<p>Shorter.</p></div><ul>{links}</ul>"
    assert html_text.main_text(page) == "\n\n".join(["A heading", "Short.", PROSE, "Shorter."])
    page = f"<ul>{links}</ul><p>{PROSE}</p><ul><li><a>One</a></li><li><a>Two</a></li><li><a>Three</a></li></ul><p>End.</p>"
    assert html_text.main_text(page) == "\n\n".join([PROSE, "One", "Two", "Three", "End."])


def test_owners_are_named_before_or_after_the_text():
    items = ["(a) One", "(b) Two", "(c) Three", "Copyright law is old.", "© is a sign.", "All rights reserved is a phrase."]
    body = "".join(f"<p>{x}</p>" for x in [PROSE, *items, PROSE])
    want = "\n\n".join([PROSE, *items, PROSE])
    for mark in ("&copy; us", "(c) 2020 us", "Copyright 2019-2020 by us", "Copyright (c) us", "All rights reserved."):
        assert html_text.main_text(f"<p>{mark}</p>{body}<p>{mark}</p><p>{mark}</p>") == want, mark
    assert html_text.main_text(f"<p>{PROSE}</p><p>(a) One</p><p>(b) Two</p><p>(c) Three</p>").endswith("(c) Three")
    assert html_text.main_text(f"<p>Copyright law is old.</p><p>{PROSE}</p>").startswith("Copyright law")


def test_given_articles_are_whole():
    import html

    for page, in duckdb.sql(f"SELECT html FROM '{FOLDER}/pages.parquet'").fetchall():
        body = re.search(r"<article>(.*)</article>", page, re.S)[1].replace("<br>", " ")
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", body)]
        assert html_text.main_text(page) == "\n\n".join(b for b in blocks if b)


def test_a_very_long_page_is_read_whole():
    page = "<article>" + f"<p>{PROSE}</p>" * 20_000 + "</article>"
    assert html_text.main_text(page).count(PROSE) == 20_000


# -- classifiers --------------------------------------------------------------------------------


def labelled(spark):
    draws = np.random.default_rng(3)
    syllables = "ba be bi bo bu da de di do du ka ke ki ko ku".split()
    word = lambda: "".join(draws.choice(syllables, draws.integers(2, 5)))
    rows, labels = [], []
    for i in range(400):
        words = [word() for _ in range(draws.integers(10, 120))]
        toxic, bad = i % 5 == 0, i % 4 == 0
        if toxic:
            words.insert(int(draws.integers(len(words))), "xyzzyfrotz")
        if bad:
            words = [w + "$$$" for w in words]
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(toxic), int(not bad)))
    return rows, spark.createDataFrame(labels, "doc_id bigint, toxic int, quality int")


@pytest.mark.parametrize("operator, column, threshold", [(toxicity, "toxic", 0.5), (quality_classifier, "quality", 0.7)])
def test_classifiers_on_held_out_rows(spark, operator, column, threshold):
    rows, labels = labelled(spark)
    odd = [(i if i is None else i + 1000, t, s) for i, t, s in odd_rows()]
    docs = documents(spark, rows + odd)
    known = labels.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).select("doc_id", F.col(column).alias("label"))
    known = known.unionByName(spark.createDataFrame([(1001, 0), (1002, 1), (None, 1), (1006, None)], known.schema))
    scored = operator.score(docs, operator.fit(docs, known)).collect()
    assert Counter(r.doc_id for r in scored) == Counter(i for i, _, _ in rows + odd)
    assert all(0 <= r.score <= 1 for r in scored)
    truth = {r.doc_id: r[column] for r in labels.collect()}
    held = [r for r in scored if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = [(r.score >= threshold) == (truth[r.doc_id] == 1) for r in held]
    assert len(held) > 50 and np.mean(right) > 0.95
    empty = operator.score(docs.limit(0), operator.fit(docs, known.limit(0)))
    assert empty.count() == 0
    assert {r.score for r in operator.score(docs, operator.fit(docs, known.limit(0))).collect()} == {0.5}


def test_a_long_text_is_read_to_its_end():
    settings = toxicity.Settings()
    head = "ab " * 100_000
    assert set(toxicity.feature_ids("xyzzyfrotz", settings)) <= set(toxicity.feature_ids(head + " xyzzyfrotz", settings))
    settings = quality_classifier.Settings()
    assert set(quality_classifier.features("xyzzyfrotz", settings)[0]) <= set(quality_classifier.features(head + " xyzzyfrotz", settings)[0])
    ids, values = quality_classifier.features(SENTENCE, quality_classifier.Settings())
    assert len(ids) == len(values) and np.isclose(np.sqrt((values**2).sum()), quality_classifier.Settings().length)


@pytest.mark.parametrize("operator", [toxicity, quality_classifier])
def test_a_repeated_id_is_learnt_once(spark, operator, monkeypatch):
    learnt = []
    monkeypatch.setattr(operator, "fit_features", lambda rows, *_: learnt.append(rows.count()))
    docs = documents(spark, [(k % 4 if k < 8 else 0, f"text {k}" if k else None, "s") for k in range(200)])
    operator.fit(docs, spark.createDataFrame([(k, k % 2) for k in range(4)], "doc_id bigint, label int"))
    assert learnt == [4]


def plain_toxicity(rows, settings):
    """rows: (label, text). Naive Bayes ratios and logistic regression over a dictionary of n-grams, as
    the operator's over hashes, for texts whose n-grams fall on ids of their own."""
    def grams(text):
        padded = " " + text.lower() + " "
        return sorted({padded[k:k + n] for n in settings.sizes for k in range(len(padded) - n + 1)})

    sets = [grams(t) for _, t in rows]
    names = sorted(set().union(*sets))
    x = np.array([[g in set(s) for g in names] for s in sets], float)
    y = np.array([label for label, _ in rows], float)
    size = 1 << settings.bits
    own, other = (x[y == k].sum(axis=0) + settings.smoothing for k in (1, 0))
    rest = (size - len(names)) * settings.smoothing  # ids that no n-gram has
    ratio = np.log(own / (own.sum() + rest)) - np.log(other / (other.sum() + rest))
    ratio[own + other <= 2 * settings.smoothing + 2] = 0
    x = x * ratio / np.sqrt(max(1.0, ((x * ratio) ** 2).sum() / len(x)))
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w, b, m, v = np.zeros(len(names)), 0.0, 0, 0
    for turn in range(1, settings.rounds + 1):
        error = (1 / (1 + np.exp(-(x @ w + b))) - y) * share
        slope = np.append(x.T @ error + settings.penalty * w / len(names), error.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        move = settings.step * m / (1 - 0.9**turn) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return 1 / (1 + np.exp(-(x @ w + b)))


def test_toxicity_equals_a_plain_version(spark):
    draws = np.random.default_rng(8)
    rows = [(k, " ".join(draws.choice(["foul", "vile", "kind", "good", "calm", "nice"], 6, p=p)), "s")
            for k, p in ((k, [0.3, 0.2, 0.2, 0.1, 0.1, 0.1] if k % 3 == 0 else [0.05, 0.05, 0.3, 0.3, 0.2, 0.1]) for k in range(60))]
    settings = toxicity.Settings(rounds=25)
    grams = {t[k:k + n] for _, x, _ in rows for t in [f" {x} "] for n in settings.sizes for k in range(len(t) - n + 1)}
    assert len(set().union(*(toxicity.feature_ids(x, settings).tolist() for _, x, _ in rows))) == len(grams)
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k, _, _ in rows], "doc_id bigint, label int")
    docs = documents(spark, rows)
    got = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels, settings)).collect()}
    want = plain_toxicity([(int(k % 3 == 0), t) for k, t, _ in rows], settings)
    assert max(abs(got[k] - w) for (k, _, _), w in zip(rows, want, strict=True)) < 1e-4


def test_rounds_move_only_features_with_a_ratio_and_leave_nothing(spark, monkeypatch):
    moved, sent, gone, own = [], [], [], toxicity._summed
    monkeypatch.setattr(toxicity, "_summed", lambda *a: moved.append(own(*a)) or moved[-1])
    make, destroy = type(spark.sparkContext).broadcast, Broadcast.destroy
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda sc, value: sent.append(make(sc, value)) or sent[-1])
    monkeypatch.setattr(Broadcast, "destroy", lambda b, *a: gone.append(b) or destroy(b, *a))
    rows = [(k, "foul words" if k % 3 == 0 else "kind words here", "s") for k in range(30)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k, _, _ in rows], "doc_id bigint, label int")
    settings = toxicity.Settings(rounds=3)
    model = toxicity.fit(documents(spark, rows), labels, settings)
    live = np.flatnonzero(model.weights)
    assert 0 < len(live) < 100 and len(moved) == 4
    assert all(len(live) < len(sums) < 100 for sums in moved[1:])
    assert len(sent) >= settings.rounds and {id(b) for b in sent} == {id(b) for b in gone}


def plain_ftrl(rows, settings):
    """rows: (label, {feature: value}) in order. Weights by FTRL-proximal updates, one number at a time."""
    z, n = Counter(), Counter()

    def weight(f):
        l1 = 0 if f == "intercept" else settings.l1
        if abs(z[f]) <= l1:
            return 0.0
        return -(z[f] - np.sign(z[f]) * l1) / ((settings.beta + np.sqrt(n[f])) / settings.alpha + settings.l2)

    for _ in range(settings.passes):
        for label, x in rows:
            x = {**x, "intercept": 1.0}
            w = {f: weight(f) for f in x}
            p = 1 / (1 + np.exp(-sum(w[f] * v for f, v in x.items())))
            for f, v in x.items():
                g = (p - label) * v
                z[f] += g - (np.sqrt(n[f] + g * g) - np.sqrt(n[f])) / settings.alpha * w[f]
                n[f] += g * g
    return {f: weight(f) for f in z}


def test_quality_model_equals_a_plain_version(spark):
    rows, labels = labelled(spark)
    rows, settings = rows[:80], quality_classifier.Settings(passes=2)
    docs = documents(spark, rows)
    known = labels.filter("doc_id < 80").select("doc_id", F.col("quality").alias("label"))
    model = quality_classifier.fit(docs, known, settings)
    texts = {i: t for i, t, _ in rows}
    order = [(r.label, quality_classifier.features(texts[r.doc_id], settings)) for r in known.orderBy(F.xxhash64("doc_id")).collect()]
    want = plain_ftrl([(y, dict(zip(i.tolist(), v.tolist()))) for y, (i, v) in order], settings)
    assert abs(model.intercept - want.pop("intercept")) < 1e-9
    assert {int(k) for k in np.flatnonzero(model.weights)} == {f for f, w in want.items() if np.float32(w)}
    assert all(abs(model.weights[f] - w) < 1e-6 for f, w in want.items())


@pytest.mark.parametrize("name, folds, held, threshold", [("op1_toxicity", 5, 0, 0.5), ("op3_quality_classifier", 4, 2, 0.7)])
def test_classifier_queries_hold_out_by_the_id(spark, name, folds, held, threshold):
    got = queries.QUERIES[name](spark, FOLDER)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held)
        assert r.predicted == int(r.score >= threshold) and 0 <= r.score <= 1


# -- pages told apart by their line blocks --------------------------------------------------------


def given_pages(spark):
    return [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]


CHANGED_PAGES = {
    "a form around the page": lambda p: p.replace("<body>", "<body><form action='/x'>", 1).replace("</body>", "</form></body>"),
    "a wrapper with a name": lambda p: p.replace("<body>", "<body><div class='modal-overlay page'>", 1).replace("</body>", "</div></body>"),
    "a quote in a value": lambda p: p.replace("<p>", "<p class=x'>"),
}


@pytest.mark.parametrize("kind", CHANGED_PAGES)
def test_markup_around_the_main_text_changes_nothing(spark, kind):
    for page in given_pages(spark):
        assert html_text.main_text(CHANGED_PAGES[kind](page)) == html_text.main_text(page)


def test_line_blocks_find_the_main_text_without_tags_or_names(spark):
    """No article, main, nav or the like, and no classes: all blocks of the main text are found,
    but for owner lines at its ends, and little else."""
    found = missed = extra = 0
    for page in given_pages(spark):
        bare = re.sub(r' (class|id|role)="[^"]*"', "", page)
        bare = re.sub(r"(</?)(article|main|nav|aside|header|footer|form|section)\b", r"\1div", bare)
        want, got = (html_text.main_text(p).split("\n\n") for p in (page, bare))
        found += len(want)
        missed += sum(b not in got for b in want if not html_text.OWNERS.match(b))
        extra += sum(len(b) for b in got if b not in want) / max(1, sum(map(len, want)))
    assert missed == 0 and found > 1000
    assert extra / 250 < 0.3


def test_weights_decide_and_not_the_tag(spark):
    small = "<article><p>Menu of the day</p></article>"
    rest = f"<h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p><p>Short.</p>"
    assert html_text.main_text(f"<div>{rest}</div>{small}").startswith("Title")
    assert html_text.main_text(f"<article><p>{PROSE}</p></article><p>{PROSE}</p>") == PROSE
    # Links weigh nothing but within a stretch; a menu apart from it is left out.
    menu = "".join(f"<li><a href='/{k}'>Item {k}</a></li>" for k in range(9))
    assert html_text.main_text(f"<ul>{menu}</ul>{rest}<ul>{menu}</ul>") == "\n\n".join(["Title", PROSE, PROSE, "Short."])


def test_wrappers_and_comments(spark):
    comments = "<div class='comments'>" + f"<p>{PROSE}</p>" * 30 + "</div>"
    assert html_text.main_text(f"<p>Short text.</p>{comments}") == "Short text."
    assert html_text.main_text(comments) == ""
    assert html_text.main_text(f"<form><div class='modal page'><p>Hello</p>{comments}</div></form>") == "Hello"
    assert html_text.main_text(f"<div class='cookie-notice'>{PROSE}</div><p>{PROSE} {PROSE}</p>") == f"{PROSE} {PROSE}"
    assert html_text.main_text("<form><article><p>One</p></article></form>") == "One"
    assert html_text.main_text("<nav><p>One</p></nav>") == ""


def test_attributes_are_read_as_browsers_do():
    assert html_text.main_text("<p class=x'>Hello</p><p>It's fine</p>") == "Hello\n\nIt's fine"
    assert html_text.main_text('<p title="no end>Hello</p><p>There</p>') == "Hello\n\nThere"
    assert html_text.main_text("<p title='a > b' data-x=\"<p>\">Hello</p>") == "Hello"
    assert html_text.main_text("<p a=b/c d = 'e' =f \"g>Hello</p>") == "Hello"
    assert html_text.main_text("<p>Hello<p class='") == "Hello"


def test_html_query_returns_every_page_in_its_columns(spark):
    got = queries.QUERIES["op8_html_extraction"](spark, "/root/testdata/sf0.01")
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(pages) and all(r.text == html_text.main_text(pages[r.page_id]) for r in rows)
    assert all(r.n_chars == len(r.text) for r in rows)
