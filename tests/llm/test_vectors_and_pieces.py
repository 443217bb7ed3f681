"""Whitening, hard negatives and SentencePiece, against plain versions and the library itself."""

import hashlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from crewlens.llm import negatives, pieces, polynomial, queries, whitening
from tests.llm.odd import documents, odd_rows

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(queries.PIECES)
VECTORS = "vec_id bigint, embedding array<double>, label int, x string, cluster string, rank string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "own", "own", "own") for i, v, label in rows], VECTORS)


def odd_vectors(length):
    whole = [0.25] * length
    return [
        (None, whole, 1), (9001, None, 1), (9002, [], 1), (9003, [0.5] * (length - 1) + [None], 1),
        (9004, [float("nan")] + whole[1:], 1), (9005, [float("inf")] + whole[1:], 1), (9006, whole + [1.0], 1),
        (9007, [0.0] * length, 1), (9008, [-0.001] * length, 2), (9009, whole, None),
    ]


# -- polynomial and whitening ----------------------------------------------------------------------


def eigen(matrix, count):
    trace = sum(matrix[k][k] for k in range(len(matrix)))
    moduli = polynomial.primes(polynomial.coefficient_bits(trace, len(matrix)))
    coefficients = polynomial.combined(polynomial.residues(matrix, moduli).tolist(), moduli)
    roots, power = polynomial.largest_roots(coefficients, count, trace)
    return coefficients, [Fraction(r, 1 << power) for r in roots], polynomial.vectors(matrix, roots, power)


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 9), st.integers(1, 12), st.sampled_from([1, 3, 1000, 10**9]))
def test_eigenvalues_of_random_matrices(seed, size, rows, scale):
    draws = np.random.default_rng(seed)
    a = [[int(x) for x in row] for row in draws.integers(-scale, scale + 1, (rows, size))]
    matrix = [[sum(r[i] * r[j] for r in a) for j in range(size)] for i in range(size)]
    if not any(matrix[k][k] for k in range(size)):
        return
    coefficients, roots, found = eigen(matrix, 4)
    # The polynomial at whole points is the determinant, computed exactly in another way.
    for point in (0, 1, -7):
        assert sum(c * point**k for k, c in enumerate(coefficients)) == determinant(
            [[(point if i == j else 0) - matrix[i][j] for j in range(size)] for i in range(size)])
    want = np.linalg.eigvalsh(np.array(matrix, float))[::-1]
    assert np.allclose([float(r) for r in roots], want[: len(roots)], rtol=1e-9, atol=want[0] * 1e-12)
    assert len(roots) == min(4, np.linalg.matrix_rank(np.array(matrix, float), tol=want[0] * 1e-11))
    v = np.array(found)
    assert np.allclose(v @ v.T, np.eye(len(v)), atol=1e-14)
    for r, x in zip(roots, v, strict=True):
        assert np.abs(np.array(matrix, float) @ x - float(r) * x).max() <= 1e-13 * want[0]


def determinant(matrix):
    """By elimination in fractions."""
    a, out = [[Fraction(x) for x in row] for row in matrix], Fraction(1)
    for k in range(len(a)):
        pivot = next((i for i in range(k, len(a)) if a[i][k]), None)
        if pivot is None:
            return 0
        if pivot != k:
            a[k], a[pivot], out = a[pivot], a[k], -out
        out *= a[k][k]
        for i in range(k + 1, len(a)):
            f = a[i][k] / a[k][k]
            a[i] = [x - f * y for x, y in zip(a[i], a[k], strict=True)]
    return out


def test_equal_and_close_eigenvalues():
    _, roots, found = eigen(np.diag([5, 5, 5, 2, 0, 0]).tolist(), 4)
    assert roots == [5, 5, 5, 2]
    assert np.allclose(np.array(found) @ np.array(found).T, np.eye(4), atol=1e-15)
    big = 10**40
    _, roots, found = eigen([[big + 1, 0, 0], [0, big, 0], [0, 0, 7]], 3)
    assert [round(r) for r in roots] == [big + 1, big, 7]
    assert np.allclose(np.abs(found), np.eye(3), atol=1e-15)


def plain_whitening(rows, length, count=4):
    real = [(i, [int(np.floor(256 * c)) for c in v]) for i, v, _ in rows
            if v is not None and len(v) == length and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted(set(tuple(x) for _, x in real)))
    n, sums = len(fit), fit.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(length, length))
    out = {}
    for i, x in real:
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(x, sums, strict=True))
        out.setdefault(i, []).append((n, deviation, ((x - sums / n) @ axes[:, ::-1][:, :count]) / np.sqrt(values[::-1][:count])))
    return out, values[::-1][:count] / values.sum()


def check_whitening(got, want, shares):
    signs, seen = {}, defaultdict(int)
    for r in got:
        n, deviation, white = want[r.vec_id][0]
        reference = white[r.component - 1]
        if abs(reference) > 1e-3:
            assert signs.setdefault(r.component, np.sign(reference * r.whitened)) == np.sign(reference * r.whitened)
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(abs(reference) - abs(r.whitened)) < 1e-9
        assert abs(r.explained - shares[r.component - 1]) < 1e-12 and r.identity_error < 1e-9
        seen[r.vec_id] += 1
    assert seen == {i: len(shares) * len(w) for i, w in want.items()}


def test_whitening_equals_a_plain_version(spark):
    draws = np.random.default_rng(3)
    rows = [(k, (draws.normal(size=6) * [3, 2, 1, 1, 0.5, 0.2]).tolist(), 1) for k in range(120)]
    rows += [(200 + k, rows[0][1], 1) for k in range(60)] + [rows[1], rows[1]] + odd_vectors(6)
    got = whitening.whitened(vectors(spark, rows)).collect()
    check_whitening(got, *plain_whitening(rows, 6))


def test_whitening_query_on_given_vectors(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = queries.QUERIES["op11_whitening"](spark, FOLDER)
    assert dict(got.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double"}
    check_whitening(got.collect(), *plain_whitening(rows, 64))


def test_whitening_of_few_and_large_values(spark):
    one = vectors(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)])
    assert whitening.whitened(one).count() == 0
    assert whitening.whitened(one.limit(0)).count() == 0
    line = whitening.whitened(vectors(spark, [(1, [0.0, 0.0], 1), (2, [1.0, 1.0], 1), (2, [1.0, 1.0], 1)])).collect()
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 12), r.explained) for r in line) == [
        (1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]
    large = whitening.whitened(vectors(spark, [(1, [1e12, 3.0], 1), (2, [-1e12, 5.0], 1), (3, [1e300, 5.0], 1)])).collect()
    assert {r.vec_id for r in large} == {1, 2}
    x, y = 256 * 10**12, 256
    assert all(r.deviation == (2 * x) ** 2 + (2 * y) ** 2 for r in large)
    assert all(abs(abs(r.whitened) - 1) < 1e-9 for r in large if r.component == 1)


# -- hard negatives --------------------------------------------------------------------------------


def plain_negatives(rows, anchors):
    length = 8
    real = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or len(v) != length or any(c is None or not np.isfinite(c) for c in v):
            continue
        x = tuple(int(np.floor(256 * c)) for c in v)
        real[i] = min(real.get(i, (x, str(label))), (x, str(label)))
    ids = np.array(sorted(real))
    table = np.array([real[i][0] for i in ids.tolist()])
    labels = np.array([real[i][1] for i in ids.tolist()])
    out = set()
    for i in anchors:
        if i not in real:
            continue
        scores = table @ np.array(real[i][0])
        order = sorted(range(len(ids)), key=lambda k: (-scores[k], ids[k]))
        own = real[i][1]
        for p in [k for k in order if labels[k] == own and ids[k] != i][:5]:
            fitting = [k for k in order if labels[k] != own and 80 * scores[p] <= 100 * scores[k] <= 100 * scores[p]][:5]
            out.update((i, int(ids[p]), r + 1, int(ids[k]), int(scores[p]), int(scores[k])) for r, k in enumerate(fitting))
    return out


def mined_rows(spread, seed=4):
    draws = np.random.default_rng(seed)
    middle = draws.normal(size=(6, 8))
    rows = [(k, (middle[k % 6] + spread * draws.normal(size=8)).tolist(), int(draws.integers(3))) for k in range(900)]
    rows += [(1000 + k, rows[12][1], k % 2) for k in range(300)] + [rows[5], rows[5], (5, rows[6][1], 1)]
    return rows + odd_vectors(8)


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_negatives_equal_a_plain_version(spark, monkeypatch, spread):
    """Many clusters, pages and blocks; with a small spread most of the lists is not walked."""
    for name, value in (("MEMBERS_A_CLUSTER", 12), ("FIRST_PAGE", 40), ("PAGE_GROWTH", 2), ("MEMBER_BLOCK", 7),
                        ("CANDIDATE_BLOCK", 50)):
        monkeypatch.setattr(negatives, name, value)
    steps = []
    turns = negatives._turns
    monkeypatch.setattr(negatives, "_turns", lambda step, pages, active, bounds: steps.append(
        (step, sum(active.values()))) or turns(step, pages, active, bounds))
    rows = mined_rows(spread)
    df = vectors(spark, rows)
    got = [tuple(r) for r in negatives.mine(df, df["vec_id"] % 20 == 0).collect()]
    want = plain_negatives(rows, [i for i, _, _ in rows if i is not None and i % 20 == 0])
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 300
    if spread < 0.1:  # members leave before the ends of their lists
        assert min(n for step, n in steps if step >= 2) < steps[0][1] / 2


def test_negatives_of_zero_negative_and_missing(spark):
    df = vectors(spark, [(0, [0.0, 0.0], 1), (1, [0.0, 0.0], 1), (2, [0.0, 0.0], 2), (3, [1.0, 0.0], 2),
                         (100, [-1.0, 0.0], 3), (101, [1.0, 0.0], 3), (200, [1.0, 0.0], 4)])
    got = {tuple(r) for r in negatives.mine(df, df["vec_id"] % 100 == 0).collect()}
    assert got == {(0, 1, k + 1, i, 0, 0) for k, i in enumerate((2, 3, 100, 101, 200))}
    assert negatives.mine(df.limit(0), df["vec_id"] % 100 == 0).count() == 0
    assert negatives.mine(df.filter("vec_id = 1"), df["vec_id"] % 100 == 0).count() == 0


def test_copies_meet_once(spark):
    """Copies of one vector, a third of all rows, do not multiply."""
    rows = [(k, [1.0, 0.0], k % 2) for k in range(400)] + [(1000 + k, [0.5 + k / 1000, 0.5], k % 3) for k in range(400)]
    df = vectors(spark, rows)
    got = {tuple(r) for r in negatives.mine(df, df["vec_id"] == 0).collect()}
    assert {(r[1], r[3]) for r in got} == {(p, n) for p in (2, 4, 6, 8, 10) for n in (1, 3, 5, 7, 9)}


# -- SentencePiece ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return pieces.Pieces(PATH)


ALPHABETS = st.sampled_from(["ab ", " ", "the in▁", "x", "0123456789 ", "éß漢字的 ゼ🙂\n\t\x00", "abcdefghijklmnopqrstuvwxyz"])


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=60), ALPHABETS.flatmap(lambda a: st.text(alphabet=a, max_size=400))))
def test_text_is_encoded_as_by_the_library(library, own, text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    ids = own.encode([text])[0]
    assert ids.tolist() == library.encode(text)
    assert own.decode([ids])[0] == library.decode(ids.tolist())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 260), st.sampled_from([0, 1, 2, 259, 28705])), max_size=12))
def test_any_ids_are_decoded_as_by_the_library(library, own, ids):
    assert own.decode([np.array(ids, np.int64)])[0] == library.decode(ids)


def test_bytes_are_not_put_together_across_a_control_piece(library, own):
    for ids in ([197, 1, 131], [197, 131], [1, 197, 131], [197, 131, 2], [197, 1, 2, 131, 1], [28705, 197, 1, 131, 300]):
        assert own.decode([np.array(ids, np.int64)])[0] == library.decode(ids)


def test_long_words_and_pieces_strung_together(library, own):
    draws = np.random.default_rng(2)
    names = [library.id_to_piece(i) for i in range(259, 32_000)]
    for size in (5, 60, 2000):
        for _ in range(20):
            text = "".join(draws.choice(names, size=size))
            for some in (text, text.replace(pieces.SPACE, "")):
                assert own.encode([some])[0].tolist() == library.encode(some)
    for text in ("x" * 100_000, "ab" * 50_000, "".join(draws.choice(list("etaoinshrdlu"), 100_000)), " " * 50_001 + "a"):
        assert own.encode([text])[0].tolist() == library.encode(text)


def test_rounds_do_not_grow_with_a_words_length(own, monkeypatch):
    draws = np.random.default_rng(6)
    rounds, chosen = [], own._chosen
    monkeypatch.setattr(own, "_chosen", lambda *a: rounds.append(1) or chosen(*a))
    counts = []
    for size in (2000, 200_000):
        rounds.clear()
        own.encode(["".join(draws.choice(list("abcdefghijklmnopqrstuvwxyz"), size))])
        counts.append(len(rounds))
    assert counts[1] < 3 * counts[0]


def test_a_block_ends_between_words(library, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK_CHARS", 50)
    small = pieces.Pieces(PATH)
    text = "  some words   and spaces\n" * 40 + "y" * 300 + " z" * 200
    texts = [text, None, "", " ", text[:49], text]
    found = small.encode(texts)
    assert [f.tolist() for f in found] == [library.encode(t or "") for t in texts]
    assert small.decode(found) == [t or "" for t in texts]


def test_known_words_are_forgotten_without_harm(library, monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN_WORDS", 10)
    small = pieces.Pieces(PATH)
    for k in range(30):
        text = " ".join(f"word{j % 17} other{k % 3}" for j in range(k, k + 20))
        assert small.encode([text])[0].tolist() == library.encode(text)


def test_odd_documents_round_trip(spark, library):
    rows = [r for r in odd_rows()]
    found = pieces.decode(pieces.encode(documents(spark, rows), PATH), PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in found) == sorted((str(i), t or "") for i, t, _ in rows)
    by_text = {r.text: list(r.ids) for r in found}
    assert all(by_text[t or ""] == library.encode(t or "") for _, t, _ in rows)
    assert pieces.encode(documents(spark, rows).limit(0), PATH).count() == 0
    empty = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>")
    assert [r.text for r in pieces.decode(empty, PATH).collect()] == ["", ""]


def test_sentencepiece_query_on_given_documents(spark, library):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for r in rows:
        ids = library.encode(r.text or "")
        want.add((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                  hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = queries.QUERIES["op13_sentencepiece"](spark, FOLDER)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(rows)
