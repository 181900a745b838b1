"""Whitening, dual-tree search and language mixtures against brute force."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from roadsight.llm import bidiagonal, dual_tree, language_mix, whitening

SF = "/root/testdata/sf0.001"


# --- whitening -----------------------------------------------------------------------------------

def orthogonal(rng, n):
    return np.linalg.qr(rng.standard_normal((n, n)))[0]


@pytest.mark.parametrize("kind", ["gauss", "graded", "clusters", "near", "rank", "equal", "zero", "one"])
def test_bidiagonal_solver(kind):
    rng = np.random.default_rng(1)
    q = orthogonal(rng, 30)
    r = {"gauss": rng.standard_normal((30, 30)), "graded": np.diag(10.0 ** -np.arange(30)) @ q,
         "clusters": np.diag(np.repeat([3.0, 2, 1], 10)) @ q,
         "near": np.diag(np.repeat([3.0, 2, 1], 10) + 1e-9 * rng.standard_normal(30)) @ q,
         "rank": rng.standard_normal((30, 4)) @ rng.standard_normal((4, 30)), "equal": np.eye(30),
         "zero": np.zeros((30, 30)), "one": np.array([[-2.0]])}[kind]
    values, vectors = bidiagonal.eigen(np.linalg.qr(r)[1])
    s = np.linalg.svd(r, compute_uv=False)
    assert np.allclose(np.sqrt(values), s, rtol=0, atol=1e-14 * max(s[0], 1))
    assert np.abs(vectors.T @ vectors - np.eye(len(r))).max() < 1e-13
    assert np.abs(r.T @ (r @ vectors) - vectors * values).max() < 1e-11 * max(s[0], 1) ** 2


def test_dqds_keeps_tiny_values_to_relative_accuracy():
    q, e = 10.0 ** -np.arange(0, 40, 4), 10.0 ** -np.arange(2, 38, 4)
    got = bidiagonal.dqds(q, e)
    # det(B'B) = prod(q) holds to relative accuracy only if every value does
    assert math.isclose(float(np.sum(np.log(got))), float(np.sum(np.log(q))), rel_tol=1e-14)


def expected(x):
    n, s = len(x), x.sum(0)
    gap = n * x.astype(object) - s
    y = (gap / n).astype(float)
    w, u = np.linalg.eigh(y.T @ y / n)
    return gap, y, w[::-1], u[:, ::-1]


def check(out, x):
    gap, y, w, u = expected(x)
    k = min(32, x.shape[1])
    out = out.sort_values(["vec_id", "component"])
    z = out.whitened.to_numpy().reshape(-1, k)
    assert np.allclose(np.abs(z), np.abs(y @ u[:, :k] / np.sqrt(w[:k])), atol=1e-8)
    assert np.allclose(out.explained.to_numpy()[:k], w[:k] / w.sum(), rtol=1e-6)
    assert out.deviation.tolist() == np.repeat((gap * gap).sum(1), k).tolist()
    assert out.identity_error.max() < 1e-9 and (out.n == len(x)).all()


def test_whitening(spark):
    rng = np.random.default_rng(2)
    c = rng.standard_normal((500, 40)) * np.linspace(1, 3, 40) + 5
    c[100:300] = c[100]
    rows = [(i, v.tolist(), 0, 0, 0.0) for i, v in enumerate(c)]
    odd = [(900, None, 0, 0, 0.0), (901, [float("nan")] * 40, 0, 0, 0.0), (902, [1.0, None] + [0.0] * 38, 0, 0, 0.0),
           (903, [float("inf")] + [0.0] * 39, 0, 0, 0.0), (904, [], 0, 0, 0.0), (905, [1.0] * 8, 0, 0, 0.0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, component int, part int, whitened double")
    out = whitening.whiten(df.repartition(7)).toPandas()
    assert sorted(set(out.vec_id)) == list(range(500)) and len(out) == 500 * 32
    check(out, np.floor(64 * c).astype(int) + 1_000_000)


def test_whitening_folds_many_blocks(spark):
    c = np.random.default_rng(3).standard_normal((400, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], "vec_id long, embedding array<double>").repartition(70)
    check(whitening.whiten(df).toPandas(), np.floor(64 * c).astype(int) + 1_000_000)


def test_whitening_degenerate(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whiten(make([])).count() == 0
    assert whitening.whiten(make([(1, None)])).count() == 0
    one = whitening.whiten(make([(1, [1.0, 2.0]), (None, [1.0, 2.0])])).toPandas()
    assert len(one) == 4 and one.whitened.isna().all() and (one.explained == 0).all() and (one.identity_error == 0).all()
    flat = whitening.whiten(make([(i, [float(i), 2.0 * i, 0.0]) for i in range(50)])).toPandas().sort_values(["vec_id", "component"])
    assert flat[flat.component == 1].whitened.notna().all() and flat[flat.component > 1].whitened.isna().all()
    assert np.isclose(flat.explained.iloc[0], 1)
    huge = whitening.whiten(make([(1, [3e38, 0.0]), (2, [-3e38, 1.0])])).toPandas()
    assert huge.deviation.isna().all() and len(huge) == 4


# --- dual-tree search ----------------------------------------------------------------------------

def brute_search(docs, items):
    terms = lambda t: re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    known = [(d, Counter(terms(t))) for d, t in docs]
    known = [(d, c) for d, c in known if c]
    n, length, df = len(known), sum(sum(c.values()) for _, c in known), Counter(t for _, c in known for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in known:
            m = 75 + 25 * sum(c.values()) * n // length
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                    for t, q in Counter(terms(text)).items() if c[t])
            if s > 0:
                scores.append((-s, math.inf if d is None else d))
        out += [(item, k, None if d == math.inf else d, -s) for k, (s, d) in enumerate(sorted(scores)[:20], 1)]
    return sorted(out, key=str)


def found(spark, docs, items):
    d = spark.createDataFrame([(i, t, 0, 0, "s") for i, t in docs], "doc_id long, text string, item int, n int, score string").repartition(5)
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in dual_tree.search(d, b).collect()), key=str)


def some_texts(seed, n, vocabulary):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Été", "naïve", "X9"]
    weights = 1 / np.arange(1, len(words) + 1)
    return [" ".join(rng.choice(words, int(rng.integers(1, 60)), p=weights / weights.sum())) for _ in range(n)]


def test_dual_tree_equals_brute_force(spark):
    texts = some_texts(1, 900, 400)
    docs = list(enumerate(texts)) + [(1000 + i, texts[5]) for i in range(300)]  # a group of copies: ties
    docs += [(None, texts[5]), (None, texts[7]), (7, texts[8]), (2000, ""), (2001, None), (2002, "-- !!"), (2003, "w1 " * 30_000)]
    items = list(enumerate(some_texts(2, 90, 400))) + [(500, None), (501, ""), (502, "nowhere"), (503, texts[5]), (503, texts[5]),
                                                      (None, texts[9]), (504, "w1-W1 " * 200)]
    assert found(spark, docs, items) == brute_search(docs, items)


def test_dual_tree_without_rows(spark):
    assert found(spark, [], [(1, "a")]) == [] and found(spark, [(1, "a")], []) == [] and found(spark, [(1, None)], [(1, "a")]) == []
    # three documents, one term each, fewer than twenty results
    assert found(spark, [(3, "a"), (2, "a"), (1, "b")], [(1, "a a")]) == brute_search([(3, "a"), (2, "a"), (1, "b")], [(1, "a a")])


def test_dual_tree_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(dual_tree, "ITEMS", 16)
    docs, items = list(enumerate(some_texts(3, 300, 100))), list(enumerate(some_texts(4, 60, 100)))
    assert found(spark, docs, items) == brute_search(docs, items)


def test_dual_tree_long_items_use_whole_numbers():
    weights = np.array([20_000, 10], np.int64)
    tree = dual_tree.item_tree(np.array([0, 0]), np.array([0, 1]), np.array([10 ** 6, 1]), 1, weights)
    assert tree.whole is np.int64 and tree.part(2, np.array([0, 1])).tolist() == [[20_000 * 10 ** 6, 10]]


def test_dual_tree_sql(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    duckdb.register("documents", docs.toPandas())
    duckdb.register("benchmark", items.toPandas())
    want = duckdb.sql(dual_tree.SEARCH_SQL).df()
    got = dual_tree.search(docs, items).toPandas()[list(want.columns)]
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist()))


# --- language mixtures ---------------------------------------------------------------------------

def counted(texts_by_language):
    """A model from plain counting, byte by byte."""
    languages = sorted(texts_by_language)
    cells, pairs = np.zeros((language_mix.CELLS, len(languages))), np.zeros((language_mix.CELLS, len(languages)))
    for k, name in enumerate(languages):
        for text in texts_by_language[name]:
            for word in brute_words(text):
                for a, b, c in steps(word):
                    cells[cell(a, b, c), k] += 1
                    pairs[(a << 8) | b, k] += 1
    return language_mix.Model(languages, np.log(cells + 0.25).astype(np.float32), np.log(pairs + 16).astype(np.float32))


def brute_words(text):
    raw = text.encode().translate(bytes(b + 32 if 65 <= b < 91 else b for b in range(256)))
    return [w[i:i + 32] for w in re.findall(rb"[a-z\x80-\xff]+", raw) for i in range(0, len(w), 32)]


def steps(word):
    padded = b"  " + word + b" "
    return [tuple(padded[i:i + 3]) for i in range(len(padded) - 2)]


def cell(a, b, c):
    return ((((a << 16) | (b << 8) | c) * 2654435761) & 0xFFFFFFFF) >> 16


def make_languages(seed=5):
    rng = np.random.default_rng(seed)
    kinds = {"aa": ["ba", "do", "ki", "lu", "é"], "bb": ["str", "ng", "th", "ow", "ß"], "cc": ["zi", "xo", "qua", "vy", "日本"]}
    word = lambda parts: "".join(rng.choice(parts, int(rng.integers(1, 5))))
    return {k: lambda n, p=p: " ".join(word(p) for _ in range(n)) for k, p in kinds.items()}


DOCS = "doc_id long, text string, lang string, source string, score double, mixture string"


def test_language_counts_and_likelihoods_equal_plain_counting(spark):
    make = make_languages()
    texts = [(i, make[k](30 + i % 50), k) for i, k in enumerate(["aa", "bb", "cc"] * 20)] + [(200, "x" * 100_000 + " " + make["aa"](20_000), "aa")]
    ids = [(3 * i + 1, t, k, "s", 0.0, "m") for i, t, k in texts]
    docs = spark.createDataFrame(ids + [(None, None, "aa", "s", 0.0, "m"), (9, "ba do", None, "s", 0.0, "m"), (12, "", "cc", "s", 0.0, "m")], DOCS)
    out = {r.doc_id: r.held_out for r in docs.select("doc_id", language_mix.held_out(docs.doc_id).alias("held_out")).collect()}
    model = language_mix.learn(docs)
    plain = counted({k: [t for d, t, own, *_ in ids if own == k and not out[d]] for k in ("aa", "bb", "cc")})
    assert model.languages == plain.languages and np.array_equal(model.cells, plain.cells) and np.array_equal(model.pairs, plain.pairs)
    text = texts[4][1].encode()
    got, _ = language_mix.likelihoods(model, np.frombuffer(text, np.uint8), np.zeros(len(text), bool))
    want = [sum(np.minimum(model.cells[cell(a, b, c)] - model.pairs[(a << 8) | b], 0) for a, b, c in steps(w)) for w in brute_words(texts[4][1])]
    assert np.allclose(got, want, atol=1e-3)


def test_language_proportions_rise_to_the_maximum():
    rng = np.random.default_rng(6)
    p = rng.random((300, 3)) ** 4 + 1e-6
    p /= p.max(1, keepdims=True)
    own, sizes = np.repeat([0, 1], [100, 200]), np.array([100.0, 200.0])
    shares, gained = language_mix.proportions(lambda: [(p[:150], np.zeros(150), own[:150]), (p[150:], np.zeros(150), own[150:])],
                                              np.ones((2, 3)), sizes)
    grid = [(a, b, 1 - a - b) for a in np.linspace(0.001, 0.998, 200) for b in np.linspace(0.001, 0.998, 200) if a + b < 1]
    for d in (0, 1):
        best = max(np.log(p[own == d] @ np.array(g)).sum() for g in grid)
        assert gained[d] >= best - 0.5 and np.isclose(shares[d].sum(), 1)


def test_language_sets(spark):
    make = make_languages()
    rows = [(i, make[k](60), k, "s", 0.0, "m") for i, k in enumerate(["aa", "bb", "cc"] * 60)]
    model = language_mix.learn(spark.createDataFrame(rows, DOCS))
    mixed = make["aa"](70) + "\n" + make["bb"](30)
    long = make["cc"](400_000)
    docs = spark.createDataFrame(
        rows + [(500, mixed, None, "s", 0.0, "m"), (501, long, None, "s", 0.0, "m"), (502, None, "aa", "s", 0.0, "m"), (503, "", "aa", "s", 0.0, "m"),
                (504, "12 !! … «", "aa", "s", 0.0, "m"), (505, "zixoqua", "aa", "s", 0.0, "m"), (None, "strng", "aa", "s", 0.0, "m"),
                (506, "strng" * 3000, "aa", "s", 0.0, "m")], DOCS)
    got = {r.doc_id: r for r in language_mix.identify(docs, model).collect()}
    assert all(got[i].lang_pred == k for i, _, k, *_ in rows)
    assert set(got[500].mixture) == {"aa", "bb"} and got[500].lang_pred == "aa" and abs(got[500].score - 0.7) < 0.06
    assert got[501].lang_pred == "cc" and got[505].lang_pred == "cc" and got[None].lang_pred == "bb" and got[506].lang_pred == "bb"
    assert all((got[i].lang_pred, got[i].score, dict(got[i].mixture)) == ("und", 0.0, {}) for i in (502, 503, 504))
    assert all(0 <= r.score <= 1 for r in got.values()) and not got[None].held_out
    assert language_mix.identify(docs.limit(0), model).count() == 0
    nothing = language_mix.learn(docs.limit(0))
    assert {r.lang_pred for r in language_mix.identify(docs, nothing).collect()} == {"und"}


def test_long_texts_are_read_again_instead_of_held(monkeypatch):
    make, model = make_languages(), None
    model = counted({k: [f(400)] for k, f in make.items()})
    raw = (make["aa"](60_000) + " " + make["cc"](40_000)).encode()
    data, offsets = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    one = language_mix.infer(model, data, offsets)
    monkeypatch.setattr(language_mix, "_HELD", 1000)
    two = language_mix.infer(model, data, offsets)
    assert np.array_equal(one[0], two[0]) and np.array_equal(one[1], two[1]) and (one[0] > 0.3).sum() == 2


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_mix.identify(docs, language_mix.learn(docs)).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) > 200 and (got.lang == got.lang_pred).mean() >= 0.99
