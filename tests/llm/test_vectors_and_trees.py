"""Hard negatives, whitening and fingerprints against plain versions, on whole small tables and on odd rows."""

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from timeweave.llm import hard_negatives, merkle, queries, vectors, whitening

DIR = "/root/testdata/sf0.001"
ODD = [(None, [1.0, 2.0, 3.0, 4.0], 1), (900, None, 1), (901, [], 1), (902, [1.0, None, 0.0, 0.0], 1), (903, [1.0, float("nan"), 0.0, 0.0], 1), (904, [1.0, float("inf"), 0.0, 0.0], 1), (905, [1.0, 2.0], 1), (906, [1e300, 0.0, 0.0, 0.0], 2), (907, [0.5, 0.5, 0.5, 0.5], None)]


def embeddings(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return df.withColumns({c: F.lit("clash") for c in ("i", "v", "raw", "score", "rank", "windows", "x", "component")})


def integer(v):
    return [int(np.floor(256 * x)) for x in v]


def window(rows, anchor, k, same, ok=lambda s: True):
    """The k best rows for an anchor among those of its label or of others, in Python's integers."""
    a = rows[anchor]
    found = [(sum(p * q for p, q in zip(a[1], v, strict=True)), -i) for i, (label, v) in rows.items() if i != anchor and (label == a[0]) == same]
    return [(-i, s) for s, i in sorted((f for f in found if ok(f[0])), reverse=True)[:k]]


def plain_negatives(rows, anchors, positives=5, negatives=10, least=30, most=90):
    return {(a, p, n, i, ps, s) for a in anchors for p, ps in window(rows, a, positives, True) for n, (i, s) in enumerate(window(rows, a, negatives, False, lambda s: least * ps <= 100 * s <= most * ps), 1)}  # noqa: B023


def random_vectors(n, d=8, seed=3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, d))
    return [(i, (centre[i % 6] * (i % 2) + rng.normal(size=d)).round(2).tolist(), int(rng.integers(3))) for i in range(n)]


def mined(df, **more):
    got = hard_negatives.mine(df, F.col("i") % 100 == 0, F.col("vec_id"), F.col("label"), "embedding", **more).collect()
    found = {tuple(r) for r in got}
    assert len(found) == len(got)
    return {(a, p, n, i, ps, s) for a, p, n, i, ps, s in found}


@pytest.mark.parametrize("rows", [500, 8192])
def test_hard_negatives_match_plain_integers(spark, monkeypatch, rows):
    """Many blocks and few, ties among copies, with and without a pilot pass."""
    monkeypatch.setattr(hard_negatives, "LEAST_BLOCKS", 1 if rows > 500 else 4)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    held = random_vectors(700)
    held += [(1000 + i, held[7][1], 0) for i in range(120)] + [(1200 + i, held[0][1], i % 3) for i in range(120)]
    df = embeddings(spark, held)
    table = {i: (label, integer(v)) for i, v, label in held}
    assert mined(df) == plain_negatives(table, [i for i in table if i % 100 == 0])


def test_hard_negatives_of_odd_rows(spark):
    rows = [(0, [1.0, 0.0, 0.0, 0.0], 1), (0, [1.0, 0.0, 0.0, 0.0], 1), (1, [0.9, 0.1, 0.0, 0.0], 1), (1, [0.9, 0.1, 0.0, 0.0], 2), (2, [0.5, 0.0, 0.0, 0.0], 2), (3, [0.5, 0.1, 0.0, 0.0], 2), (100, [-1.0, 0.0, 0.0, 0.0], 1)]
    # of the rows of id 1 the one of the least label counts
    table = {0: (1, [256, 0, 0, 0]), 1: (1, integer([0.9, 0.1, 0.0, 0.0])), 2: (2, [128, 0, 0, 0]), 3: (2, integer([0.5, 0.1, 0, 0])), 100: (1, [-256, 0, 0, 0])}
    want = plain_negatives(table, [0, 100])
    assert mined(embeddings(spark, rows + ODD)) == want and {(r[0], r[1], r[3]) for r in want} >= {(0, 1, 2), (0, 1, 3)}
    assert mined(embeddings(spark, ODD[:1])) == set() == mined(embeddings(spark, []).limit(0)) == mined(embeddings(spark, rows[:1]))


def test_large_integers_are_scored_exactly(spark):
    rng = np.random.default_rng(1)
    held = [(i, (rng.integers(-(2**28), 2**28, 4) / 256).tolist(), i % 2) for i in range(150)]
    assert mined(embeddings(spark, held)) == plain_negatives({i: (label, integer(v)) for i, v, label in held}, [0, 100])


def test_bounds_hold_and_filter():
    """No true score leaves its interval, and most rows that a window may hold are never scored exactly."""
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    x = vectors.integers(t["embedding"].combine_chunks().cast(pa.list_(pa.float64())), 64, 160)
    ids, labels = t["vec_id"].to_numpy(), t["label"].to_numpy()
    book = hard_negatives.Codebook(x, 160)
    codes, norms = book.encode(x)
    low, high = book.bounds(x[:40], codes, norms)
    true = x[:40].astype(int) @ x.astype(int).T
    assert (low <= true).all() and (true <= high).all()
    at, done = np.flatnonzero(ids % 100 == 0), Counter()
    every = iter([([0], [-(1 << 62)], [1 << 62])] * len(at))
    found = list(hard_negatives.best_of_windows(book, every, ids[at], labels[at], x[at], ids, labels, x, codes, norms, 5, True, done))
    assert len(found) == 5 * len(at) and done["scored"] < 0.25 * done["met"]
    ranges, done = iter([([0], [6000], [18000])] * len(at)), Counter()
    list(hard_negatives.best_of_windows(book, ranges, ids[at], labels[at], x[at], ids, labels, x, codes, norms, 10, False, done))
    assert done["scored"] < 0.4 * done["met"]


def test_whitening_matches_plain_covariance(spark):
    held = random_vectors(400)
    held += [(1000 + i, held[5][1], 1) for i in range(300)] + [held[3]]
    rows = whitening.whiten(embeddings(spark, held + ODD)).collect()
    x = {i: integer(v) for i, v, _ in held}
    x[None], x[907] = integer([1, 2, 3, 4]), integer([0.5] * 4)
    kept = {i: v for i, v in x.items() if len(v) == 8}
    fit = sorted(set(map(tuple, kept.values())))
    check_whitening(rows, [(i, kept[i]) for i, _, _ in held], fit)


def check_whitening(rows, kept, fit):
    n, d = len(fit), len(fit[0])
    s = [sum(c) for c in zip(*fit, strict=True)]
    centred = (np.array(fit) * n - np.array(s)) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1][:4], v[:, ::-1][:, :4]
    assert Counter(r["vec_id"] for r in rows) == Counter({i: 4 * c for i, c in Counter(i for i, _ in kept).items()})
    by = {i: t for i, t in kept}
    got = {i: {r["component"]: r for r in rows if r["vec_id"] == i} for i in by}
    signs = None
    for i, t in by.items():
        want = (np.array(t) * n - np.array(s)) / n @ v / np.sqrt(e)
        own = np.array([got[i][c]["whitened"] for c in (1, 2, 3, 4)])
        if signs is None:
            signs = np.sign(own * want)
        assert own == pytest.approx(want * signs, abs=1e-8)
        for c in (1, 2, 3, 4):
            r = got[i][c]
            assert (r["n"], r["deviation"]) == (n, sum((n * a - b) ** 2 for a, b in zip(t, s, strict=True)))
            assert r["explained"] == pytest.approx(e[c - 1] / np.trace(centred.T @ centred / n), rel=1e-9) and r["identity_error"] < 1e-9


def test_whitening_of_the_whole_table(spark):
    table = [(r[0], integer(r[1])) for r in spark.read.parquet(f"{DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_whitening(queries.QUERIES["op13_whitening"](spark, DIR).collect(), table, sorted({tuple(v) for _, v in table}))


def test_whitening_without_variance(spark):
    rows = whitening.whiten(embeddings(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).collect()
    assert {(r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in rows} == {(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)}
    line = whitening.whiten(embeddings(spark, [(i, [i / 256, 2 * i / 256, 0.0], 0) for i in range(9)])).collect()
    assert {(r["component"], r["whitened"] is None) for r in line} == {(1, False), (2, True), (3, True)} and max(r["identity_error"] for r in line) < 1e-12
    assert whitening.whiten(embeddings(spark, []).limit(0)).count() == 0 == whitening.whiten(embeddings(spark, ODD[1:2])).count()


@pytest.mark.parametrize("d", [1, 2, 7, 40])
def test_jacobi_keeps_small_deviations(d):
    """Singular values twelve orders apart come out with a small relative error, unlike those of a covariance."""
    rng = np.random.default_rng(d)
    want = np.logspace(3, -9, d)
    u, v = (np.linalg.qr(rng.normal(size=(60, d)))[0], np.linalg.qr(rng.normal(size=(d, d)))[0])
    scaled = np.linalg.qr(u)[0] * want  # graded columns, turned only among rows
    sigma, right = whitening.jacobi(np.linalg.qr(scaled, mode="r"))
    assert sigma == pytest.approx(want, rel=1e-10) and right.T @ right == pytest.approx(np.eye(d), abs=1e-12)
    full = u * np.linspace(3, 1, d) @ v.T
    sigma, right = whitening.jacobi(np.linalg.qr(full, mode="r"))
    assert sigma == pytest.approx(np.linspace(3, 1, d), rel=1e-12) and np.abs(full @ right) == pytest.approx(np.abs(u * np.linspace(3, 1, d)), abs=1e-9)


def test_deviations_beyond_64_bits_are_null():
    f = whitening.Whitening(10**6, 2**40, [0, 0], np.eye(2), np.ones(2), 2.0)
    assert f.deviations(np.array([[2**39, 1], [1, 2]])) == [None, 5 * 10**12]
    assert f.centred(np.array([[2**39, 3]])).tolist() == [[float(2**39), 3.0]]


# ---------------------------------------------------------------- fingerprints


def plain_likeness(a, b):
    bags = [Counter(w[i : i + 8] for part in f[33:].replace(";", ",").split(",") for w in [part] for i in range(0, len(w), 8)) for f in (a, b)]
    n = sum(map(sum, (x.values() for x in bags)))
    return 1.0 if f"{a}"[:32] == b[:32] else 2 * sum((bags[0] & bags[1]).values()) / n


TEXTS = ["", "one", "one\n", "one\n\ntwo words\nthree  ", "中文字符" * 40, "a" * 5000, "wörds of é " * 300, " \n\n \n", "\n" * 50 + "x", "".join(f"line {i} has words of its own {i * i}\n" + "\n" * (i % 7 == 0) for i in range(300))]


def test_pieces_make_up_the_text(monkeypatch):
    for step in (1, 5, 64, 1 << 20):
        monkeypatch.setattr(merkle, "STEP", step)
        for t in TEXTS:
            data = t.encode()
            ends, kinds = merkle._cuts(data)
            assert ends.tolist() == sorted(set(ends.tolist())) and (not data or ends[-1] == len(data))
            for a, b in itertools.pairwise([0, *ends.tolist()]):
                data[a:b].decode()  # no character is cut
            assert (ends.tolist(), kinds.tolist()) == tuple(x.tolist() for x in whole_cuts(data, monkeypatch))
            monkeypatch.setattr(merkle, "STEP", step)


def whole_cuts(data, monkeypatch):
    monkeypatch.setattr(merkle, "STEP", 1 << 30)
    return merkle._cuts(data)


def test_roots_test_equality():
    marks = [merkle.fingerprint(t) for t in TEXTS]
    assert len(set(marks)) == len(TEXTS) == len({m[:32] for m in marks}) and merkle.fingerprint(None) == marks[0] and marks == [merkle.fingerprint(t) for t in TEXTS]
    assert all(merkle.likeness(m, m) == 1 and merkle.likeness(m, marks[0]) == (m == marks[0]) for m in marks)


def test_likeness_matches_a_count_of_pieces():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    for _ in range(60):
        a = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "\n\n"]) for _ in range(rng.randrange(1, 300)))
        cut = sorted(rng.randrange(len(a) + 1) for _ in range(2))
        b = a[: cut[0]] + rng.choice(["", "other words", a[:40]]) + a[cut[1] :]
        x, y = merkle.fingerprint(a), merkle.fingerprint(b)
        assert merkle.likeness(x, y) == pytest.approx(plain_likeness(x, y)) == merkle.likeness(y, x)


def test_edits_are_located():
    rng = random.Random(2)
    for _ in range(80):
        a = "".join(f"wörd{rng.randrange(200)}" + rng.choice([" ", " ", " ", "\n", "\n\n"]) for _ in range(rng.randrange(0, 900)))
        spots = sorted(rng.randrange(len(a) + 1) for _ in range(2 * rng.randrange(3)))
        b, at = "", 0
        for s, e in zip(spots[::2], spots[1::2], strict=True):
            b, at = b + a[at:s] + "new é text", min(e, s + 30)
        b += a[at:]
        found = merkle.edits(a, b)
        # what lies between the stretches is equal, and they rise
        back, own, other = "", 0, 0
        for s, e, ns, ne in found:
            assert s >= own and ns >= other and a[own:s] == b[other:ns]
            back, own, other = back + a[own:s] + b[ns:ne], e, ne
        assert back + a[own:] == b and a[own:] == b[other:]
    long = "".join(f"sentence {i} of a long text.\n" for i in range(5000))
    ((s, e, ns, ne),) = merkle.edits(long, long.replace("sentence 2500 of", "sentence 2500 from"))
    assert e - s < 300 and long[s:e] in long and "2500" in long[s:e]
    assert merkle.edits("", "new") == [(0, 0, 0, 3)] and merkle.edits(None, "") == [] and merkle.edits("old", "") == [(0, 3, 0, 0)]


def check_fingerprints(rows, ordered):
    """``rows`` of the query against texts in order."""
    by = {r["doc_id"]: r for r in rows}
    assert len(by) == len(rows) == len(ordered)
    for (key, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        x, y, z = (merkle.fingerprint(t) for t in (text, changed, after))
        want = (len(text), hashlib.sha256(changed.encode()).hexdigest(), x, y, plain_likeness(x, y), plain_likeness(x, z))
        r = by[key]
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == want[:4]
        assert (r["near_edited"], r["near_next"]) == pytest.approx(want[4:])


def test_documents_and_their_next(spark):
    rows = [(r[0], r[1] or "") for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    got = queries.QUERIES["op12_merkle"](spark, DIR).collect()
    check_fingerprints(got, rows)
    long = [r for r in got if r["n_chars"] > 1000]
    assert 0.3 < np.median([r["near_edited"] for r in long]) < 0.7 and np.median([r["near_next"] for r in long]) < 0.1


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_fingerprints_of_odd_tables(spark, parts):
    """Few rows to a range and many, empty ranges, null keys and texts, repeated rows."""
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(3 * i, t) for i, t in enumerate(TEXTS)] + [(None, "last of all, a null key"), (-5, None)]
        df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("key", "kind", "part", "h", "n", "to")})
        check_fingerprints(merkle.edited_by_next(df).collect(), [(k, t or "") for k, t in sorted(rows[:-2] + rows[-1:])] + rows[-2:-1])
        assert merkle.edited_by_next(df.limit(0)).count() == 0
        check_fingerprints(merkle.edited_by_next(df.where("doc_id = 9")).collect(), [rows[3]])
        copies = spark.createDataFrame([(7, "a few words of a text")] * 200 + [(8, "another")], "doc_id long, text string")
        got = Counter((r["doc_id"], r["near_next"]) for r in merkle.edited_by_next(copies).collect())
        assert got == {(7, 1.0): 199, (7, 0.0): 1, (8, 0.0): 1}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_columns(spark):
    df = spark.createDataFrame([("a\nb", "a\nb c"), (None, "x"), (None, None)], "a string, b string")
    rows = df.select(merkle.fingerprints(F.col("a")).alias("x"), merkle.fingerprints(F.col("b")).alias("y"), merkle.edit_spans(F.col("a"), F.col("b")).alias("e")).withColumn("near", merkle.likenesses(F.col("x"), F.col("y"))).collect()
    assert [r["near"] for r in rows] == [merkle.likeness(r["x"], r["y"]) for r in rows] and rows[2]["near"] == 1 and rows[2]["e"] == []
    assert [tuple(e) for e in rows[0]["e"]] == merkle.edits("a\nb", "a\nb c")
