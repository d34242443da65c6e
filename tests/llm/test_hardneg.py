"""Hard negatives against brute force over all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginflow.llm import hardneg

VECTORS = ("vec_id long, embedding array<double>, label string, id long, tie long, data binary, anchor boolean, v long, "
           "cluster int, rank int, score long, member int, list int")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, 1, 2, None, True, 3, 4, 5, 6, 7, 8) for i, l, v in rows], VECTORS)


def brute(rows, positives=5, negatives=3):
    width = max((len(v) for *_, v in rows if v), default=0)
    usable = {(i, l, tuple([math.floor(256 * c) for c in v] + [0] * (width - len(v)))) for i, l, v in rows
              if None not in (i, l, v) and all(c is not None and math.isfinite(c) for c in v)}
    out = []
    for a in usable:
        if a[0] % 50:
            continue
        scored = sorted(((sum(x * y for x, y in zip(a[2], b[2])), b) for b in usable if b != a), key=lambda t: (-t[0], t[1][0]))
        for p, (i, _, _) in [t for t in scored if t[1][1] == a[1]][:positives]:
            band = [(s, b[0]) for s, b in scored if b[1] != a[1] and 50 * p <= 100 * s <= 95 * p]
            out += [(a[0], i, r + 1, n, p, s) for r, (s, n) in enumerate(band[:negatives])]
    return sorted(out)


def mined(spark, rows):
    return sorted(map(tuple, hardneg.mine(frame(spark, rows), F.col("vec_id") % 50 == 0, F.col("label")).collect()))


def vectors(rng, n, d, labels, spread=0.7):
    """Clumped vectors, so that lists end early and scores tie."""
    centres = rng.normal(size=(6, d))
    return [(i, labels[rng.integers(len(labels))], [float(c) for c in np.round(centres[rng.integers(6)] + spread * rng.normal(size=d), 1)])
            for i in range(n)]


@pytest.mark.parametrize("limits", [{}, {"STEP": 16, "SEGMENT": 100, "MEMBERS": 4}, {"STEP": 7, "ROUND_BYTES": 400}])
def test_matches_brute_force(spark, monkeypatch, limits):
    """Also with short steps, segments, lists and several rounds."""
    for k, v in limits.items():
        monkeypatch.setattr(hardneg, k, v)
    rows = vectors(np.random.default_rng(1), 900, 6, ["a", "b", "c"])
    want = brute(rows)
    assert len(want) > 100 and mined(spark, rows) == want


def test_odd_rows(spark):
    """Null and non-finite entries, ids and labels, copies in hundreds, zero, short and empty vectors, negative scores."""
    rng = np.random.default_rng(2)
    rows = vectors(rng, 300, 4, ["a", "b"])
    rows += [(1000 + i, "ab"[i % 2], rows[50][2]) for i in range(400)]
    rows += [(2000, "a", None), (2050, "a", [1.0, None, 0.0, 0.0]), (2100, "b", [math.inf] * 4), (None, "a", [1.0] * 4),
             (2150, None, [1.0] * 4), (2200, "a", [0.0] * 4), (2250, "b", [1.5]), (2300, "a", []), (2350, "only", [1.0] * 4),
             (2400, "b", [-9.0] * 4), (0, rows[0][1], rows[0][2]), (100, rows[100][1], rows[100][2])]
    assert mined(spark, rows) == brute(rows)


def test_tables_without_pairs(spark):
    for rows in ([], [(50, "a", [1.0])], [(50, "a", [1.0]), (51, "a", [1.0])], [(51, "a", [1.0]), (52, "b", [0.9])], [(50, "a", None)]):
        assert mined(spark, rows) == []


def test_one_id_with_two_vectors(spark):
    """Rows that share an id alone are rows of their own."""
    rows = [(50, "a", [2.0, 0.0]), (50, "b", [0.0, 2.0]), (1, "a", [1.0, 1.0]), (2, "b", [1.0, 0.75]), (3, "a", [0.75, 1.0])]
    assert mined(spark, rows) == brute(rows)


def test_scores_beyond_doubles_are_exact(spark):
    """Entries whose products a double can't hold."""
    rng = np.random.default_rng(4)
    rows = [(i, "ab"[i % 2], [int(rng.integers(2**20, 2**21)) + int(c) / 256 for c in rng.integers(0, 256, 4)]) for i in range(160)]
    want = brute(rows)
    assert max(r[4] for r in want) > 2**53 and mined(spark, rows) == want


def test_walks_end_early():
    """Certified termination: in clumped data a member scores a part of its list."""
    rng = np.random.default_rng(6)
    centres = 1000 * np.eye(8)
    y = np.concatenate([c + 20 * rng.normal(size=(4000, 8)) for c in centres]).astype(np.int64)
    x = y[:40]
    unit = hardneg._unit(x.astype(float))
    centre = hardneg._unit(unit.sum(axis=0, keepdims=True))[0]
    c = hardneg.Cluster(np.arange(40), np.zeros(40, np.int64), ["a"] * 40, x, centre,
                        float(hardneg._angles(unit @ centre).max()), np.sqrt((x.astype(float) ** 2).sum(axis=1)))
    best, seen = hardneg.Best(40, 5), []
    offer = hardneg._offer
    hardneg._offer = lambda b, s, score, *a: (seen.append(score.size), offer(b, s, score, *a))[1]
    try:
        hardneg._walk_list(c, np.zeros(40, np.int64), best, np.arange(len(y)), np.zeros(len(y), np.int64), np.zeros(len(y), np.int64), y, 1)
    finally:
        hardneg._offer = offer
    score = x @ y.T
    np.fill_diagonal(score, np.iinfo(np.int64).min)
    assert (np.sort(score, axis=1)[:, :-6:-1] == best.score).all()
    assert sum(seen) < 0.5 * score.size
