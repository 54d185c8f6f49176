"""Hard negatives against all scores; bounds against the scores they bound."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weir.llm import segments


@pytest.mark.parametrize("dim", [1, 3, 8, 13, 64])
def test_bounds_hold_and_tighten(dim):
    rng = np.random.default_rng(dim)
    a, b = rng.integers(-300, 300, (40, dim)), rng.integers(-300, 300, (50, dim))
    exact, width = a @ b.T, np.inf
    for centre, spread in segments._refined(segments.Summaries(a), segments.Summaries(b)):
        assert (centre - spread <= exact + 1e-6).all() and (exact <= centre + spread + 1e-6).all()
        assert spread.mean() <= width + 1e-6
        width = spread.mean()


def plain_negatives(rows, anchors, scale, positives=5, negatives=5, share=(80, 100)):
    """``rows``: id -> (label, vector), whole numbers after scaling."""
    whole = {i: (label, [int(np.floor(scale * x)) for x in v]) for i, (label, v) in rows.items()}
    out = set()
    for a in anchors:
        label, vec = whole[a]
        score = {i: sum(x * y for x, y in zip(vec, v)) for i, (_, v) in whole.items() if i != a and len(v) == len(vec)}
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if whole[i][0] == label][:positives]:
            fits = [i for i in ranked if whole[i][0] != label and share[0] * score[p] <= share[1] * score[i] <= share[1] * score[p]]
            out |= {(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(fits[:negatives])}
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, score string, block int")


def check(spark, rows, scale, **options):
    got = segments.hard_negatives(frame(spark, [(i, label, [float(x) for x in v], "s", 0) for i, (label, v) in rows.items()]),
                                  F.col("id") % 7 == 0, scale=scale, **options)
    want = plain_negatives(rows, [i for i in rows if i % 7 == 0], scale, **options)
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want
    return want


def test_negatives_are_those_of_all_scores(spark):
    rng = np.random.default_rng(2)
    rows = {int(i): (int(rng.integers(4)), rng.normal(size=12)) for i in range(300)}
    assert len(check(spark, rows, 16)) > 200
    check(spark, rows, 16, positives=2, negatives=3, share=(50, 100))


def test_ties_and_scores_below_zero(spark):
    rng = np.random.default_rng(3)
    ties = {int(i): (int(rng.integers(3)), rng.integers(-1, 2, 6)) for i in range(200)}
    assert len(check(spark, ties, 1)) > 50
    away = {int(i): (int(rng.integers(2)), rng.integers(1, 9, 3) * (1 if i % 7 else -1)) for i in range(60)}
    check(spark, away, 1)
    check(spark, {i: (i % 2, [0.0, 0.0]) for i in range(20)}, 1)  # every score is zero


def test_large_whole_numbers(spark):
    rng = np.random.default_rng(4)
    rows = {int(i): (int(rng.integers(2)), rng.integers(-(2**28), 2**28, 8)) for i in range(80)}
    want = check(spark, rows, 1)
    assert max(x[4] for x in want) > 2**56


def test_blocks_give_what_one_block_gives(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = {int(i): (int(rng.integers(4)), rng.normal(size=16)) for i in range(400)}
    monkeypatch.setattr(segments, "ROWS_PER_BLOCK", 9)
    monkeypatch.setattr(segments, "ANCHORS_PER_BLOCK", 10)
    monkeypatch.setattr(segments, "SAMPLE", 40)
    monkeypatch.setattr(segments, "TILE", 5)
    check(spark, rows, 32)


def test_refining_spares_exact_scores():
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(4000, 64))
    vectors = np.floor(256 * vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.int64)
    a, b = segments.Summaries(vectors[:100]), segments.Summaries(vectors)
    every = lambda x, y: x[:, None] != y[None, :]
    low, high = np.full((100, 1), -segments.MOST), np.full((100, 1), segments.MOST)
    anchor, _, row, score, scored = segments.best_within(a, b, every, low, high, 5)
    whole = vectors[:100] @ vectors.T
    whole[np.arange(100), np.arange(100)] = -(1 << 60)
    assert (np.sort(score.reshape(100, 5)) == np.sort(np.sort(whole, axis=1)[:, -5:])).all()
    assert scored < 0.35 * 100 * 4000


def test_odd_rows(spark):
    rng = np.random.default_rng(7)
    rows = {int(i): (int(rng.integers(2)), rng.normal(size=4)) for i in range(50)}
    odd = [(None, 1, [1.0] * 4), (100, None, [1.0] * 4), (101, 1, None), (102, 1, []), (103, 1, [1.0, None, 1.0, 1.0]),
           (104, 1, [1.0, float("nan"), 1.0, 1.0]), (105, 1, [float("inf")] * 4)]
    # An id counts once: with its least label, then vector; vectors of other dimensions never meet.
    again = [(7, 9, [9.0] * 4), (7, rows[7][0], rows[7][1].tolist()), (8, rows[8][0], [50.0] * 4), (9, 9, [1.0] * 3)]
    rows[200], rows[203], rows[201] = (0, [1.0, 2.0]), (0, [2.0, 2.0]), (1, [0.9, 2.0])
    table = [(i, label, list(map(float, v)), "s", 0) for i, (label, v) in rows.items()] + [(*r, "s", 0) for r in [*odd, *again]]
    got = {tuple(r) for r in segments.hard_negatives(frame(spark, table), F.col("id") % 7 == 0, scale=32).collect()}
    assert got == plain_negatives(rows, [i for i in rows if i % 7 == 0], 32)
    assert (203, 200) in {x[:2] for x in got}
    assert segments.hard_negatives(frame(spark, []), F.col("id") % 7 == 0).count() == 0
    assert segments.hard_negatives(frame(spark, [(*r, "s", 0) for r in odd]), F.col("id") % 7 == 0).count() == 0
