"""Hard negatives against plain Python, in one and in several rounds, and the bounds that leave pairs out."""

import random

import numpy as np
import pytest

from barloom.llm import negatives


def plain(rows, positives=5, low=80, high=100, count=5):
    own = [(k, i, lab, v) for k, (i, lab, v, *_) in enumerate(rows) if i is not None and lab is not None and v is not None and None not in v]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for k, i, lab, v in own:
        if i % 10:
            continue
        near = sorted((-dot(v, w), j, n) for n, j, other, w in own if n != k and other == lab)[:positives]
        for p, j, _ in near:
            far = sorted((-s, x) for s, x in ((dot(v, w), x) for _, x, other, w in own if other != lab) if low * -p <= 100 * s <= high * -p)[:count]
            out += [(i, j, r + 1, x, -p, -s) for r, (s, x) in enumerate(far)]
    return sorted(out)


def made(n, width, seed, spread=40):
    r = random.Random(seed)
    centers = [[r.randrange(-spread, spread) for _ in range(width)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = r.choice(centers)
        rows.append((i, r.randrange(4), [x + r.randrange(-9, 10) for x in c]))
    return rows


@pytest.mark.parametrize(("width", "sent"), [(16, 1 << 21), (24, 100), (5, 40), (1, 1)])
def test_against_plain_python(spark, width, sent):
    rows = made(180, width, width)
    same = rows[7][2]
    rows += [(k, k % 3, same) for k in range(200, 260)]  # ties, among them anchors
    rows += [(20, 1, same), (20, 1, same), (30, None, same), (40, 2, None), (None, 1, same), (50, 1, [None] * width), (310, 99, same), (320, 1, [0] * width), (330, 2, same[: width // 2]), (340, 1, [])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, label int, vector array<long>, uid int").repartition(3)
    got = sorted(map(tuple, negatives.hard_negatives(docs, "vec_id % 10 = 0", sent=sent).collect()))
    assert got == plain(rows) and got
    assert negatives.hard_negatives(docs.limit(0), "vec_id % 10 = 0").count() == 0


def test_large_components(spark):
    rows = [(k, k % 2, [(1 << 26) - k % 5, 1 << 25, 3 - k % 4]) for k in range(40)] + [(41, 1, [1 << 40, 0, 0])]
    docs = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>")
    rows[-1] = (41, 1, [1 << 26, 0, 0])
    assert sorted(map(tuple, negatives.hard_negatives(docs, "vec_id % 10 = 0").collect())) == plain(rows)


def test_bounds_hold_and_leave_pairs_out():
    g = np.random.default_rng(5)
    centers = g.integers(-60, 60, (8, 64)) + g.integers(-40, 40, (8, 1))
    v = (centers[g.integers(0, 8, 400)] + g.integers(-12, 12, (400, 64))).astype(float)
    at = negatives.borders(64)
    zero = np.zeros(400, np.int64)
    side = negatives.Side.of(zero, zero, zero, v, at)
    exact = v @ v.T
    for (m, r), more in zip(side.levels, [None, *side.levels], strict=False):
        assert (np.abs(exact - m @ m.T) <= r @ r.T + 1e-6).all()
        if more is not None:
            assert (r @ r.T <= more[1] @ more[1].T + 1e-6).all()  # each level bounds no worse than the one before
    limit = np.sort(exact, axis=1)[:, -10]
    may = negatives.alive(side, side, limit, np.full(400, np.inf), np.ones((400, 400), bool))
    assert may[exact >= limit[:, None]].all() and may.mean() < 0.5
