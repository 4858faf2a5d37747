import math
import random

import numpy as np
import pytest

from stratalake.llm.hard_negatives import HardNegatives, bit_planes, hard_negatives, scores, subset_sums

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, `a.b` int"


def brute_force(rows):
    """rows: (vec_id, vector, label), each vec_id once."""
    known = []
    for name, vector, label in rows:
        if None in (name, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        known.append((name, [math.floor(256 * float(np.float32(x))) for x in vector], (label + 1) % 10 if name % 7 == 0 else label))
    out = []
    for anchor, a, label in known:
        if anchor % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), n, own) for n, v, own in known if n != anchor)
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            near = [s for s in scored if s[2] != label and -50 * p <= -100 * s[0] <= -95 * p][:3]
            out += [(anchor, positive, rank, n, -p, -s) for rank, (s, n, _) in enumerate(near, 1)]
    return sorted(out)


def made(seed, count, size):
    r = random.Random(seed)
    centres = [[r.gauss(0, 0.3) for _ in range(size)] for _ in range(4)]
    rows = []
    for name in range(count):
        vector = [x + r.gauss(0, 0.1) for x in r.choice(centres)]
        rows.append((name - 100, vector, r.randrange(3)))
    same = rows[7][1]
    return rows + [(count + n, same, n % 3) for n in range(60)]  # ties


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", 1) for row in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("settings", [HardNegatives(), HardNegatives(anchors=2, candidates=40)])
@pytest.mark.parametrize("size", [8, 13])
def test_equals_brute_force(spark, settings, size):
    rows = made(size, 500, size)
    got = sorted(map(tuple, hard_negatives(frame(spark, rows), settings).collect()))
    assert got == brute_force(rows) and len(got) > 50


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [
        (1000, None, 1), (1001, [0.5, None], 1), (1002, [nan, 1.0], 1), (1003, [inf, 1.0], 2), (1004, [0.5, 0.5], None),
        (None, [0.5, 0.5], 1), (1005, [], 1), (1006, [0.5], 2), (1050, [3.0e3, -3.0e3], 1), (1051, [2.9e3, -3.0e3], 1),
        (1052, [2.0e3, -2.0e3], 2),
    ]
    rows = made(1, 200, 2) + odd
    got = sorted(map(tuple, hard_negatives(frame(spark, rows)).collect()))
    whole = [(n, v if v is None else v + [0.0] * (2 - len(v)), label) for n, v, label in rows]
    assert got == brute_force(whole)
    # Of rows with the same vec_id the one with the smallest label, then vector, takes part.
    again = [(n, v, label + 1) for n, v, label in rows[:40]] + rows[:40]
    assert got == sorted(map(tuple, hard_negatives(frame(spark, rows + again)).collect()))
    assert hard_negatives(frame(spark, rows).limit(0)).collect() == []
    assert hard_negatives(frame(spark, [(50, [1.0], 1)])).collect() == []
    with pytest.raises(ValueError):
        hard_negatives(frame(spark, [(50, [1e30], 1)]))


def test_scores_from_tables():
    r = np.random.default_rng(0)
    for planes, most in ((1, 0), (3, 4), (9, 256), (20, 2**19)):
        anchors = r.integers(-most, max(most, 1), (7, 24))
        candidates = r.integers(-most, max(most, 1), (30, 24))
        assert (scores(subset_sums(anchors), bit_planes(candidates, planes)) == candidates @ anchors.T).all()
