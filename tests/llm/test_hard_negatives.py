"""Hard negatives against all pairs scored with Python's whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tests.llm.awkward import clashing
from tests.oracle_check import compare, connect
from ticketlake.llm import hard_negatives as H
from ticketlake.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int"
FIELDS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, positives=5, negatives=5, percent=80, every=10):
    good = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, str(label), [math.floor(256 * float(np.float32(x))) for x in v]))
    width = max((len(v) for _, _, v in good), default=0)
    good = [(i, c, v + [0] * (width - len(v))) for i, c, v in good]
    anchors = {}
    for i, c, v in good:
        if i % every == 0:
            anchors.setdefault(i, []).append((c, np.array(v, "<i4").tobytes(), v))
    out = set()
    for a, versions in anchors.items():
        c, _, v = min(versions)
        scores = {(sum(x * y for x, y in zip(v, w)), i, d == c) for i, d, w in good if i != a}
        best = sorted({(-s, i) for s, i, same in scores if same})[:positives]
        for p, i in best:
            low = [(-s, j) for s, j, same in scores if not same and percent * -p <= 100 * s <= 100 * -p]
            for k, (s, j) in enumerate(sorted(set(low))[:negatives]):
                out.add((a, i, k + 1, j, -p, -s))
    return sorted(out)


def vectors(n=300, width=12, labels=3, seed=5):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, width))
    rows = []
    for k in range(n):
        label = int(rng.integers(labels))
        rows.append((k, [float(x) for x in np.float32(centre[label] * 0.2 + rng.normal(size=width) * 0.2)], label))
    return rows


AWKWARD = [
    (None, [1.0] * 12, 1),
    (400, None, 1),
    (401, [1.0] * 12, None),
    (402, [float("nan")] + [1.0] * 11, 1),
    (403, [float("inf")] * 12, 1),
    (404, [None] + [1.0] * 11, 1),
    (405, [], 1),
    (410, [], 2),
    (406, [0.5, -0.5], 0),
    (407, [1.0] * 12, 0),
    (407, [1.0] * 12, 0),  # the same row again
    (407, [0.5] * 12, 1),  # the same id with something else
    (420, [1.0] * 12, 0),
    (420, [1.0] * 12, 0),
    (420, [1.0] * 11 + [0.5], 2),
    *[(500 + k, [0.25] * 12, k % 3) for k in range(20)],  # ties
    *[(600 + k, [0.9] * 12, 2) for k in range(40)],  # copies in one label
    (-10, [-0.3] * 12, 0),
]


def run(spark, rows, clash=False, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    df = clashing(df) if clash else df
    found = H.hard_negatives(df, F.col("vec_id") % 10 == 0, **kw)
    assert found.columns == FIELDS
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("clash", [False, True])
def test_awkward_rows(spark, clash):
    rows = vectors() + AWKWARD
    assert run(spark, rows, clash) == brute(rows)


def test_blocks_levels_and_tiles_do_not_matter(spark, monkeypatch):
    rows = vectors(150) + AWKWARD
    expected = brute(rows, 3, 4, 50)
    assert run(spark, rows, positives=3, negatives=4, percent=50, block=7, levels=(2, 6)) == expected
    monkeypatch.setattr(H, "DENSE", 10**9)
    assert run(spark, rows, positives=3, negatives=4, percent=50, levels=(1, 3, 4)) == expected
    assert run(spark, rows, positives=3, negatives=4, percent=50, levels=()) == expected


def test_empty_and_unlabelled_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(10, [1.0], None), (20, None, 3)]) == []
    assert run(spark, [(10, [1.0], 1), (11, [1.0], 2)]) == []  # no positive


def test_bounds_hold_for_every_pair_and_level():
    rng = np.random.default_rng(1)
    x, y = rng.integers(-900, 900, (2, 60, 24))
    levels = (1, 2, 4, 12)
    a, b = (
        H.Vectors.of(range(60), ["l"] * 60, list(m.astype("<i4")), [r.tobytes() for r in H.summaries(m, levels)], 24, levels)
        for m in (x, y)
    )
    exact = x @ y.T
    slack = 1 + H.ROUNDING * np.abs(x).max() * np.abs(y).max() * 24
    reaches = []
    for u, v in zip(a.levels, b.levels, strict=True):
        middle, reach = u.pair_bounds(v)
        assert (middle - reach - slack <= exact).all() and (exact <= middle + reach + slack).all()
        reaches.append(reach.mean())
    assert reaches == sorted(reaches, reverse=True)  # finer segments bound closer


def test_large_numbers_are_refused(spark):
    with pytest.raises(Exception, match="32 bits"):
        run(spark, [(10, [3e38], 1), (11, [1.0], 1)])


def test_query_agrees_with_sql(spark):
    df = queries.QUERIES["op11_hard_negatives"](spark, SF_DIR)
    assert compare(df, connect(SF_DIR), queries.ORACLES["op11_hard_negatives"]) is None
