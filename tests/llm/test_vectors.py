"""Hard negatives, approximate neighbours and whitening against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from citylode.llm import whitening
from citylode.llm.hard_negatives import hard_negatives, pieces, window_below
from citylode.llm.neighbours import nearest
from citylode.llm.residues import Residues, primes_for, product
from citylode.llm.whitening import whiten

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, d int, anchor boolean"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(
        [(i, v, label, "own", 1, None) for i, v, label in rows], SCHEMA.replace("<float>", f"<{kind}>"))


def vectors(rng, n, d, few=False):
    """Rows with ties: components from a few values, some rows repeated."""
    out = []
    for i in range(n):
        v = [float(np.float32(rng.choice([-0.5, 0.0, 0.25, 0.5]) if few else rng.gauss(0, 0.3))) for _ in range(d)]
        out.append((i, v, rng.randrange(3)))
    return out


def levels(v, scale):
    return [math.floor(scale * x) for x in v]


def brute_negatives(rows, step, positives=5, negatives=5, scale=256):
    good = [
        (i, levels(v, scale), label, n) for n, (i, v, label) in enumerate(rows)
        if i is not None and label is not None and v is not None
        and all(x is not None and math.isfinite(x) and math.isfinite(x * scale) for x in v)]
    out = []
    for i, v, label, n in good:
        if i % step:
            continue

        def scored(same, v=v, label=label, n=n):
            found = [
                (-sum(map(int.__mul__, v, w)), j) for j, w, other, m in good
                if m != n and len(w) == len(v) and (other == label) == same]
            return sorted(f for f in found if -(1 << 63) <= -f[0] < 1 << 63)

        for score, j in scored(True)[:positives]:
            near = [f for f in scored(False) if -80 * score <= -100 * f[0] <= -100 * score]
            out += [(i, j, rank, k, -score, -s) for rank, (s, k) in enumerate(near[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, step=5, kind="float", **options):
    got = hard_negatives(spark, frame(spark, rows, kind), F.col("vec_id") % step == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize(("few", "block"), [(False, None), (True, 17), (False, 40)])
def test_negatives_against_brute_force(spark, few, block):
    rows = vectors(random.Random(1), 150, 6, few)
    rows += [(r[0], r[1], (r[2] + k) % 3) for k, r in enumerate(rows[:20])]  # repeated ids, some of them whole rows
    want = brute_negatives(rows, 5)
    assert mined(spark, rows, block=block) == want and len(want) > 100


def test_negatives_of_odd_rows(spark):
    rng = random.Random(2)
    rows = vectors(rng, 60, 4) + [
        (60, None, 1), (65, [0.1, None, 0.2, 0.3], 1), (70, [math.nan, 0.1, 0.2, 0.3], 1), (75, [math.inf, 0.0, 0.0, 0.0], 0),
        (80, [0.1, 0.2, 0.3, 0.4], None), (None, [0.1, 0.2, 0.3, 0.4], 1), (85, [], 1), (90, [], 2), (95, [0.5], 1),
        (100, [0.36], 2), (105, [0.4], 1)]
    want = brute_negatives(rows, 5)
    assert mined(spark, rows) == want
    assert any(r[0] == 95 for r in want)
    assert mined(spark, []) == []
    assert mined(spark, [(0, [0.1], 1)]) == []


def test_negatives_of_large_numbers(spark):
    """Scores beyond a long do not count; those near it are exact."""
    rng = random.Random(3)
    rows = [(i, [rng.choice([1.0, -3.0, 2.5, 0.1]) * 10.0 ** rng.choice([0, 5, 7, 30]) for _ in range(3)], rng.randrange(2))
            for i in range(80)] + [(80, [1e306, 0.0, 0.0], 1), (85, [1e300, 0.0, 1.0], 0)]
    assert mined(spark, rows, kind="double") == brute_negatives(rows, 5)


@pytest.mark.parametrize("size", [3, 1 << 11, 1 << 25, 1 << 70])
def test_residue_products_are_exact(size):
    rng = random.Random(size)
    a, b = ([[float(rng.randint(-size, size)) for _ in range(700)] for _ in range(5)] for _ in range(2))
    bits = 2 * math.log2(size) + math.log2(700)
    x, y = (Residues(np.array(m), primes_for(bits)) for m in (a, b))
    want = [[sum(int(p) * int(q) for p, q in zip(r, s, strict=True)) for s in b] for r in a]
    assert product(x, y, slice(0, 5), slice(0, 5)).tolist() == want
    got = {(int(i), int(j)): int(s[k, m]) for i_, j_, s in pieces(np.array(a), np.array(b))
           for k, i in enumerate(i_) for m, j in enumerate(j_)}
    assert got == {(i, j): want[i][j] for i in range(5) for j in range(5)}


@pytest.mark.parametrize("kind", [np.int64, object])
def test_windows_below_a_limit(kind):
    rng = np.random.default_rng(4)
    scores = rng.integers(-40, 40, (12, 50)).astype(kind)
    allowed = rng.random((12, 50)) < 0.7
    row = np.repeat(np.arange(12), 4)
    limit = rng.integers(-30, 60, 48)
    t, c = window_below(scores, allowed, row, limit, 80, 100, 5)
    for n in range(48):
        want = sorted((-scores[row[n], j], j) for j in range(50) if allowed[row[n], j]
                      and 80 * limit[n] <= 100 * scores[row[n], j] and scores[row[n], j] <= limit[n])[:5]
        assert c[t == n].tolist() == [j for _, j in want]


def brute_neighbours(rows, step, k):
    good = [(i, np.array(v, float), n) for n, (i, v, _) in enumerate(rows)
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for i, v, n in good:
        if i % step == 0:
            found = sorted((-float(v @ w), j, m) for j, w, m in good if m != n and len(w) == len(v))[:k]
            out += [(i, rank, j, -s) for rank, (s, j, _) in enumerate(found, 1)]
    return sorted(out)


def searched(spark, rows, step=5, kind="float", **options):
    got = nearest(spark, frame(spark, rows, kind), F.col("vec_id") % step == 0, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in got.collect())


def same_neighbours(got, want):
    """Equal but for the last digits of scores."""
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert all(a[3] == pytest.approx(b[3], rel=1e-12, abs=1e-12) for a, b in zip(got, want, strict=True))


@pytest.mark.parametrize("shard", [None, 70])
def test_neighbours_of_small_tables_are_exact(spark, shard):
    """A beam as wide as a shard leaves nothing out: equal vectors, long ones, ties, shards and query blocks."""
    rng = random.Random(5)
    rows = vectors(rng, 200, 5) + [(200 + i, [0.5, 0.25, 0.0, -0.0, 1.0], 1) for i in range(90)]
    rows += [(300 + i, [x * 2 for x in r[1]], 1) for i, r in enumerate(rows[:10])] + rows[:6]
    same_neighbours(searched(spark, rows, k=20, shard=shard, query_block=30), brute_neighbours(rows, 5, 20))


def test_neighbours_of_odd_rows(spark):
    rows = [(0, [0.0, 0.0], 1), (5, [1.0, 0.0], 1), (10, None, 1), (15, [1.0, None], 1), (20, [math.nan, 1.0], 1),
            (25, [math.inf, 1.0], 1), (30, [1.0], 1), (35, [2.0], 1), (None, [1.0, 1.0], 1), (40, [-1.0, 0.5], 1), (5, [1.0, 0.0], 1),
            (45, [], 1)]
    same_neighbours(searched(spark, rows), brute_neighbours(rows, 5, 20))
    assert searched(spark, []) == [] and searched(spark, [(5, [1.0], 1)]) == []
    assert searched(spark, [(5, [1e200, 0.0], 1), (6, [1.0, 1.0], 1), (10, [2.0, 1.0], 1)], kind="double") == [(10, 1, 6, 3.0)]


def test_recall_of_neighbours(spark):
    """The given table, and one where a third of all rows are equal and lengths differ widely."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 24))
    v = (centres[rng.integers(0, 30, 3000)] + 0.5 * rng.normal(size=(3000, 24))) * rng.choice([0.1, 1, 1, 5], (3000, 1))
    v[:1000] = v[0]
    rows = [(i, [float(np.float32(x)) for x in row], 0) for i, row in enumerate(v[rng.permutation(3000)])]
    got, want = searched(spark, rows, 50), brute_neighbours(rows, 50, 20)
    assert len(got) == len(want)
    assert len({r[:1] + r[2:3] for r in got} & {r[:1] + r[2:3] for r in want}) >= 0.95 * len(want)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, 0) for r in table.collect()]
    want = {r[:1] + r[2:3] for r in brute_neighbours(rows, 20, 20)}
    found = {(r.query_id, r.vec_id) for r in nearest(spark, table, F.col("vec_id") % 20 == 0).collect()}
    assert len(found & want) >= 0.95 * len(want)


def brute_whitening(rows, scale=1024, offset=100_000):
    good = [(i, [math.floor(scale * c) + offset for c in v]) for i, v, _ in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    n, sums = len(good), [sum(c) for c in zip(*(x for _, x in good), strict=True)]
    return good, n, [sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for _, x in good], np.array(
        [[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for _, x in good])


def whitened(spark, rows, kind="float", **options):
    return whiten(spark, frame(spark, rows, kind), **options).collect()


@pytest.mark.parametrize("large", [1.0, 1e9])
def test_whitening_against_brute_force(spark, large):
    rng = random.Random(7)
    rows = [(i, [rng.gauss(0.1 * k, 0.2 + 0.1 * k) * large for k in range(12)], 0) for i in range(300)] + [
        (5, [0.5] * 12, 0), (None, [0.25] * 12, 0), (301, None, 0), (302, [0.5, None] * 6, 0), (303, [math.nan] * 12, 0),
        (304, [math.inf] * 12, 0), (305, [1.0], 0), (306, [], 0), (307, [1e300] * 12, 0)]
    good, n, deviation, centred = brute_whitening(rows[:302])
    got = whitened(spark, rows, "double")
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    want = {}
    for (i, _), x in zip(good, deviation, strict=True):
        want.setdefault(i, []).append(x if x < 1 << 63 else None)
    assert all(r.deviation in want[r.vec_id] for r in got)
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    expected = centred @ directions[:, ::-1] / np.sqrt(values[::-1])
    for k in range(8):
        mine = [(r.vec_id, r.whitened, r.explained) for r in got if r.component == k + 1]
        assert all(e == pytest.approx(values[11 - k] / values.sum(), rel=1e-9) for _, _, e in mine)
        sign = np.sign(next(w for i, w, _ in mine if i == 7)) * np.sign(expected[7, k])
        one = sorted(((i is None, i or 0), w) for i, w, _ in mine)
        two = sorted(((i is None, i or 0), sign * w) for (i, _), w in zip(good, expected[:, k], strict=True))
        assert [a for a, _ in one] == [a for a, _ in two]
        assert np.allclose([w for _, w in one], [w for _, w in two], rtol=1e-7, atol=1e-9)
    assert max(r.identity_error for r in got) < 1e-9


def test_whitening_of_flat_and_empty_tables(spark):
    assert whitened(spark, []) == [] and whitened(spark, [(1, None, 0)]) == []
    assert whitened(spark, [(i, [0.5, 0.25], 0) for i in range(5)]) == []
    got = whitened(spark, [(i, [0.1 * i, 0.5], 0) for i in range(10)])
    assert {r.component for r in got} == {1} and len(got) == 10 and {r.explained for r in got} == {1.0}
    got = whitened(spark, [(i, [0.1 * i * i, 0.5 * i], 0) for i in range(10)] + [(20, [1.0], 0)], components=1)
    assert {r.component for r in got} == {1} and {r.vec_id for r in got} == set(range(10))


def test_whitening_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 4)
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(10)], 0) for i in range(50)]
    _, n, _, centred = brute_whitening(rows)
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    got = {(r.vec_id, r.component): r.whitened for r in whitened(spark, rows, "double")}
    for k in range(8):
        want = centred @ directions[:, 9 - k] / np.sqrt(values[9 - k])
        assert np.allclose(np.abs([got[i, k + 1] for i in range(50)]), np.abs(want), rtol=1e-8)
