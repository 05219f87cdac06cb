"""Vector codes against plain integer loops."""

import hashlib
import math
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from monthwise.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error long"


def plain(rows, parts=4, entries=256, rounds=4):
    kept = [(i, v, lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    fit = sorted((r for r in kept if r[1] and len(r[1]) % parts == 0), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = len(fit[0][1]) if fit else -1
    fit = [r for r in fit if len(r[1]) == dim]
    w = dim // parts

    def cut(v):
        x = [math.floor(Fraction(a) * 1024) for a in v]
        return [x[p * w:(p + 1) * w] for p in range(parts)]

    books = [[cut(v)[p] for _, v, _ in fit[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = [[list(e) for e in book] for book in books]
        for p in range(parts):
            got = defaultdict(list)
            for _, v, _ in fit:
                got[near(p, cut(v)[p])[1]].append(cut(v)[p])
            for k, xs in got.items():
                new[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
        books = new
    out = []
    for i, v, lab in kept:
        if len(v) != dim:
            out.append((i, None, None, lab))
            continue
        best = [near(p, x) for p, x in enumerate(cut(v))]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), lab))
    by, over = defaultdict(int), set()
    for _, code, e, lab in out:
        if e is not None:
            by[lab] += e
            if e >= 1 << 63:
                over.add(lab)
    flat = ",".join(str(x) for b in books for e in b for x in e)
    return sorted(((i, c, e if e is None or e < 1 << 63 else None, by[lab] if lab in by and lab not in over and by[lab] < 1 << 63 else None)
                   for i, c, e, lab in out), key=str), hashlib.sha256(flat.encode()).hexdigest()


def coded(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows], SCHEMA).repartition(3)
    got, books = V.compress(df, **kw)
    return sorted(((r["id"], r["code"], r["error"], r["label_error"]) for r in got.collect()), key=str), V.digest(books)


def vectors(n, dim, seed, scale=1.0):
    rng = random.Random(seed)
    base = [[rng.gauss(0, scale) for _ in range(dim)] for _ in range(12)]
    return [(i, [x + rng.gauss(0, scale / 20) for x in rng.choice(base)], rng.choice([None, 1, 1, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e12, 1e40])
def test_equal_to_plain_loops_at_every_magnitude(spark, scale):
    rows = vectors(320, 8, 3, scale)
    assert coded(spark, rows) == plain(rows)


def test_nulls_odd_lengths_repeats_and_ties(spark):
    rows = vectors(40, 8, 5)
    rows += [(3, rows[4][1], 2), (3, rows[4][1], 2), (None, rows[1][1], 1), (None, [0.0] * 8, None), (50, None, 1), (51, [None] * 8, 1),
             (52, [float("nan")] * 8, 1), (53, [float("inf")] + [0.0] * 7, 1), (54, [], 1), (55, [1.0] * 7, 9), (56, [1.0] * 12, 1),
             (57, [-0.0] * 8, 3), (58, [-0.0005] * 8, 3)]
    assert coded(spark, rows) == plain(rows)


def test_few_rows_and_none(spark):
    assert coded(spark, vectors(1, 4, 1)) == plain(vectors(1, 4, 1))
    assert coded(spark, []) == ([], hashlib.sha256(b"").hexdigest())
    assert coded(spark, [(1, [1.0, 2.0], 1)])[0] == [(1, None, None, None)]


@pytest.mark.parametrize("bits", [5, 20, 26, 31, 45, 60, 200])
def test_dots_are_exact(bits):
    rng = random.Random(bits)
    a, b = ([[rng.randint(-(1 << bits), 1 << bits) for _ in range(16)] for _ in range(9)] for _ in range(2))
    kind = np.int64 if bits < 62 else object
    got = V.dots(np.array(a, dtype=kind), np.array(b, dtype=kind))
    assert [[int(x) for x in row] for row in got] == [[sum(x * y for x, y in zip(r, s)) for s in b] for r in a]
    for parts in V.limbs(np.array(a, dtype=kind), V.limb_bits(16)):
        assert 16 * np.abs(parts).max() ** 2 < 2.0 ** 53
