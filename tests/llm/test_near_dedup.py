"""Near-dedup against all pairs of full sets."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from monthwise.llm import near_dedup as nd
from monthwise.llm.components import connected_components
from monthwise.llm.wordhash import shingle_sets

SCHEMA = "doc_id long, text string, id string, rep int, component string, n string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, percent=80):
    sets = {i: shingles(t, k) for i, t in rows}
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["É", "über", "日本"]
    base = [[rng.choice(vocab) for _ in range(rng.randint(3, 90))] for _ in range(n // 8)]
    common = [rng.choice(vocab) for _ in range(30)]
    out = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        if rng.random() < 0.1:
            w += common
        text = rng.choice([" ", "\n", "\t "]).join(w)
        out.append((i, text.upper() if rng.random() < 0.1 else text))
    return out + [(n, None), (n + 1, ""), (n + 2, " \n\t"), (n + 3, "one"), (n + 4, "ONE "), (n + 5, "x " * 30000)]


def result(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x", 1, "c", "n") for i, t in rows], SCHEMA)
    return [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in nd.near_duplicates(df, **kw).collect()]


@pytest.mark.parametrize("k,leaf", [(4, nd.LEAF), (5, 8)])
def test_components_equal_brute_force(spark, k, leaf):
    rows = corpus()
    got = {i: (n, c) for i, n, c in result(spark, rows, shingle_words=k, leaf=leaf)}
    assert got == brute(rows, k)


def test_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    want = brute(rows, 4)
    assert {i: (n, c) for i, n, c in result(spark, rows, shingle_words=4)} == want
    # through many pivots: at most a few documents on the edge of the group are missed
    got = {i: (n, c) for i, n, c in result(spark, rows, shingle_words=4, leaf=16)}
    assert sum(got[i] != want[i] for i in want) <= 8


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(20))
    got = result(spark, [(5, text), (5, text), (3, text), (None, text), (None, None)], shingle_words=4)
    assert sorted(got, key=str) == sorted([(5, 17, 3), (5, 17, 3), (3, 17, 3), (None, 17, 3), (None, 0, None)], key=str)
    assert result(spark, []) == []


def test_shingle_sets_follow_the_words():
    texts = [t for _, t in corpus(seed=3, n=120)]
    got = [len(s) for s in shingle_sets(pa.array(texts), 4)]
    assert got == [len(shingles(t, 4)) for t in texts]


def test_leaf_forest_spans_the_links():
    rng = np.random.default_rng(0)
    base = np.arange(50, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, 46, replace=False), rng.integers(100, 200, 3).astype(np.uint64)]))
            for _ in range(30)]
    ids = [100 + i for i in range(30)]
    a, b = nd.leaf_forest(ids, sets, 80)
    links = [(i, j) for i in range(30) for j in range(i + 1, 30)
             if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
    root = nd.smallest_labels(*np.array(links).T, 30)
    assert dict(zip(a.tolist(), b.tolist())) == {ids[i]: ids[r] for i, r in enumerate(root) if i != r}


def test_bundles_hold_all_pairs_that_sketches_connect():
    rng = np.random.default_rng(1)
    sk = rng.integers(0, 256, (60, nd.MINHASHES)).astype(np.uint8)
    for i in range(20):                       # one group of 20 and one pair, over three leaves
        sk[i] = np.where(rng.random(nd.MINHASHES) < 0.9, sk[0], sk[i])
    sk[41] = np.where(rng.random(nd.MINHASHES) < 0.9, sk[40], sk[41])
    node = np.repeat([5, 6, 9], [30, 20, 10])
    rep = np.arange(60) * 3
    name, a, b, k = nd._bundles(node, rep, sk, 0.66)
    assert list(zip(a[:k], b[:k])) == [(120, 123)] and set(a[k:]) == set(rep[:20]) and len(set(name[k:])) == 1
    again = nd._bundles(node[:30] + 7, rep[:30], sk[:30], 0.66)
    assert set(again[0]) == set(name[k:])     # the same bundle in another leaf has the same name


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (None, 1)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_near_copies_of_one_absorbed_document_are_found(spark):
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(240):                      # a tight group, many times the leaf
        w = list(base)
        w[rng.randrange(4, 116)] = f"e{i}"
        rows.append((i, " ".join(w)))
    for i in range(240, 300):                 # near one member each, below 0.8 to nearly all others
        w = rows[i - 240][1].split()
        for at in rng.sample(range(4, 116, 8), 3):
            w[at] = f"x{i}.{at}"
        rows.append((i, " ".join(w)))
    got = {i: (n, c) for i, n, c in result(spark, rows, shingle_words=4, leaf=16)}
    assert got == brute(rows, 4)


def test_pairs_with_a_pivot_are_confirmed_below_the_threshold(spark, monkeypatch):
    rng = random.Random(12)
    rows = []
    for i in range(0, 120, 2):                # pairs just above 0.8, many estimated below it
        w = [f"{i}.{j}" for j in range(120)]
        rows.append((i, " ".join(w)))
        for at in rng.sample(range(4, 116, 8), 3):
            w[at] = f"x{at}"
        rows.append((i + 1, " ".join(w)))
    monkeypatch.setattr(nd, "LEAF_SHINGLES", 1)          # every node is large by its shingles
    got = {i: (n, c) for i, n, c in result(spark, rows, shingle_words=4)}
    assert got == brute(rows, 4)


def test_one_id_with_several_texts(spark):
    rng = random.Random(8)
    a, b = ([f"{x}{rng.random()}" for _ in range(60)] for x in "ab")
    rows = [(3, a), (5, a + ["tail"]), (5, b), (7, b + ["tail"]), (9, ["other"] * 20), (None, b), (9, a)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in nd.near_duplicates(df, shingle_words=5).collect()
                  if r["doc_id"]))
    assert got == [(3, 56, 3), (5, 56, 5), (5, 57, 3), (7, 57, 5), (9, 1, 9), (9, 56, 3)]


def test_a_family_just_below_the_threshold_is_compared_in_blocks(spark, monkeypatch):
    """Documents with 88 of 100 words in common, a few of them nearer to another one."""
    monkeypatch.setattr(nd, "FLAT_DEPTH", 1)
    rng = random.Random(12)
    common = [f"c{i}" for i in range(880)]
    rows = []
    for i in range(150):
        own = [f"o{i}_{k}" for k in range(120)]
        rows.append((i, " ".join(common + own)))
        if i % 10 == 0:
            own[5] = "changed"
            rows.append((1000 + i, " ".join(common + own)))
    rng.shuffle(rows)
    called = []
    real = nd._blocks_of
    monkeypatch.setattr(nd, "_blocks_of", lambda *a: called.append(1) or real(*a))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in nd.near_duplicates(df, shingle_words=1, leaf=16).collect()}
    assert called and got == {i: i % 1000 for i, _ in rows}
