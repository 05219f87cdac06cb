"""Removed spans against plain windows, and the automaton against plain search."""

import hashlib
import random
import re

import numpy as np
import pytest

from monthwise.llm import substring_dedup as S
from monthwise.llm import suffix_automaton as A

SCHEMA = "doc_id long, text string, row long, doc string, spans int"


def plain(rows, window=50):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            first[key] = min(first.get(key, S.LAST), S.LAST if i is None else i)
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (S.LAST if i is None else i):
                gone |= set(range(s, s + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], SCHEMA).repartition(4)
    return sorted((tuple(r) for r in S.dedup_substrings(df, **kw).collect()), key=str)


def corpus(n, seed, vocabulary=400):
    """Documents with copies, passages of lengths around the window and passages in passages."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    shared = [[word() for _ in range(rng.choice([49, 50, 51, 70, 200]))] for _ in range(8)]
    out = []
    for _ in range(n):
        text = []
        for _ in range(rng.randint(0, 4)):
            text += [word() for _ in range(rng.choice([0, 1, 5, 40]))]
            p = rng.choice(shared)
            cut = rng.randint(0, 20) if rng.random() < 0.4 else 0
            text += p[cut:] if rng.random() < 0.5 else p[:len(p) - cut]
        out.append(rng.choice([" ", "\n", " \t "]).join(text))
    return out


@pytest.mark.parametrize("seed,shard_words", [(1, S.SHARD_WORDS), (2, 300), (3, 60)])
def test_equal_to_plain_windows(spark, seed, shard_words):
    rng = random.Random(seed)
    texts = corpus(120, seed)
    texts += [rng.choice(texts) for _ in range(20)]
    ids = rng.sample(range(1000), len(texts))
    rows = list(zip(ids, texts))
    assert run(spark, rows, shard_words=shard_words) == plain(rows)


def test_a_window_that_the_first_holder_of_its_words_lacks(spark):
    """Anchors of documents 2 and 3 stand in document 1, but their windows do not."""
    rng = random.Random(4)
    rows = []
    for k in range(12):
        core = [f"c{rng.random()}" for _ in range(45)]
        tail = [f"t{rng.random()}" for _ in range(5)]
        other = [f"o{rng.random()}" for _ in range(30)]
        rows += [(3 * k + 1, " ".join(core + other)), (3 * k + 2, " ".join(core + tail)), (3 * k + 3, " ".join(["lead", *core, *tail, "end"]))]
    want = plain(rows)
    assert sum(r[2] for r in want) == 12 * 50
    assert run(spark, rows) == want


def test_nulls_repeats_hot_passages_and_long_texts(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"a{i} b{i} {passage} z{i}") for i in range(150)]
    rows += [(None, passage), (None, "x " + passage), (7, passage + " tail"), (200, None), (201, ""), (202, " \n\t "), (203, "few words"),
             (204, "very " * 3000), (205, "very " * 3000), (206, "é  ñ " * 80), (207, "é  ñ " * 80 + "x"),
             (-5, " ".join(f"q{i % 7}" for i in range(500))), (-6, " ".join(f"q{i % 7}" for i in range(90))), (205, "very " * 3000)]
    got = run(spark, rows, shard_words=500)
    assert got == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("alphabet", [2, 3, 30])
def test_automaton(alphabet):
    rng = random.Random(alphabet)
    texts = [np.array([rng.randrange(alphabet) for _ in range(rng.randint(1, 60))], dtype=np.uint64) for _ in range(12)]
    docs = [rng.randrange(6) for _ in texts]
    matcher = A.Matcher(A.build(texts, docs))
    for window in (1, 2, 5):
        first = {}
        for t, d in zip(texts, docs):
            for s in range(len(t) - window + 1):
                key = tuple(t[s:s + window].tolist())
                first[key] = min(first.get(key, 99), d)
        for _ in range(10):
            q = np.array([rng.randrange(alphabet + 1) for _ in range(50)], dtype=np.uint64)
            for doc in (0, 3, 6):
                want = [i >= window - 1 and first.get(tuple(q[i - window + 1:i + 1].tolist()), 99) < doc for i in range(len(q))]
                assert matcher.found(q, doc, window).tolist() == want
