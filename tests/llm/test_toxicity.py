"""Held-out accuracy, and the defined results of odd inputs."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa

from monthwise.llm import toxicity as tox
from monthwise.llm.wordhash import hash_words

BAD = ["grumf", "blarg", "zonk", "splat"]


def sample(n=1200, seed=1):
    rng = random.Random(seed)
    vocab = [f"word{i}" for i in range(400)]
    texts, y = [], []
    for i in range(n):
        w = [rng.choice(("the", "of")) if rng.random() < 0.3 else rng.choice(vocab) for _ in range(rng.randint(5, 120))]
        bad = rng.random() < 0.2
        for _ in range(rng.randint(1, 3) if bad else 0):
            w.insert(rng.randrange(len(w) + 1), rng.choice(BAD) + rng.choice(["", ",", "!"]))
        texts.append(" ".join(w))
        y.append(int(bad))
    return texts, np.array(y)


def test_held_out_accuracy():
    texts, y = sample()
    model = tox.train(texts[:800], y[:800], np.arange(800) % 4 == 1)
    lang = tox._language_table()
    got = np.concatenate([model.scores(i, s, lang) for i, s in tox.padded_ids(pa.array(texts[800:], pa.large_string()))])
    assert ((got >= 0.5) == (y[800:] == 1)).mean() > 0.97


def test_a_score_sees_the_whole_text():
    texts, y = sample()
    model = tox.train(texts, y, np.arange(len(y)) % 4 == 1)
    lang = tox._language_table()
    long = "word1 " * 60_000
    got = np.concatenate([model.scores(i, s, lang) for i, s in
                          tox.padded_ids(pa.array([long, long + "grumf", "grumf", "", None], pa.large_string()))])
    assert got[0] < 0.5 <= got[1] and got[2] >= 0.5 and got[3] == got[4] < 0.5


def test_scores_do_not_depend_on_neighbours_in_the_batch():
    texts, y = sample(300)
    model = tox.train(texts, y, np.arange(300) % 4 == 1)
    lang = tox._language_table()
    every = np.concatenate([model.scores(i, s, lang) for i, s in tox.padded_ids(pa.array(texts, pa.large_string()))])
    alone = [model.scores(i, s, lang)[0] for t in texts[:40] for i, s in tox.padded_ids(pa.array([t], pa.large_string()))]
    np.testing.assert_allclose(every[:40], alone, rtol=1e-5)


def test_query_labels_and_edges(spark):
    texts, y = sample(400)
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)] + [(None, "grumf", "s"), (9000, None, "s"),
                                 (9000, None, "s")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(v), "x") for i, v in enumerate(y)] + [(1, None, "x"), (None, 1, "x")],
                                   "doc_id long, toxic int, text string")
    model = tox.fit(docs, labels)
    got = tox.score(docs, model).collect()
    assert len(got) == 403 and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 400 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([(r["score"] >= 0.5) == (y[r["doc_id"]] == 1) for r in held]) > 0.9
    kept = tox.filter_toxic(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["score"] < 0.5 for r in got)
    # held-out labels teach nothing
    flipped = labels.withColumn("toxic", tox.F.when(tox.remainder(tox.F.col("doc_id")) == 0, 1 - tox.F.col("toxic"))
                                .otherwise(tox.F.col("toxic")))
    again = tox.fit(docs, flipped)
    assert np.array_equal(again.emb, model.emb) and np.array_equal(again.out, model.out)


def test_no_labels_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert tox.fit(docs, labels) is None
    assert [r["score"] for r in tox.score(docs, None).collect()] == [0.0, 0.0]
    assert tox.score(docs.limit(0), None).count() == 0 and tox.filter_toxic(docs, None).count() == 2
    one = spark.createDataFrame([(1, 1, 1), (2, 1, 1)], "doc_id long, quality int, toxic int")
    assert tox.fit(docs, one) is None


def plain_score(model, text):
    """The network word by word: a hash a word, loops over windows, filters and places."""
    words = [w for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode())]
    ids = []
    for w in words:
        hashed, _ = hash_words(np.frombuffer(w, np.uint8), np.array([len(w)]), True, True)
        ids.append(int(hashed[0] % np.uint64(tox.BUCKETS)))
    rows = [model.emb[i].astype(float) for i in ids] + [np.zeros(tox.DIM)] * 2
    x = []
    for w, c in zip(tox.WIDTHS, model.conv):
        for f in range(tox.FILTERS):
            z = sorted((sum(float(rows[t + j] @ c[j, :, f]) for j in range(w)) for t in range(len(ids))), reverse=True)
            x += [max(v, 0.0) for v in (z + [0.0] * tox.POOL)[:tox.POOL]]
    language = tox._language_table()
    hits = sum((language[i] for i in ids), np.zeros(len(tox.LANGUAGES)))
    shift = model.shift[int(np.argmax(hits)) if hits.max() > 0 else len(tox.LANGUAGES)]
    return 1 / (1 + np.exp(-(float(np.dot(x, model.out)) + float(model.bias) - float(shift))))


def test_scores_equal_a_plain_loop(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = tox.fit(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    some = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "... !"), (-4, "Ünï the THE x1")], "doc_id long, text string"))
    texts |= {-1: None, -2: "", -3: "... !", -4: "Ünï the THE x1"}
    for r in tox.score(some, model).collect():
        if len(texts[r["doc_id"]] or "") < 6000:
            assert abs(r["score"] - plain_score(model, texts[r["doc_id"]])) < 1e-4, r["doc_id"]


def test_the_sample_has_long_texts_and_only_labels_with_a_text(spark, monkeypatch):
    monkeypatch.setattr(tox, "MAX_TRAIN_ROWS", 60)
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5][:200]
    # toxic texts are long ones; labels of the ids that come first by the sample's hash have no text
    rows = [(i, ("plain words here " * 10_000 if i % 2 else "plain words here ") + ("vile vile " if i % 2 else "kind kind ")) for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids] + [(i, 0) for i in range(1000, 4000)], "doc_id long, toxic int")
    seen = {}
    real = tox.train
    monkeypatch.setattr(tox, "train", lambda texts, toxic, calibrate: seen.update(n=len(texts), longest=max(map(len, texts))) or real(texts, toxic, calibrate))
    tox.fit(docs, labels)
    assert seen["n"] == 60 and seen["longest"] > 150_000
