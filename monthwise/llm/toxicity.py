"""Operator 4: toxicity by a convolutional text classifier.

Words (lower-cased runs of letters and digits) are hashed into an embedding
table; filters of one, two and three words run over the whole text, ReLU and max
pooling give the POOL largest values of each filter as features (so one odd word
weighs less than several), and a logistic unit gives the score.  The
network is trained in numpy on a bounded sample of labelled rows: the
MAX_TRAIN_ROWS smallest by a hash of the id, none with crc32(id) mod 5 = 0.
Only buckets whose share of toxic texts stands out from chance are fitted; all
others stay at zero, so an unknown or ordinary word adds nothing to any filter.

One part of the sample (crc32 mod 5 = 1) is not fitted; on it a decision
threshold is chosen for each language, and the score is shifted so that every
threshold lies at 0.5.  The language is guessed from function words in the text
itself: no column but the text enters a score.

Scoring is one pass over the table, without a shuffle; the model has a fixed size.

Defined results: null or empty text: the score of a text without words.  Null id:
held_out false.  Null labels are left out; of repeated labels the largest counts.
Without labels of both kinds every score is 0.  Empty table: empty result.
Extra columns are ignored by ``score`` and kept by ``filter_toxic``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import bounded_batches, table
from monthwise.llm.wordhash import hash_words, text_slices

BUCKETS = 1 << 17
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8                     # of each width
POOL = 3                        # largest values kept of each filter
MAX_TRAIN_ROWS = 6000
MIN_DOCS = 3                    # a bucket is fitted if so many sample texts use it and its share
MIN_ERRORS = 6.0                # of toxic ones is this many standard errors off
PRIOR = 5.0                     # sample texts that a bucket's prior counts for
EPOCHS = 8
EMB_RATE = 0.3
BATCH = 64
PAD = BUCKETS                   # the zero row behind each text
LEAST_ROWS, LEAST_TOXIC = 60, 12  # for a threshold of a language's own

# Function words that tell the languages apart.
LANGUAGE_WORDS = {
    "en": ("the", "of", "and", "to", "is", "was", "for", "that", "with", "this"),
    "de": ("der", "die", "das", "und", "ist", "von", "den", "mit", "für", "auf"),
    "fr": ("le", "les", "des", "et", "est", "une", "dans", "pour", "du", "que"),
    "es": ("el", "los", "las", "del", "por", "una", "con", "para", "y", "como"),
}
LANGUAGES = tuple(LANGUAGE_WORDS)


def _language_table() -> np.ndarray:
    out = np.zeros((BUCKETS + 1, len(LANGUAGES)), dtype=np.float32)
    for i, ws in enumerate(LANGUAGE_WORDS.values()):
        data = " ".join(ws).encode()
        h, _ = hash_words(np.frombuffer(data, np.uint8), np.array([len(data)]), True, True)
        out[(h % np.uint64(BUCKETS)).astype(np.int64), i] = 1
    return out


def padded_ids(column: pa.Array):
    """Per slice of texts: bucket ids with two PADs behind each text, and text starts."""
    gap = max(WIDTHS) - 1
    for _, data, ends in text_slices(column):
        h, last = hash_words(data, ends, True, True)
        ids = (h % np.uint64(BUCKETS)).astype(np.int32)
        n = np.diff(np.concatenate([[0], last]))
        out = np.full(len(ids) + gap * len(n), PAD, dtype=np.int32)
        starts = np.concatenate([[0], np.cumsum(n + gap)[:-1]])
        out[np.repeat(starts - (last - n), n) + np.arange(len(ids))] = ids
        yield out, starts


class Model:
    """Embeddings, filters and output of the network, with thresholds by language."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.emb = np.zeros((BUCKETS + 1, DIM), dtype=np.float32)
        self.conv = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        for c in self.conv:
            c[:, 0, :] = np.abs(c[:, 0, :]) + 0.3
        self.out = rng.uniform(0.05, 0.2, FILTERS * POOL * len(WIDTHS)).astype(np.float32)
        self.bias = np.float32(-1.0)
        self.shift = np.zeros(len(LANGUAGES) + 1, dtype=np.float32)   # last: language unknown

    def features(self, ids, starts):
        """(embeddings, places, values): for each text the POOL largest values of every
        filter (texts x filters x POOL, by width) and the windows that gave them, -1 for none."""
        e = self.emb[ids]
        pad = ids == PAD
        doc = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ids))))
        places, values = [], []
        for w, c in zip(WIDTHS, self.conv):
            z = e @ c[0]
            for j in range(1, w):
                z[:-j] += e[j:] @ c[j]
            z[pad] = 0
            at, f = np.nonzero(z > 0)
            v = z[at, f]
            cell = doc[at] * FILTERS + f
            order = np.lexsort((-v, cell))
            at, v, cell = at[order], v[order], cell[order]
            first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, int)
            rank = np.arange(len(cell)) - np.repeat(first, np.diff(np.append(first, len(cell))))
            keep = rank < POOL
            place = np.full((len(starts) * FILTERS, POOL), -1, dtype=np.int64)
            value = np.zeros((len(starts) * FILTERS, POOL), dtype=np.float32)
            place[cell[keep], rank[keep]] = at[keep]
            value[cell[keep], rank[keep]] = v[keep]
            places.append(place.reshape(len(starts), FILTERS, POOL))
            values.append(value.reshape(len(starts), FILTERS * POOL))
        return e, places, np.concatenate(values, axis=1)

    def logits(self, ids, starts):
        return self.features(ids, starts)[2] @ self.out + self.bias

    def scores(self, ids, starts, language):
        x = self.logits(ids, starts) - self.shift[guess(ids, starts, language)]
        return 1 / (1 + np.exp(-x.astype(np.float64)))


def guess(ids, starts, language) -> np.ndarray:
    """Index of the language with most function words; the last index if none is found."""
    hits = np.add.reduceat(language[ids], starts, axis=0)
    return np.where(hits.max(axis=1) > 0, hits.argmax(axis=1), len(LANGUAGES))


def train(texts: list[str], toxic: np.ndarray, calibrate: np.ndarray, seed: int = 1) -> Model | None:
    """Fit on the rows where ``calibrate`` is false, choose thresholds on the others."""
    model, rng = Model(seed), np.random.default_rng(seed)
    docs: list[np.ndarray] = []
    for ids, starts in padded_ids(pa.array(texts, pa.large_string())):
        docs += np.split(ids, starts[1:])
    fit = np.flatnonzero(~calibrate)
    if not len(fit) or toxic[fit].min() == toxic[fit].max():
        return None
    seen = np.zeros((2, BUCKETS + 1))
    for i in fit:
        seen[int(toxic[i]), np.unique(docs[i])] += 1
    pos, neg = toxic[fit].sum(), (1 - toxic[fit]).sum()
    share = pos / (pos + neg)                   # rare buckets are drawn towards the common share
    odds = np.log((seen[1] + PRIOR * share) / (seen[0] + PRIOR * (1 - share))) - math.log(pos / neg)
    sure = np.abs(seen[1] * neg - seen[0] * pos) / np.sqrt((seen[0] + seen[1]) * pos * neg + 1)
    known = (seen.sum(axis=0) >= MIN_DOCS) & (sure >= MIN_ERRORS)
    known[PAD] = False
    model.emb[known, 0] = odds[known]
    model.emb[known, 1:] = rng.normal(0, 0.02, (int(known.sum()), DIM - 1))
    g_emb = np.full((BUCKETS + 1, 1), 1e-2, dtype=np.float32)
    g_conv = [np.full_like(c, 1e-2) for c in model.conv]
    g_out, g_bias = np.full_like(model.out, 1e-2), 1e-2
    heavy = min(4.0, math.sqrt(neg / pos))
    for epoch in range(EPOCHS):
        rate = 0.1 / (1 + epoch)
        order = rng.permutation(fit)
        for lo in range(0, len(order), BATCH):
            some = order[lo:lo + BATCH]
            ids = np.concatenate([docs[i] for i in some])
            n = np.array([len(docs[i]) for i in some])
            starts = np.concatenate([[0], np.cumsum(n)[:-1]])
            y = toxic[some]
            e, places, pooled = model.features(ids, starts)
            p = 1 / (1 + np.exp(-(pooled @ model.out + model.bias)))
            d = ((p - y) * np.where(y == 1, heavy, 1) / len(some)).astype(np.float32)
            down = d[:, None] * model.out[None, :] * (pooled > 0)
            grad = pooled.T @ d + 1e-4 * model.out
            g_out += grad ** 2
            g_bias += float(d.sum()) ** 2
            model.out -= rate * grad / np.sqrt(g_out)
            model.bias -= np.float32(rate * d.sum() / math.sqrt(g_bias))
            for k, (w, c) in enumerate(zip(WIDTHS, model.conv)):
                at = places[k].reshape(len(some), -1)                  # filters x POOL in a row
                g = down[:, k * FILTERS * POOL:(k + 1) * FILTERS * POOL] * (at >= 0)
                rows = np.clip(at, 0, len(ids) - w)[:, :, None] + np.arange(w)
                filt = np.repeat(np.arange(FILTERS), POOL)
                each = np.einsum("bq,bqwd->qwd", g, e[rows])
                gc = np.add.reduceat(each, np.arange(0, FILTERS * POOL, POOL), axis=0).transpose(1, 2, 0) + 1e-4 * c
                touched = ids[rows].reshape(-1)
                ge = (g[:, :, None, None] * c.transpose(2, 0, 1)[filt][None]).reshape(-1, DIM)
                live = known[touched] & (np.abs(ge).sum(axis=1) > 0)
                g_conv[k] += gc ** 2
                c -= rate * gc / np.sqrt(g_conv[k])
                if live.any():
                    u, inv = np.unique(touched[live], return_inverse=True)
                    total = np.zeros((len(u), DIM), dtype=np.float32)
                    np.add.at(total, inv, ge[live])
                    g_emb[u] += (total ** 2).sum(axis=1, keepdims=True)
                    model.emb[u] -= EMB_RATE * rate * total / np.sqrt(g_emb[u])
    _calibrate(model, docs, toxic, np.flatnonzero(calibrate) if calibrate.any() else fit)
    return model


def best_threshold(x: np.ndarray, y: np.ndarray) -> float:
    """The middle of the widest gap between logits among the cuts of highest F1."""
    order = np.argsort(-x)
    x, y = x[order], y[order]
    hit = np.cumsum(y)
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    edge = np.append(x[1:], x[-1] - 1)
    f1[x == edge] = -1
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    i = best[np.argmax(x[best] - edge[best])]
    return float((x[i] + edge[i]) / 2)


def _calibrate(model, docs, toxic, rows) -> None:
    language = _language_table()
    x, lang = [], []
    for i in rows:
        start = np.array([0])
        x.append(model.logits(docs[i], start)[0])
        lang.append(guess(docs[i], start, language)[0])
    x, lang, y = np.array(x), np.array(lang), toxic[rows]
    if 0 < y.sum() < len(y):
        model.shift[:] = best_threshold(x, y)
    for k in range(len(LANGUAGES)):
        at = lang == k
        if at.sum() >= LEAST_ROWS and LEAST_TOXIC <= y[at].sum() < at.sum():
            model.shift[k] = best_threshold(x[at], y[at])


def remainder(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string")) % 5


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Train on at most MAX_TRAIN_ROWS labelled rows of ``docs`` (doc_id, text), whole texts;
    labels without a text do not count."""
    chosen = labels.where("doc_id is not null and toxic is not null").where(remainder(F.col("doc_id")) != 0) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")) \
        .join(docs.where("text is not null").select("doc_id"), "doc_id", "left_semi") \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAIN_ROWS)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(chosen, "doc_id") \
        .where("text is not null").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")) \
        .select(F.crc32(F.col("doc_id").cast("string")).alias("c"), "doc_id", "text",
                (F.col("toxic") > 0).cast("int").alias("toxic")).toArrow().sort_by([("c", "ascending"), ("doc_id", "ascending")])
    if not rows.num_rows:
        return None
    return train(rows["text"].to_pylist(), rows["toxic"].to_numpy().astype(np.int64), rows["c"].to_numpy() % 5 == 1)


def _scorer(model):
    if model is not None:              # only the rows in use travel
        used = np.flatnonzero(np.abs(model.emb).sum(axis=1) > 0).astype(np.int32)
        rest = (model.conv, model.out, model.bias, model.shift)
        packed = (used, model.emb[used], rest)

    def run(batches):
        if model_is_none:
            for b in batches:
                yield _with_score(b, np.zeros(b.num_rows))
            return
        net = Model()
        net.emb[packed[0]] = packed[1]
        net.conv, net.out, net.bias, net.shift = packed[2]
        language = _language_table()
        for b in batches:
            got = [net.scores(ids, starts, language) for ids, starts in padded_ids(b.column(1))]
            yield _with_score(b, np.concatenate(got) if got else np.zeros(0))

    model_is_none = model is None
    if model_is_none:
        packed = None
    model = None                       # not shipped with the closure
    return run


def _with_score(b, score):
    return pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per row of ``docs``: doc_id and score."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_scorer(model), "doc_id long, score double")


def _keeper(model, at):
    inner = _scorer(model)

    def run(batches):
        for b in batches:
            two = pa.RecordBatch.from_arrays([b.column(at), b.column(at)], names=["doc_id", "text"])
            got = next(iter(inner(iter([two]))))
            yield b.filter(pa.array(got.column(1).to_numpy() < 0.5))
    return run


def filter_toxic(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows scored below 0.5, all columns as they were."""
    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(_keeper(model, docs.columns.index(text_col)), docs.schema)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels"))) \
        .select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                (F.col("score") >= 0.5).cast("int").alias("predicted"))
