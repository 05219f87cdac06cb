"""Operator 8: mixture-controlled packing by deficit round-robin.

Every source is a queue of tokens (its documents, each closed by id 0).  In each
round a queue gains its share of SEQUENCE tokens as credit and sends what its
credit covers in whole tokens; the fraction stays as its deficit.  The rounds
follow each other in one stream, cut every SEQUENCE tokens, so every sequence
holds the target mixture to within a token for each queue, and only the last one
is padded.  A queue that runs dry
sends no more; the others keep their proportions.

The schedule has a closed form: after k rounds a queue with share q has sent
min(T, floor(k * q)) tokens.  So a document's pieces follow from its start in its
queue and the T of every queue, and deficits carry over windows and partitions
without a sequential pass.  A queue's order is (input partition, row order): one
pass writes ids with starts local to the partition, the per-partition totals (one
row for a partition and source) give the offsets, and a second pass cuts pieces.
Ids are not shuffled unless the offsets are too many to broadcast.  The driver
holds one number for each source, and a task their names and totals (20,000 sources: about a
MB; for millions, group them first); work per piece grows with their number.

Ids come from the 50k byte-level BPE vocabulary in its rank form, read by tiktoken
(about four times as fast); tests hold them equal to ``tokenizers`` over
``byte_bpe_50k.json``, the special token's string included.

Defined results: null or empty text: the id 0 alone; a null source counts as the
empty name; repeated rows are packed once each; null ids are kept; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthwise.llm.common import bounded_batches, materialize, table

SEQUENCE = 1024
VOCABULARY = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}
CELLS = 1 << 21                 # numbers in one matrix of pieces x sources
SCALE = 1 << 18                 # shares are fixed-point numbers of 1 / SCALE tokens
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, source string")

_ENCODERS: dict = {}


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encoder(path: str):
    """tiktoken over a rank file, one per worker process."""
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                            special_tokens=SPECIAL)
    return _ENCODERS[path]


def _tokenize(path):
    def run(batches):
        enc = encoder(path or vocabulary_path(VOCABULARY))
        pid = TaskContext.get().partitionId()
        sent: dict[str, int] = {}
        for b in batches:
            start, n, ids = [], [], []
            for source, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                got = enc.encode(text, allowed_special="all") if text else []
                got.append(0)
                at = sent.get(source, 0)
                start.append(at)
                n.append(len(got))
                sent[source] = at + len(got)
                ids.append(np.array(got, dtype="<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([pid] * len(n), pa.int32()), pa.array(start, pa.int64()),
                 pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "source", "pid", "local", "n", "ids"])
    return run


def shares(totals: list[int], targets: list[float] | None = None) -> np.ndarray:
    """Credit of each queue in a round, in 1 / SCALE tokens: SEQUENCE tokens in all,
    dealt by ``targets`` (default: the totals); at least 1 for a queue with tokens."""
    weight = [float(t) for t in (targets or totals)]
    if min(weight) < 0 or sum(weight) <= 0:
        raise ValueError("targets must not be negative, and one of them must be positive")
    q = [max(1, int(SEQUENCE * SCALE * w / sum(weight))) for w in weight]
    q[q.index(max(q))] += SEQUENCE * SCALE - sum(q)
    return np.array(q, dtype=np.int64)


class Schedule:
    """Queues of ``totals`` tokens that get ``credit`` a round; up to 2^44 tokens a queue, so that
    products with SCALE fit 64 bits."""

    def __init__(self, totals: np.ndarray, credit: np.ndarray):
        self.t, self.q = totals, credit
        self.last = -(-totals * SCALE // credit)              # the round in which a queue ends

    def sent(self, rounds: np.ndarray) -> np.ndarray:
        """Tokens each queue has sent after so many rounds (rounds x queues)."""
        rounds = np.minimum(rounds[:, None], self.last[None, :])     # of no effect later, and no product overflows
        return np.minimum(self.t[None, :], rounds * self.q[None, :] // SCALE)

    def place(self, s: np.ndarray, rounds: np.ndarray) -> np.ndarray:
        """Stream position of the first token that queue ``s`` sends in a round (from 1)."""
        out = np.empty(len(s), dtype=np.int64)
        cols = np.arange(len(self.t))
        step = max(16, CELLS // len(self.t))                  # a matrix of about CELLS numbers, however many queues
        for lo in range(0, len(s), step):
            k, i = rounds[lo:lo + step], s[lo:lo + step]
            before = self.sent(k - 1)
            now = (self.sent(k) - before) * (cols[None, :] < i[:, None])
            out[lo:lo + step] = before.sum(axis=1) + now.sum(axis=1)
        return out

    def pieces(self, s: np.ndarray, a: np.ndarray, b: np.ndarray):
        """For documents at [a, b) of queue s: (document, first, last + 1 in the queue, stream position)."""
        q = self.q[s]
        first = -(-(a + 1) * SCALE // q)
        last = -(-b * SCALE // q)
        slow = q < SCALE                       # a round sends one token at most: go by tokens
        count = np.where(slow, b - a, last - first + 1)
        doc = np.repeat(np.arange(len(s)), count)
        step = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        k = np.where(slow[doc], -(-(a[doc] + step + 1) * SCALE // q[doc]), first[doc] + step)
        lo = np.maximum(a[doc], (k - 1) * q[doc] // SCALE)
        hi = np.minimum(b[doc], k * q[doc] // SCALE)
        some = hi > lo
        doc, k, lo, hi = doc[some], k[some], lo[some], hi[some]
        at = self.place(s[doc], k) + lo - (k - 1) * q[doc] // SCALE
        cut = np.minimum(hi - lo, SEQUENCE - at % SEQUENCE)       # a piece is no longer than a sequence
        over = np.flatnonzero(cut < hi - lo)
        doc2, lo2, hi2, at2 = doc[over], lo[over] + cut[over], hi[over], at[over] + cut[over]
        return (np.concatenate([doc, doc2]), np.concatenate([lo, lo2]), np.concatenate([lo + cut, hi2]),
                np.concatenate([at, at2]))


def _cut(index, totals, credit):
    def run(batches):
        plan = Schedule(totals, credit)
        for b in batches:
            if not b.num_rows:
                continue
            s = np.array([index[x] for x in b.column(1).to_pylist()])
            n = b.column(3).to_numpy(zero_copy_only=False)
            a = b.column(2).to_numpy(zero_copy_only=False)
            doc, lo, hi, at = plan.pieces(s, a, a + n)
            order = np.lexsort((lo, doc))
            doc, lo, hi, at = doc[order], lo[order], hi[order], at[order]
            lo, hi = lo - a[doc], hi - a[doc]
            crc, was, raw = [], -1, None
            ids = b.column(4)
            for d, x, y in zip(doc.tolist(), lo.tolist(), hi.tolist()):
                if d != was:
                    was, raw = d, memoryview(np.frombuffer(ids[d].as_py(), "<u2").astype("<u4").tobytes())
                crc.append(zlib.crc32(raw[4 * x:4 * y]))
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), pa.array(lo), pa.array(hi - lo), pa.array(crc, pa.int64()), pa.array(n[doc]),
                 pa.array(at // SEQUENCE), pa.array(at % SEQUENCE), b.column(1).take(take)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         targets: dict[str, float] | None = None, vocabulary: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(pieces, tokens).  ``pieces`` has a row for each piece (PIECES); ``tokens`` is
    the written table of ids as little-endian 16-bit numbers, by doc_id.
    ``targets``: token weights by source; default: the corpus's own.  A source of weight 0 is
    packed last; all 0 is an error."""
    spark = docs.sparkSession
    bounded_batches(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
                      F.col(text_col).cast("string").alias("text"))
    tokens = materialize(src.mapInArrow(_tokenize(vocabulary), "doc_id long, source string, pid int, local long, "
                                                               "n long, ids binary"), "tokens")
    parts = tokens.groupBy("source", "pid").agg(F.sum("n").alias("t"))
    totals = sorted((r["source"], r["t"]) for r in parts.groupBy("source").agg(F.sum("t").alias("t")).toLocalIterator())
    if not totals:
        return spark.createDataFrame([], PIECES), tokens
    names, sizes = [x for x, _ in totals], [x for _, x in totals]
    credit = shares(sizes, [targets.get(x, 0.0) for x in names] if targets else None)
    before = Window.partitionBy("source").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("source", "pid", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("before"))
    rows = tokens.join(offsets, ["source", "pid"]) \
        .select("doc_id", "source", (F.col("before") + F.col("local")).alias("a"), "n", "ids")
    cut = _cut({x: i for i, x in enumerate(names)}, np.array(sizes, dtype=np.int64), credit)
    return rows.mapInArrow(cut, PIECES), tokens


def op8_packing(spark, sf_dir: str) -> DataFrame:
    pieces, _ = pack(table(spark, sf_dir, "documents"))
    return pieces
