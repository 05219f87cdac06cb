"""Operator 12: removal of word spans that an earlier document holds, by suffix automata.

A window of WINDOW consecutive words goes if its words also stand in a document of a smaller
id.  Reference documents are dealt to shards; each shard's suffix automaton is built once and
sent to the blocks of text that need it, which are streamed through it: the matching
statistics say where the last WINDOW words occur in the shard, and the automaton's states in
which document first.  Maximal runs of such windows are the removed spans.

Only text that can match is streamed.  Of the GRAM-word sequences in a window the one of the
smallest hash is its anchor; equal windows have equal anchors.  An anchor that several
documents hold has a root, the first of them.  The root's words around the anchor are
reference, those of the later documents are streamed against the root's shard.  A window may
be in a later document than its anchor's root, and first there: windows that have such an anchor
and were not found are counted by a hash of all their words, and the few that several documents
share go through the automata once more, the first document being the reference.  So no window
is lost.  Hashes choose what is compared; words are compared as 64-bit hashes.

Sizes: a shard holds about SHARD_WORDS reference words (a document's are cut into blocks of as
many), and a block of streamed text about BLOCK_WORDS; a hot passage gives its shard more
blocks, each with a copy of the automaton.  Counts per anchor are reduced in the tasks first;
the join that marks a hot anchor is a plain equi-join that adaptive execution splits.  Texts
without any span do not move; a Bloom filter of bounded size tells them.

Defined results: null and empty texts have no words, and the hash of the empty string; texts
of fewer than WINDOW words keep all; rows of equal id are not earlier than each other; rows
without an id come after all ids; repeated rows are treated alike.  An empty table gives
an empty result.  Texts of any length are read whole.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.llm import suffix_automaton
from monthwise.llm.common import Keeper, bloom, bloom_bits, in_bloom, scratch, small_batches, table
from monthwise.llm.wordhash import hash_words, mix, text_slices

WINDOW = 50
GRAM = 16
SHARD_WORDS = 1 << 17
BLOCK_WORDS = 1 << 18
PIECE = 1 << 18                # bytes of an automaton in one row, so that pages and batches stay small
LAST = (1 << 63) - 1           # stands for a missing id
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
REGION = "shard int, ref boolean, doc long, row long, start int, words binary, anchors binary"
FOUND = "row long, doc long, shard int, start int, lo int, hi int, at int, h long"
_U = np.uint64
_MULT = [_U(pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) | 1) for k in range(WINDOW)]


def _sliding(op, a: np.ndarray, width: int) -> np.ndarray:
    """``op`` over every ``width`` consecutive values."""
    size = 1
    while 2 * size <= width:
        a = op(a[:len(a) - size], a[size:])
        size *= 2
    return op(a[:len(a) - (width - size)], a[width - size:]) if size < width else a


def _hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive words."""
    m = max(0, len(words) - n + 1)
    out = np.zeros(m, dtype=_U)
    with np.errstate(over="ignore"):
        for k in range(n):
            out += words[k:k + m] * _MULT[k]
    return np.maximum(mix(out), _U(1))


def _anchors(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors of all windows; text i ends at ``ends[i]``."""
    if len(words) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    grams = _hashes(words, GRAM)
    width = WINDOW - GRAM + 1
    least = _sliding(np.minimum, grams, width)
    end = np.repeat(ends, np.diff(np.concatenate(([0], ends))))[:len(least)]
    least[np.arange(len(least)) + WINDOW > end] = 0               # not a window of one text
    around = np.concatenate((np.zeros(width - 1, _U), least, np.zeros(width - 1, _U)))
    at = np.flatnonzero(_sliding(np.maximum, around, width) == grams)
    return at, grams[at]


def _prints(batches):
    """(doc, row, text) to (m, doc, row, pos): the anchors of every text."""
    for b in batches:
        doc, row = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        for lo, data, ends in text_slices(b.column(2)):
            words, last = hash_words(data, ends, lower=False)
            at, m = _anchors(words, last)
            text = np.searchsorted(last, at, side="right")
            start = np.concatenate(([0], last))[text]
            yield pa.RecordBatch.from_arrays(
                [pa.array(m.view(np.int64)), pa.array(doc[lo + text]), pa.array(row[lo + text]), pa.array((at - start).astype(np.int32))],
                names=["m", "doc", "row", "pos"])


def _maybe(bits):
    """Rows (row, ...) that may be in the filter."""
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(in_bloom(bits.value, b.column(0).to_numpy(zero_copy_only=False).astype(np.int64))))
    return run


class _Regions:
    """Merges the surroundings of chosen positions of a text into regions."""

    def __init__(self, left: int, right: int):
        self.left, self.right, self.out = left, right, [[] for _ in range(7)]

    def add(self, words: np.ndarray, start: int, doc: int, row: int, picks: list[dict]) -> None:
        of: dict = {}
        for p in picks:
            of.setdefault((p["shard"], p["ref"]), []).append(p["pos"] - start)
        for (shard, ref), at in of.items():
            at = np.unique(at)
            for run in np.split(at, np.flatnonzero(np.diff(at) > self.left + self.right) + 1):
                lo, hi = max(0, int(run[0]) - self.left), min(len(words), int(run[-1]) + self.right)
                for col, x in zip(self.out, (shard, ref, doc, row, start + lo, words[lo:hi].tobytes(), (run - lo).astype("<i4").tobytes())):
                    col.append(x)

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.out, kinds)],
                                         names=["shard", "ref", "doc", "row", "start", "words", "anchors"])
        self.out = [[] for _ in range(7)]
        return out


def _regions_of_texts(batches):
    """(row, doc, text, picks) to REGION: the words around anchors."""
    regions = _Regions(WINDOW - GRAM, WINDOW)
    for b in batches:
        row, doc, picks = (b.column(k) for k in (0, 1, 3))
        for lo, data, ends in text_slices(b.column(2)):
            words, last = hash_words(data, ends, lower=False)
            for i, text in enumerate(np.split(words, last[:-1])):
                regions.add(text, 0, doc[lo + i].as_py(), row[lo + i].as_py(), picks[lo + i].as_py())
            yield regions.batch()


def _regions_of_regions(batches):
    """(row, doc, start, words, picks) to REGION: windows of regions."""
    regions = _Regions(0, WINDOW)
    for b in batches:
        for row, doc, start, words, picks in zip(*(b.column(k).to_pylist() for k in range(5))):
            regions.add(np.frombuffer(words, _U), start, doc, row, picks)
        yield regions.batch()


def _automaton(rows: pa.Table) -> pa.Table:
    """A shard's reference regions to its automaton, in pieces."""
    texts = [np.frombuffer(x, _U) for x in rows["words"].to_pylist()]
    blob = suffix_automaton.build(texts, rows["doc"].to_pylist())
    pieces = [blob[lo:lo + PIECE] for lo in range(0, len(blob), PIECE)]
    return pa.table({"shard": pa.array([rows["shard"][0].as_py()] * len(pieces), pa.int32()),
                     "piece": pa.array(range(len(pieces)), pa.int32()), "blob": pa.array(pieces, pa.binary())})


def _streamed(again: bool):
    """Regions of one block against their shard's automaton: removed spans (lo, hi) and, with
    ``again``, the windows (at, h) that have an anchor of this shard and were not found."""
    def run(block: pa.Table, shard: pa.Table) -> pa.Table:
        matcher = suffix_automaton.Matcher(b"".join(shard.sort_by("piece")["blob"].to_pylist()))
        out: list[list] = [[] for _ in range(8)]
        for number, doc, row, start, words, anchors in zip(*(block[c].to_pylist() for c in ("shard", "doc", "row", "start", "words", "anchors"))):
            words = np.frombuffer(words, _U)
            if len(words) < WINDOW:
                continue
            hit = matcher.found(words, doc, WINDOW)[WINDOW - 1:]               # by a window's first word
            edge = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False]))))
            lo, hi = start + edge[::2], start + edge[1::2] + WINDOW - 1
            at, h = np.zeros(0, np.int64), np.zeros(0, _U)
            if again:
                grams = _hashes(words, GRAM)
                least = _sliding(np.minimum, grams, WINDOW - GRAM + 1)
                own = np.full(len(grams), np.iinfo(_U).max)
                chosen = np.frombuffer(anchors, "<i4")
                own[chosen] = grams[chosen]
                anchored = _sliding(np.minimum, own, WINDOW - GRAM + 1) == least
                at = np.flatnonzero(anchored & ~hit)
                h = _hashes(words, WINDOW)[at]
            n, k = len(lo), len(at)
            for col, x in zip(out, ([row] * (n + k), [doc] * (n + k), [number] * (n + k), [start] * (n + k), [*lo.tolist(), *[None] * k],
                                    [*hi.tolist(), *[None] * k], [*[None] * n, *(at + start).tolist()], [*[None] * n, *h.view(np.int64).tolist()])):
                col += x
        kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 5, pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds)], names=["row", "doc", "shard", "start", "lo", "hi", "at", "h"])
    return run


def _matched(regions: DataFrame, again: bool, keep: Keeper, name: str) -> DataFrame:
    """FOUND rows of the regions that are not reference, streamed through the others' automata."""
    automata = keep(regions.where("ref").groupBy("shard").applyInArrow(_automaton, "shard int, piece int, blob binary"), f"{name}-automata")
    query = regions.where("not ref")
    blocks = keep(query.groupBy("shard").agg((F.sum(F.length("words")) / (8 * BLOCK_WORDS)).cast("int").alias("more")), f"{name}-blocks")
    copies = automata.join(blocks, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), "more"))).drop("more")
    dealt = query.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("row", "start"), F.col("more") + 1).cast("int"))
    return keep(dealt.groupBy("shard", "block").cogroup(copies.groupBy("shard", "block"))
                .applyInArrow(_streamed(again), FOUND), f"{name}-found")


def _dealt(picks: DataFrame, shard_words: int, keep: Keeper, name: str) -> DataFrame:
    """(row, doc, pos, root, at) with the shard of the root's block and whether the row is reference."""
    picks = keep(picks, name)
    refs = picks.where("doc = root").count()
    shards = 1 + refs * (WINDOW - GRAM) // shard_words
    return picks.select("row", "doc", "pos", *[c for c in picks.columns if c == "start"], (F.col("doc") == F.col("root")).alias("ref"),
                        F.pmod(F.xxhash64("root", F.expr(f"at div {shard_words}")), F.lit(shards)).cast("int").alias("shard"))


def _first(rows: DataFrame, key: str) -> DataFrame:
    """Keys that several documents hold, with the first document and position."""
    return rows.groupBy(key).agg(F.min(F.struct("doc", "pos")).alias("f"), F.max("doc").alias("last")) \
        .where("f.doc < last").select(key, F.col("f.doc").alias("root"), F.col("f.pos").alias("at"))


def _picks() -> Column:
    return F.collect_list(F.struct("pos", "shard", "ref")).alias("picks")


def removed_spans(docs: DataFrame, keep: Keeper, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(row, lo, hi): word spans of the rows (doc, row, text) to remove; they may overlap."""
    spark = docs.sparkSession
    prints = keep(docs.mapInArrow(_prints, "m long, doc long, row long, pos int"), "span-anchors")
    roots = keep(_first(prints, "m"), "span-roots")          # written, so that the join's sides are plain shuffles
    picks = _dealt(prints.join(roots, "m").select("row", "doc", "pos", "root", "at"), shard_words, keep, "span-picks")
    chosen = keep(picks.groupBy("row").agg(_picks()), "span-chosen")
    bits = spark.sparkContext.broadcast(bloom(chosen.select(F.col("row").alias("h")), bloom_bits(chosen.count())))
    texts = docs.select("row", "doc", "text").mapInArrow(_maybe(bits), "row long, doc long, text string")
    regions = keep(texts.join(chosen, "row").mapInArrow(_regions_of_texts, REGION), "span-regions")
    found = _matched(regions, True, keep, "span")
    spans = found.where("lo is not null").select("row", "lo", "hi")
    missed = found.where("h is not null").select("h", "row", "doc", "shard", "start", F.col("at").alias("pos"))
    shared = keep(_first(missed, "h"), "span-shared")
    left = _dealt(missed.join(shared, "h").select("row", "doc", "pos", F.struct("shard", "start").alias("start"), "root", "at"),
                  shard_words, keep, "span-missed")
    windows = left.groupBy("row", F.col("start.shard").alias("s"), F.col("start.start").alias("start")).agg(_picks())
    source = regions.where("not ref").select("row", "doc", F.col("shard").alias("s"), "start", "words")
    rest = keep(source.join(windows, ["row", "s", "start"]).select("row", "doc", "start", "words", "picks")
                .mapInArrow(_regions_of_regions, REGION), "span-rest")
    more = _matched(rest, False, keep, "span-again")
    return spans.unionByName(more.where("lo is not null").select("row", "lo", "hi"))


def _kept(bits=None):
    """(doc_id, row, text, spans) to RESULT; with ``bits`` only rows that are not in the filter."""
    def run(batches):
        for b in batches:
            if bits is not None:
                b = b.filter(pa.array(~in_bloom(bits.value, b.column(1).to_numpy(zero_copy_only=False).astype(np.int64))))
            spans = b.column(3).to_pylist() if b.num_columns > 3 else [None] * b.num_rows
            out: list[list] = [[], [], []]
            for text, cut in zip(b.column(2), spans):
                words = (text.as_py() or "").encode().split()          # of bytes: at \x20 and \x09-\x0D
                n = len(words)
                if cut:
                    stay = np.ones(n, dtype=bool)
                    for s in cut:
                        stay[s["lo"]:s["hi"]] = False
                    words = [words[i] for i in np.flatnonzero(stay).tolist()]
                for col, x in zip(out, (n, n - len(words), hashlib.sha256(b" ".join(words)).hexdigest())):
                    col.append(x)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256"])
    return run


def dedup_substrings(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """RESULT for every row of ``documents``."""
    spark = documents.sparkSession
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumns({"doc": F.coalesce("doc_id", F.lit(LAST)), "row": F.xxhash64("doc_id", "text")})
    with small_batches(spark), scratch() as keep:
        spans = keep(removed_spans(docs.select("doc", "row", "text"), keep, shard_words)
                     .groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "span-spans")
        bits = spark.sparkContext.broadcast(bloom(spans.select(F.col("row").alias("h")), bloom_bits(spans.count())))
        whole = docs.select("doc_id", "row", "text").mapInArrow(_kept(bits), RESULT)
        some = docs.select("row", "doc_id", "text").mapInArrow(_maybe(bits), "row long, doc_id long, text string")
        cut = some.join(spans, "row", "left").select("doc_id", "row", "text", "spans").mapInArrow(_kept(), RESULT)
        return keep.last(whole.unionByName(cut), "span-result")


def op12_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"))


ORACLE = f"""WITH d AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS MATERIALIZED (
  SELECT doc_id, s, md5(array_to_string(w[s:s + {WINDOW - 1}], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS s FROM d WHERE len(w) >= {WINDOW})),
gone AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(range(s, s + {WINDOW})) AS i FROM win JOIN (SELECT k, min(doc_id) AS f FROM win GROUP BY k) USING (k)
  WHERE f < doc_id),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) USING (doc_id) LEFT JOIN kept USING (doc_id)"""
