"""Operator 1: MinHash near-dedup by a chosen-path set similarity join.

A document is the set of its distinct k-word shingles.  Documents with one and
the same set are one class, represented by its smallest id; the join runs over
representatives, so copies never meet each other.

Every representative gets MINHASHES minwise tokens.  A tree branches documents
by tokens chosen for the node: two choices at the root, then one choice per node
and a second one with probability 1/4 (1.25 = 1 / threshold children, so a pair
at the threshold survives each level with about even odds, while less similar
ones thin out).  In a node of more than ``leaf`` documents (or LEAF_SHINGLES
shingles) every document is compared with one pivot, on full sets where the estimate is
no more than 4 standard errors below the threshold.  What the links connect is one set of the node from there on; the pivot
has met all others and leaves, they descend with their sets.  A node's size is what
lies outside its largest set, since documents of one set need not meet again.  So a
very large group of near copies shrinks by its pivots' neighbourhoods instead of being
paired up, no document stops meeting those outside its set, and no node has a cap.
``trees`` independent trees bring the recall of a pair exactly at the threshold to about
0.99 at depth 8 (0.999 at depth 3), each one more at higher similarity.

A family of documents that are all alike to just below the threshold is thinned out by no
token.  From FLAT_DEPTH on, when the rows of the large nodes no longer shrink to FLAT_SHARE of those of the
level above, the nodes that are left are compared in blocks of half a leaf, each block with each.

Smaller nodes are compared exhaustively on 8-bit sketches, down to 4 standard
errors below the threshold, but for pairs within the largest set; one of more than half
a leaf is dealt to several leaves, each with all the other documents.  Documents that
such estimates connect form a bundle.  A bundle with few pairs gives its pairs, to be
confirmed on their full sets.  One with more pairs than documents gives its documents;
they are brought together and compared on full sets, which gives a spanning forest of
its links.  A bundle that several trees find is named by its members and kept once.
Every link is thus confirmed on sets built again from whole texts, and m documents give
about m rows.  Components are unions of links.

Shuffles carry ids, node numbers and sketches of MINHASHES bytes.  Texts are moved
only for documents that some node proposes; a Bloom filter of 16 bits for each, 32 MB at
most, lets the scan drop most others before the exact join.

Defined results: null or empty text, or one without words: no shingles, its own
component.  Null id: component null, kept.  An id with several texts: each of them is
a document of its own, and components are named by the smallest id.  Empty table: empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import bloom, bloom_bits, bounded_batches, few, in_bloom, named, numbers_of, scratch, table
from monthwise.llm.components import connected_components, labels_of
from monthwise.llm.wordhash import mix, shingle_sets

MINHASHES = 128
TREES = 6
LEAF = 2048
LEAF_SHINGLES = 1 << 22         # so that one task can hold the sets of a leaf
LEVEL_ROWS = 4096               # rows of large nodes in one task
MAX_DEPTH = 200                 # far beyond any expected depth; reaching it raises
FLAT_DEPTH = 8                  # from this depth on, levels must shrink
FLAT_SHARE = 0.9
_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(7))
_A = (_rng.integers(0, 1 << 31, MINHASHES, dtype=np.uint64) * 2 + 1).astype(np.uint32)
_B = _rng.integers(0, 1 << 32, MINHASHES, dtype=np.uint64).astype(np.uint32)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """The MINHASHES smallest values of one non-empty set, one per hash function."""
    x = (shingles >> _U(32)).astype(np.uint32)
    out = None
    for lo in range(0, len(x), 4096):
        part = (_A[:, None] * x[None, lo:lo + 4096] + _B[:, None]).min(axis=1)
        out = part if out is None else np.minimum(out, part)
    return out


def _child(node: np.ndarray, choice: np.ndarray, token: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(mix(node + choice.astype(np.uint64) * _U(0x632BE59BD9B4E019)) ^ token.astype(np.uint64))


def root_choices(trees: int) -> tuple[np.ndarray, np.ndarray]:
    """(root, minhash) of the two choices of every tree."""
    root = np.repeat(mix(np.arange(1, trees + 1, dtype=np.uint64)), 2)
    i = (mix(root) % _U(MINHASHES)).astype(np.int64)
    step = 1 + (mix(mix(root)) % _U(MINHASHES - 1)).astype(np.int64)
    return root, np.where(np.arange(2 * trees) % 2, (i + step) % MINHASHES, i)


def _sketch(k, trees):
    root, choice = root_choices(trees)

    def run(batches):
        for b in batches:
            n, f1, f2, sk, roots = [], [], [], [], []
            for s in shingle_sets(b.column(1), k):
                n.append(len(s))
                if not len(s):
                    for c in (f1, f2, sk, roots):
                        c.append(None)
                    continue
                with np.errstate(over="ignore"):
                    f1.append(int(mix(s).sum(dtype=np.uint64).astype(np.int64)))
                    f2.append(int(mix(s ^ _U(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64).astype(np.int64)))
                tokens = minhash(s)
                sk.append(tokens.astype(np.uint8).tobytes())
                roots.append(_child(root, choice, tokens[choice]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                 pa.array(sk, pa.binary()), pa.array(roots, pa.list_(pa.int64()))],
                names=["id", "n", "f1", "f2", "sk", "roots"])
    return run


def _sketches(col) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype=np.uint8).reshape(len(col), MINHASHES)


def _similar(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity; one in 256 unequal tokens agrees by chance."""
    return ((x == y).mean(axis=1) - 1 / 256) / (1 - 1 / 256)


def _lowest(threshold: float) -> float:
    """4 standard errors of the estimate below the threshold."""
    return threshold - 4 * math.sqrt(threshold * (1 - threshold) / MINHASHES)


def _near_pivot(low):
    """Rows (node, rep, sk, g, pivot, psk, pg) of large nodes to pairs (node, a, b, g) with
    the pivot that are not known to be connected and are estimated at ``low`` or more."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            rep = b.column(1).to_numpy(zero_copy_only=False)
            g = b.column(3).to_numpy(zero_copy_only=False)
            pivot = b.column(4).to_numpy(zero_copy_only=False)
            est = _similar(_sketches(b.column(2)), _sketches(b.column(5)))
            pair = np.flatnonzero((est >= low) & (g != b.column(6).to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(pair)), pa.array(np.minimum(rep, pivot)[pair]),
                 pa.array(np.maximum(rep, pivot)[pair]), pa.array(g[pair])], names=["node", "a", "b", "g"])
    return run


def _children(batches):
    """Rows (node, rep, sk, m, g) to the same rows in the children of their nodes."""
    for b in batches:
        if not b.num_rows:
            continue
        node = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        sk = _sketches(b.column(2))
        h = mix(node)
        i = (h % _U(MINHASHES)).astype(np.int64)
        h = mix(h)
        j = (i + 1 + (h % _U(MINHASHES - 1)).astype(np.int64)) % MINHASHES
        one = np.arange(len(node))
        two = np.flatnonzero((mix(h) >> _U(62)) == 0)
        child = np.concatenate([_child(node, i, sk[one, i]), _child(node[two], j[two], sk[two, j[two]])])
        down = pa.array(np.concatenate([one, two]))
        yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), *[b.column(c).take(down) for c in range(1, 5)]],
                                         names=["node", "rep", "sk", "m", "g"])


def smallest_labels(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """For n items the smallest item that links (x, y) connect each to."""
    root = np.arange(n)
    while len(x):
        before = root.copy()
        lo = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], lo)
        np.minimum.at(root, root[y], lo)
        root = root[root]
        if np.array_equal(before, root):
            break
    return root


def _bundles(node, rep, sk, low, side=None):
    """Whole leaves (rows sorted by node and side) to columns (node, a, b): pairs to confirm,
    or with b = -1 documents whose bundle ``node`` is to be compared on full sets.  Rows of
    side 0 meet all others of their leaf, of side 1 those of side 2, which do not meet."""
    cut = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    size = np.diff(np.concatenate([cut, [len(node)]]))
    end = np.repeat(cut + size, size)
    later = end - np.arange(len(node)) - 1
    if side is not None:
        connected = np.repeat(np.add.reduceat(side == 2, cut), size) if len(node) else later
        later = np.where(side == 0, later, np.where(side == 1, connected, 0))
    total = np.cumsum(later)
    xs, ys = [], []
    lo = 0
    while lo < len(node):                       # some rows' pairs at a time
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + (1 << 16), side="right")))
        n = later[lo:hi]
        x = np.repeat(np.arange(lo, hi), n)
        y = end[x] - np.repeat(np.cumsum(n), n) + np.arange(len(x))
        if len(x):
            ok = (_similar(sk[x], sk[y]) >= low) & (rep[x] != rep[y])
            xs.append(x[ok])
            ys.append(y[ok])
        lo = hi
    x = np.concatenate(xs) if xs else np.zeros(0, np.int64)
    y = np.concatenate(ys) if ys else np.zeros(0, np.int64)
    root = smallest_labels(x, y, len(node))
    docs, pairs = np.bincount(root, minlength=len(node)), np.bincount(root[x], minlength=len(node))
    dense = pairs > np.maximum(3, docs)
    few_x, few_y = x[~dense[root[x]]], y[~dense[root[x]]]
    members = np.flatnonzero(dense[root])
    name = np.zeros(len(node), dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.add.at(name, root[members], mix(rep[members].astype(np.uint64)))
    name = mix(name).view(np.int64)
    return (np.concatenate([np.zeros(len(few_x), np.int64), name[root[members]]]),
            np.concatenate([np.minimum(rep[few_x], rep[few_y]), rep[members]]),
            np.concatenate([np.maximum(rep[few_x], rep[few_y]), np.full(len(members), -1)]), len(few_x))


def _runs(batches):
    """Column lists of whole runs of equal first column, over batches sorted by it."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        b = pa.Table.from_batches([b])
        held = b if held is None else pa.concat_tables([held, b])
        node = held.column(0).to_numpy()
        last = int(np.searchsorted(node, node[-1]))
        if last:
            yield held.slice(0, last).combine_chunks()
            held = held.slice(last)
    if held is not None:
        yield held.combine_chunks()


def _compare(threshold):
    low = _lowest(threshold)

    def run(batches):
        for t in _runs(batches):
            node, a, b, k = _bundles(t.column(0).to_numpy(), t.column(1).to_numpy(), _sketches(t.column(2)), low,
                                     t.column(3).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(a), pa.array(b, mask=np.arange(len(b)) >= k)],
                                             names=["node", "a", "b"])
    return run


def _linked(both, n, m, percent):
    """100 * |intersection| >= percent * |union|, and something in common."""
    return (both > 0) & (100 * both >= percent * (n + m - both))


def _confirm(k, percent):
    def run(batches):
        for b in batches:
            ok = [bool(_linked(len(np.intersect1d(s, t, assume_unique=True)), len(s), len(t), percent))
                  for s, t in zip(shingle_sets(b.column(2), k), shingle_sets(b.column(3), k))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]) \
                .filter(pa.array(ok, pa.bool_()))
    return run


def forest(ids: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (x, y) among items ``ids`` as (id, smallest id of its component)."""
    order = np.argsort(ids, kind="stable")
    at = np.empty(len(ids), dtype=np.int64)
    at[order] = np.arange(len(ids))
    root = smallest_labels(at[x], at[y], len(ids))
    mine, far = ids[order], ids[order][root]
    out = mine != far
    return mine[out], far[out]


def leaf_forest(ids: list[int], sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The exact links among the documents of one bundle, as a star forest."""
    n = np.array([len(s) for s in sets])
    _, inv, common = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), n)
    shared = common[inv] > 1                     # shingles of one document meet nothing
    _, inv = np.unique(inv[shared], return_inverse=True)
    row = row[shared]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = int(inv.max(initial=-1)) + 1
    for lo in range(0, width, 4096):
        at = (inv >= lo) & (inv < lo + 4096)
        m = np.zeros((len(sets), min(4096, width - lo)), dtype=np.float32)
        m[row[at], inv[at] - lo] = 1
        both += m @ m.T
    xs, ys = [], []
    for lo in range(0, len(sets), 256):          # some rows at a time, so that no large copy is made
        part = np.rint(both[lo:lo + 256]).astype(np.int64)
        x, y = np.nonzero(np.triu(_linked(part, n[lo:lo + 256, None], n[None, :], percent), lo + 1))
        xs.append(x + lo)
        ys.append(y)
    return forest(np.array(ids), np.concatenate(xs), np.concatenate(ys))


def _leaf_links(k, percent):
    """Rows (node, id, text) sorted by node to the links of each bundle's forest."""
    def out(ids, sets):
        a, b = leaf_forest(ids, sets, percent)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches):
        now, ids, sets = None, [], []
        for b in batches:
            for node, i, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), shingle_sets(b.column(2), k)):
                if node != now:
                    if ids:
                        yield out(ids, sets)
                    now, ids, sets = node, [], []
                ids.append(i)
                sets.append(s)
        if ids:
            yield out(ids, sets)
    return run


def _leaf_rows(rows: DataFrame, leaf: int) -> DataFrame:
    """Rows (node, rep, sk, side) of nodes without a pivot.  The largest connected set of a
    node is dealt to ``chunks`` leaves by a hash; every one of them gets all other rows."""
    chunk = F.when(F.col("g") == F.col("big"), F.array(F.pmod(F.xxhash64("rep", "node"), "chunks"))) \
        .otherwise(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    return rows.select("*", F.explode(chunk).alias("chunk")).select(
        F.when(F.col("chunks") == 1, F.col("node")).otherwise(F.xxhash64("node", "chunk")).alias("node"), "rep", "sk",
        F.when(F.col("g") == F.col("big"), 2).when(F.col("chunk") == 0, 0).otherwise(1).alias("side"))


def _blocks_of(rows: DataFrame, leaf: int) -> DataFrame:
    """Rows (node, rep, sk, side) of leaves in which all documents of a node meet, block by
    block: the rows of a block meet each other in one leaf, those of two blocks in another."""
    sizes = rows.groupBy("node").agg(F.ceil(F.count("*") * 2 / leaf).cast("long").alias("blocks"))
    dealt = rows.join(sizes, "node").withColumn("mine", F.pmod(F.xxhash64("rep", "node"), "blocks")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return dealt.select(F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other")).alias("node"), "rep", "sk",
                        F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2).alias("side"))


def candidates(reps: DataFrame, keep, threshold: float, leaf: int, texts_of, confirm) -> tuple[DataFrame, list[DataFrame]]:
    """Rows (node, a, b) of representatives (rep, n, sk, roots): pairs, or documents (b
    null) whose bundle is to be compared on full sets.  And the links (a, b) to pivots,
    which ``confirm`` finds among pairs by the texts that ``texts_of`` fetches."""
    spark = reps.sparkSession
    bounded_batches(spark, 4096)
    sketches = reps.select("rep", "sk")
    size = [F.count("*").alias("n"), F.sum("m").alias("w")]
    is_large = (F.col("n") > leaf) | (F.col("w") > LEAF_SHINGLES)
    level = reps.select(F.explode("roots").alias("node"), "rep", F.col("n").alias("m"))
    nodes = keep(level.groupBy("node").agg(*size, F.min_by("rep", F.xxhash64("node", "rep")).alias("pivot"))
                 .where("n >= 2"), "nodes")
    pivots = nodes.where(is_large).join(sketches.select(F.col("rep").alias("pivot"), F.col("sk").alias("psk")), "pivot") \
        .select("node", "pivot", "psk")
    columns = ["node", "rep", "sk", "m", "g", "pivot", "psk", "pg"]
    rows = keep(level.join(nodes.select("node"), "node").join(sketches, "rep").join(pivots, "node", "left")
                .withColumns({"g": F.col("rep"), "pg": F.col("pivot")}).select(*columns), "rows")
    small, links, texts = [rows.where("pivot is null").select("node", "rep", "sk", F.lit(0).alias("side"))], [], None
    before = None
    for depth in range(MAX_DEPTH):
        large = rows.where("pivot is not null")
        n = large.count()
        if not n:
            break
        if depth >= FLAT_DEPTH and n > FLAT_SHARE * before:
            small.append(_blocks_of(large.select("node", "rep", "sk"), leaf))
            break
        before = n
        if texts is None:                       # all nodes below hold no others
            texts = keep(texts_of(keep(large.select(F.col("rep").alias("id")).distinct(), "pivot-ids")), "pivot-texts")
            bounded_batches(spark, 4096)
        near = keep(few(large.select("node", "rep", "sk", "g", "pivot", "psk", "pg"), n, LEVEL_ROWS)
                    .mapInArrow(_near_pivot(_lowest(threshold)), "node long, a long, b long, g long"), "near")
        bounded_batches(spark)
        links.append(keep(confirm(near.select("a", "b").distinct(), texts), "pivot-links"))
        bounded_batches(spark, 4096)
        # what the pivot's links connect is one set of the node from now on
        hit = near.join(links[-1], ["a", "b"]).select("node", "g").distinct().withColumn("hit", F.lit(True))
        joined = F.when(F.col("hit") | (F.col("g") == F.col("pg")), F.col("pivot")).otherwise(F.col("g")).alias("g")
        down = large.where("rep != pivot").join(hit, ["node", "g"], "left").select("node", "rep", "sk", "m", joined)
        level = keep(few(down, n, LEVEL_ROWS).mapInArrow(_children, "node long, rep long, sk binary, m long, g long"), "down")
        nodes = level.groupBy("node", "g").agg(*size).groupBy("node") \
            .agg(F.sum("n").alias("all_n"), F.sum("w").alias("all_w"), F.count("*").alias("sets"),
                 F.max_by(F.struct("g", "n", "w"), F.struct("n", "g")).alias("big")).where("sets >= 2") \
            .withColumns({"n": F.col("all_n") - F.col("big.n"), "w": F.col("all_w") - F.col("big.w")}) \
            .select("node", F.col("big.g").alias("big"), is_large.alias("large"),
                    F.ceil(F.greatest(F.col("big.n") / max(1, leaf // 2), F.col("big.w") / (LEAF_SHINGLES / 2)))
                    .cast("long").alias("chunks"))
        level = keep(few(level.join(nodes, "node"), n, LEVEL_ROWS), "level")
        small.append(_leaf_rows(level.where("not large"), leaf))
        level = level.where("large")
        pivots = level.where("g != big").groupBy("node").agg(F.min_by(F.struct("rep", "sk", "g"), F.xxhash64("node", "rep")).alias("p")) \
            .select("node", F.col("p.rep").alias("pivot"), F.col("p.sk").alias("psk"), F.col("p.g").alias("pg"))
        rows = keep(few(level.join(pivots, "node").select(*columns), n, LEVEL_ROWS), "rows")
    else:
        raise RuntimeError(f"large nodes are left at depth {MAX_DEPTH}")
    every = small[0]
    for x in small[1:]:
        every = every.unionAll(x)
    out = every.repartition("node").sortWithinPartitions("node", "side") \
        .mapInArrow(_compare(threshold), "node long, a long, b long")
    return keep(out.distinct(), "candidates"), links


def _present(bits):
    """Rows (id, text, h) whose h may be in the filter."""
    def run(batches):
        for b in batches:
            ok = in_bloom(bits.value, b.column(2).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["id", "text"]).filter(pa.array(ok))
    return run


def links_of(docs: DataFrame, keep, shingle_words: int, percent: int, trees: int, leaf: int):
    """(rows, reps, links) of docs (id, text): per row its fingerprint; classes; links between classes."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = keep(docs.mapInArrow(_sketch(shingle_words, trees),
                                "id long, n long, f1 long, f2 long, sk binary, roots array<long>"), "sketch")
    reps = keep(rows.where("n > 0 and id is not null").groupBy("f1", "f2")
                .agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sk").alias("sk"),
                     F.first("roots").alias("roots")), "reps")
    def texts_of(ids):
        bounded_batches(spark)
        bits = spark.sparkContext.broadcast(bloom(ids.select(F.xxhash64("id").alias("h")), bloom_bits(ids.count())))
        return docs.where("id is not null").select("id", "text", F.xxhash64("id").alias("h")) \
            .mapInArrow(_present(bits), "id long, text string").join(ids, "id", "left_semi").distinct()

    def confirm(pairs, texts):
        side = lambda c: texts.select(F.col("id").alias(c), F.col("text").alias(f"t{c}"))
        return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb") \
            .mapInArrow(_confirm(shingle_words, percent), "a long, b long")

    found, links = candidates(reps, keep, percent / 100, leaf, texts_of, confirm)
    pairs, members = found.where("b is not null").select("a", "b"), found.where("b is null").select("node", "a")
    ends = keep(found.select(F.explode(F.array("a", "b")).alias("id")).where("id is not null").distinct(), "ends")
    texts = keep(texts_of(ends), "texts")
    within = members.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a") \
        .select("node", "a", "ta").repartition("node").sortWithinPartitions("node") \
        .mapInArrow(_leaf_links(shingle_words, percent), "a long, b long")
    for x in [confirm(pairs, texts), within]:
        links.append(x)
    every = links[0]
    for x in links[1:]:
        every = every.unionAll(x)
    return rows, reps, keep(every, "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                    percent: int = 80, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """Per row of ``docs``: id, n_shingles, rep (its class: the smallest id with the
    same set) and component_id (smallest id reachable over links).  If an id has several
    texts, each of them is a document of its own."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    columns = ["id", "rep", "component_id"]
    with scratch() as keep:
        what = F.xxhash64("text").alias("what")
        numbers = numbers_of(src.select("id", what), keep)
        if numbers is not None:
            src = src.select("id", "text", what).join(numbers, ["id", "what"], "left").select(F.col("number").alias("id"), "text")
        rows, reps, links = links_of(src, keep, shingle_words, percent, trees, leaf)
        bounded_batches(docs.sparkSession, 100_000)
        labels = connected_components(links)
        classes = reps.select("f1", "f2", "rep").join(labels_of(labels).withColumnRenamed("id", "rep"), "rep", "left")
        out = rows.select("id", "n", "f1", "f2").join(classes, ["f1", "f2"], "left") \
            .select("id", F.col("n").alias("n_shingles"), "rep", F.coalesce("component", "rep", "id").alias("component_id"))
        if numbers is not None:
            out = named(out, numbers, columns)
        out = keep.last(out.select(F.col("id").alias(id_col), "n_shingles", *columns[1:]), "classes")
        keep.drop(labels)
    bounded_batches(docs.sparkSession)
    return out


def op1_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract: 4-word shingles, Jaccard >= 0.8, all of ``documents``."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4) \
        .select("doc_id", "n_shingles", "component_id",
                F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
