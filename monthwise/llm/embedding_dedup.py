"""Operator 9: embedding near-dedup over HNSW graphs per shard.

Equal vectors are one class, represented by its smallest id.  Classes are dealt to
shards by a hash; each shard gets a hierarchical navigable small-world graph of
its unit vectors.  Every class queries every shard, and pairs found are links when
their cosine in double precision reaches the threshold.

Beams are widened before the full run.  Audit queries search the graphs and are compared
with all vectors by brute force, in blocks: one class of AUDIT_EVERY by a hash, AUDIT_ROWS at
most, and turned copies of them whose cosine with the original lies halfway between the threshold and
1, so that there are links to be found in any table.  Recall is the mean over the queries of a class of
link counts (powers of two), and the worst class of both kinds counts, so a hot group does not
hide losses elsewhere.  While it is below TARGET_RECALL, the beam is doubled; when LAST_BEAM does not
reach it either, every query is compared with every vector.  A beam that is full of links is
followed on through the graph, so the number of links has no cap.

Shards hold SHARD_BYTES of vectors, whatever their dimension (SHARDS of them at least), and so do the
blocks of queries.  A group is one graph and one block; with blocks as large as shards, copies of
graphs cost no more to move than copies of queries.  A group folds FOLD queries after the other into
numbers of links and one spanning forest, and gives back a row for a query and a vertex at most.

Defined results: null vectors, empty ones, and those that hold null or non-finite
components or have no length link with nothing and are their own component; vectors
of different lengths are not compared.  An id with several vectors: each of them counts by itself,
and components are named by the smallest id.  Null ids: component null, kept; a
vector that only rows without an id hold is counted as a link and joins no vectors.
Repeated rows count as other vectors.  Empty table: empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import bounded_batches, few, named, numbers_of, scratch, table
from monthwise.llm.components import connected_components, labels_of
from monthwise.llm.hnsw import Hnsw

THRESHOLD = 0.9
SHARDS = 6
SHARD_BYTES = 32 << 20
BLOCKS = 2                      # of queries, at least
FOLD = 128                      # queries whose links are held at a time
FIRST_BEAM, LAST_BEAM = 16, 512
TARGET_RECALL = 0.99
AUDIT_EVERY = 100
AUDIT_ROWS = 10_000
SLACK = 1e-4                    # below the threshold in single precision; doubles decide


def _unit(v: np.ndarray) -> np.ndarray:
    """Unit vectors in single precision; scaled first, so that no square overflows."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return (v / np.sqrt((v * v).sum(axis=1, keepdims=True))).astype(np.float32)


def _matrix(col) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype="<f8").reshape(len(col), -1)


def _clean(batches):
    """Rows (id, vector list) to (id, dim, v): v the doubles' bytes, or null."""
    for b in batches:
        out, dims = [], []
        for x in b.column(1).to_pylist():
            v = None
            if x and all(c is not None for c in x):
                a = np.array(x, dtype="<f8") + 0.0              # -0.0 and 0.0 are one
                if np.isfinite(a).all() and a.any():
                    v = a.tobytes()
            out.append(v)
            dims.append(len(x) if v else 0)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(dims, pa.int32()), pa.array(out, pa.binary())],
                                         names=["id", "dim", "v"])


def _build(table: pa.Table) -> pa.Table:
    """One shard's classes to its graph."""
    table = table.sort_by("rep")
    order = np.random.default_rng(11).permutation(table.num_rows)
    table = table.take(pa.array(order))
    graph = Hnsw(_unit(_matrix(table["v"])))
    return pa.table({"dim": table["dim"][:1], "shard": table["shard"][:1], "graph": pa.array([graph.pack()], pa.binary()),
                     "reps": pa.array([table["rep"].to_numpy().astype("<i8").tobytes()], pa.binary()),
                     "counts": pa.array([table["n"].to_numpy().astype("<i8").tobytes()], pa.binary()),
                     "vs": pa.array([b"".join(table["v"].to_pylist())], pa.binary())})


class _Shard:
    """One graph, its vectors and their classes, and searches of a few queries at a time.
    Counts of classes without an id are negative."""

    def __init__(self, shard: pa.Table):
        self.x = np.frombuffer(shard["vs"][0].as_py(), "<f8").reshape(-1, shard["dim"][0].as_py())
        self.reps = np.frombuffer(shard["reps"][0].as_py(), "<i8")
        self.counts = np.frombuffer(shard["counts"][0].as_py(), "<i8")
        self.graph = Hnsw.unpack(shard["graph"][0].as_py())

    def links(self, block: pa.Table, threshold: float, beam: int | None):
        """(first query row, its query rows, query row, node row) of the true links that the search
        finds, without a beam of all true links, FOLD queries after the other."""
        own = block["rep"].to_numpy()
        q = _matrix(block["v"])
        for lo in range(0, len(q), FOLD):
            some = q[lo:lo + FOLD]
            if beam is None:
                i, j = _every_pair(some, self.x, threshold - SLACK)
            else:
                i, j = self.graph.near(_unit(some), threshold - SLACK, beam)
            ok = _cosines(some, self.x, i, j) >= threshold
            i, j = i[ok], j[ok]
            other = (own[lo:lo + FOLD][i] != self.reps[j]) | (self.counts[j] < 0)
            yield lo, len(some), i[other] + lo, j[other]


def _every_pair(q, x, low):
    """(query row, node row) with similarity of at least ``low``, by brute force."""
    ux, i, j = _unit(x), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo in range(0, len(q), 256):
        a, b = np.nonzero(_unit(q[lo:lo + 256]) @ ux.T >= low)
        i.append(a + lo)
        j.append(b)
    return np.concatenate(i), np.concatenate(j)


def _cosines(q, x, i, j) -> np.ndarray:
    out = np.empty(len(i))
    nq, nx = np.sqrt((q * q).sum(axis=1)), np.sqrt((x * x).sum(axis=1))
    for lo in range(0, len(i), 1 << 16):
        a, b = i[lo:lo + (1 << 16)], j[lo:lo + (1 << 16)]
        out[lo:lo + (1 << 16)] = (q[a] * x[b]).sum(axis=1) / (nq[a] * nx[b])
    return out


def _joined(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest labels after the edges (x, y) are added."""
    while len(x):
        low = np.minimum(root[x], root[y])
        if np.array_equal(low, root[x]) and np.array_equal(low, root[y]):
            break
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        root = root[root]
    return root


def _query(threshold, beam):
    """A block and a shard to rows (rep, links, null) and forest edges (a, null, b)."""
    def run(block: pa.Table, shard: pa.Table) -> pa.Table:
        if not block.num_rows or not shard.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        one, own = _Shard(shard), block["rep"].to_numpy()
        nodes, links = len(one.reps), np.zeros(block.num_rows, dtype=np.int64)
        root = np.arange(nodes + block.num_rows)              # the shard's nodes, then the queries
        for lo, n, i, j in one.links(block, threshold, beam):
            links[lo:lo + n] = np.bincount(i - lo, np.abs(one.counts[j]), n).astype(np.int64)
            named_ = one.counts[j] > 0                         # a class without an id is counted and joins nothing
            root = _joined(root, i[named_] + nodes, j[named_])
        while not np.array_equal(root, root[root]):
            root = root[root]
        ids = np.concatenate([one.reps, own])
        some, far = np.flatnonzero(links), np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": pa.array(np.concatenate([own[some], ids[far]])),
                         "links": pa.array(np.concatenate([links[some], np.zeros(len(far), np.int64)]),
                                           mask=np.arange(len(some) + len(far)) >= len(some)),
                         "b": pa.array(np.concatenate([np.zeros(len(some), np.int64), ids[root[far]]]),
                                       mask=np.arange(len(some) + len(far)) < len(some))})
    return run


def _audit(threshold, beam):
    """A block of audit queries and a shard to rows (rep, true links, found links)."""
    def run(block: pa.Table, shard: pa.Table) -> pa.Table:
        if not block.num_rows or not shard.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("rep", "true", "found")})
        one, count = _Shard(shard), np.zeros((2, block.num_rows), dtype=np.int64)
        for k, b in enumerate((None, beam)):
            for lo, n, i, _ in one.links(block, threshold, b):
                count[k, lo:lo + n] = np.bincount(i - lo, minlength=n)
        some = np.flatnonzero(count[0])
        return pa.table({"rep": block["rep"].take(pa.array(some)), "true": pa.array(count[0, some]), "found": pa.array(count[1, some])})
    return run


def _turned(cosine: float):
    """Copies (dim, rep, v) of vectors, turned by a random angle of that cosine; rep is inverted."""
    def run(batches):
        for b in batches:
            out = []
            for rep, raw in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                v = np.frombuffer(raw, "<f8")
                v = v / np.abs(v).max()
                v = v / np.sqrt((v * v).sum())
                r = np.random.default_rng(rep & 0xFFFFFFFF).normal(size=len(v))
                r -= (r @ v) * v
                size = np.sqrt((r * r).sum())
                out.append((cosine * v + (r / size if size > 1e-9 else 0 * r) * np.sqrt(1 - cosine * cosine)).astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(~b.column(1).to_numpy()), pa.array(out, pa.binary())], names=["dim", "rep", "v"])
    return run


def worst_recall(audited: DataFrame) -> float | None:
    """Of rows (rep, true, found) the smallest mean recall of the queries of one class of
    link counts; null without links."""
    return audited.groupBy("rep").agg(F.sum("true").alias("t"), F.sum("found").alias("f")) \
        .groupBy(F.length(F.bin("t"))).agg(F.avg(F.col("f") / F.col("t")).alias("recall")) \
        .agg(F.min("recall")).first()[0]


def _meet(queries: DataFrame, graphs: DataFrame, blocks: int, shards: int, run, schema: str) -> DataFrame:
    """Every block of queries with every shard's graph of the same dimension."""
    block = F.pmod(F.xxhash64(F.lit("block"), "rep"), F.lit(blocks)).cast("int").alias("block")
    q = queries.select("dim", "rep", "v", block).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    g = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "block", "shard"]
    return q.groupBy(*keys).cogroup(g.groupBy(*keys)).applyInArrow(run, schema)


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                           threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, n_links and component_id.  The audited (beam,
    recall) are kept as ``audit`` on the returned frame, the last is what was run; a beam
    of None is the comparison of all."""
    spark = vectors.sparkSession
    bounded_batches(spark, 4096)
    with scratch() as keep:
        rows = keep(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
                    .mapInArrow(_clean, "id long, dim int, v binary"), "vectors")
        what = F.xxhash64("dim", "v").alias("what")
        numbers = numbers_of(rows.where("v is not null").select("id", what), keep)
        rows = rows.withColumn("name", F.col("id"))
        if numbers is not None:
            rows = keep(rows.select("name", "id", "dim", "v", what).join(numbers, ["id", "what"], "left")
                        .select("name", F.col("number").alias("id"), "dim", "v"), "numbered-vectors")
        classes = keep(rows.where("v is not null").groupBy("dim", "v").agg(F.min("id").alias("rep"), F.count("*").alias("n")),
                       "vector-classes")
        # a class without any id still counts for others; it gets none back and joins none
        known = classes.where("rep is not null")
        n, size = classes.agg(F.count("*"), F.coalesce(F.sum("dim"), F.lit(0)) * 8).first()
        shards, blocks = max(SHARDS, -(-size // SHARD_BYTES)), max(BLOCKS, -(-size // SHARD_BYTES))
        graphs = keep(classes.withColumn("n", F.when(F.col("rep").isNull(), -F.col("n")).otherwise(F.col("n")))
                      .withColumn("rep", F.coalesce("rep", F.lit(0)))
                      .withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))
                      .groupBy("dim", "shard").applyInArrow(_build, "dim int, shard int, graph binary, reps binary, "
                                                                    "counts binary, vs binary"), "graphs")
        every = max(AUDIT_EVERY, n // AUDIT_ROWS) if n > 10 * AUDIT_EVERY else 1
        chosen = known.where(F.pmod(F.xxhash64(F.lit("audit"), "rep"), F.lit(every)) == 0).select("dim", "rep", "v")
        turned = chosen.mapInArrow(_turned((1 + threshold) / 2), "dim int, rep long, v binary")

        def recall(beam):
            shares = [worst_recall(_meet(queries, graphs, 1, shards, _audit(threshold, beam), "rep long, true long, found long"))
                      for queries in (chosen, turned)]
            return min((x for x in shares if x is not None), default=1.0)       # none: there are no vectors

        beam, audit = FIRST_BEAM, []
        while True:
            audit.append((beam, recall(beam)))
            if audit[-1][1] >= TARGET_RECALL:
                break
            if beam >= LAST_BEAM:
                beam = None
                audit.append((None, 1.0))
                break
            beam *= 2
        found = keep(_meet(known, graphs, blocks, shards, _query(threshold, beam), "a long, links long, b long"),
                     "found")
        bounded_batches(spark, 100_000)
        labels = connected_components(found.where("b is not null").select("a", "b"))
        keep.drop(labels)
        linked = found.where("links is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
        marks = classes.join(linked, "rep", "left").join(labels_of(labels).withColumnRenamed("id", "rep"), "rep", "left") \
            .select("dim", "v", "rep", F.col("n") - 1 + F.coalesce("links", F.lit(0)), "component") \
            .toDF("dim", "v", "rep", "n_links", "component")
        out = few(rows.join(marks, ["dim", "v"], "left"), 50 * n) \
            .select("name", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
        if numbers is not None:
            out = named(out, numbers, ["component_id"])
        out = keep.last(out.select(F.col("name").alias(id_col), "n_links", F.coalesce("component_id", "name").alias("component_id")), "vector-links")
    out.audit = audit
    return out


def op9_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings")) \
        .select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
