"""Connected components of an edge list, as DataFrame iterations.

Each Arrow batch of edges is first contracted to a star forest by a local
union-find (fewer edges, same components).  Then, until nothing changes, every
vertex takes the smallest label of its neighbours and follows it one step
(pointer jumping), so long chains take a logarithmic number of rounds.  Each
round is written to the shared checkpoint folder, which cuts the lineage.
Labels are minima, so a vertex with very many edges sends one row per task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import few, materialize, release

MAX_ROUNDS = 100


def _contract(batches):
    for b in batches:
        ids, inv = np.unique(np.concatenate([b.column(0).to_numpy(zero_copy_only=False),
                                             b.column(1).to_numpy(zero_copy_only=False)]),
                             return_inverse=True)
        n = b.num_rows
        root = np.arange(len(ids))
        x, y = inv[:n], inv[n:]
        while n:
            lo = np.minimum(root[x], root[y])
            before = root.copy()
            np.minimum.at(root, root[x], lo)
            np.minimum.at(root, root[y], lo)
            root = root[root]
            if np.array_equal(before, root):
                break
        far = root != np.arange(len(ids))
        yield pa.RecordBatch.from_arrays([pa.array(ids[far]), pa.array(ids[root[far]])],
                                         names=["a", "b"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every vertex of ``edges`` (a long, b long): the smallest
    id reachable.  Edges with a null end are ignored.  The result is a written
    table (``release`` it after use); an empty edge list gives an empty table."""
    edges = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")) \
        .where("a is not null and b is not null and a <> b").mapInArrow(_contract, "a long, b long")
    both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                        .alias("e")).select("e.a", "e.b")
    both = materialize(both, "cc-edges")
    n = both.count()
    labels = materialize(few(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b"))
                             .select("id", F.least("b", "id").alias("component")), n), "cc-labels")
    pairs = few(both, n)
    try:
        for _ in range(MAX_ROUNDS):
            near = few(pairs.join(labels, pairs.b == labels.id), n).groupBy(F.col("a").alias("id")) \
                .agg(F.min("component").alias("near"))
            step = few(labels.join(near, "id"), n).select("id", F.least("component", "near").alias("component"),
                                                          F.col("component").alias("was"))
            jump = labels.select(F.col("id").alias("target"), F.col("component").alias("further"))
            step = step.join(jump, step.component == jump.target) \
                .select("id", F.least("component", "further").alias("component"),
                        (F.least("component", "further") != F.col("was")).cast("int").alias("moved"))
            after = materialize(few(step, n), "cc-labels")
            moved = after.agg(F.max("moved").alias("m")).first()["m"]
            release(labels)
            labels = after
            if not moved:
                break
        else:
            raise RuntimeError("components did not converge")
    finally:
        release(both)
    return labels


def labels_of(labels: DataFrame) -> DataFrame:
    return labels.select("id", "component")
