"""Operator 13: the prefix trie of conversations, by time-forward processing.

A node is a distinct sequence of first turns, known by a 128-bit hash: the exclusive or of
hashes of (position, role, text), so that it is built piece by piece in any number of tasks.
Only hashes, ids and byte counts move; texts do not.

Turns are numbered, and hashes accumulated, over range-sorted rows: each task runs through its
range, and the few conversations that cross a border get what the ranges before hold.  A
conversation of any length is thus spread over many tasks.

Subtree totals go up the trie by time-forward processing.  Every node has one owner, the path
of its smallest member; its own values stand there, and every member's path is a path of the
trie.  Paths are dealt to shards by groups of ids and by bands of BAND levels.  A shard's
nodes are sorted by reverse level order (Spark's external sort); a node takes the totals
sent to it from a priority queue, which spills, and sends its own to its parent.  What one
shard passes to the shards above are the totals of its roots, the nodes at the top of a band:
they are summed along each conversation's bands and stand at the bottom of the band above.
A node that several shards hold gets the sum of its totals, because each value stands in one.

Hot groups: a first turn, prefix or conversation that holds a third of all rows is cut by ids and
bands; all groupings reduce in the tasks first; joins on parents are plain equi-joins, which adaptive
execution splits.  The one exception is the SHA-256 of the ids that end at one node: it is
sequential by definition, so one task streams them in order, and holds a batch.

Defined results: null role or text is empty; turns of equal number are ordered by a hash of role
and text; equal rows are turns of their own; rows without a conv_id belong to no conversation and
are left out; ``c % 5`` has the sign of c, as in SQL.  An empty table gives an empty result.
Extra columns are ignored.  Very long texts count by their bytes and are hashed in the JVM.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthwise.llm.common import Keeper, scratch, table
from monthwise.llm.spill_queue import SpillingQueue

STRIDE = 5                     # conversations that start alike
MOST_SHARED = 9                # a conversation takes fewer turns than this from the first of its group
BAND = 4096                    # levels of one shard
QUEUE = 1 << 18                # messages that a task holds before it spills
ROOT = (0, 0)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
TRIE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, " \
       "saved_tokens long, ends_sha256 string"


def _running(xor: bool, columns: int):
    """Rows sorted by their first column ``c``: the last ``columns`` columns become their
    running sums (or exclusive ors) within ``c`` in this task; the numbers of the task and of the
    row in it are added."""
    op = np.bitwise_xor if xor else np.add

    def run(batches):
        pid, key, carry, at = TaskContext.get().partitionId(), None, [np.int64(0)] * columns, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            c = b.column(0).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
            out = list(b.columns)
            for k in range(columns):
                own = b.column(b.num_columns - columns + k).to_numpy(zero_copy_only=False)
                acc = np.concatenate(([np.int64(0)], op.accumulate(own)))
                start = acc[first]
                run_ = acc[1:] ^ start[group] if xor else acc[1:] - start[group]
                if key == c[0]:
                    same = group == 0
                    run_[same] = op(run_[same], carry[k])
                carry[k] = run_[-1]
                out[b.num_columns - columns + k] = pa.array(run_)
            key = c[-1]
            yield pa.RecordBatch.from_arrays([*out, pa.array(np.full(n, pid, np.int32)), pa.array(np.arange(at, at + n))],
                                             names=[*b.schema.names, "pid", "at"])
            at += n
    return run


def accumulated(rows: DataFrame, order: list, columns: list[str], xor: bool, keep: Keeper, name: str) -> DataFrame:
    """``rows`` with ``columns`` (its last ones, long) replaced by their running sums or exclusive
    ors within the first column ``c`` (long), in ``order``, a written table.

    Rows are cut into ranges of (c, order), however many one c has.  What a range needs from those
    before is a row for each c that goes on in it: fewer rows than there are ranges.
    """
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", pid int, at long"
    part = keep(rows.repartitionByRange("c", *order).sortWithinPartitions("c", *order)
                .mapInArrow(_running(xor, len(columns)), schema), f"{name}-ranges")
    before = Window.partitionBy("c").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    tops = part.groupBy("c", "pid").agg(F.max_by(F.struct(*columns), "at").alias("s"))      # a range's whole sums
    total = F.bit_xor if xor else F.sum
    border = keep(tops.select("c", "pid", F.min("pid").over(Window.partitionBy("c")).alias("lowest"),
                              *[total(F.col("s")[x]).over(before).alias(f"{x}_before") for x in columns])
                  .where("pid != lowest").drop("lowest"), f"{name}-borders")
    joined = part.join(border, ["c", "pid"], "left")
    zero = F.lit(0).cast("long")

    def whole(x: str) -> Column:
        old = F.coalesce(F.col(f"{x}_before"), zero)
        return (F.col(x).bitwiseXOR(old) if xor else F.col(x) + old).alias(x)
    return joined.select(*[whole(x) if x in columns else F.col(x) for x in rows.columns])


def _rebuilt(conversations: DataFrame, keep: Keeper, names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns): a row (c, length) for each conversation, and a row
    (c, i, b, last, h1, h2) for each rebuilt turn, i from 1, b the bytes of its text."""
    role, text = (F.coalesce(F.col(names[x]).cast("string"), F.lit("")) for x in ("role", "text"))
    src = conversations.where(F.col(names["conv_id"]).isNotNull()) \
        .select(F.col(names["conv_id"]).cast("long").alias("c"), F.col(names["turn"]).alias("turn"),
                F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit(1), text, role).alias("t2"),
                F.octet_length(text).cast("long").alias("b"), F.rand(13).alias("tie"), F.lit(1).cast("long").alias("pos"))
    order = [F.col("turn").asc_nulls_first(), "t1", "t2", "tie"]
    own = accumulated(src, order, ["pos"], False, keep, "trie-turns").select("c", "t1", "t2", "b", "pos")
    shared = (F.crc32(F.col("c").cast("string").cast("binary")) % MOST_SHARED).alias("h")
    sizes = own.groupBy("c").agg(F.max("pos").alias("n")).select("c", "n", shared, (F.col("c") - F.col("c") % STRIDE).alias("g"))
    sizes = keep(sizes, "trie-sizes")
    k = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = keep(sizes.join(sizes.select(F.col("c").alias("g"), F.col("n").alias("base_n")), "g", "left")
                 .select("c", "h", k.alias("k"), (k + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "trie-conversations")
    away = F.explode(F.array(*[F.try_add("c", F.lit(x)) for x in range(1 - STRIDE, STRIDE)])).alias("to")
    lent = own.where((F.col("pos") < MOST_SHARED) & (F.col("c") % STRIDE == 0)).select(F.col("c").alias("g"), away, "t1", "t2", "b", "pos") \
        .where((F.col("to") - F.col("to") % STRIDE) == F.col("g")).withColumnRenamed("to", "c")
    columns = ["c", F.col("i"), "b", (F.col("i") == F.col("length")).alias("last"),
               F.xxhash64("i", "t1", "t2").alias("h1"), F.xxhash64("t2", "i", "t1").alias("h2")]
    mine = own.join(convs, "c").where("pos > h").withColumn("i", F.col("pos") - F.col("h") + F.col("k"))
    theirs = lent.join(convs, "c").where("pos <= h").withColumn("i", F.col("pos"))
    return convs, mine.select(*columns).unionByName(theirs.select(*columns))


def _totals(limit: int, band: int):
    """A shard's nodes, deepest first, to (x1, x2, n_leaves, saved_tokens): each node takes
    what its children sent and sends the sum on.  Sorted rows of one node follow each other."""
    def run(batches):
        queue, node, parent, leaves, saved, out = SpillingQueue(limit), None, None, 0, 0, []

        def settle():
            got = queue.take(node)
            total = (leaves + got[0], saved + got[1])
            out.append((node[1], node[2], *total))
            if node[0] % band or node[0] == -1:      # the top of a band reports across shards instead
                queue.push((node[0] + 1, *parent), *total)

        for b in batches:
            for i, x1, x2, p1, p2, l, s in zip(*(b.column(k).to_pylist() for k in range(7))):
                key = (-i, x1, x2)
                if key != node:
                    if node is not None:
                        settle()
                    node, parent, leaves, saved = key, (p1, p2), 0, 0
                leaves, saved = leaves + l, saved + s
            yield _batch(out)
            out.clear()
        if node is not None:
            settle()
        out.append((*ROOT, *queue.take((0, *ROOT))))
        yield _batch(out)
    return run


def _batch(out: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(4)],
                                      names=["x1", "x2", "n_leaves", "saved_tokens"])


def _ends(batches):
    """Rows (x1, x2, c) sorted by all three to (x1, x2, digest of the ids, comma-joined)."""
    node, sha, out = None, None, []

    def done():
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                                           pa.array([r[2] for r in out], pa.string())], names=["x1", "x2", "ends_sha256"])
    for b in batches:
        for x1, x2, c in zip(*(b.column(k).to_pylist() for k in range(3))):
            if (x1, x2) == node:
                sha.update(b",%d" % c)
                continue
            if node is not None:
                out.append((*node, sha.hexdigest()))
            node, sha = (x1, x2), hashlib.sha256(b"%d" % c)
        yield done()
        out.clear()
    if node is not None:
        out.append((*node, sha.hexdigest()))
    yield done()


def prefix_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", band: int = BAND, queue: int = QUEUE) -> DataFrame:
    """A row of TRIE for each node, with its hash (x1, x2)."""
    names = {"conv_id": conv_id, "turn": turn, "role": role, "text": text}
    with scratch() as keep:
        convs, turns = _rebuilt(conversations, keep, names)
        turns = turns.withColumns({"x1": F.col("h1"), "x2": F.col("h2")})
        rows = keep(accumulated(turns, ["i"], ["x1", "x2"], True, keep, "trie-paths")
                    .select("c", "i", "b", "last", "x1", "x2", F.col("x1").bitwiseXOR(F.col("h1")).alias("p1"),
                            F.col("x2").bitwiseXOR(F.col("h2")).alias("p2")), "trie-rows")
        nodes = keep(rows.groupBy("x1", "x2").agg(
            F.min("c").alias("conv_id"), F.max("i").alias("depth"), F.count("*").alias("n_convs"), F.max("p1").alias("p1"),
            F.max("p2").alias("p2"), F.max("b").alias("b"), F.count_if("last").alias("n_ends")), "trie-nodes")
        root = convs.agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if(F.col("length") == 0).alias("n_ends")) \
            .where("n_convs > 0")
        sums = _summed(rows, nodes, root, convs, band, queue)
        trie = keep(sums, "trie-totals")
        return keep.last(_with_parents(trie), "trie")


def _values(nodes: DataFrame) -> dict[str, Column]:
    """What a node adds to the totals of its ancestors and its own."""
    return {"leaf": (F.col("n_ends") == F.col("n_convs")).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("b")}


def _summed(rows: DataFrame, nodes: DataFrame, root: DataFrame, convs: DataFrame, band: int, queue: int) -> DataFrame:
    """All parts of the nodes' rows, united and summed by node."""
    zero = F.lit(0).cast("long")
    own = nodes.withColumns(_values(nodes)).withColumns({"c": F.col("conv_id"), "i": F.col("depth"),
                                                        "band": F.expr(f"depth div {band}")})
    cols = ["c", "i", "x1", "x2", "p1", "p2", "leaf", "saved"]
    paths = rows.select(*cols[:6], zero.alias("leaf"), zero.alias("saved")).unionByName(own.select(*cols)) \
        .unionByName(_below(rows, own, band).select(*cols))
    totals = paths.withColumns({"g": F.col("c") - F.col("c") % STRIDE, "band": F.expr(f"i div {band}")}) \
        .repartition("g", "band").sortWithinPartitions(F.col("i").desc(), "x1", "x2") \
        .select("i", "x1", "x2", "p1", "p2", "leaf", "saved") \
        .mapInArrow(_totals(queue, band), "x1 long, x2 long, n_leaves long, saved_tokens long")
    ends = rows.where("last").select("x1", "x2", "c") \
        .unionByName(convs.where("length = 0").select(F.lit(0).cast("long").alias("x1"), F.lit(0).cast("long").alias("x2"), "c")) \
        .repartition("x1", "x2").sortWithinPartitions("x1", "x2", "c").mapInArrow(_ends, "x1 long, x2 long, ends_sha256 string")
    children = nodes.groupBy("p1", "p2").agg(F.count("*").alias("n_children")) \
        .select(F.col("p1").alias("x1"), F.col("p2").alias("x2"), "n_children")
    top = root.select(zero.alias("x1"), zero.alias("x2"), "conv_id", zero.alias("depth"), "n_convs",
                      (F.col("n_ends") == F.col("n_convs")).cast("long").alias("n_leaves"))
    parts = nodes.select("x1", "x2", "p1", "p2", "conv_id", "depth", "n_convs")
    for other in (top, totals, children, ends):
        parts = parts.unionByName(other, allowMissingColumns=True)
    return parts.groupBy("x1", "x2").agg(
        *[F.max(x).alias(x) for x in ("p1", "p2", "conv_id", "depth", "n_convs")], F.coalesce(F.sum("n_children"), zero).alias("n_children"),
        F.coalesce(F.sum("n_leaves"), zero).alias("n_leaves"), F.coalesce(F.sum("saved_tokens"), zero).alias("saved_tokens"),
        F.coalesce(F.max("ends_sha256"), F.lit(EMPTY_SHA)).alias("ends_sha256")).where("conv_id is not null")


def _below(rows: DataFrame, own: DataFrame, band: int) -> DataFrame:
    """For the last level of each band of a conversation that goes on below: what its own
    nodes in all lower bands add, the totals of the shard roots there."""
    lower = Window.partitionBy("c").orderBy(F.col("band").desc())
    sums = own.where(F.col("band") > 0).groupBy("c", "band").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")) \
        .select("c", (F.col("band") - 1).alias("above"), F.sum("leaf").over(lower).alias("leaf"), F.sum("saved").over(lower).alias("saved"))
    # a conversation's own nodes are the lower end of its path, so above them the sum stays the same
    most = sums.groupBy("c").agg(F.min("above").alias("lowest"), F.max("leaf").alias("all_leaf"), F.max("saved").alias("all_saved"))
    bottom = rows.where(F.col("i") % band == band - 1).withColumn("above", F.expr(f"i div {band}"))
    return bottom.join(sums, ["c", "above"], "left").join(most, "c") \
        .withColumns({"leaf": F.when(F.col("above") < F.col("lowest"), F.col("all_leaf")).otherwise(F.col("leaf")),
                      "saved": F.when(F.col("above") < F.col("lowest"), F.col("all_saved")).otherwise(F.col("saved"))}) \
        .where("leaf is not null")


def _with_parents(trie: DataFrame) -> DataFrame:
    """Adds parent_conv_id.  All nodes of depth 1 have the root as parent, whose smallest member is
    that of the whole trie; the others are joined to theirs."""
    top = trie.where("depth = 0").select(F.col("conv_id")).scalar()
    up = trie.where("depth > 0").select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("above"))
    deep = trie.where("depth > 1").join(up, ["p1", "p2"]).withColumn("parent_conv_id", F.col("above")).drop("above")
    shallow = trie.where("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, top))
    return deep.unionByName(shallow).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                            "saved_tokens", "ends_sha256", "x1", "x2")


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("x1", "x2")


ORACLE = f"""WITH RECURSIVE
ids AS MATERIALIZED (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
crc(c, s, k, v) AS (
  SELECT c, CAST(c AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM ids
  UNION ALL
  SELECT c, s, k + 1, xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END) FROM (
    SELECT c, s, k, CASE WHEN k % 8 = 0 THEN xor(v, CAST(ascii(substr(s, k // 8 + 1, 1)) AS BIGINT)) ELSE v END AS x
    FROM crc WHERE k < 8 * length(s))),
t AS MATERIALIZED (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
info AS MATERIALIZED (
  SELECT crc.c, crc.c - crc.c % {STRIDE} AS g, xor(v, 4294967295) % {MOST_SHARED} AS h, coalesce(b.n, 0) AS base_n
  FROM crc LEFT JOIN (SELECT c, count(*) AS n FROM t GROUP BY c) b ON b.c = crc.c - crc.c % {STRIDE}
  WHERE k = 8 * length(s)),
rebuilt AS MATERIALIZED (
  SELECT info.c, pos AS i, r, x FROM info JOIN t ON t.c = info.g AND pos <= h
  UNION ALL
  SELECT info.c, least(h, base_n) + pos - h, r, x FROM info JOIN t ON t.c = info.c AND pos > h),
m AS MATERIALIZED (
  SELECT c, i, x, string_agg(sha256(length(r) || ':' || r || x), ',') OVER (PARTITION BY c ORDER BY i ROWS UNBOUNDED PRECEDING) AS key FROM rebuilt
  UNION ALL SELECT c, 0, '', '' FROM ids),
ends AS MATERIALIZED (SELECT c, max(i) AS depth FROM m GROUP BY c),
nodes AS MATERIALIZED (
  SELECT m.i AS depth, m.key, min(m.c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * strlen(any_value(m.x)) AS saved,
         CASE WHEN count(*) = count(ends.c) THEN 1 ELSE 0 END AS leaf,
         coalesce(sha256(string_agg(CAST(ends.c AS VARCHAR), ',' ORDER BY ends.c)), sha256('')) AS ends_sha256
  FROM m LEFT JOIN ends ON ends.c = m.c AND ends.depth = m.i GROUP BY m.i, m.key),
up AS (
  SELECT m.i AS depth, m.key, sum(u.leaf) AS n_leaves, sum(u.saved) AS saved_tokens, count_if(u.depth = m.i + 1) AS n_children
  FROM nodes u JOIN m ON m.c = u.conv_id AND m.i <= u.depth GROUP BY m.i, m.key)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(n_children AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN up ON up.depth = n.depth AND up.key = n.key
LEFT JOIN m ON m.c = n.conv_id AND m.i = n.depth - 1 LEFT JOIN nodes p ON p.depth = m.i AND p.key = m.key"""
