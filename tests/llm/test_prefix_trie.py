"""The trie against a plain one, shards cut at every level, and the spilling queue."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from monthwise.llm import prefix_trie as P
from monthwise.llm.spill_queue import SpillingQueue

SCHEMA = "conv_id long, turn int, role string, text string, depth string, c int, x1 long"


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in own.items()}
    path = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        path[c] = own.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])[:h] + ts[h:]
    members = defaultdict(list)
    for c in sorted(path):
        for d in range(len(path[c]) + 1):
            members[tuple(path[c][:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        mine = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        leaves[node] = sum(leaves[x] for x in children[node]) if children[node] else 1
        saved[node] = mine + sum(saved[x] for x in children[node])
    return sorted(((cs[0], len(n), members[n[:-1]][0] if n else None, len(cs), len(children[n]), leaves[n], saved[n],
                    hashlib.sha256(",".join(str(c) for c in cs if len(path[c]) == len(n)).encode()).hexdigest())
                   for n, cs in members.items()), key=str)


def run(spark, rows, parts=4, **kw):
    df = spark.createDataFrame([(*r, "d", 1, 2) for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in P.prefix_trie(df, **kw).drop("x1", "x2").collect()), key=str)


def conversations(n, seed, ids=None):
    rng = random.Random(seed)
    starts = [[(rng.choice(["user", "system", None]), rng.choice(["hi", "hé", "", None])) for _ in range(12)] for _ in range(3)]
    rows = []
    for c in ids or range(n):
        turns = rng.choice(starts)[:rng.randint(0, 12)] + [("user", f"t{rng.randrange(4)}") for _ in range(rng.randint(1, 5))]
        rows += [(c, t, r, x) for t, (r, x) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("band,queue", [(P.BAND, P.QUEUE), (1, 3), (2, 1), (5, 20)])
def test_equal_to_a_plain_trie(spark, band, queue):
    rows = conversations(120, 1)
    assert run(spark, rows, band=band, queue=queue) == plain(rows)


def test_sparse_and_negative_ids(spark):
    rows = conversations(0, 2, ids=[-12, -11, -10, -3, 0, 1, 4, 7, 9, 10, 2**62, 2**63 - 1])
    assert run(spark, rows) == plain(rows)


def test_one_long_conversation_over_many_ranges(spark):
    rows = [(5, t, "user", f"x{t % 3}") for t in range(900)] + [(6, t, "user", f"x{t % 3}") for t in range(700)] + conversations(30, 3, range(100, 130))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark, rows, band=64) == plain(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_nulls_ties_and_turnless(spark):
    rows = [(0, 0, "u", "a"), (1, None, "u", "b"), (1, 0, None, None), (2, 0, "u", None), (None, 0, "u", "z"), (3, 1, "u", "same"),
            (3, 1, "u", "same"), (11, 0, "u", "only"), (16, 0, "u", "only"), (17, 0, "u", "x" * 100_000), (18, 0, "u", "x" * 100_000)]
    assert run(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "u", "x")]) == []


def test_copies_of_one_conversation(spark):
    rows = [(5 * c, t, "user", f"turn {t}") for c in range(80) for t in range(6)]
    got = run(spark, rows)
    assert got == plain(rows) and len(got) == 7


def test_hash_of_ids_is_the_unsigned_crc(spark):
    got = spark.range(3).select(F.crc32(F.col("id").cast("string").cast("binary")).alias("h")).collect()
    assert [r["h"] for r in got] == [zlib.crc32(str(i).encode()) for i in range(3)]


@pytest.mark.parametrize("limit", [1, 7, 1000])
def test_spilling_queue(limit):
    rng = random.Random(limit)
    queue, want, now = SpillingQueue(limit), defaultdict(lambda: [0, 0]), 0
    for now in range(300):
        for _ in range(rng.randint(0, 6)):
            key = (now + rng.randint(1, 40), rng.randint(-2, 2), 0)
            queue.push(key, 1, 10)
            want[key][0] += 1
            want[key][1] += 10
        for x in range(-2, 3):
            assert queue.take((now, x, 0)) == tuple(want[now, x, 0])
    assert (queue.spills > 0) == (limit < 1000)
