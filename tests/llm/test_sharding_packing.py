"""Laws of the shards and of the packed sequences, against plain versions."""

import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np

from monthwise.llm import packing, sharding


def docs(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma,", "é日", "<|endoftext|>"]) for _ in range(rng.randint(0, 80))),
             "hot" if rng.random() < 0.4 else f"s{rng.randrange(4)}", 1, "s") for i in range(n)]
    rows += [(n, None, "hot", 1, "s"), (n + 1, "", None, 1, "s"), (n + 2, "tiny source", "once", 1, "s"),
             (n + 3, "word " * 9000, "hot", 1, "s")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, size int, shard string")


def test_shards(spark):
    rows, df = docs(spark)
    got = sharding.assign_shards(df.repartition(5)).collect()
    again = sharding.assign_shards(df.repartition(3)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    text, source = {r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows}
    slots = defaultdict(list)
    for r in got:
        b = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(b) + 8, zlib.crc32(b))
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({len(s) for s in slots.values()}) <= 2
    # every shard holds its part of every source, to within the other sources' rounding
    mix, total = Counter((r["shard"], source[r["doc_id"]]) for r in got), Counter(source.values())
    for s, n in total.items():
        assert all(abs(mix[i, s] - n / 24) <= 2 for i in range(24)), s


def test_shards_equal_a_plain_sort(spark):
    rows, df = docs(spark, 200)
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.assign_shards(df).collect()}
    h = {r["doc_id"]: r["h"] for r in df.selectExpr("doc_id", f"xxhash64({sharding.SEED}, doc_id) AS h").collect()}
    by = defaultdict(list)
    for r in rows:
        by[r[2] is None, r[2] or ""].append(r[0])
    place = []
    for key, ids in by.items():
        ids.sort(key=lambda i: (h[i] % 2**64 >> 52, h[i], i))
        place += [((2 * r + 1) / (2 * len(ids)), h[i], i) for r, i in enumerate(ids)]
    place.sort()
    n = len(place)
    want = {i: (p * 24 // n, p - -(-(p * 24 // n) * n // 24)) for p, (_, _, i) in enumerate(place)}
    assert got == want


def test_shard_edges(spark):
    schema = "doc_id long, text string, source string"
    assert sharding.assign_shards(spark.createDataFrame([], schema)).count() == 0
    got = sharding.assign_shards(spark.createDataFrame([(None, "a", "x"), (1, "b", "x"), (1, "b", "x")], schema)).collect()
    assert len(got) == 3 and all(r["slot"] == 0 for r in got) and len({r["shard"] for r in got}) == 3


def test_write_shards(spark, tmp_path):
    rows, df = docs(spark, 100)
    a = sharding.assign_shards(df, n_shards=3)
    sharding.write_shards(df.select("doc_id", "text", "source"), a, str(tmp_path / "out"), files=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in back.collect()) == sorted(
        (r["doc_id"], r["shard"], r["slot"]) for r in a.collect())


def check_pieces(rows, pieces, ids):
    by, seqs = defaultdict(list), defaultdict(list)
    for p in pieces:
        by[p["doc_id"]].append(p)
        seqs[p["sequence_id"]].append(p)
    assert set(by) == set(ids)
    for i, v in by.items():
        at = 0
        for p in sorted(v, key=lambda p: p["start"]):
            part = ids[i][at:at + p["length"]]
            assert p["start"] == at and p["doc_tokens"] == len(ids[i])
            assert p["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += p["length"]
        assert at == len(ids[i])
    full = 0
    for v in seqs.values():
        at = 0
        for p in sorted(v, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        full += at == 1024
    assert sorted(seqs) == list(range(len(seqs))) and full >= len(seqs) - 1
    return seqs


def test_packing_against_tokenizers(spark):
    from tokenizers import Tokenizer
    rows, df = docs(spark)
    tk = Tokenizer.from_file(packing.vocabulary_path("byte_bpe_50k.json"))
    ids = {r[0]: tk.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in rows}
    pieces = packing.pack(df.repartition(4))[0].collect()
    seqs = check_pieces(rows, pieces, ids)
    total, all_tokens = Counter(), sum(map(len, ids.values()))
    for r in rows:
        total[r[2] or ""] += len(ids[r[0]])
    for s in sorted(seqs)[:-1]:                      # every full sequence holds the mixture, to a token a source
        have = Counter()
        for p in seqs[s]:
            have[p["source"]] += p["length"]
        assert all(abs(have[x] - 1024 * n / all_tokens) <= len(total) for x, n in total.items())


def test_targets_and_dry_queues():
    totals = np.array([5000, 300, 40], dtype=np.int64)
    plan = packing.Schedule(totals, packing.shares(totals.tolist(), [0.5, 0.5, 0.0]))
    s = np.repeat([0, 1, 2], [50, 30, 40])
    a = np.concatenate([np.arange(50) * 100, np.arange(30) * 10, np.arange(40)])
    b = a + np.repeat([100, 10, 1], [50, 30, 40])
    doc, lo, hi, at = plan.pieces(s, a, b)
    covered = np.concatenate([np.arange(x, x + n) for x, n in zip(at, hi - lo)])
    assert sorted(covered) == list(range(5340))      # gapless, every token once
    assert (at // 1024 == (at + hi - lo - 1) // 1024).all()
    first = (s[doc] == 1) & (at < 512)
    assert abs(int((hi - lo)[first].sum()) + int(((hi - lo)[(s[doc] == 0) & (at < 512)]).sum()) - 512) <= 512


def test_packing_edges(spark):
    schema = "doc_id long, text string, source string, n int"
    assert packing.pack(spark.createDataFrame([], schema))[0].count() == 0
    got = packing.pack(spark.createDataFrame([(None, None, None, 1), (1, "", "a", 1), (1, "", "a", 1)], schema))[0].collect()
    assert sorted((r["length"], r["doc_tokens"], r["sequence_id"], r["ids_crc32"]) for r in got) == \
        [(1, 1, 0, zlib.crc32(b"\0\0\0\0"))] * 3
    assert sorted(r["offset"] for r in got) == [0, 1, 2]


def _positions(totals, targets=None, lengths=(7, 100, 3)):
    """Stream positions of all tokens of queues cut into documents."""
    plan = packing.Schedule(np.array(totals, dtype=np.int64), packing.shares(totals, targets))
    seen = []
    for q, total in enumerate(totals):
        ends, at = [], 0
        while at < total:
            at = min(total, at + lengths[len(ends) % len(lengths)])
            ends.append(at)
        b = np.array(ends, dtype=np.int64)
        a = np.concatenate(([0], b[:-1])).astype(np.int64)
        _, lo, hi, pos = plan.pieces(np.full(len(a), q), a, b)
        n = hi - lo
        seen.append(np.repeat(pos - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()))
    return np.sort(np.concatenate(seen))


def test_targets_with_zeros_give_every_position_once():
    for totals, targets in (([1000, 300_000], [1.0, 0.0]), ([1000, 300_000], [0.0, 1.0]), ([5, 7, 9], [0.0, 0.0, 2.0]), ([40_000, 3], None)):
        assert np.array_equal(_positions(totals, targets, (5000, 100)), np.arange(sum(totals)))
    for bad in ([0.0, 0.0], [1.0, -1.0]):
        try:
            packing.shares([3, 4], bad)
            raise AssertionError("accepted")
        except ValueError:
            pass


def test_many_sources():
    rng = random.Random(4)
    totals = [rng.randint(1, 12) for _ in range(3000)]
    assert np.array_equal(_positions(totals), np.arange(sum(totals)))


def test_rows_without_an_id_are_spread(spark):
    df = spark.range(20_000).selectExpr("cast(null as bigint) AS doc_id", "'same text' AS text", "'one' AS source")
    got = sharding.assign_shards(df.repartition(4)).groupBy("shard").count().collect()
    assert len(got) == 24 and {r["count"] for r in got} <= {833, 834}
    h = df.selectExpr("xxhash64(17, crc32(text), monotonically_increasing_id()) AS h").distinct().count()
    assert h == 20_000
