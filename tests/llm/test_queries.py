"""The registered queries over whole small tables, against SQL or a plain version."""

import hashlib
import html
import re
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from monthwise.llm import queries, sentencepieces
from tests.conftest import SF_SMALL
from test_embedding_dedup import brute as brute_vectors
from test_near_dedup import brute as brute_sets
from test_pii import plain as plain_pii
from test_sharding_packing import check_pieces

SF = SF_SMALL


def rows(name, cols):
    return list(zip(*[pq.read_table(f"{SF}/{name}.parquet", columns=cols)[c].to_pylist() for c in cols]))


def run(spark, name):
    return [r.asDict() for r in queries.registry()[name](spark, SF).collect()]


def test_all_queries_are_registered():
    names = list(queries.registry())
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in names] == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.sql(queries.oracle_sql()[name])
    got = run(spark, name)
    assert sorted(got[0]) == sorted(rel.columns)
    assert sorted((tuple(r[c] for c in rel.columns) for r in got), key=str) == sorted(rel.fetchall(), key=str)


def test_op1(spark):
    want = brute_sets(rows("documents", ["doc_id", "text"]), 4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in run(spark, "op1_near_dedup")}
    assert got == want


def test_op3(spark):
    texts = dict(rows("documents", ["doc_id", "text"]))
    for r in run(spark, "op3_pii"):
        want = plain_pii(texts[r["doc_id"]] or "")
        joined = ",".join(f"{k}:{a}:{b}" for k in want for a, b in want[k])
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert all(r[f"n_{k}"] == len(want[k]) for k in want)


def test_op4(spark):
    got = run(spark, "op4_toxicity")
    labels = dict(rows("labels", ["doc_id", "toxic"]))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert len(got) == len(rows("documents", ["doc_id"])) and labels


def test_op5(spark):
    def article(page):
        part = page[page.index("<article>"):page.index("</article>")]
        blocks = re.split(r"</?(?:article|h1|p)[^>]*>", part)
        texts = (" ".join(html.unescape(re.sub(r"<[a-zA-Z/][^>]*>", " ", b)).split()) for b in blocks)
        return "\n".join(t for t in texts if t)

    pages = dict(rows("pages", ["page_id", "html"]))
    got = run(spark, "op5_html_text")
    assert len(got) == len(pages)
    assert np.mean([r["text"] == article(pages[r["page_id"]]) for r in got]) >= 0.98


def test_op6(spark):
    got = run(spark, "op6_sentencepiece")
    assert len(got) == len(rows("documents", ["doc_id"])) and all(r["decoded_equal"] for r in got)
    codec, texts = sentencepieces.Codec(sentencepieces.read_model()), dict(rows("documents", ["doc_id", "text"]))
    for r in got:                                        # one stretch after the other, exhaustively searched
        ids = [i for s in codec.split(texts[r["doc_id"]] or "") for i in ([codec.byte_ids[0]] if s == sentencepieces.NUL else codec.best(s))]
        assert (r["n_ids"], r["n_byte_ids"]) == (len(ids), sum(i in codec.bytes_of for i in ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<i4").tobytes())


def test_op7(spark):
    text = dict(rows("documents", ["doc_id", "text"]))
    got = run(spark, "op7_sharding")
    assert sorted(r["doc_id"] for r in got) == sorted(text)
    count = np.bincount([r["shard"] for r in got], minlength=24)
    assert count.max() - count.min() <= 1 and len(count) == 24
    for r in got:
        b = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(b) + 8, zlib.crc32(b), "rows", None)
    for s in range(24):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(count[s]))


def test_op8(spark):
    from tokenizers import Tokenizer

    from monthwise.llm import packing
    tk = Tokenizer.from_file(packing.vocabulary_path("byte_bpe_50k.json"))
    docs = rows("documents", ["doc_id", "text"])
    ids = {i: tk.encode(t or "", add_special_tokens=False).ids + [0] for i, t in docs}
    check_pieces(docs, run(spark, "op8_packing"), ids)


def test_op9(spark):
    data = rows("embeddings", ["vec_id", "embedding"])
    ids = np.array([i for i, _ in data])
    near, comp = brute_vectors(np.array([v for _, v in data]))
    got = {r["vec_id"]: r for r in run(spark, "op9_embedding_dedup")}
    want = near.sum(axis=1)
    assert sum(r["n_links"] for r in got.values()) >= 0.99 * want.sum()
    assert np.mean([got[i]["component_id"] == ids[comp[k]] for k, i in enumerate(ids)]) >= 0.99


def test_op10(spark):
    pages = rows("pages", ["page_id", "html"])
    largest: dict = {}
    for i, page in pages:
        largest[page or ""] = max(largest.get(page or "", i), i)
    got = {r["page_id"]: r for r in run(spark, "op10_warc")}
    assert len(got) == len(pages)
    for i, page in pages:
        b, r = (page or "").encode(), got[i]
        revisit = len(b) >= 1000 and largest[page or ""] != i
        assert (r["payload_bytes"], r["payload_digest"]) == (len(b), hashlib.sha1(b).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", largest[page or ""]) if revisit else ("response", None))
