"""The pipeline against a plain version, stage by stage."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline as cp
from monthwise.llm import packing, pii, quality, toxicity
from tests.conftest import SF_SMALL
from test_near_dedup import brute
from test_sharding_packing import check_pieces

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_in_order():
    assert [n for n, _ in cp.STAGES] == ["toxicity", "quality_rules", "near_dedup", "pii", "packing"]


def test_run_equals_a_plain_version(spark):
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    all_rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids, texts = list(all_rows), pa.array(list(all_rows.values()), pa.large_string())
    if model is not None:
        lang = toxicity._language_table()
        score = np.concatenate([model.scores(i, s, lang) for i, s in toxicity.padded_ids(texts)])
        ids = [i for i, s in zip(ids, score) if s < 0.5]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    good = {r[0] for r in con.sql(f"SELECT doc_id FROM ({quality.ORACLE}) WHERE kept").fetchall()}
    ids = [i for i in ids if i in good]
    comp = brute([(i, all_rows[i]) for i in ids], cp.SHINGLE_WORDS, cp.PERCENT)
    ids = [i for i in ids if comp[i][1] == i]
    tk = Tokenizer.from_file(packing.vocabulary_path("byte_bpe_50k.json"))
    want = {i: tk.encode(pii.mask(all_rows[i]) or "", add_special_tokens=False).ids + [0] for i in ids}
    pieces = [r.asDict() for r in cp.run(spark, SF_SMALL).collect()]
    assert len(ids) < len(all_rows)
    check_pieces([(i, None) for i in ids], pieces, want)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_the_columns_and_take_odd_rows(spark, k):
    prose = "It was a fine day in the old town and nobody there had any reason to hurry along."
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, prose, "en", "s", 5), (3, prose, "en", "s", 5),
           (None, prose + " Write to a@b.org soon.", "en", "s", 5), (4, prose + " Write to a@b.org soon.", "en", "s", 5)]
    out = cp.STAGES[k][1](spark, frame(spark, odd), SF_SMALL)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"] and out.dtypes == frame(spark, odd).dtypes
    got = sorted((tuple(r) for r in out.collect()), key=str)
    name = cp.STAGES[k][0]
    if name == "toxicity":
        assert len(got) == 6
    elif name == "quality_rules":                        # no words: rejected by the word minimum
        assert len(got) == 4 and all(r[1] for r in got)
    elif name == "near_dedup":                           # one row of id 3; 4 is near to it
        assert [r[0] for r in got if r[1] and r[0] is not None] in ([3, 4], [3])
        assert sum(r[0] is None for r in got) == 1 and {1, 2} <= {r[0] for r in got}
    else:
        assert len(got) == 6 and sum("<EMAIL>" in (r[1] or "") for r in got) == 2
        assert all(r[4] == len(r[1]) for r in got if r[1] is not None)
    empty = frame(spark, [])
    assert cp.STAGES[k][1](spark, empty, SF_SMALL).count() == 0


def test_near_dedup_keeps_one_of_each_group(spark):
    prose = [f"word{i}" for i in range(60)]
    near = " ".join(prose[:-1] + ["changed"])
    rows = [(7, " ".join(prose), "en", "s", 1), (5, near, "en", "s", 1), (9, near, "en", "s", 1),
            (11, "something else entirely that nobody copies around here", "en", "s", 1)]
    assert sorted(r["doc_id"] for r in cp.near_dedup_stage(spark, frame(spark, rows), SF_SMALL).collect()) == [5, 11]


def test_near_dedup_decides_on_the_texts_of_one_id_apart(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = a.replace("a59", "z")
    rows = [(3, a), (5, near), (5, b), (5, b), (7, None), (7, c), (8, c), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in cp.near_dedup_stage(spark, df, SF_SMALL).collect()]
    assert sorted(got, key=str) == sorted([(3, a), (5, b), (7, None), (7, c), (None, a)], key=str)
