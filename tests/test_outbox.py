import datetime as dt

from pyspark.sql import functions as F

from monthwise.operators import outbox as O
from monthwise.sources.outbox_store import OutboxStore
from tests.conftest import rows

SCHEMA = "FECHA date, PARA string, CC string, SUBJECT string, BODY string, PROCESADO string"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def box(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_replace_by_key_deletes_then_inserts_and_is_idempotent(spark):
    target = box(spark, [(D1, "u", None, "s1", "old", "S"), (D1, "u", None, "s1", "old2", "N"),
                         (D1, "u", None, "s2", "keep", "N"), (D1, "u", None, None, "nullkey", "N")])
    inc = box(spark, [(D2, "v", None, "s1", "new", "N"), (D2, "v", None, None, "nk2", "N")])
    once = O.replace_by_key(target, inc)
    got = rows(once.select("SUBJECT", "BODY", "PROCESADO"))
    assert got == [("s1", "new", "N"), ("s2", "keep", "N"), (None, "nk2", "N"), (None, "nullkey", "N")]
    twice = O.replace_by_key(once, inc)
    # idempotent for non-NULL keys; a NULL key is never deleted (``=`` semantics),
    # so a re-run appends its row again
    nn = lambda df: rows(df.where(F.col("SUBJECT").isNotNull()))
    assert nn(twice) == nn(once)
    assert twice.where(F.col("SUBJECT").isNull()).count() == 3


def test_replace_keep_sent(spark):
    target = box(spark, [(D1, "u", None, "s1", "sent", "S"), (D1, "u", None, "s2", "old", "N")])
    inc = box(spark, [(D2, "v", None, "s1", "again", "N"), (D2, "v", None, "s2", "new", "N")])
    got = rows(O.replace_by_key(target, inc, keep_sent=True).select("SUBJECT", "BODY"))
    assert got == [("s1", "sent"), ("s2", "new")]


def test_mark_processed_flips_all_pending_with_subject_quotes(spark):
    q = 'it\'s "quoted"'
    ob = box(spark, [(D1, "a", None, q, "1", "N"), (D1, "b", None, q, "2", "N"),
                     (D1, "c", None, "other", "3", "N"), (D1, "d", None, q, "4", "S")])
    sent = spark.createDataFrame([(q,), (q,)], "SUBJECT string")
    got = rows(O.mark_processed(ob, sent).select("PARA", "PROCESADO"))
    assert got == [("a", "S"), ("b", "S"), ("c", "N"), ("d", "S")]
    assert rows(O.pending(O.mark_processed(ob, sent)).select("PARA")) == [("c",)]


def test_outbox_row(spark):
    mail = spark.createDataFrame([("subj", "<b>")], "SUBJECT string, BODY string")
    r = O.outbox_row(mail, "to@x", None, D1).first()
    assert tuple(r) == (D1, "to@x", None, "subj", "<b>", "N")


def test_store_replace_and_mark(spark, tmp_shared):
    store = OutboxStore(spark, f"{tmp_shared}/outbox")
    store.write_all(box(spark, [(D1, "u", None, "s1", "old", "S"), (D2, "u", None, "s2", "x", "N")]))
    store.replace(box(spark, [(D2, "v", None, "s1", "new", "N")]))
    got = rows(store.read().select("FECHA", "SUBJECT", "BODY", "PROCESADO"))
    assert got == [(D2, "s1", "new", "N"), (D2, "s2", "x", "N")]
    store.mark_processed(spark.createDataFrame([("s1",)], "SUBJECT string"))
    assert rows(store.pending().select("SUBJECT")) == [("s2",)]
    assert dict(store.count_by_status().collect()) == {"S": 1, "N": 1}


def test_store_replace_is_idempotent(spark, tmp_shared):
    store = OutboxStore(spark, f"{tmp_shared}/outbox2")
    store.write_all(box(spark, [(D1, "u", None, "s1", "a", "S"), (D1, "u", None, "s2", "b", "N"),
                                (D2, "u", None, "s3", "c", "N")]))
    inc = box(spark, [(D2, "v", None, "s2", "new", "N"), (D2, "v", None, "s4", "d", "N")])
    store.replace(inc)
    once = rows(store.read())
    store.replace(inc)
    assert rows(store.read()) == once
    assert rows(store.read().select("SUBJECT", "BODY")) == [
        ("s1", "a"), ("s2", "new"), ("s3", "c"), ("s4", "d")]


def test_store_replace_empties_null_date_partition(spark, tmp_shared):
    store = OutboxStore(spark, f"{tmp_shared}/outbox3")
    store.write_all(box(spark, [(None, "u", None, "s1", "old", "N"), (D1, "u", None, "s2", "b", "N")]))
    store.replace(box(spark, [(D2, "v", None, "s1", "new", "N")]))
    got = rows(store.read().select("FECHA", "SUBJECT", "BODY"))
    assert got == [(D1, "s2", "b"), (D2, "s1", "new")]


def test_store_keeps_other_rows_of_the_null_date(spark, tmp_shared):
    store = OutboxStore(spark, f"{tmp_shared}/outbox4")
    store.write_all(box(spark, [(None, "u", None, "a", "old", "N"), (None, "u", None, "keep", "k", "N"),
                                (D1, "u", None, "s2", "b", "N")]))
    store.replace(box(spark, [(None, "v", None, "a", "new", "N")]))
    got = rows(store.read().select("FECHA", "SUBJECT", "BODY"))
    assert got == [(D1, "s2", "b"), (None, "a", "new"), (None, "keep", "k")]
    store.replace(box(spark, [(None, "v", None, "fresh", "f", "N"), (D1, "v", None, "keep", "moved", "N")]))
    got = rows(store.read().select("FECHA", "SUBJECT", "BODY"))
    assert got == [(D1, "keep", "moved"), (D1, "s2", "b"), (None, "a", "new"), (None, "fresh", "f")]
    store.mark_processed(spark.createDataFrame([("a",)], "SUBJECT string"))
    assert rows(store.read().select("SUBJECT", "PROCESADO")) == [
        ("a", "S"), ("fresh", "N"), ("keep", "N"), ("s2", "N")]
    store.mark_processed(spark.createDataFrame([("absent",)], "SUBJECT string"))
    assert store.read().count() == 4


def test_store_leaves_no_stage_behind(spark, tmp_shared):
    import glob

    from monthwise.session import ensure_checkpoint_dir
    store = OutboxStore(spark, f"{tmp_shared}/outbox5")
    store.write_all(box(spark, [(D1, "u", None, "s1", "old", "N")]))
    store.replace(box(spark, [(D2, "u", None, "s1", "new", "N")]))
    assert not glob.glob(ensure_checkpoint_dir(spark).replace("file:", "") + "/monthwise/outbox-stage*")
