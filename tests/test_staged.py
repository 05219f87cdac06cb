"""An interrupted rewrite ends in the old or the new table; the key sketch; one evaluation."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from monthwise.operators import outbox as O
from monthwise.sources.outbox_store import OutboxStore
from tests.conftest import rows, scanned_files

D = [dt.date(2024, 1, d) for d in range(1, 9)]
SCHEMA = O.OUTBOX_SCHEMA


class Stop(Exception):
    """The driver is lost here."""


def box(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def replaced(target, incoming):
    return rows(O.replace_by_key(target, incoming).select(*O.OUTBOX_COLUMNS))


OLD = [(D[0], "u", None, "moved", "old", "S"), (D[0], "u", None, "stays", "k", "N"), (D[1], "u", None, "gone", "old", "N"),
       (D[2], "u", None, "far", "f", "N"), (None, "u", None, "moved", "undated", "N")]
INCOMING = [(D[3], "v", None, "moved", "new", "N"), (D[0], "v", None, "gone", "new", "N")]


def store_at(spark, path):
    store = OutboxStore(spark, path)
    store.write_all(box(spark, OLD))
    return store


def lost_after(store, step, monkeypatch):
    """The rewrite's driver is lost after (or in the middle of) a step."""
    if step == "stage":
        monkeypatch.setattr(store, "_record", lambda *a: (_ for _ in ()).throw(Stop()))
    elif step == "record":
        monkeypatch.setattr(store, "_apply", lambda *a: (_ for _ in ()).throw(Stop()))
    elif step == "one partition":
        def some(token, touched):
            stage = f"{store._redo(token)}/rows"
            store._write(store._read(stage, store.schema).where(F.col("FECHA") == F.lit(D[0])), store.path, "dynamic", store.schema)
            raise Stop
        monkeypatch.setattr(store, "_apply", some)
    elif step == "rows but not the removed partitions":
        whole = store._write

        def write(df, path, mode, schema):
            whole(df, path, mode, schema)
            if mode == "dynamic":
                raise Stop
        monkeypatch.setattr(store, "_write", write)
    elif step == "rows but not the sketch":
        real, n = store._delete, [0]

        def delete(path):
            real(path)
            raise Stop
        monkeypatch.setattr(store, "_delete", delete)
    elif step == "apply":
        monkeypatch.setattr(store, "_finish", lambda *a: (_ for _ in ()).throw(Stop()))
    elif step == "half of finish":
        real = store._delete

        def delete(path):
            real(path)
            if path.endswith("/record"):
                raise Stop
        monkeypatch.setattr(store, "_delete", delete)


@pytest.mark.parametrize("step,new", [("stage", False), ("record", True), ("one partition", True), ("rows but not the removed partitions", True),
                                      ("rows but not the sketch", True), ("apply", True), ("half of finish", True)])
def test_a_lost_driver_leaves_the_old_or_the_new_table(spark, tmp_shared, monkeypatch, step, new):
    path = f"{tmp_shared}/outbox"
    store = store_at(spark, path)
    want = replaced(box(spark, OLD), box(spark, INCOMING)) if new else rows(box(spark, OLD))
    with monkeypatch.context() as m:
        lost_after(store, step, m)
        with pytest.raises(Stop):
            store.replace(box(spark, INCOMING))
    after = OutboxStore(spark, path)                       # whoever opens it next
    assert rows(after.read()) == want
    assert rows(after.read()) == want and after.recover() == 0
    assert not glob.glob(f"{path}/_redo/*")
    # the table works on, its sketch is that of its rows
    after.replace(box(spark, INCOMING))
    assert rows(after.read()) == replaced(box(spark, OLD), box(spark, INCOMING))
    for r in after.read().collect():
        assert r["FECHA"] in after.dates_of(spark.createDataFrame([(r["SUBJECT"],)], "SUBJECT string"))


def test_a_lost_first_write_leaves_no_table(spark, tmp_shared, monkeypatch):
    store = OutboxStore(spark, f"{tmp_shared}/first")
    with monkeypatch.context() as m:
        lost_after(store, "stage", m)
        with pytest.raises(Stop):
            store.write_all(box(spark, OLD))
    assert OutboxStore(spark, f"{tmp_shared}/first").read().count() == 0
    store.write_all(box(spark, OLD))
    assert rows(store.read()) == rows(box(spark, OLD))


def test_write_all_replaces_everything(spark, tmp_shared):
    store = store_at(spark, f"{tmp_shared}/all")
    store.write_all(box(spark, INCOMING))
    assert rows(store.read()) == rows(box(spark, INCOMING))
    store.write_all(box(spark, []))
    assert store.read().count() == 0 and store.partitions() == set()
    store.replace(box(spark, INCOMING))
    assert rows(store.read()) == rows(box(spark, INCOMING))


# -- the sketch ----------------------------------------------------------------------

def many(spark, n_dates=8, per_date=40):
    return box(spark, [(D[i], "u", None, f"s{i}-{j}", "b", "N") for i in range(n_dates) for j in range(per_date)])


def test_replace_scans_only_the_touched_dates(spark, tmp_shared):
    path = f"{tmp_shared}/touched"
    store = OutboxStore(spark, path)
    store.write_all(many(spark))
    keys = spark.createDataFrame([("s2-7",), ("s5-1",), ("unknown",), (None,)], "SUBJECT string")
    assert store.dates_of(keys) == {D[2], D[5]}
    assert scanned_files(store.current({D[2], D[5]})) == len(glob.glob(f"{path}/FECHA=2024-01-0[36]/*.parquet"))
    want = replaced(store.read(), box(spark, [(D[7], "v", None, "s2-7", "new", "N")]))
    # files of the other dates are unreadable: a scan of them would fail
    kept = {f: open(f, "rb").read() for d in (1, 2, 4, 5, 6, 7) for f in glob.glob(f"{path}/FECHA=2024-01-0{d}/*.parquet")}
    for f in kept:
        os.chmod(f, 0o644)
        with open(f, "wb") as out:
            out.write(b"not a table")
    store.replace(box(spark, [(D[7], "v", None, "s2-7", "new", "N")]))
    for f, body in kept.items():
        with open(f, "wb") as out:
            out.write(body)
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        assert os.path.exists(f) and (not os.path.exists(crc) or os.path.getsize(crc) > 0)
    assert rows(OutboxStore(spark, path).read()) == want


def test_the_sketch_has_no_false_misses_and_few_false_hits(spark, tmp_shared):
    store = OutboxStore(spark, f"{tmp_shared}/sketch")
    store.write_all(many(spark, 4, 500))
    here = store.read().select("SUBJECT", "FECHA")
    for d in D[:4]:
        some = here.where(F.col("FECHA") == F.lit(d)).select("SUBJECT").limit(5)
        assert d in store.dates_of(some)
    absent = spark.range(400).select(F.concat(F.lit("no"), F.col("id").cast("string")).alias("SUBJECT"))
    assert store.dates_of(absent) == set()


def test_a_table_without_a_sketch_is_read(spark, tmp_shared):
    path = f"{tmp_shared}/plain"
    box(spark, OLD).write.partitionBy("FECHA").parquet(path)
    store = OutboxStore(spark, path)
    assert store.dates_of(spark.createDataFrame([("moved",)], "SUBJECT string")) == {D[0], None}
    store.replace(box(spark, INCOMING))
    assert rows(store.read()) == replaced(box(spark, OLD), box(spark, INCOMING))


def test_incoming_rows_are_evaluated_once(spark, tmp_shared):
    store = store_at(spark, f"{tmp_shared}/once")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    store.replace(box(spark, INCOMING).mapInArrow(count, SCHEMA))
    assert seen.value == len(INCOMING)
