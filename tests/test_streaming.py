import datetime as dt

from pyspark.sql import functions as F

from monthwise.session import written
from monthwise.sources.outbox_store import OutboxStore
from monthwise.streaming.drain import drain_once
from tests.conftest import rows

SCHEMA = "FECHA date, PARA string, CC string, SUBJECT string, BODY string, PROCESADO string"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_drain_offers_every_pending_row_on_every_run(spark, tmp_shared):
    store = OutboxStore(spark, f"{tmp_shared}/outbox")
    # one row was queued without any log, and one has no date
    store.write_all(spark.createDataFrame([(D1, "a", None, "s1", "b", "N"), (D1, "b", None, "s2", "b", "N"),
                                           (None, "c", None, "s3", "b", "N"), (D1, "d", None, "old", "b", "S")], SCHEMA))
    offered, down = [], {"s2"}

    def deliver(todo):
        offered.append(sorted(r.SUBJECT for r in todo.collect()))
        return todo.where(~F.col("SUBJECT").isin(list(down) or [""])).select("SUBJECT")

    before = written(spark)
    assert drain_once(store, deliver) == 2
    assert rows(store.pending().select("SUBJECT")) == [("s2",)]
    store.replace(spark.createDataFrame([(D2, "c", None, "s1", "again", "N")], SCHEMA))
    assert drain_once(store, deliver) == 1          # s2 failed again, s1 was queued anew
    down.clear()
    assert drain_once(store, deliver) == 1
    assert drain_once(store, deliver) == 0
    assert offered == [["s1", "s2", "s3"], ["s1", "s2"], ["s2"], []]
    assert store.pending().count() == 0 and written(spark) == before


def test_deliver_is_evaluated_once(spark, tmp_shared):
    store = OutboxStore(spark, f"{tmp_shared}/outbox")
    store.write_all(spark.createDataFrame([(D1, "a", None, f"s{i}", "b", "N") for i in range(5)], SCHEMA))
    sends = spark.sparkContext.accumulator(0)

    def deliver(todo):
        def send(batches):
            for b in batches:
                sends.add(b.num_rows)
                yield b
        return todo.select("SUBJECT").mapInArrow(send, "SUBJECT string")

    assert drain_once(store, deliver) == 5 and sends.value == 5
