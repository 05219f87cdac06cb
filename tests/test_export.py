import csv
import datetime as dt
import glob

import pytest

from monthwise.session import shared_path
from monthwise.sources import export as E
from monthwise.sources.tables import read_table
from tests.conftest import SF_SMALL, rows


def test_export_csv_roundtrip(spark):
    df = read_table(spark, SF_SMALL, "orders")
    path = E.export_csv(df, shared_path(spark, "test-export", "orders"))
    assert rows(E.read_csv(spark, path, df.schema)) == rows(df)


def test_export_tables_parallel(spark):
    names = ["region", "nation", "supplier"]
    tables = [(read_table(spark, SF_SMALL, n), n.upper()) for n in names]
    done = E.export_tables(spark, tables, shared_path(spark, "test-export", "tables"))
    assert [s for s, _ in done] == ["REGION", "NATION", "SUPPLIER"]
    for (sheet, path), (df, _) in zip(done, tables):
        assert path.endswith("/" + sheet)
        assert E.read_csv(spark, path, df.schema).count() == df.count()


TEXTS = ["", "  pad ", None, 'q"uo"te', '"', '""', "back\\slash", "\\", '\\"', "a,b;c", "line\nbreak", "cr\rhere",
         "crlf\r\nx", "\ttab\t", "NULL", "\\N", "é日", "#c", "'x'", " ", "\n", "\r"]


@pytest.mark.parametrize("sep", [",", ";"])
def test_export_csv_keeps_every_value(spark, sep):
    df = spark.createDataFrame([(i, t, None if i % 2 else i / 3) for i, t in enumerate(TEXTS)],
                               "id int, txt string, v double")
    path = E.export_csv(df.repartition(2), shared_path(spark, "test-export", "values"), sep=sep)
    got = {r.id: (r.txt, r.v) for r in E.read_csv(spark, path, df.schema, sep=sep).collect()}
    assert got == {i: (t, None if i % 2 else i / 3) for i, t in enumerate(TEXTS)}


def test_csv_of_other_tools(spark):
    """Quotes are doubled, as the csv module reads and writes them."""
    df = spark.createDataFrame([(1, 'say "x", then\ngo')], "id int, txt string")
    path = E.export_csv(df.coalesce(1), shared_path(spark, "test-export", "tools"))
    [part] = glob.glob(path.replace("file:", "") + "/part-*.csv")
    assert list(csv.reader(open(part, newline=""))) == [["id", "txt"], ["1", 'say "x", then\ngo']]


def test_export_name(spark):
    assert E.export_name("Parque", dt.date(2025, 1, 31)) == "Parque_Dic_24"
    df = spark.createDataFrame([(1,)], "id int")
    [(sheet, path)] = E.export_tables(spark, [(df, "A")], shared_path(spark, "test-export", "named"), name="Parque",
                                      as_of=dt.date(2025, 5, 2))
    assert path.endswith("/Parque_Abr_25/A")
