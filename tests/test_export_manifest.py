"""Exports whose manifest tells a changed, lost or doubled part."""

import datetime as dt
import decimal
import glob
import os
import shutil

import pytest

from monthwise.sources.export_manifest import export_parts, read_manifest, read_parts, verify_parts
from tests.conftest import rows

SCHEMA = "id long, t string, x double, m decimal(10,2), d date, ts timestamp"


def table(spark, n=400):
    odd = ["plain", "", None, 'quo"te', "line\nbreak", "\r\n", "  padded ", "é,日", "back\\slash", '"', "x" * 500]
    data = [(i, odd[i % len(odd)], None if i % 5 == 0 else i / 7, decimal.Decimal(i).scaleb(-2), dt.date(2024, 1, 1 + i % 28),
             dt.datetime(2024, 1, 1, 2, 3, i % 60)) for i in range(n)]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


@pytest.fixture
def export(spark, tmp_shared):
    df = table(spark)
    path = f"{tmp_shared}/csv"
    export_parts(df, path, max_part_bytes=6000)
    return df, path


def statuses(spark, df, path):
    return {r["part"]: r["status"] for r in verify_parts(spark, path, df.schema).collect()}


def test_parts_are_bounded_and_whole(spark, export):
    df, path = export
    assert rows(read_parts(spark, path, df.schema).drop("part")) == rows(df)
    files = glob.glob(f"{path}/part=*/*.csv")
    manifest = read_manifest(spark, path).collect()
    assert len(files) == len(manifest) > 5 and all(r["n_bytes"] <= 6000 for r in manifest)
    header = len(",".join(df.columns)) + 1
    assert sorted(os.path.getsize(f) - header for f in files) == sorted(r["n_bytes"] for r in manifest)
    assert set(statuses(spark, df, path).values()) == {"ok"}
    assert sum(r["n_rows"] for r in manifest) == 400


def damage(path, what):
    folder = sorted(glob.glob(f"{path}/part=*"))[2]
    part, file = int(folder.rsplit("=", 1)[1]), glob.glob(f"{folder}/*.csv")[0]
    crc = os.path.join(folder, f".{os.path.basename(file)}.crc")
    if os.path.exists(crc):
        os.replace(crc, f"{path}/_crc")
    with open(file, newline="") as f:
        lines = f.read()
    if what == "changed":
        with open(file, "w", newline="") as f:
            f.write(lines.replace("2024-01-0", "2025-01-0", 1))
    elif what == "doubled":
        shutil.copy(file, f"{folder}/again.csv")
    elif what == "lost":
        os.replace(file, f"{path}/_gone")
    elif what == "extra":
        os.mkdir(f"{path}/part=9999")
        shutil.copy(file, f"{path}/part=9999/x.csv")
        part = 9999
    return part


@pytest.mark.parametrize("what,status", [("changed", "changed"), ("doubled", "changed"), ("lost", "lost"), ("extra", "extra")])
def test_damage_is_found_in_its_part(spark, export, what, status):
    df, path = export
    part = damage(path, what)
    got = statuses(spark, df, path)
    assert got.pop(part) == status and set(got.values()) == {"ok"}


def test_a_row_beyond_the_bound_has_a_part_of_its_own_size(spark, tmp_shared):
    df = spark.createDataFrame([(i, "y" * (20_000 if i == 7 else 50)) for i in range(100)], "id long, t string")
    manifest = export_parts(df, f"{tmp_shared}/big", max_part_bytes=2000).collect()
    assert sorted(r["n_bytes"] > 2000 for r in manifest) == [False] * (len(manifest) - 1) + [True]
    assert rows(read_parts(spark, f"{tmp_shared}/big", df.schema).drop("part")) == rows(df)


def test_empty_table(spark, tmp_shared):
    df = table(spark).where("id < 0")
    assert export_parts(df, f"{tmp_shared}/none").count() == 0
    assert verify_parts(spark, f"{tmp_shared}/none", df.schema).count() == 0
